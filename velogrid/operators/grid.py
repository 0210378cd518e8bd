"""The dense grid: every half hour of every station, with departures, arrivals, rider mix,
calendar and lags.

Departures carry the end of their half hour and arrivals its start, so the row of 10:30 pairs the
departures of [10:00, 10:30) with the arrivals of [10:30, 11:00).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.functions.slots import slot_number, slot_of, slot_start, slot_time, with_calendar
from velogrid.operators.columns import with_missing
from velogrid.operators.enrich import add_users, add_users_balanced
from velogrid.operators.stations import first_seen_stations
from velogrid.schemas import (
    CALENDAR,
    FEMALE,
    LAGGED,
    LAGS,
    SLOT_MINUTES,
    STATION_COLUMNS,
    TRIP_SCHEMA,
    UNKNOWN_MODEL,
    lag_columns,
)

STRETCH = 28 * 48  # slots per stretch of the grid, four weeks of half hours
SUMS = ["duraciones", "dur_suma", "dur_cuadrados", "edades", "edad_suma", "edad_cuadrados", "mujeres"]
RIDER_COLUMNS = [
    "despachos_count",
    "duracion_recorrido_mean",
    "duracion_recorrido_std",
    "duracion_recorrido_count",
    "edad_usuario_mean",
    "edad_usuario_std",
    "proporcion_mujeres",
    "modelo_mas_comun",
]


def slot_span(trips: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """First and last slot of the grid: the first departure label to the last arrival label."""
    slots = trips.select(
        (slot_of("fecha_origen_recorrido", minutes) + 1).alias("o"), slot_of("fecha_destino_recorrido", minutes).alias("d")
    )
    return slots.agg(F.expr("named_struct('desde', min(o), 'hasta', max(d))").alias("rango"))


def slot_traffic(trips: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Trips summed per trip end, slot, station and bike model, from a single scan.

    Each trip gives a departure and an arrival row; the state is counts and sums only, so rows
    are combined before the shuffle and a hot station shrinks to a few rows per task.
    """
    trips = with_missing(trips, [*TRIP_SCHEMA.fields, T.StructField("edad_usuario", T.IntegerType())])
    labelled = trips.select(
        (slot_of("fecha_origen_recorrido", minutes) + 1).alias("o"),
        slot_of("fecha_destino_recorrido", minutes).alias("d"),
        *["id_estacion_origen", "id_estacion_destino", "modelo_bicicleta", "genero", "duracion_recorrido", "edad_usuario"],
    )
    ends = f"""array(
        named_struct('llegada', false, 'slot', o, 'id_estacion', id_estacion_origen, 'modelo', modelo_bicicleta,
            'dur', cast(duracion_recorrido as double), 'edad', cast(edad_usuario as double),
            'mujer', if(genero = '{FEMALE}', 1, 0)),
        named_struct('llegada', true, 'slot', d, 'id_estacion', id_estacion_destino, 'modelo', cast(null as string),
            'dur', cast(null as double), 'edad', cast(null as double), 'mujer', 0))"""
    return (
        labelled.selectExpr(f"inline({ends})")
        .filter("slot is not null and id_estacion is not null")
        .groupBy("llegada", "slot", "id_estacion", "modelo")
        .agg(
            F.expr("count(*)").alias("viajes"),
            F.expr("count(dur)").alias("duraciones"),
            F.expr("sum(dur)").alias("dur_suma"),
            F.expr("sum(dur * dur)").alias("dur_cuadrados"),
            F.expr("count(edad)").alias("edades"),
            F.expr("sum(edad)").alias("edad_suma"),
            F.expr("sum(edad * edad)").alias("edad_cuadrados"),
            F.expr("sum(mujer)").alias("mujeres"),
        )
    )


# Totals of one cell from its traffic rows. The commonest model is the one with most trips, the
# smallest name on a tie.
CELL_TOTALS = {
    "despachos": "sum(case when not llegada then viajes end)",
    "arribos": "sum(case when llegada then viajes end)",
    **{c: f"sum({c})" for c in SUMS},
    "modelo": "min(case when not llegada and modelo is not null then named_struct('n', -viajes, 'm', modelo) end).m",
}


def _mean(total: str, n: str) -> str:
    return f"coalesce(try_divide({total}, {n}), 0D)"


def _deviation(n: str, total: str, squares: str) -> str:
    """Sample deviation. The inputs are sums of whole numbers, so equal values give exactly 0."""
    spread = f"greatest({n} * {squares} - {total} * {total}, 0D)"
    return f"coalesce(case when {n} > 1 then sqrt({spread} / (cast({n} as double) * ({n} - 1))) end, 0D)"


# Statistics of one cell from its totals, with the defaults of an empty one.
CELL_COLUMNS = {
    "despachos_count": "coalesce(despachos, 0L)",
    "duracion_recorrido_mean": _mean("dur_suma", "duraciones"),
    "duracion_recorrido_std": _deviation("duraciones", "dur_suma", "dur_cuadrados"),
    "duracion_recorrido_count": "coalesce(duraciones, 0L)",
    "edad_usuario_mean": _mean("edad_suma", "edades"),
    "edad_usuario_std": _deviation("edades", "edad_suma", "edad_cuadrados"),
    "proporcion_mujeres": _mean("mujeres", "despachos"),
    "modelo_mas_comun": f"coalesce(modelo, '{UNKNOWN_MODEL}')",
}


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in expressions.items()]


def departures(trips: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Departures and rider statistics per (half hour, station) that saw any."""
    totals = (
        slot_traffic(trips, minutes)
        .filter("not llegada")
        .groupBy("slot", "id_estacion")
        .agg(*[F.expr(e).alias(n) for n, e in CELL_TOTALS.items()])
    )
    return totals.withColumn("timestamp", slot_start("slot", minutes)).selectExpr(
        "timestamp", "id_estacion", *_named(CELL_COLUMNS)
    )


def arrivals(trips: DataFrame, minutes: int = SLOT_MINUTES, shift: int = 0, name: str = "arribos_count") -> DataFrame:
    """Arrivals per (half hour, station), labelled ``shift`` windows later."""
    return (
        trips.select(
            (slot_of("fecha_destino_recorrido", minutes) + shift).alias("slot"), F.col("id_estacion_destino").alias("id_estacion")
        )
        .filter("slot is not null and id_estacion is not null")
        .groupBy("slot", "id_estacion")
        .agg(F.count("*").alias(name))
        .select(slot_start("slot", minutes).alias("timestamp"), "id_estacion", name)
    )


def previous_arrivals(trips: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    return arrivals(trips, minutes, 1, "arribos_prev_count")


def _skeleton_slots(stations: DataFrame, span: DataFrame, lead: int, stretch: int) -> DataFrame:
    """Every slot of every station, cut into stretches that also hold the ``lead`` slots before them.

    The small (station, stretch) table is spread first, so no task writes out a whole grid. The
    station attributes travel as one struct, which also marks the rows as part of the grid.
    """
    start = f"tramo * {stretch}"
    slots = f"sequence(greatest(rango.desde, {start} - {lead}), least(rango.hasta, {start} + {stretch - 1}))"
    return (
        stations.select("id_estacion", F.struct(*STATION_COLUMNS[1:]).alias("estacion"))
        .withColumn("rango", span.scalar())
        .filter("rango.desde <= rango.hasta")
        .selectExpr(
            "id_estacion",
            "estacion",
            "rango",
            f"explode(sequence(cast(floor(rango.desde / {stretch}) as int), cast(floor(rango.hasta / {stretch}) as int))) as tramo",
        )
        .repartition("id_estacion", "tramo")
        .selectExpr("id_estacion", "estacion", "tramo", f"explode({slots}) as slot")
    )


def dense_skeleton(trips: DataFrame, stations: DataFrame | None = None, minutes: int = SLOT_MINUTES) -> DataFrame:
    """All timestamps of the range for all stations."""
    stations = first_seen_stations(trips) if stations is None else stations
    slots = _skeleton_slots(stations, slot_span(trips, minutes), 0, STRETCH)
    return slots.select(slot_start("slot", minutes).alias("timestamp"), "id_estacion")


def _placed(traffic: DataFrame, lags: int, stretch: int) -> DataFrame:
    """Traffic rows in their stretch, and in the next one if that looks back on them.

    An arrival counts once more, as a previous arrival, one slot later.
    """
    own = "named_struct('slot', slot, 'llegada', llegada, 'viajes', viajes, 'previos', cast(null as bigint))"
    later = "named_struct('slot', slot + 1, 'llegada', cast(null as boolean), 'viajes', cast(null as bigint), 'previos', viajes)"
    rows = traffic.selectExpr(
        "id_estacion", "modelo", *SUMS, f"inline(case when llegada then array({own}, {later}) else array({own}) end)"
    )
    first, last = f"cast(floor(slot / {stretch}) as int)", f"cast(floor((slot + {lags}) / {stretch}) as int)"
    return rows.selectExpr("*", f"explode(sequence({first}, {last})) as tramo")


def _time(at: datetime | str) -> datetime:
    return at if isinstance(at, datetime) else datetime.fromisoformat(at)


def _in_slots(ts: str, low: int | None, high: int | None, label: int, minutes: int) -> Column:
    """Times that count in the slots from ``low`` to ``high``, which are labelled ``label`` slots later.

    One slot more on the low side: an arrival counts once more in the slot after its own.
    """
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(ts) >= F.lit(str(slot_time(low - label - 1, minutes))).cast("timestamp_ntz"))
    if high is not None:
        inside = inside & (F.col(ts) < F.lit(str(slot_time(high - label + 1, minutes))).cast("timestamp_ntz"))
    return inside


def station_grid(
    trips: DataFrame,
    users: DataFrame | None = None,
    stations: DataFrame | None = None,
    minutes: int = SLOT_MINUTES,
    lags: int = LAGS,
    stretch: int = STRETCH,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    salt: int | None = 1,
) -> DataFrame:
    """The full feature grid: one row per timestamp and station.

    Traffic rows and skeleton rows are stacked and shuffled once by (station, stretch of time).
    The totals per cell and all lags are then taken inside that partitioning. A stretch carries
    the last ``lags`` slots of the one before it, so lags cross its edge, and a grid of few
    stations still spreads over the cluster. Traffic outside the range has no skeleton row and
    falls out. ``users`` are joined only where ages are summed; stations and range are read from
    the trips alone, in narrow scans.

    ``since`` and ``until`` (both belong to the grid) cut it to a range: the rows are those of the full grid, but only
    trips that leave or arrive in the range or its lags are summed, by bounds on the two time columns that reach the
    scan where the trips store them. One trip dated decades away then adds no slots. ``salt`` splits the trips of
    riders with a large share of all trips (see ``add_users``); with None such riders are found and split (``add_users_balanced``).
    """
    if lags >= stretch:
        raise ValueError("a stretch must be longer than the lags")
    stations = first_seen_stations(trips) if stations is None else stations
    span = slot_span(trips, minutes)
    first, last = (None if x is None else slot_number(_time(x), minutes) for x in (since, until))
    if first is not None and slot_time(first, minutes) < _time(since):
        first += 1  # a slot that starts before the range isn't part of it
    if first is not None or last is not None:
        low, high = (None if first is None else first - lags), last
        bounds = F.struct(
            F.greatest("rango.desde", F.lit(low)).alias("desde"), F.least("rango.hasta", F.lit(high)).alias("hasta")
        ).alias("rango")
        span = span.select(bounds)
        trips = trips.filter(_in_slots("fecha_origen_recorrido", low, high, 1, minutes) | _in_slots("fecha_destino_recorrido", low, high, 0, minutes))
    skeleton = _skeleton_slots(stations, span, lags, stretch)
    if users is not None:
        ages = users.select("id_usuario", "edad_usuario")
        trips = add_users_balanced(trips, ages) if salt is None else add_users(trips, ages, salt=salt)
    placed = _placed(slot_traffic(trips, minutes), lags, stretch)

    totals = {"estacion": "max(estacion)", "previos": "sum(previos)", **CELL_TOTALS}
    cells = (
        skeleton.unionByName(placed, allowMissingColumns=True)
        .repartition("id_estacion", "tramo")
        .groupBy("id_estacion", "tramo", "slot")
        .agg(*[F.expr(e).alias(n) for n, e in totals.items()])
        .filter("estacion is not null")
        .selectExpr(
            "id_estacion",
            "tramo",
            "slot",
            "estacion.*",
            *_named(CELL_COLUMNS),
            "coalesce(arribos, 0L) as arribos_count",
            "coalesce(previos, 0L) as arribos_prev_count",
        )
    )
    over = "over (partition by id_estacion, tramo order by slot)"
    lagged = [
        f"lag({c}, {k}, {'0L' if c.endswith('_count') else '0D'}) {over} as {c}_prev_{k}"
        for k in range(1, lags + 1)
        for c in LAGGED
    ]
    rows = cells.selectExpr("*", *lagged).filter(f"floor(slot / {stretch}) = tramo")
    if first is not None:
        rows = rows.filter(F.col("slot") >= first)
    full = with_calendar(rows.withColumn("timestamp", slot_start("slot", minutes)))
    return full.select(
        "timestamp",
        *STATION_COLUMNS,
        *RIDER_COLUMNS,
        "arribos_count",
        "arribos_prev_count",
        *CALENDAR,
        *(lag_columns(lags) if lags else []),
    )
