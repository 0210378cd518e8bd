"""The registered queries. Each takes a session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.functions.slots import floor_window
from velogrid.operators import cleaning as C
from velogrid.operators import comparison as K
from velogrid.operators import demand_score as S
from velogrid.operators import grid as G
from velogrid.operators import learning as L
from velogrid.operators import metrics as M
from velogrid.operators import profile as P
from velogrid.operators import scaling as N
from velogrid.operators import scoring as R
from velogrid.operators import splits as W
from velogrid.operators import stations as A
from velogrid.operators.columns import feature_columns, prepare_features
from velogrid.operators.enrich import add_users
from velogrid.plans import flows
from velogrid.registry import parts
from velogrid.schemas import BASE_FEATURES, TARGET, lag_columns
from velogrid.session import staged, work_path
from velogrid.sources import files, sinks, views
from velogrid.stages import stage
from velogrid.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

DIGITS = 6
DAY = "2024-01-09"
INSTANTS = [f"2024-01-09 {h:02d}:00:00" for h in range(12, 19)]


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Comparable columns: whole numbers as bigint, floating ones rounded, dates as text."""

    def as_text(f: T.StructField) -> str:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return f"round(cast(`{f.name}` as double), {digits}) as `{f.name}`"
        if isinstance(f.dataType, T.IntegralType):
            return f"cast(`{f.name}` as bigint) as `{f.name}`"
        if isinstance(f.dataType, T.DateType):
            return f"cast(`{f.name}` as string) as `{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            return f"cast(`{f.name}` as timestamp_ntz) as `{f.name}`"
        return f"`{f.name}`"

    return df.selectExpr(*[as_text(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a function as query ``name``; ``sql`` is its counterpart."""

    def add(fn: Query) -> Query:
        _QUERIES[name] = lambda spark, folder: tidy(fn(spark, folder), digits)
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def r(*columns: str, digits: int = DIGITS) -> str:
    """SQL: rounded columns under their own names."""
    return ", ".join(f'round(cast("{c}" as double), {digits}) as "{c}"' for c in columns)


def b(*columns: str) -> str:
    """SQL: whole columns as bigint under their own names."""
    return ", ".join(f'cast("{c}" as bigint) as "{c}"' for c in columns)


# --- inputs -----------------------------------------------------------------


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return views.trips_view(spark, folder)


def valid(spark: SparkSession, folder: str) -> DataFrame:
    return C.valid_trips(trips(spark, folder))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return C.clean_users(views.users_view(spark, folder))


def grid(spark: SparkSession, folder: str, lags: int = 0, **cut) -> DataFrame:
    return G.station_grid(valid(spark, folder), users(spark, folder), lags=lags, **cut)


def staged_grid(spark: SparkSession, folder: str, lags: int = 0) -> DataFrame:
    """The grid as a stage that queries share, clustered by station."""
    return stage(grid(spark, folder, lags), "grid", "id_estacion", ("timestamp",)).read()


def parts_and_days(spark: SparkSession, folder: str, columns: list[str] | None = None, lags: int = 0) -> tuple[DataFrame, DataFrame]:
    """The staged grid, and its validation days as a stage of their own, a row per week."""
    full = staged_grid(spark, folder, lags)
    days = stage(W.validation_days(full), "days").read()
    return full.select(*columns) if columns else full, days


def split(spark: SparkSession, folder: str, columns: list[str] | None = None, lags: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows."""
    rows, days = parts_and_days(spark, folder, columns, lags)
    return W.split_by_week(rows, days=days)


def flagged(spark: SparkSession, folder: str, columns: list[str] | None = None, lags: int = 0) -> DataFrame:
    """Both parts in one scan, told apart by ``parte``."""
    return W.with_part(*parts_and_days(spark, folder, columns, lags))


PRED_COLUMNS = [
    "timestamp",
    "id_estacion",
    "lat_estacion",
    "long_estacion",
    "despachos_count",
    "duracion_recorrido_mean",
    TARGET,
    "hora",
    "dia_semana",
]


def predicted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(train, validation) with the profile prediction."""
    train, val = split(spark, folder, PRED_COLUMNS)
    return L.predict_from_profile(train, train), L.predict_from_profile(val, train)


def comparison(spark: SparkSession, folder: str, hour: int | None = None) -> DataFrame:
    val = predicted(spark, folder)[1]
    return K.compare_stations(val, A.first_seen_stations(trips(spark, folder)), hour)


def stock(spark: SparkSession, folder: str) -> DataFrame:
    return A.with_station_status(views.with_availability(A.catalog(trips(spark, folder))))


# --- the grid ---------------------------------------------------------------

GRID_INTS = ["id_estacion", "despachos_count", "duracion_recorrido_count", "arribos_count", "arribos_prev_count", "hora", "dia_semana", "es_fin_semana", "mes", "dia_mes", "año"]
GRID_REALS = ["lat_estacion", "long_estacion", "duracion_recorrido_mean", "duracion_recorrido_std", "edad_usuario_mean", "edad_usuario_std", "proporcion_mujeres"]
GRID_TEXT = '"timestamp", nombre_estacion, direccion_estacion, modelo_mas_comun'
LAG_INTS = [c for c in lag_columns() if "_count_prev" in c]
LAG_REALS = [c for c in lag_columns() if "_count_prev" not in c]


@query("station_grid", parts.sql(["grid"], f"select {GRID_TEXT}, {b(*GRID_INTS)}, {r(*GRID_REALS)} from grid"))
def station_grid(spark, folder):
    return grid(spark, folder)


@query(
    "station_grid_with_lags",
    parts.sql(["lagged"], f"select {GRID_TEXT}, {b(*GRID_INTS, *LAG_INTS)}, {r(*GRID_REALS, *LAG_REALS)} from lagged"),
)
def station_grid_with_lags(spark, folder):
    return grid(spark, folder, 6)


@query("dense_skeleton", parts.sql(["skeleton"], 'select ts as "timestamp", id_estacion from skeleton'))
def dense_skeleton(spark, folder):
    return G.dense_skeleton(valid(spark, folder))


DEP_REALS = ["duracion_recorrido_mean", "duracion_recorrido_std", "edad_usuario_mean", "edad_usuario_std", "proporcion_mujeres"]


@query(
    "departures_per_slot",
    parts.sql(
        ["dep", "modes"],
        f"""select "timestamp", id_estacion, {b('despachos_count', 'duracion_recorrido_count')}, {r(*DEP_REALS)}, modelo_mas_comun
  from (select d.*, d.ts as "timestamp", coalesce(m.modelo, 'UNKNOWN') as modelo_mas_comun
    from dep d left join modes m on d.ts = m.ts and d.id_estacion = m.id_estacion)""",
    ),
)
def departures_per_slot(spark, folder):
    return G.departures(add_users(valid(spark, folder), users(spark, folder)))


@query("arrivals_per_slot", parts.sql(["arr"], 'select ts as "timestamp", id_estacion, arribos_count from arr'))
def arrivals_per_slot(spark, folder):
    return G.arrivals(valid(spark, folder))


@query(
    "previous_arrivals_per_slot",
    parts.sql(["arr"], """select ts + interval '30 minutes' as "timestamp", id_estacion, arribos_count as arribos_prev_count from arr"""),
)
def previous_arrivals_per_slot(spark, folder):
    return G.previous_arrivals(valid(spark, folder))


@query("grid_range", parts.sql(["span"], "select desde, hasta from span"))
def grid_range(spark, folder):
    span = G.slot_span(valid(spark, folder))
    return span.select(*[G.slot_start(f"rango.{c}").alias(c) for c in ("desde", "hasta")])


@query(
    "first_seen_stations",
    parts.sql(["stations"], f"select id_estacion, nombre_estacion, direccion_estacion, {r('lat_estacion', 'long_estacion')} from stations"),
)
def first_seen_stations(spark, folder):
    return A.first_seen_stations(valid(spark, folder))


@query(
    "trip_windows",
    parts.sql(
        ["trips"],
        """select id_recorrido, time_bucket(interval '30 minutes', fecha_origen_recorrido) as origen_30,
  time_bucket(interval '15 minutes', fecha_destino_recorrido) as destino_15, cast(isodow(fecha_origen_recorrido) - 1 as bigint) as dia_semana,
  cast(weekofyear(fecha_origen_recorrido) as bigint) as semana from trips""",
    ),
)
def trip_windows(spark, folder):
    o = "fecha_origen_recorrido"
    return trips(spark, folder).select(
        "id_recorrido",
        floor_window(o).alias("origen_30"),
        floor_window("fecha_destino_recorrido", 15).alias("destino_15"),
        F.weekday(o).alias("dia_semana"),
        F.weekofyear(o).alias("semana"),
    )


# --- reading, cleaning, filters ---------------------------------------------

CLEAN_COLUMNS = (
    f"{b('id_recorrido', 'duracion_recorrido', 'id_estacion_origen', 'id_estacion_destino', 'id_usuario')}, "
    f"{r('lat_estacion_origen', 'long_estacion_origen', 'lat_estacion_destino', 'long_estacion_destino')}, "
    "modelo_bicicleta, genero, fecha_origen_recorrido, fecha_destino_recorrido"
)
CLEAN_NAMES = [
    "id_recorrido", "duracion_recorrido", "id_estacion_origen", "id_estacion_destino", "id_usuario", "lat_estacion_origen",
    "long_estacion_origen", "lat_estacion_destino", "long_estacion_destino", "modelo_bicicleta", "genero",
    "fecha_origen_recorrido", "fecha_destino_recorrido",
]


def raw_csv(spark: SparkSession, folder: str, packed: bool) -> str:
    """The raw text trips as CSV files."""
    path = work_path(spark, "raw")
    views.raw_trips_view(spark, folder, packed).write.option("header", True).option("escape", '"').csv(path)
    return path


@query("clean_trips_packed_coordinates", parts.sql(["packed"], f"select {CLEAN_COLUMNS} from packed"))
def clean_trips_packed_coordinates(spark, folder):
    return files.read_trips(spark, raw_csv(spark, folder, True)).select(*CLEAN_NAMES)


@query("clean_trips_decimal_comma", parts.sql(["comma"], f"select {CLEAN_COLUMNS} from comma"))
def clean_trips_decimal_comma(spark, folder):
    return files.read_trips(spark, raw_csv(spark, folder, False)).select(*CLEAN_NAMES)


@query(
    "union_of_years",
    parts.sql(["packed", "comma"], f"select {CLEAN_COLUMNS} from packed union all select {CLEAN_COLUMNS} from comma"),
)
def union_of_years(spark, folder):
    base = work_path(spark, "years")
    for year, packed in ((2022, True), (2023, False), (2020, False)):
        raw = views.raw_trips_view(spark, folder, packed).withColumn("X", F.lit("1"))
        raw.write.option("header", True).option("escape", '"').csv(f"{base}/{year}")
    configs = [
        files.YearFile(f"{base}/2020", use=False),
        files.YearFile(f"{base}/2022", drop=("X", "Unnamed: 0"), rename={"Género": "genero"}),
        files.YearFile(f"{base}/2023", drop=("X",)),
    ]
    return files.read_years(spark, configs).select(*CLEAN_NAMES)


@query(
    "user_files",
    parts.sql(["users_raw"], "select id_usuario, edad_usuario, cast(anio as bigint) as anio from users_raw, (values (2023), (2024)) y(anio)"),
)
def user_files(spark, folder):
    base = work_path(spark, "users")
    raw = views.users_view(spark, folder)
    for year, dni in ((2023, True), (2024, False)):
        extra = [F.lit("Yes").alias("Customer.Has.Dni..Yes...No.")] if dni else []
        out = raw.select(
            F.col("id_usuario").alias("ID_usuario"), F.col("edad_usuario").alias("edad.usuario" if dni else "edad_usuario"), F.lit(year).alias("anio"), *extra
        )
        out.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/{year}")
    both = files.read_users(spark, {f"{base}/2023": True, f"{base}/2024": False})
    return both.select(F.col("id_usuario").cast("bigint"), "edad_usuario", F.col("anio").cast("bigint"))


@query("clean_users", parts.sql(["users"], f"select id_usuario, {b('edad_usuario')} from users"))
def clean_users(spark, folder):
    return users(spark, folder)


JOINED = ["id_recorrido", "id_usuario", "edad_usuario"]


@query("trips_with_users", parts.sql(["enriched"], f"select {b(*JOINED)} from enriched"))
def trips_with_users(spark, folder):
    return add_users(valid(spark, folder), users(spark, folder)).select(*JOINED)


@query(
    "trips_with_repeated_users",
    parts.sql(
        ["valid", "users"],
        f"""select {b(*JOINED)} from valid t left join (select * from users union all select id_usuario, edad_usuario + 1 from users
  where id_usuario % 2 = 0) u using (id_usuario)""",
    ),
)
def trips_with_repeated_users(spark, folder):
    u = users(spark, folder)
    again = u.filter("id_usuario % 2 = 0").withColumn("edad_usuario", F.col("edad_usuario") + 1)
    return add_users(valid(spark, folder), u.unionByName(again), salt=4).select(*JOINED)


@query(
    "trips_with_deduped_users",
    parts.sql(
        ["valid", "users"],
        f"""select {b(*JOINED)} from valid t left join (select id_usuario, min(edad_usuario) as edad_usuario from (select * from users
  union all select id_usuario, edad_usuario + 1 from users) group by 1) u using (id_usuario)""",
    ),
)
def trips_with_deduped_users(spark, folder):
    u = users(spark, folder)
    again = u.withColumn("edad_usuario", F.col("edad_usuario") + 1)
    return add_users(valid(spark, folder), u.unionByName(again), dedupe=True).select(*JOINED)


@query(
    "train_test_cut",
    """select o_orderkey, case when year(o_orderdate) < 1996 or (year(o_orderdate) = 1996 and month(o_orderdate) <= 8) then 'train'
  when year(o_orderdate) = 1996 then 'test' end as parte from orders where year(o_orderdate) <= 1996""",
)
def train_test_cut(spark, folder):
    orders = views.table(spark, folder, "orders")
    train = C.train_part(orders, 1996, 8, "o_orderdate").withColumn("parte", F.lit("train"))
    return train.unionByName(C.test_part(orders, 1996, 8, "o_orderdate").withColumn("parte", F.lit("test"))).select("o_orderkey", "parte")


SLIM = ["timestamp", "id_estacion", "despachos_count", "arribos_count"]
SLIM_SQL = f'"timestamp", {b(*SLIM[1:])}'


@query(
    "grid_of_one_day",
    parts.sql(["grid"], f"""select {SLIM_SQL} from grid where cast("timestamp" as date) = date '{DAY}'"""),
)
def grid_of_one_day(spark, folder):
    return grid(spark, folder, since=DAY, until=f"{DAY} 23:30:00").select(*SLIM)


@query(
    "grid_time_filter",
    parts.sql(
        ["grid"],
        f"""select {SLIM_SQL} from grid where "timestamp" >= timestamp '2024-01-03 08:00:00' and "timestamp" <= timestamp '2024-01-24 08:30:00'
  and hora = 8 and dia_semana = 2""",
    ),
)
def grid_time_filter(spark, folder):
    cut = "2024-01-03 08:00:00", "2024-01-24 08:30:00"
    return C.time_filter(grid(spark, folder, since=cut[0], until=cut[1]), *cut, 8, 2).select(*SLIM)


@query(
    "grid_at_instants",
    parts.sql(["grid"], f"""select {SLIM_SQL} from grid where "timestamp" in ({', '.join(f"timestamp '{i}'" for i in INSTANTS)})"""),
)
def grid_at_instants(spark, folder):
    return C.at_instants(grid(spark, folder, since=INSTANTS[0], until=INSTANTS[-1]), INSTANTS).select(*SLIM)


@query(
    "stage_table_range",
    parts.sql(
        ["grid"],
        f"""select {SLIM_SQL} from grid where "timestamp" >= timestamp '2024-01-10' and "timestamp" < timestamp '2024-01-20'""",
    ),
)
def stage_table_range(spark, folder):
    path = work_path(spark, "stage")
    sinks.write_stage(grid(spark, folder).select(*SLIM), path)
    return files.read_stage(spark, path, "2024-01-10", "2024-01-20").select(*SLIM)


FEATURE_SQL = ", ".join(
    f'cast(coalesce("{c}", 0) as bigint) as "{c}"' if c in GRID_INTS else f'round(cast(coalesce("{c}", 0) as double), {DIGITS}) as "{c}"'
    for c in BASE_FEATURES
    if c != "proporcion_mujeres"
)


@query(
    "prepared_features",
    parts.sql(["grid"], f'select "timestamp", cast(0 as bigint) as proporcion_mujeres, {FEATURE_SQL} from grid'),
)
def prepared_features(spark, folder):
    without = grid(spark, folder).drop("proporcion_mujeres")
    return prepare_features(without, BASE_FEATURES, keep=["timestamp"])


@query(
    "input_checks",
    parts.sql(
        ["trips", "users_raw", "grid"],
        """select 'grid' as entrada, 'processed' as tipo, cast(count(*) filter (where id_estacion is null or "timestamp" is null) = 0 as bigint) as valida from grid
  union all select 'trips', 'raw', 1 union all select 'users', 'unknown', 0""",
    ),
)
def input_checks(spark, folder):
    inputs = {"grid": grid(spark, folder), "trips": trips(spark, folder), "users": views.users_view(spark, folder)}
    rows = [(n, R.input_kind(df), int(R.validate_input(df).valid)) for n, df in inputs.items()]
    return spark.createDataFrame(rows, "entrada string, tipo string, valida bigint")


@query(
    "column_overview",
    parts.sql(
        ["trips"],
        " union all ".join(
            f"select '{c}' as columna, '{t}' as tipo, count({c}) as no_nulos from trips"
            for c, t in (
                ("id_recorrido", "bigint"), ("id_estacion_destino", "bigint"), ("genero", "string"), ("modelo_bicicleta", "string"),
                ("lat_estacion_origen", "double"), ("fecha_destino_recorrido", "timestamp_ntz"),
            )
        ),
    ),
)
def column_overview(spark, folder):
    names = ["id_recorrido", "id_estacion_destino", "genero", "modelo_bicicleta", "lat_estacion_origen", "fecha_destino_recorrido"]
    return sinks.inspect(trips(spark, folder).select(*names))[1]


# --- stations and the catalogue ---------------------------------------------

CATALOG_SQL = f"id, name, address, {r('lat', 'lng', 'popularity_score')}, {b('total_trips')}"


@query("station_catalog", parts.sql(["catalog"], f"select {CATALOG_SQL} from catalog"))
def station_catalog(spark, folder):
    return A.catalog(trips(spark, folder))


RECORD_SQL = f"""name, address, {r('lat', 'lng', 'popularity_score')}, {b('total_trips', 'available_bikes', 'total_docks')}, status
  from (select * replace (coalesce(name, 'Estación ' || id) as name, coalesce(address, 'Dirección no disponible') as address) from stock)"""


@query("catalog_records", parts.sql(["stock"], f"select cast(id as varchar) as id, {RECORD_SQL}"))
def catalog_records(spark, folder):
    return A.catalog_records(stock(spark, folder)).drop("ocupacion")


@query("catalog_json_round_trip", parts.sql(["stock"], f"select id, {RECORD_SQL}"))
def catalog_json_round_trip(spark, folder):
    path = work_path(spark, "catalog")
    sinks.write_catalog(stock(spark, folder), path, "trips")
    return files.read_station_catalog(spark, path)


@query(
    "catalog_kpis",
    parts.sql(
        ["stock"],
        """select count(*) as estaciones, count(*) filter (where status = 'active') as activas, count(*) filter (where status = 'full') as completas,
  count(*) filter (where status = 'empty') as vacias, count(*) filter (where status = 'maintenance') as mantenimiento,
  cast(sum(available_bikes) as bigint) as bicis_disponibles, cast(sum(total_trips) as bigint) as viajes from stock""",
    ),
)
def catalog_kpis(spark, folder):
    return A.catalog_kpis(stock(spark, folder))


@query(
    "catalog_summary",
    parts.sql(
        ["catalog"],
        """select (select name from catalog order by total_trips desc, id limit 1) as mas_popular, cast(sum(total_trips) as bigint) as total,
  round(avg(total_trips), 6) as promedio from catalog""",
    ),
)
def catalog_summary(spark, folder):
    return A.catalog_summary(A.catalog(trips(spark, folder)))


@query(
    "station_status",
    parts.sql(
        ["stock"],
        """select id, status, available_bikes, total_docks,
  cast(case when total_docks = 0 then null else floor(available_bikes / total_docks * 100 + 0.5) end as bigint) as ocupacion from stock""",
    ),
)
def station_status(spark, folder):
    return stock(spark, folder).select("id", "status", "available_bikes", "total_docks", "ocupacion")


@query("stations_by_status", parts.sql(["stock"], "select id, status from stock where status = 'full'"))
def stations_by_status(spark, folder):
    return C.with_status(stock(spark, folder), "full").select("id", "status")


@query("busiest_stations", parts.sql(["traffic"], "select * from traffic order by trafico desc, id_estacion limit 20"))
def busiest_stations(spark, folder):
    return A.busiest(A.traffic(trips(spark, folder)), 20, "trafico", "id_estacion")


@query("quietest_stations", parts.sql(["traffic"], "select * from traffic where trafico > 0 order by trafico, id_estacion limit 10"))
def quietest_stations(spark, folder):
    return A.quietest(A.traffic(trips(spark, folder)), 10)


@query("station_choices", parts.sql(["catalog"], "select id, name from catalog order by total_trips desc, id limit 50"))
def station_choices(spark, folder):
    return A.busiest(A.catalog(trips(spark, folder)), 50).select("id", "name")


@query(
    "top_origins_and_destinations",
    parts.sql(
        ["catalog"],
        """select id, name as station, total_trips as count, 'origen' as type from (select * from catalog order by total_trips desc, id limit 10)
  union all select id, name, cast(floor(total_trips * 0.8 + 0.5) as bigint), 'destino'
  from (select * from catalog order by popularity_score desc, id limit 10)""",
    ),
)
def top_origins_and_destinations(spark, folder):
    return A.top_ends(A.catalog(trips(spark, folder)))


@query(
    "heat_points",
    parts.sql(
        ["catalog"],
        f"""select id, station, {r('lat', 'lng', 'intensity')}, type from (
  select id, name as station, lat, lng, greatest(0.1, popularity_score / 100) as intensity, 'origen' as type from catalog
  union all select id, name, lat, lng, greatest(0.1, popularity_score / 120), 'destino' from catalog)""",
    ),
)
def heat_points(spark, folder):
    return A.heat_points(A.catalog(trips(spark, folder)))


@query(
    "availability_share",
    parts.sql(
        ["stock"],
        f"""select id, name, available_bikes, {r('parte')} from (select id, name, available_bikes,
  cast(available_bikes as double) / sum(available_bikes) over () as parte from (select * from stock order by total_trips desc, id limit 10))""",
    ),
)
def availability_share(spark, folder):
    return A.availability_share(stock(spark, folder))


REASONS = """array_to_string(list_filter([
  'Popularidad de estación: ' || case when pop = floor(pop) then cast(cast(pop as bigint) as varchar) else cast(cast(pop as double) as varchar) end || '%',
  case when hour(t) between 7 and 9 then 'Hora pico matutina (7-9 AM)' when hour(t) between 17 and 19 then 'Hora pico vespertina (5-7 PM)'
    when hour(t) between 12 and 14 then 'Hora de almuerzo (12-2 PM)' when hour(t) >= 22 or hour(t) <= 6 then 'Hora de bajo tráfico (10 PM - 6 AM)' end,
  case when isodow(t) >= 6 then 'Fin de semana (menor actividad)' else 'Día laborable (mayor actividad)' end,
  case when avail > 0.8 then 'Alta disponibilidad de bicis' when avail < 0.2 then 'Baja disponibilidad de bicis' end,
  case when total_trips > 10000 then 'Estación muy activa (' || format('{:,}', total_trips) || ' viajes históricos)'
    when total_trips > 5000 then 'Estación moderadamente activa (' || format('{:,}', total_trips) || ' viajes históricos)'
    else 'Estación de baja actividad (' || total_trips || ' viajes históricos)' end], lambda x: x is not null), '; ')"""

SLOT_TIMES = """(select distinct time_bucket(interval '30 minutes', fecha_origen_recorrido) as t, id_estacion_origen as so from trips)"""


@query(
    "demand_score",
    parts.sql(
        ["trips", "rated"],
        f"""select id, t as "timestamp", {parts.score('hour(t)', 'isodow(t) >= 6')} as predicted,
  {parts.confidence('hour(t)', 'isodow(t) >= 6')} as confidence, {REASONS} as factors
  from rated join {SLOT_TIMES} x on rated.id = x.so""",
    ),
)
def demand_score(spark, folder):
    """The estimate for every station at every half hour in which it was used."""
    ts = trips(spark, folder)
    used = ts.select(F.col("id_estacion_origen").alias("id"), floor_window("fecha_origen_recorrido").alias("timestamp")).distinct()
    scored = S.demand_score(used.join(stock(spark, folder), "id"))
    return scored.select("id", "timestamp", "predicted", "confidence", F.array_join("factors", "; ").alias("factors"))


@query(
    "score_at_peak_and_low",
    parts.sql(
        ["rated"],
        f"""select id, name, {parts.score('9', 'false')} as "currentPrediction", {parts.confidence('9', 'false')} as confidence,
  {parts.score('18', 'false')} as "peakHourPrediction", {parts.score('3', 'false')} as "lowHourPrediction"
  from (select * from rated order by total_trips desc, id limit 10)""",
    ),
)
def score_at_peak_and_low(spark, folder):
    return S.score_overview(stock(spark, folder), f"{DAY} 09:10:00")


@query(
    "score_of_station",
    parts.sql(
        ["rated"],
        f"""select id, {parts.score('18', 'true')} as predicted, {parts.confidence('18', 'true')} as confidence from rated where id = 7""",
    ),
)
def score_of_station(spark, folder):
    return S.score_of(stock(spark, folder), 7, "2024-01-13 18:00:00").select("id", "predicted", "confidence")


# --- split, scaling, filter -------------------------------------------------


@query("validation_days", parts.sql(["days"], "select cast(fecha as varchar) as fecha from days"))
def validation_days(spark, folder):
    return W.validation_days(grid(spark, folder))


@query(
    "training_and_validation_rows",
    parts.sql(
        ["train", "val"],
        f"""select 'train' as parte, {SLIM_SQL} from train union all select 'val', {SLIM_SQL} from val""",
    ),
)
def training_and_validation_rows(spark, folder):
    return flagged(spark, folder, SLIM).select("parte", *SLIM)


@query(
    "days_in_both_parts",
    parts.sql(
        ["train", "val"],
        """select count(*) as dias from (select cast("timestamp" as date) from train intersect select cast("timestamp" as date) from val)""",
    ),
)
def days_in_both_parts(spark, folder):
    return W.shared_days(*split(spark, folder, ["timestamp"])).agg(F.count("*").alias("dias"))


@query(
    "rows_per_month",
    parts.sql(
        ["train", "val"],
        """select mes, parte, filas, round(filas / sum(filas) over () * 100, 6) as pct from (
  select month("timestamp") as mes, 'train' as parte, count(*) as filas from train group by 1
  union all select month("timestamp"), 'val', count(*) from val group by 1)""",
    ),
)
def rows_per_month(spark, folder):
    return W.month_shares(flagged(spark, folder, ["timestamp"]))


SCALED = ["id_estacion", "lat_estacion", "long_estacion", "despachos_count", "duracion_recorrido_mean", "duracion_recorrido_std",
          "duracion_recorrido_count", "edad_usuario_mean", "edad_usuario_std", "proporcion_mujeres", "arribos_count", "arribos_prev_count"]
SCALE_SQL = ", ".join(
    f"""round(("{c}" - (select avg("{c}") from train)) / (select case when min("{c}") = max("{c}") then 1 else stddev_pop("{c}") end from train), 6) as "{c}\""""
    for c in SCALED
)


@query(
    "scaler_statistics",
    parts.sql(
        ["train"],
        " union all ".join(
            f"""select '{c}' as columna, round(avg("{c}"), 6) as media, round(case when min("{c}") = max("{c}") then 1 else stddev_pop("{c}") end, 6) as desvio from train"""
            for c in SCALED
        ),
    ),
)
def scaler_statistics(spark, folder):
    train, _ = split(spark, folder)
    columns = N.scaled_columns(train)
    stats = N.scaler_stats(train, columns)
    return stats.select(F.inline(F.array(*[F.struct(F.lit(c).alias("columna"), f"escala.{c}.media", f"escala.{c}.desvio") for c in columns])))


@query(
    "standardised_parts",
    parts.sql(
        ["train", "val"],
        f"""select parte, "timestamp", {b('hora', 'mes')}, {SCALE_SQL} from (select 'train' as parte, * from train union all select 'val', * from val)""",
    ),
)
def standardised_parts(spark, folder):
    return N.standardise_parts(flagged(spark, folder)).select("parte", "timestamp", "hora", "mes", *SCALED)


@query(
    "activity_thresholds",
    parts.sql(
        ["train"],
        """select round(quantile_cont(despachos_count, 0.97), 6) as despachos_count, round(quantile_cont(arribos_count, 0.97), 6) as arribos_count from train""",
    ),
)
def activity_thresholds(spark, folder):
    train, _ = split(spark, folder, SLIM)
    return N.activity_thresholds(train, 0.97).select("umbral.*")


@query(
    "active_intervals",
    parts.sql(
        ["train", "val"],
        f"""select {SLIM_SQL} from val where not (despachos_count <= (select quantile_cont(despachos_count, 0.1) from train)
  and arribos_count <= (select quantile_cont(arribos_count, 0.1) from train))""",
    ),
)
def active_intervals(spark, folder):
    train, val = split(spark, folder, SLIM)
    return N.active_intervals(val, train)


# --- predictions, metrics, comparison ---------------------------------------


@query(
    "profile_predictions",
    parts.sql(["pred"], f'select "timestamp", {b("id_estacion", "arribos_count")}, {r("arribos_predichos")} from pred'),
)
def profile_predictions(spark, folder):
    return predicted(spark, folder)[1].select("timestamp", "id_estacion", "arribos_count", "arribos_predichos")


@query(
    "submission",
    parts.sql(
        ["pred"],
        """select id_estacion, "timestamp", cast(round_even(greatest(arribos_predichos * 4 - 1, 0), 0) as bigint) as arribos_predichos from pred""",
    ),
)
def submission(spark, folder):
    return R.submission(predicted(spark, folder)[1].withColumn("arribos_predichos", F.col("arribos_predichos") * 4 - 1))


R2_SQL = """case when min(arribos_count) = max(arribos_count) then case when sum(power(arribos_count - arribos_predichos, 2)) = 0 then 1 else 0 end
  else 1 - sum(power(arribos_count - arribos_predichos, 2)) / (count(*) * var_pop(arribos_count)) end"""


@query(
    "regression_metrics",
    parts.sql(
        ["pred"],
        f"""select {r('mse', 'mae', 'rmse', 'r2', 'error_promedio', 'error_mediano', 'error_maximo')} from (
  select avg(power(arribos_count - arribos_predichos, 2)) as mse, avg(abs(arribos_count - arribos_predichos)) as mae,
    sqrt(avg(power(arribos_count - arribos_predichos, 2))) as rmse, {R2_SQL} as r2, avg(abs(arribos_count - arribos_predichos)) as error_promedio,
    quantile_cont(abs(arribos_count - arribos_predichos), 0.5) as error_mediano, max(abs(arribos_count - arribos_predichos)) as error_maximo from pred)""",
    ),
)
def regression_metrics(spark, folder):
    return M.regression_metrics(predicted(spark, folder)[1])


STATION_METRICS = f"""(select id_estacion, avg(power(arribos_count - arribos_predichos, 2)) as mse,
  avg(abs(arribos_count - arribos_predichos)) as mae, {R2_SQL} as r2 from pred group by 1)"""


@query("station_metrics", parts.sql(["pred"], f"select id_estacion, {r('mse', 'mae', 'r2')} from {STATION_METRICS}"))
def station_metrics(spark, folder):
    return M.station_metrics(predicted(spark, folder)[1])


@query(
    "best_and_worst_stations",
    parts.sql(
        ["pred"],
        f"""select id_estacion, {r('mse', 'mae', 'r2')}, grupo from (
  select *, 'mejor' as grupo from (select * from {STATION_METRICS} order by r2 desc, id_estacion limit 5)
  union all select *, 'peor' from (select * from {STATION_METRICS} order by r2, id_estacion limit 5))""",
    ),
)
def best_and_worst_stations(spark, folder):
    return M.best_and_worst(M.station_metrics(predicted(spark, folder)[1]))


@query(
    "overfit_gap",
    parts.sql(
        ["pred", "pred_train"],
        f"""select {r('brecha_mse', 'brecha_mae')}, case when brecha_mse < -10 then 'Overfitting' else 'OK' end as estado_mse,
  case when brecha_mae < -10 then 'Overfitting' else 'OK' end as estado_mae from (
  select (t.mse - v.mse) / v.mse * 100 as brecha_mse, (t.mae - v.mae) / v.mae * 100 as brecha_mae
  from (select avg(power(arribos_count - arribos_predichos, 2)) as mse, avg(abs(arribos_count - arribos_predichos)) as mae from pred_train) t,
    (select avg(power(arribos_count - arribos_predichos, 2)) as mse, avg(abs(arribos_count - arribos_predichos)) as mae from pred) v)""",
    ),
)
def overfit_gap(spark, folder):
    rows = flagged(spark, folder, PRED_COLUMNS)
    return M.overfit_gap_of(L.predict_from_profile(rows, rows.where("parte = 'train'")))


@query(
    "residual_statistics",
    parts.sql(
        ["pred"],
        f"""select {r('real_media', 'real_desvio', 'predicho_media', 'residuo_media', 'residuo_desvio')}, {b('real_min', 'real_max')} from (
  select avg(arribos_count) as real_media, stddev_samp(arribos_count) as real_desvio, min(arribos_count) as real_min, max(arribos_count) as real_max,
    avg(arribos_predichos) as predicho_media, avg(arribos_count - arribos_predichos) as residuo_media,
    stddev_samp(arribos_count - arribos_predichos) as residuo_desvio from pred)""",
    ),
)
def residual_statistics(spark, folder):
    return M.residual_stats(predicted(spark, folder)[1])


COMPARED = f"""id_estacion, nombre_estacion, {r('lat_estacion', 'lng_estacion', 'error_prediccion', 'accuracy', 'duracion_promedio')},
  {b('arribos_reales', 'salidas_reales', 'arribos_predichos', 'total_viajes')}"""


@query(
    "station_comparison",
    parts.sql(["comparison"], f"select {COMPARED}, cast(8 as bigint) as hour from comparison", where="where hora = 8"),
)
def station_comparison(spark, folder):
    return comparison(spark, folder, 8)


@query(
    "comparison_of_one_day",
    parts.sql(
        ["comparison", "days"],
        f"select {COMPARED}, cast(9 as bigint) as hour from comparison",
        where="""where hora = 9 and cast("timestamp" as date) = date '2024-01-02'""",
    ).replace("from val v", "from grid v"),
)
def comparison_of_one_day(spark, folder):
    """A given day of the whole grid, scored with the profile of the train part."""
    full = staged(spark, grid(spark, folder).select(*PRED_COLUMNS), "grid")
    train, _ = W.split_by_week(full)
    scored = L.predict_from_profile(full, train)
    return flows.compare_day(scored, A.first_seen_stations(trips(spark, folder)), "2024-01-02", 9)[0]


@query(
    "predictions_with_names",
    parts.sql(
        ["pred", "all_stations"],
        f"""select p."timestamp", p.id_estacion, {r('arribos_predichos')}, s.nombre_estacion, s.direccion_estacion
  from pred p left join all_stations s on p.id_estacion = s.id_estacion""",
    ),
)
def predictions_with_names(spark, folder):
    val = predicted(spark, folder)[1].select("timestamp", "id_estacion", "arribos_predichos")
    return K.with_station_names(val, A.first_seen_stations(trips(spark, folder)))


PERFORMANCE_SQL = """round(round_even(avg(abs(arribos_reales - arribos_predichos)), 2), 6) as mae,
  round(round_even(sqrt(avg(power(arribos_reales - arribos_predichos, 2))), 2), 6) as rmse, round(round_even(avg(accuracy), 3), 6) as avg_accuracy,
  count(*) filter (where error_prediccion = 0) as exact_predictions, count(*) as total_stations,
  round(round_even(count(*) filter (where error_prediccion = 0) / count(*), 3), 6) as exact_prediction_rate"""


@query("model_performance", parts.sql(["comparison"], f"select {PERFORMANCE_SQL} from comparison"))
def model_performance(spark, folder):
    return K.model_performance(comparison(spark, folder))


@query(
    "result_summary",
    parts.sql(
        ["comparison", "val"],
        """select count(*) as "totalTrips", count(distinct id_estacion) as "totalStations",
  cast(min("timestamp")::date as varchar) || ' to ' || cast(max("timestamp")::date as varchar) as "dateRange",
  round(round_even(avg(duracion_recorrido_mean), 0), 6) as "avgTripDuration",
  (select string_agg(hora, ',' order by n desc, hora) from (select hora, count(*) as n from val group by 1 order by n desc, hora limit 3)) as "peakHours",
  (select string_agg(nombre_estacion || ':' || total_viajes, ',' order by total_viajes desc, id_estacion) from (
    select * from comparison order by total_viajes desc, id_estacion limit 5)) as "topStations",
  (select round(round_even(avg(abs(arribos_reales - arribos_predichos)), 2), 6) from comparison) as mae,
  (select count(*) from comparison) as "dataPoints" from val""",
    ),
)
def result_summary(spark, folder):
    train, val = split(spark, folder, PRED_COLUMNS)
    rows = K.compare_stations(L.predict_from_profile(val, train), A.first_seen_stations(trips(spark, folder)))
    s = K.result_summary(val, rows)
    return s.select(
        "totalTrips",
        "totalStations",
        "dateRange",
        "avgTripDuration",
        F.array_join(F.col("peakHours").cast("array<string>"), ",").alias("peakHours"),
        F.array_join(F.transform("topStations", lambda t: F.concat(t["name"], F.lit(":"), t["trips"].cast("string"))), ",").alias("topStations"),
        F.col("modelPerformance.mae").alias("mae"),
        "dataPoints",
    )


@query("peak_hours", parts.sql(["dep"], "select cast(hour(ts) as bigint) as hora, count(*) as filas from dep group by 1 order by 2 desc, 1 limit 3"))
def peak_hours(spark, folder):
    return K.peak_hours(G.departures(valid(spark, folder)).select(F.hour("timestamp").alias("hora")))


TOP_SQL = " union all ".join(
    f"select '{by}' as lista, id_estacion, {r(by + '_v')} from (select *, {by} as {by}_v from comparison order by {by} desc, id_estacion limit 5)".replace(
        f'as "{by}_v"', "as valor"
    )
    for by in ("accuracy", "error_prediccion", "total_viajes")
)


@query("top_stations", parts.sql(["comparison"], TOP_SQL))
def top_stations(spark, folder):
    rows = staged(spark, comparison(spark, folder), "comparison")
    lists = [
        K.top_stations(rows, by).select(F.lit(by).alias("lista"), "id_estacion", F.col(by).cast("double").alias("valor"))
        for by in ("accuracy", "error_prediccion", "total_viajes")
    ]
    return files.union_all(lists)


@query(
    "usable_station_coordinates",
    parts.sql(["comparison"], "select id_estacion, total_viajes from comparison where lat_estacion <> 0 and lng_estacion <> 0"),
)
def usable_station_coordinates(spark, folder):
    return C.usable_coordinates(comparison(spark, folder)).select("id_estacion", "total_viajes")


@query(
    "marker_style",
    parts.sql(
        ["comparison"],
        """select id_estacion, case when accuracy > 0.6 then '#059669' when accuracy > 0.4 then '#d97706' else '#dc2626' end as fill_color,
  round(8 + coalesce(v / nullif(max(v) over (), 0), 0) * 20, 6) as radius, round(0.6 + coalesce(v / nullif(max(v) over (), 0), 0) * 0.4, 6) as fill_opacity
  from (select *, greatest(arribos_reales, arribos_predichos) as v from comparison)""",
    ),
)
def marker_style(spark, folder):
    return K.marker_style(comparison(spark, folder)).select("id_estacion", "fill_color", "radius", "fill_opacity")


@query(
    "busiest_by_arrivals",
    parts.sql(
        ["train"],
        """select id_estacion, count(*) as filas, cast(sum(arribos_count) as bigint) as arribos from train group by 1
  order by filas desc, arribos desc, id_estacion limit 30""",
    ),
)
def busiest_by_arrivals(spark, folder):
    return L.busiest_by_target(split(spark, folder, SLIM)[0], 30)


@query(
    "hourly_real_and_predicted",
    parts.sql(
        ["pred"],
        "select hora, cast(sum(arribos_count) as bigint) as viajes, round(sum(arribos_predichos), 6) as predicciones from pred group by 1",
    ),
)
def hourly_real_and_predicted(spark, folder):
    return P.hourly_real_and_predicted(predicted(spark, folder)[1])


# --- profiles ---------------------------------------------------------------


@query(
    "trips_per_period",
    """select cast(year(o_orderdate) as bigint) as anio, cast(month(o_orderdate) as bigint) as mes,
  cast(grouping(year(o_orderdate), month(o_orderdate)) as bigint) as nivel, count(*) as viajes from orders
  group by grouping sets ((year(o_orderdate)), (month(o_orderdate)), (year(o_orderdate), month(o_orderdate)))""",
)
def trips_per_period(spark, folder):
    return P.trips_per_period(views.table(spark, folder, "orders").withColumnRenamed("o_orderdate", "fecha_origen_recorrido"))


@query(
    "trips_per_day",
    parts.sql(["trips"], "select cast(cast(fecha_origen_recorrido as date) as varchar) as fecha, count(*) as viajes from trips group by 1"),
)
def trips_per_day(spark, folder):
    return P.trips_per_day(trips(spark, folder))


@query(
    "trips_per_hour",
    parts.sql(
        ["trips"],
        "select cast(year(fecha_origen_recorrido) as bigint) as anio, cast(hour(fecha_origen_recorrido) as bigint) as hora, count(*) as viajes from trips group by 1, 2",
    ),
)
def trips_per_hour(spark, folder):
    return P.trips_per_hour(trips(spark, folder))


@query(
    "peak_hour",
    parts.sql(["trips"], "select cast(hour(fecha_origen_recorrido) as bigint) as hora_pico, count(*) as viajes from trips group by 1 order by 2 desc, 1 limit 1"),
)
def peak_hour(spark, folder):
    return P.peak_hour(trips(spark, folder))


@query(
    "day_part_shares",
    parts.sql(
        ["trips"],
        ", ".join(
            f"{'select ' if i == 0 else ''}round(count(*) filter (where hour(fecha_origen_recorrido) between {lo} and {hi}) / count(*) * 100, 6) as {n}"
            for i, (n, lo, hi) in enumerate([("manana", 6, 11), ("tarde", 12, 17), ("noche", 18, 23), ("madrugada", 0, 5)])
        )
        + " from trips",
    ),
)
def day_part_shares(spark, folder):
    return P.day_part_shares(trips(spark, folder))


@query(
    "period_cut",
    parts.sql(
        ["trips"],
        f"""select antes, despues, {r('antes_pct', 'despues_pct', 'antes_por_dia', 'despues_por_dia')} from (select antes, despues, antes / n * 100 as antes_pct,
  despues / n * 100 as despues_pct, antes / 213 as antes_por_dia, despues / 153 as despues_por_dia from (select count(*) as n,
    count(*) filter (where fecha_origen_recorrido < timestamp '{DAY}') as antes, count(*) filter (where fecha_origen_recorrido >= timestamp '{DAY}') as despues from trips))""",
    ),
)
def period_cut(spark, folder):
    return P.period_cut(trips(spark, folder), DAY)


@query(
    "duration_profile",
    parts.sql(
        ["trips"],
        f"""select validas, {b('minima', 'maxima')}, menos_60, de_60_a_300, {r('media', 'menos_60_pct', 'de_60_a_300_pct', 'media_menos_60', 'mediana')} from (
  select count(*) as validas, min(d) as minima, max(d) as maxima, avg(d) as media, count(*) filter (where d < 60) as menos_60,
    count(*) filter (where d < 60) / count(*) * 100 as menos_60_pct, count(*) filter (where d >= 60 and d < 300) as de_60_a_300,
    count(*) filter (where d >= 60 and d < 300) / count(*) * 100 as de_60_a_300_pct, avg(d) filter (where d < 60) as media_menos_60,
    quantile_cont(d, 0.5) as mediana from (select duracion_recorrido as d from trips where duracion_recorrido is not null))""",
    ),
)
def duration_profile(spark, folder):
    return P.duration_profile(trips(spark, folder))


@query(
    "duration_histogram",
    parts.sql(
        ["trips"],
        """select cast(bin as bigint) as bin, round(lo + (bin - 1) * (hi - lo) / 60, 6) as desde, count(*) as viajes from (
  select least(cast(floor((d - lo) / ((hi - lo) / 60e0)) as int) + 1, 60) as bin, lo, hi from (
    select d, min(d) over () as lo, max(d) over () as hi from (select cast(duracion_recorrido as double) as d from trips where duracion_recorrido <= 400)))
  group by bin, lo, hi""",
    ),
)
def duration_histogram(spark, folder):
    return P.duration_histogram(trips(spark, folder))


@query("station_traffic", parts.sql(["traffic"], "select * from traffic"))
def station_traffic(spark, folder):
    return P.station_traffic(trips(spark, folder))


@query(
    "traffic_distribution",
    parts.sql(
        ["traffic"],
        """select count(*) as estaciones, count(*) filter (where trafico = 0) as sin_trafico, count(*) filter (where trafico < 10) as menos_10,
  count(*) filter (where trafico < 5000) as menos_5000, round(avg(trafico), 6) as media, round(quantile_cont(trafico, 0.5), 6) as mediana from traffic""",
    ),
)
def traffic_distribution(spark, folder):
    return P.traffic_distribution(P.station_traffic(trips(spark, folder)))


SUPPLIER_TRAFFIC = """(select s_suppkey as id_estacion, coalesce(trafico, 0) as trafico from supplier left join traffic on s_suppkey = id_estacion
  union all select id_estacion, trafico from traffic where id_estacion not in (select s_suppkey from supplier))"""


@query(
    "traffic_tiers",
    parts.sql(
        ["traffic"],
        f"""select nivel, estaciones, media, viajes, round(estaciones / sum(estaciones) over () * 100, 6) as pct from (
  select case when trafico = 0 then 'fantasma' when trafico < 200 then 'poco_activa' when trafico < 500 then 'trafico_bajo' else 'normal' end as nivel,
    count(*) as estaciones, round(avg(trafico), 6) as media, cast(sum(trafico) as bigint) as viajes from {SUPPLIER_TRAFFIC} group by 1)""",
    ),
)
def traffic_tiers(spark, folder):
    """Supplier keys are the station register, so that some stations have no trips."""
    register = views.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id_estacion"))
    return P.traffic_tiers(P.station_traffic(trips(spark, folder), register), (200, 500))


@query(
    "traffic_percentiles",
    parts.sql(
        ["traffic"],
        " union all ".join(
            f"select cast({p} as bigint) as percentil, round(quantile_cont(trafico, {p / 100}), 6) as viajes from traffic" for p in P.TRAFFIC_POINTS
        ),
    ),
)
def traffic_percentiles(spark, folder):
    return P.traffic_percentiles(P.station_traffic(trips(spark, folder)))


@query(
    "quiet_station_impact",
    parts.sql(
        ["traffic", "trips"],
        f"""select estaciones, viajes, {r('estaciones_pct', 'viajes_pct')} from (select count(*) filter (where trafico < 450) as estaciones,
  count(*) filter (where trafico < 450) / count(*) * 100 as estaciones_pct, cast(coalesce(sum(trafico) filter (where trafico < 450), 0) as bigint) as viajes,
  coalesce(sum(trafico) filter (where trafico < 450), 0) / (select count(*) from trips) * 100 as viajes_pct from traffic)""",
    ),
)
def quiet_station_impact(spark, folder):
    return P.quiet_station_impact(trips(spark, folder), 450)


@query(
    "age_value_counts",
    parts.sql(["users_raw"], "select edad_usuario as valor, count(*) as cantidad from users_raw group by 1 order by 2 desc, 1 nulls last limit 20"),
)
def age_value_counts(spark, folder):
    return P.value_counts(views.users_view(spark, folder), "edad_usuario", 20)


@query(
    "non_numeric_ages",
    parts.sql(["ages"], "select texto as valor, count(*) as cantidad from ages where not regexp_full_match(texto, '[0-9]+') group by 1 order by 2 desc, 1 limit 10"),
)
def non_numeric_ages(spark, folder):
    return P.non_numeric_ages(views.users_view(spark, folder))


@query(
    "age_funnel",
    parts.sql(
        ["ages"],
        f"""select originales, solo_digitos, en_rango, menores, mayores, {b('minima', 'maxima')}, {r('solo_digitos_pct', 'en_rango_pct')} from (
  select count(*) as originales, count(edad) as solo_digitos, count(edad) / count(*) * 100 as solo_digitos_pct,
    count(*) filter (where edad between 10 and 100) as en_rango, count(*) filter (where edad between 10 and 100) / count(*) * 100 as en_rango_pct,
    count(*) filter (where edad < 10) as menores, count(*) filter (where edad > 100) as mayores, min(edad) as minima, max(edad) as maxima from ages)""",
    ),
)
def age_funnel(spark, folder):
    return P.age_funnel(views.users_view(spark, folder))


@query(
    "age_bands",
    parts.sql(
        ["users"],
        """select cast(case when edad_usuario = 10 then 1 else ceil((edad_usuario - 10) / 10.0) end as bigint) as banda, count(*) as usuarios from users group by 1""",
    ),
)
def age_bands(spark, folder):
    return P.age_bands(users(spark, folder))


@query("age_summary", parts.sql(["users"], "select round(avg(edad_usuario), 6) as media, round(quantile_cont(edad_usuario, 0.5), 6) as mediana from users"))
def age_summary(spark, folder):
    return P.age_summary(users(spark, folder))


PROFILED = ["id_estacion_origen", "id_estacion_destino", "id_recorrido", "id_usuario", "lat_estacion_origen", "long_estacion_origen",
            "lat_estacion_destino", "long_estacion_destino"]


@query(
    "missing_values",
    parts.sql(
        ["trips"],
        " union all ".join(
            f"select '{c}' as columna, count(*) - count({c}) as faltantes, round((count(*) - count({c})) / count(*) * 100, 6) as pct from trips" for c in PROFILED
        ),
    ),
)
def missing_values(spark, folder):
    return P.missing_values(trips(spark, folder), [*PROFILED, "columna_ausente"])


@query(
    "coordinate_profile",
    parts.sql(
        ["trips"],
        f"""select validas, invalidas, {r('validas_pct', 'lat_min', 'lat_max', 'long_min', 'long_max')} from (
  select count(*) filter (where f) as validas, count(*) filter (where f) / count(*) * 100 as validas_pct, count(*) - count(*) filter (where f) as invalidas,
    min(a) filter (where f) as lat_min, max(a) filter (where f) as lat_max, min(b) filter (where f) as long_min, max(b) filter (where f) as long_max
  from (select lat_estacion_origen as a, long_estacion_origen as b,
    coalesce(lat_estacion_origen between -34.8 and -34.5 and long_estacion_origen between -58.7 and -58.3, false) as f from trips))""",
    ),
)
def coordinate_profile(spark, folder):
    return P.coordinate_profile(trips(spark, folder))


@query(
    "id_profile",
    parts.sql(
        ["ends"],
        """select count(distinct id) as ids_unicos, count(*) filter (where contains(id, 'BAEcobici')) as con_prefijo,
  round(count(*) filter (where contains(id, 'BAEcobici')) / count(*) * 100, 6) as con_prefijo_pct,
  (select substr(id, 1, 3) from ids group by 1 order by count(*) desc, 1 limit 1) as inicio_comun from ids""",
    ).replace(
        "\nselect count(distinct id)",
        ",\nids as (select case when event_id % 2 = 0 then so || 'BAEcobici' else cast(so as varchar) end as id from ends where event_id % 31 <> 0)\nselect count(distinct id)",
    ),
)
def id_profile(spark, folder):
    return P.id_profile(views.raw_trips_view(spark, folder))


@query(
    "cleaning_funnel",
    parts.sql(
        ["ends"],
        f"""select registros, tras_duracion, tras_ids, registros - tras_ids as eliminados, registros - tras_duracion as por_duracion,
  tras_duracion - tras_ids as por_ids, {r('tras_duracion_pct', 'tras_ids_pct', 'eliminados_pct')} from (select *, tras_duracion / registros * 100 as tras_duracion_pct,
  tras_ids / registros * 100 as tras_ids_pct, (registros - tras_ids) / registros * 100 as eliminados_pct from (
    select count(*) as registros, count(*) filter (where dur >= 60 and event_id % 97 <> 0) as tras_duracion,
      count(*) filter (where dur >= 60 and event_id % 97 <> 0 and event_id % 31 <> 0) as tras_ids from ends))""",
    ),
)
def cleaning_funnel(spark, folder):
    from velogrid.operators.columns import fold_headers

    return P.cleaning_funnel(C.type_trips(fold_headers(views.raw_trips_view(spark, folder))))


@query(
    "weekday_average",
    parts.sql(
        ["trips"],
        """select cast(isodow(f) - 1 as bigint) as dia_semana, round(avg(n), 6) as viajes from (
  select cast(fecha_origen_recorrido as date) as f, count(*) as n from trips group by 1) group by 1""",
    ),
)
def weekday_average(spark, folder):
    return P.weekday_average(trips(spark, folder))


# --- sets -------------------------------------------------------------------


@query(
    "distinct_coordinates",
    parts.sql(["grid"], f"select distinct {r('lat_estacion', 'long_estacion')} from grid where lat_estacion is not null and long_estacion is not null"),
)
def distinct_coordinates(spark, folder):
    return grid(spark, folder).select("lat_estacion", "long_estacion").dropna().distinct()


@query(
    "station_ids",
    parts.sql(["trips"], "select id_estacion_origen as id_estacion from trips union select id_estacion_destino from trips where id_estacion_destino is not null"),
)
def station_ids(spark, folder):
    ts = trips(spark, folder)
    ends = ts.select(F.explode(F.array("id_estacion_origen", "id_estacion_destino")).alias("id_estacion"))
    return ends.filter("id_estacion is not null").distinct()


# --- learning (no SQL counterpart) ------------------------------------------


def _parts_for_learning(spark, folder, history: bool = False) -> tuple[DataFrame, DataFrame, list[str]]:
    full, days = parts_and_days(spark, folder, lags=6 if history else 0)
    names = feature_columns(full, history)
    train, val = W.split_by_week(full.select("timestamp", TARGET, *names), days=days)
    return train, val, names


PREDICTED = ["timestamp", "id_estacion", TARGET, "arribos_predichos"]


@query("boosted_tree_predictions")
def boosted_tree_predictions(spark, folder):
    train, val, _ = _parts_for_learning(spark, folder)
    model = L.fit_boosted_trees(train, val)
    return L.predict(model, val).select(*PREDICTED)


@query("boosted_trees_with_history")
def boosted_trees_with_history(spark, folder):
    """All features, lags and the station cluster, squared loss."""
    train, val, names = _parts_for_learning(spark, folder, history=True)
    lookup = L.cluster_lookup(L.fit_station_clusters(train), train)
    train, val = L.add_clusters(train, lookup), L.add_clusters(val, lookup)
    features = [*names, "cluster_geo"]
    model = L.fit_boosted_trees(train, val, features)
    return L.predict(model, val, features).select(*PREDICTED)


@query("count_model_predictions")
def count_model_predictions(spark, folder):
    train, val, names = _parts_for_learning(spark, folder, history=True)
    return L.predict(L.fit_count_model(train, names, val=val), val, names).select(*PREDICTED)


@query("active_interval_trees")
def active_interval_trees(spark, folder):
    """Trees on the rows that stay after the filter of quiet intervals."""
    train, val, _ = _parts_for_learning(spark, folder)
    live_train, live_val = N.active_intervals(train, train), N.active_intervals(val, train)
    model = L.fit_boosted_trees(live_train, live_val, depth=6, step=0.1, subsample=1.0, columns="all")
    return L.predict(model, live_val).select(*PREDICTED)


@query("feature_importance")
def feature_importance(spark, folder):
    train, val, names = _parts_for_learning(spark, folder)
    model = L.fit_boosted_trees(train, val, names, depth=5, bins=64)
    return L.feature_importance(model, names, 15)


@query("station_clusters")
def station_clusters(spark, folder):
    stations = A.first_seen_stations(valid(spark, folder))
    lookup = L.cluster_lookup(L.fit_station_clusters(stations), stations)
    return L.add_clusters(stations, lookup).select("id_estacion", "cluster_geo")


@query("cluster_sizes")
def cluster_sizes(spark, folder):
    rows = grid(spark, folder).select("id_estacion", "lat_estacion", "long_estacion")
    lookup = L.cluster_lookup(L.fit_station_clusters(rows), rows)
    return L.cluster_sizes(rows, lookup)


STATION_FEATURES = [f for f in BASE_FEATURES if f != "id_estacion"]


@query("station_models")
def station_models(spark, folder):
    """A linear model for each of the 30 stations with most arrivals, judged on validation rows."""
    train, val, _ = _parts_for_learning(spark, folder)
    top = L.busiest_by_target(train, 30).select("id_estacion")
    models = L.fit_station_models(train.join(top, "id_estacion", "left_semi"), STATION_FEATURES)
    return M.station_metrics(L.predict_by_station(val, models, STATION_FEATURES))


@query(
    "station_slopes",
    parts.sql(
        ["train"],
        f"""select id_estacion, count(*) as filas, {r('intercepto', 'pendiente', digits=5)} from (select id_estacion, m - p * x as intercepto, p as pendiente, n from (
  select id_estacion, count(*) as n, avg(arribos_count) as m, avg(hora) as x,
    (sum(hora * arribos_count) - count(*) * avg(hora) * avg(arribos_count)) / (sum(hora * hora) - count(*) * avg(hora) * avg(hora) + 1) as p
  from train group by 1))""".replace("count(*) as filas", "n as filas"),
    ),
    digits=5,
)
def station_slopes(spark, folder):
    """The per-station fit with one feature, for which the solution is a formula."""
    train, _ = split(spark, folder, [*SLIM, "hora"])
    models = L.fit_station_models(train, ["hora"])
    return models.select("id_estacion", "filas", "intercepto", F.get("coeficientes", F.lit(0)).alias("pendiente"))


# --- files written and read again ------------------------------------------


@query("submission_file", _SQL["submission"])
def submission_file(spark, folder):
    path = work_path(spark, "submission")
    sinks.write_submission(predicted(spark, folder)[1].withColumn("arribos_predichos", F.col("arribos_predichos") * 4 - 1), path)
    return spark.read.schema("id_estacion bigint, timestamp timestamp_ntz, arribos_predichos bigint").option("header", True).csv(path)


@query("metrics_file", _SQL["regression_metrics"])
def metrics_file(spark, folder):
    path, metrics = work_path(spark, "metrics"), regression_metrics(spark, folder)
    sinks.write_metrics(metrics, path)
    return spark.read.schema(metrics.schema).option("header", True).csv(path)


# The reader takes all features but the station id as double.
SCORING_SQL = ", ".join(f'round(cast(coalesce("{c}", 0) as double), {DIGITS}) as "{c}"' for c in BASE_FEATURES if c not in ("id_estacion", "proporcion_mujeres"))


@query("scoring_input_file", parts.sql(["grid"], f'select "timestamp", cast(id_estacion as bigint) as id_estacion, cast(0 as double) as proporcion_mujeres, {SCORING_SQL} from grid'))
def scoring_input_file(spark, folder):
    """Ready-made features as CSV, read as scoring input."""
    path = work_path(spark, "features")
    prepared_features(spark, folder).write.option("header", True).csv(path)
    return files.read_scoring_input(spark, path)


@query("catalog_sample_file", parts.sql(["catalog"], """select id, coalesce(name, 'Estación ' || id) as name, coalesce(address, 'Dirección no disponible') as address,
  cast(total_trips as bigint) as total_trips from catalog order by id limit 10"""))
def catalog_sample_file(spark, folder):
    path = work_path(spark, "sample")
    sinks.write_catalog_sample(A.catalog(trips(spark, folder)), path, 10)
    return files.read_station_catalog(spark, path).select("id", "name", "address", "total_trips")


# --- learners in cases that SQL can state -----------------------------------

GROUP_MEANS = """select v.es_fin_semana, count(*) as filas, round(avg(m.media), 4) as minimo, round(avg(m.media), 4) as maximo
  from (select cast(es_fin_semana as bigint) as es_fin_semana from val) v
  join (select cast(es_fin_semana as bigint) as es_fin_semana, avg(arribos_count) as media from train group by 1) m using (es_fin_semana) group by 1"""


def _by_weekend(predicted: DataFrame) -> DataFrame:
    """The range of the predictions in each group; one value, if the model found the group's mean."""
    low, high = (F.round(f("arribos_predichos"), 4).alias(n) for f, n in ((F.min, "minimo"), (F.max, "maximo")))
    return predicted.groupBy(F.col("es_fin_semana").cast("bigint").alias("es_fin_semana")).agg(F.count("*").alias("filas"), low, high)


@query("count_model_of_one_flag", parts.sql(["train", "val"], GROUP_MEANS), digits=4)
def count_model_of_one_flag(spark, folder):
    """A log link with one binary feature has the group means as its fit."""
    train, val = split(spark, folder, [*SLIM, "es_fin_semana"])
    return _by_weekend(L.predict(L.fit_count_model(train, ["es_fin_semana"], val=val), val, ["es_fin_semana"]))


@query("tree_of_one_flag", parts.sql(["train", "val"], GROUP_MEANS), digits=4)
def tree_of_one_flag(spark, folder):
    """One tree over all rows splits at the flag and predicts the group means."""
    train, val = split(spark, folder, [*SLIM, "es_fin_semana"])
    model = L.fit_boosted_trees(train, val, ["es_fin_semana"], rounds=1, depth=1, subsample=1.0, columns="all")
    return _by_weekend(L.predict(model, val, ["es_fin_semana"]))


@query("cluster_checks", parts.sql(["grid"], "select count(*) as filas, count(distinct id_estacion) as estaciones, 0 as lejos from grid where lat_estacion is not null and long_estacion is not null"))
def cluster_checks(spark, folder):
    """Rows and stations that have a cluster, and stations whose centre isn't the nearest one."""
    rows = staged(spark, grid(spark, folder).select("id_estacion", "lat_estacion", "long_estacion"), "grid")
    model = L.fit_station_clusters(rows)
    out = L.add_clusters(rows, L.cluster_lookup(model, rows)).where("cluster_geo >= 0")
    away = F.array(*[F.pow(F.col("lat_estacion") - F.lit(float(a)), 2) + F.pow(F.col("long_estacion") - F.lit(float(g)), 2) for a, g in model.clusterCenters()])
    far = F.get(away, F.col("cluster_geo")) > F.array_min(away) + 1e-9
    return out.agg(F.count("*").alias("filas"), F.count_distinct("id_estacion").alias("estaciones"), F.count_distinct(F.when(far, F.col("id_estacion"))).alias("lejos"))


LEARNER_SQL = """select m as modelo, (select count(*) from val) as filas, 0 as nulos, 0 as negativos, true as mejor_que_la_media
  from (values ('conteo'), ('perfil')) t(m)"""


@query("learner_checks", parts.sql(["val"], LEARNER_SQL))
def learner_checks(spark, folder):
    """Full learners on validation rows: all scored, none null or negative, and closer on their own train rows than the plain mean."""
    train, val, names = _parts_for_learning(spark, folder, history=True)
    model = L.fit_count_model(train, names, val=val)
    scored = {"conteo": [L.predict(model, part, names) for part in (val, train)], "perfil": [L.predict_from_profile(part, train) for part in (val, train)]}
    rows = []
    for name, (on_val, on_train) in scored.items():
        error = F.avg(F.pow(F.col(TARGET) - F.col("arribos_predichos"), 2)) < F.var_pop(TARGET)
        better = on_train.agg(error.alias("mejor_que_la_media"))
        one = on_val.agg(F.lit(name).alias("modelo"), F.count("*").alias("filas"), F.count_if(F.expr("arribos_predichos is null")).alias("nulos"), F.count_if(F.expr("arribos_predichos < 0")).alias("negativos"))
        rows.append(one.withColumn("mejor_que_la_media", better.scalar()))
    return rows[0].unionByName(rows[1])


# --- streams ----------------------------------------------------------------

LIVE_SQL = """(select inicio, inicio + interval '30 minutes' as fin, id_estacion, sum(s) as salidas, sum(l) as llegadas from (
  select time_bucket(interval '30 minutes', fecha_origen_recorrido) as inicio, id_estacion_origen as id_estacion, 1 as s, 0 as l from trips
  union all select time_bucket(interval '30 minutes', fecha_destino_recorrido), id_estacion_destino, 0, 1 from trips where id_estacion_destino is not null)
  group by 1, 2, 3)"""


def trip_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The trip view over the event table, a file or a folder of files, read as a stream.

    A pattern in the path, as a stream takes a plain path for a folder only.
    """
    return views.trips_of(spark.readStream.schema(views.SCHEMAS["events"]).parquet(f"{folder}/events.parque[t]"))


@query("live_counts_complete", parts.sql(["trips"], f"select inicio, fin, id_estacion, {b('salidas', 'llegadas')} from {LIVE_SQL}"))
def live_counts_complete(spark, folder):
    return live.drain(spark, live.live_counts(trip_stream(spark, folder)), "complete")


@query(
    "live_counts_closed_windows",
    parts.sql(
        ["trips"],
        f"""select inicio, fin, id_estacion, {b('salidas', 'llegadas')} from {LIVE_SQL}
  where fin <= (select max(greatest(fecha_origen_recorrido, case when id_estacion_destino is not null then fecha_destino_recorrido else fecha_origen_recorrido end)) from trips) - interval '1 hour'""",
    ),
)
def live_counts_closed_windows(spark, folder):
    return live.drain(spark, live.live_counts(trip_stream(spark, folder)), "append")


@query("live_kpis", parts.sql(["trips"], f"select inicio, cast(sum(salidas) as bigint) as viajes, count(*) as estaciones_activas from {LIVE_SQL} group by 1"))
def live_kpis(spark, folder):
    return live.live_kpis(live.drain(spark, live.live_counts(trip_stream(spark, folder)), "complete"))


from velogrid.registry import learners  # noqa: E402, F401  registers more queries; it needs the names above


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
