"""Data-quality and usage profiles of trips and users. All run over the whole input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.numbers import percent
from velogrid.functions.quantiles import exact_percentiles
from velogrid.operators.cleaning import in_analysis_box
from velogrid.operators.stations import traffic
from velogrid.schemas import MAX_AGE, MIN_AGE, MIN_TRIP_SECONDS, SYSTEM_TAG

START = "fecha_origen_recorrido"


# --- when trips happen ------------------------------------------------------


def trips_per_period(trips: DataFrame) -> DataFrame:
    """Trips per year, per month and per both, in one pass; the part not grouped by is null."""
    dated = trips.select(F.year(START).alias("anio"), F.month(START).alias("mes")).filter("anio is not null")
    year, month = F.col("anio"), F.col("mes")
    return dated.groupingSets([[year], [month], [year, month]], year, month).agg(
        F.grouping_id().cast("int").alias("nivel"), F.count("*").alias("viajes")
    )


def trips_per_day(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col(START).isNotNull()).groupBy(F.to_date(START).alias("fecha")).agg(F.count("*").alias("viajes"))


def trips_per_hour(trips: DataFrame) -> DataFrame:
    return (
        trips.filter(F.col(START).isNotNull())
        .groupBy(F.year(START).alias("anio"), F.hour(START).alias("hora"))
        .agg(F.count("*").alias("viajes"))
    )


def peak_hour(trips: DataFrame) -> DataFrame:
    """The hour with most trips, the lower one on a tie."""
    hours = trips_per_hour(trips).groupBy("hora").agg(F.sum("viajes").alias("viajes"))
    return hours.agg(F.max_by("hora", F.struct("viajes", -F.col("hora"))).alias("hora_pico"), F.max("viajes").alias("viajes"))


def day_part_shares(trips: DataFrame) -> DataFrame:
    hour = F.hour(START)

    def part(low: int, high: int) -> Column:
        return percent(F.count_if(hour.between(low, high)), F.count("*"))

    return trips.agg(
        part(6, 11).alias("manana"), part(12, 17).alias("tarde"), part(18, 23).alias("noche"), part(0, 5).alias("madrugada")
    )


def period_cut(trips: DataFrame, cut: str, days_before: int = 213, days_after: int = 153) -> DataFrame:
    """Trips before and from a date on, their share and their mean per day."""
    at = F.lit(f"{cut} 00:00:00").cast("timestamp_ntz")
    n = F.count("*")
    before, after = F.count_if(F.col(START) < at), F.count_if(F.col(START) >= at)
    return trips.agg(
        before.alias("antes"),
        after.alias("despues"),
        percent(before, n).alias("antes_pct"),
        percent(after, n).alias("despues_pct"),
        (before / F.lit(days_before)).alias("antes_por_dia"),
        (after / F.lit(days_after)).alias("despues_por_dia"),
    )


def weekday_average(trips: DataFrame) -> DataFrame:
    """Mean trips per date for every weekday, Monday = 0."""
    return trips_per_day(trips).groupBy(F.weekday("fecha").alias("dia_semana")).agg(F.avg("viajes").alias("viajes"))


def hourly_real_and_predicted(predicted: DataFrame, y: str = "arribos_count", p: str = "arribos_predichos") -> DataFrame:
    return predicted.groupBy("hora").agg(F.sum(y).alias("viajes"), F.sum(p).alias("predicciones"))


# --- durations --------------------------------------------------------------


def duration_profile(trips: DataFrame) -> DataFrame:
    d = F.col("duracion_recorrido")
    short = d < MIN_TRIP_SECONDS
    quick = d.between(MIN_TRIP_SECONDS, 299)
    known = trips.filter(d.isNotNull())
    median = exact_percentiles(known, "duracion_recorrido", {"mediana": 0.5})
    return known.agg(
        F.count("*").alias("validas"),
        F.min(d).alias("minima"),
        F.max(d).alias("maxima"),
        F.avg(d).alias("media"),
        F.count_if(short).alias("menos_60"),
        percent(F.count_if(short), F.count("*")).alias("menos_60_pct"),
        F.count_if(quick).alias("de_60_a_300"),
        percent(F.count_if(quick), F.count("*")).alias("de_60_a_300_pct"),
        F.avg(F.when(short, d)).alias("media_menos_60"),
    ).withColumn("mediana", median.scalar())


def duration_histogram(trips: DataFrame, limit: int = 400, bins: int = 60) -> DataFrame:
    """Equal bins between the observed ends; the largest value falls into the last bin."""
    short = trips.select(F.col("duracion_recorrido").cast("double").alias("d")).filter(F.col("d") <= limit)
    ends = short.agg(F.struct(F.min("d").alias("lo"), F.max("d").alias("hi")))
    lo, hi = F.col("r.lo"), F.col("r.hi")
    place = F.when(hi > lo, F.width_bucket("d", lo, hi, F.lit(bins))).otherwise(F.lit(1).cast("bigint"))
    return (
        short.withColumn("r", ends.scalar())
        .select(F.least(place, F.lit(bins)).alias("bin"), lo.alias("lo"), ((hi - lo) / bins).alias("ancho"))
        .groupBy("bin", "lo", "ancho")
        .agg(F.count("*").alias("viajes"))
        .select("bin", (F.col("lo") + (F.col("bin") - 1) * F.col("ancho")).alias("desde"), "viajes")
    )


# --- station traffic --------------------------------------------------------


def station_traffic(trips: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Traffic per station; with a station table those without any trip appear with 0."""
    used = traffic(trips)
    if stations is None:
        return used
    known = stations.select("id_estacion").unionByName(used.select("id_estacion")).distinct()
    return known.join(used, "id_estacion", "left").select(
        "id_estacion", F.coalesce("trafico", F.lit(0).cast("bigint")).alias("trafico")
    )


def traffic_distribution(by_station: DataFrame) -> DataFrame:
    t = F.col("trafico")
    median = exact_percentiles(by_station, "trafico", {"mediana": 0.5})
    return by_station.agg(
        F.count("*").alias("estaciones"),
        F.count_if(t == 0).alias("sin_trafico"),
        F.count_if(t < 10).alias("menos_10"),
        F.count_if(t < 5000).alias("menos_5000"),
        F.avg(t).alias("media"),
    ).withColumn("mediana", median.scalar())


def traffic_tiers(by_station: DataFrame, edges: tuple[int, int] = (10, 100)) -> DataFrame:
    """Stations without use, hardly used and little used."""
    low, high = edges
    t = F.col("trafico")
    tier = (
        F.when(t == 0, "fantasma").when(t < low, "poco_activa").when(t < high, "trafico_bajo").otherwise("normal")
    )
    total = by_station.agg(F.count("*"))
    return (
        by_station.groupBy(tier.alias("nivel"))
        .agg(F.count("*").alias("estaciones"), F.avg(t).alias("media"), F.sum(t).alias("viajes"))
        .withColumn("pct", percent(F.col("estaciones"), total.scalar()))
    )


TRAFFIC_POINTS = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def traffic_percentiles(by_station: DataFrame) -> DataFrame:
    wide = exact_percentiles(by_station, "trafico", {f"p{p}": p / 100 for p in TRAFFIC_POINTS})
    return wide.select(F.inline(F.array(*[F.struct(F.lit(p).alias("percentil"), F.col(f"p{p}").alias("viajes")) for p in TRAFFIC_POINTS])))


def quiet_station_impact(trips: DataFrame, limit: int = 10, stations: DataFrame | None = None) -> DataFrame:
    """What goes when stations with fewer trips than ``limit`` are removed."""
    t = F.col("trafico")
    all_trips = trips.agg(F.count("*"))
    return (
        station_traffic(trips, stations)
        .agg(
            F.count_if(t < limit).alias("estaciones"),
            percent(F.count_if(t < limit), F.count("*")).alias("estaciones_pct"),
            F.coalesce(F.sum(F.when(t < limit, t)), F.lit(0).cast("bigint")).alias("viajes"),
        )
        .withColumn("viajes_pct", percent(F.col("viajes"), all_trips.scalar()))
    )


# --- values, ages, nulls, ids -----------------------------------------------


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    return (
        df.groupBy(F.col(column).cast("string").alias("valor"))
        .agg(F.count("*").alias("cantidad"))
        .orderBy(F.desc("cantidad"), F.asc_nulls_last("valor"))
        .limit(n)
    )


def _age_text() -> Column:
    return F.trim(F.replace(F.col("edad_usuario").cast("string"), F.lit(","), F.lit("")))


def non_numeric_ages(users: DataFrame, n: int = 10) -> DataFrame:
    """The most common ages, commas and blanks removed, that are not all digits."""
    text = users.select(_age_text().alias("edad_usuario"))
    return value_counts(text.filter(~F.coalesce(F.col("edad_usuario").rlike("^[0-9]+$"), F.lit(False))), "edad_usuario", n)


def age_funnel(users: DataFrame, low: int = MIN_AGE, high: int = MAX_AGE) -> DataFrame:
    """Users left after each step of the age cleaning, and the extremes."""
    digits = F.when(_age_text().rlike("^[0-9]+$"), _age_text().try_cast("bigint"))
    valid = digits.between(low, high)
    return users.agg(
        F.count("*").alias("originales"),
        F.count(digits).alias("solo_digitos"),
        percent(F.count(digits), F.count("*")).alias("solo_digitos_pct"),
        F.count_if(valid).alias("en_rango"),
        percent(F.count_if(valid), F.count("*")).alias("en_rango_pct"),
        F.count_if(digits < low).alias("menores"),
        F.count_if(digits > high).alias("mayores"),
        F.min(digits).alias("minima"),
        F.max(digits).alias("maxima"),
    )


def age_bands(clean_users: DataFrame) -> DataFrame:
    """Bands of ten years, closed on the right; the first also holds 10."""
    age = F.col("edad_usuario")
    band = F.when(age == MIN_AGE, F.lit(1).cast("bigint")).otherwise(F.ceil((age - MIN_AGE) / 10.0))
    return clean_users.groupBy(band.alias("banda")).agg(F.count("*").alias("usuarios"))


def age_summary(clean_users: DataFrame) -> DataFrame:
    median = exact_percentiles(clean_users, "edad_usuario", {"mediana": 0.5})
    return clean_users.agg(F.avg("edad_usuario").alias("media")).withColumn("mediana", median.scalar())


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, one scan; columns that are not there give no row."""
    present = [c for c in columns if c in df.columns]
    counted = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("columna"), F.col(c).alias("faltantes"), percent(F.col(c), F.col("_n")).alias("pct"))
                    for c in present
                ]
            )
        )
    )


def coordinate_profile(trips: DataFrame, lat: str = "lat_estacion_origen", lng: str = "long_estacion_origen") -> DataFrame:
    """Trips with coordinates inside the city's box and the range of those."""
    a, b = F.col(lat).cast("string").try_cast("double"), F.col(lng).cast("string").try_cast("double")
    rows = trips.select(a.alias("a"), b.alias("b"))
    fine = F.coalesce(in_analysis_box("a", "b"), F.lit(False))
    return rows.agg(
        F.count_if(fine).alias("validas"),
        percent(F.count_if(fine), F.count("*")).alias("validas_pct"),
        (F.count("*") - F.count_if(fine)).alias("invalidas"),
        F.min(F.when(fine, F.col("a"))).alias("lat_min"),
        F.max(F.when(fine, F.col("a"))).alias("lat_max"),
        F.min(F.when(fine, F.col("b"))).alias("long_min"),
        F.max(F.when(fine, F.col("b"))).alias("long_max"),
    )


def id_profile(trips: DataFrame, column: str = "id_estacion_origen") -> DataFrame:
    """Distinct ids, their commonest three-letter start, and how many carry the system tag.

    Ids are counted first; everything else is read from that small table.
    """
    ids = (
        trips.select(F.col(column).cast("string").alias("id")).filter("id is not null").groupBy("id").agg(F.count("*").alias("n"))
    )
    starts = ids.groupBy(F.substring("id", 1, 3).alias("inicio")).agg(F.sum("n").alias("n"))
    commonest = starts.agg(F.min_by("inicio", F.struct((-F.col("n")).alias("n"), "inicio")))
    tagged = F.sum(F.when(F.col("id").contains(SYSTEM_TAG), F.col("n")).otherwise(0))
    return ids.agg(
        F.count("*").alias("ids_unicos"), tagged.alias("con_prefijo"), percent(tagged, F.sum("n")).alias("con_prefijo_pct")
    ).withColumn("inicio_comun", commonest.scalar())


def cleaning_funnel(trips: DataFrame) -> DataFrame:
    """Rows left after the duration filter and after the origin filter, cumulative."""
    long_enough = F.col("duracion_recorrido") >= MIN_TRIP_SECONDS
    kept = long_enough & F.col("id_estacion_origen").isNotNull()
    n, first, second = F.count("*"), F.count_if(long_enough), F.count_if(kept)
    return trips.agg(
        n.alias("registros"),
        first.alias("tras_duracion"),
        percent(first, n).alias("tras_duracion_pct"),
        second.alias("tras_ids"),
        percent(second, n).alias("tras_ids_pct"),
        (n - second).alias("eliminados"),
        percent(n - second, n).alias("eliminados_pct"),
        (n - first).alias("por_duracion"),
        (first - second).alias("por_ids"),
    )
