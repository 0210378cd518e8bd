"""Stations seen in trips: attributes, traffic and the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velogrid.functions.numbers import half_even, half_up, share
from velogrid.operators.cleaning import in_box
from velogrid.operators.columns import with_missing
from velogrid.schemas import ADDRESS_DEFAULT, CATALOG_BOX, NAME_DEFAULT, STATION_COLUMNS, TRIP_SCHEMA

ATTRIBUTES = STATION_COLUMNS[1:]


def first_seen_stations(trips: DataFrame) -> DataFrame:
    """One row per station with the attributes of its first record.

    Records count as ordered by side (all origins before all destinations), then by departure
    time; records of the same instant by their attributes. Trips are first reduced to distinct
    attribute sets with their earliest time, a hash aggregate on fixed-width state that combines
    before the shuffle, so a station with a large part of all trips costs no more than others.
    """
    trips = with_missing(trips, TRIP_SCHEMA.fields)

    ends = ", ".join(
        f"named_struct('lado', {number}, "
        + ", ".join(f"'{c}', {c}_{side}" for c in STATION_COLUMNS)
        + ", 'visto', fecha_origen_recorrido)"
        for number, side in enumerate(("origen", "destino"))
    )
    variants = (
        trips.selectExpr(f"inline(array({ends}))")
        .filter("id_estacion is not null")
        .groupBy("lado", *STATION_COLUMNS)
        .agg(F.min("visto").alias("visto"))
    )
    order = F.struct("lado", F.col("visto").isNull().alias("sin_fecha"), "visto", *ATTRIBUTES)
    return variants.groupBy("id_estacion").agg(F.min(order).alias("_first")).select(
        "id_estacion", *[f"_first.{c}" for c in ATTRIBUTES]
    )


def traffic(trips: DataFrame) -> DataFrame:
    """Departures plus arrivals per station, each trip counted once per end."""
    ends = trips.select(F.explode(F.array("id_estacion_origen", "id_estacion_destino")).alias("id_estacion"))
    return ends.filter("id_estacion is not null").groupBy("id_estacion").agg(F.count("*").alias("trafico"))


def catalog(trips: DataFrame, box=CATALOG_BOX) -> DataFrame:
    """Stations inside the box with their use and popularity.

    A station whose first record lacks coordinates is left out, as is one outside the box. The
    popularity is relative to the busiest station that stays.
    """
    inside = first_seen_stations(trips).filter(in_box("lat_estacion", "long_estacion", box))
    used = inside.join(traffic(trips), "id_estacion", "left").withColumn(
        "total_trips", F.coalesce("trafico", F.lit(0).cast("bigint"))
    )
    return used.select(
        F.col("id_estacion").alias("id"),
        F.col("nombre_estacion").alias("name"),
        F.col("direccion_estacion").alias("address"),
        F.col("lat_estacion").alias("lat"),
        F.col("long_estacion").alias("lng"),
        "total_trips",
    ).transform(with_popularity)


def with_popularity(stations: DataFrame, total: str = "total_trips") -> DataFrame:
    """Score 0-100 relative to the largest total, one decimal, halves to even."""
    largest = stations.agg(F.max(total))
    return (
        stations.withColumn("_max", largest.scalar())
        .withColumn("popularity_score", half_even(share(F.col(total), F.col("_max")) * 100, 1))
        .drop("_max")
    )


def with_station_status(stations: DataFrame) -> DataFrame:
    """Status and occupancy from measured availability."""
    bikes, docks = F.col("available_bikes"), F.col("total_docks")
    return stations.withColumns(
        {
            "status": F.when(bikes == 0, "empty").when(bikes >= docks * 0.8, "full").otherwise("active"),
            "ocupacion": half_up(share(bikes, docks) * 100),
        }
    )


def catalog_records(stations: DataFrame) -> DataFrame:
    """The catalogue as exported: text ids, names and addresses never missing."""
    ident = F.col("id").cast("string")
    return stations.withColumns(
        {
            "id": ident,
            "name": F.coalesce("name", F.concat(F.lit(NAME_DEFAULT), ident)),
            "address": F.coalesce("address", F.lit(ADDRESS_DEFAULT)),
        }
    )


def catalog_kpis(stations: DataFrame) -> DataFrame:
    status = F.col("status")
    return stations.agg(
        F.count("*").alias("estaciones"),
        F.count_if(status == "active").alias("activas"),
        F.count_if(status == "full").alias("completas"),
        F.count_if(status == "empty").alias("vacias"),
        F.count_if(status == "maintenance").alias("mantenimiento"),
        F.sum("available_bikes").alias("bicis_disponibles"),
        F.sum("total_trips").alias("viajes"),
    )


def catalog_summary(stations: DataFrame) -> DataFrame:
    """The busiest station (the smallest id on a tie), all trips, mean trips per station."""
    return stations.agg(
        F.max_by("name", F.struct("total_trips", -F.col("id"))).alias("mas_popular"),
        F.sum("total_trips").alias("total"),
        F.avg("total_trips").alias("promedio"),
    )


def busiest(stations: DataFrame, n: int, by: str = "total_trips", key: str = "id") -> DataFrame:
    return stations.orderBy(F.desc(by), F.col(key)).limit(n)


def quietest(stations: DataFrame, n: int, by: str = "trafico", key: str = "id_estacion") -> DataFrame:
    """Least traffic first; stations without any do not count."""
    return stations.filter(F.col(by) > 0).orderBy(F.asc(by), F.col(key)).limit(n)


def top_ends(stations: DataFrame, n: int = 10) -> DataFrame:
    """Top origins by trips and top destinations by popularity, the latter at 80 % of the trips."""
    trips = F.coalesce("total_trips", F.lit(0).cast("bigint"))
    origins = busiest(stations.withColumn("total_trips", trips), n).select(
        "id", F.col("name").alias("station"), F.col("total_trips").alias("count"), F.lit("origen").alias("type")
    )
    score = F.coalesce("popularity_score", F.lit(0.0))
    ends = busiest(stations.withColumns({"popularity_score": score, "total_trips": trips}), n, "popularity_score").select(
        "id", F.col("name").alias("station"), half_up(F.col("total_trips") * 0.8).alias("count"), F.lit("destino").alias("type")
    )
    return origins.unionByName(ends)


def heat_points(stations: DataFrame) -> DataFrame:
    """Two weighted points per station, one for each trip end."""
    score = F.coalesce("popularity_score", F.lit(0.0))

    def point(kind: str, scale: float) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.greatest(F.lit(0.1), score / scale).alias("intensity"))

    return stations.select(
        "id", F.col("name").alias("station"), "lat", "lng", F.inline(F.array(point("origen", 100.0), point("destino", 120.0)))
    )


def availability_share(stations: DataFrame, n: int = 10) -> DataFrame:
    """Share of each of the n busiest stations in their bikes on hand; a missing figure counts as 0."""
    top = busiest(stations, n).withColumn("available_bikes", F.coalesce("available_bikes", F.lit(0)))
    whole = F.sum("available_bikes").over(Window.partitionBy())  # n rows
    return top.select("id", "name", "available_bikes", share(F.col("available_bikes"), whole).alias("parte"))
