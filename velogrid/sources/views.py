"""Trip, user and station views over the given star-schema tables.

The tables hold no trips. ``events`` serves as the trip log and ``customer`` as the user register;
the rules below only rename and derive columns, row by row, so the views grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

E = F.expr


# Known columns, so that reading a table needs no look into its files.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _ends(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "so": E("user_id % 40 + 1"),
            "sd": E("case when event_id % 50 = 0 then null else (user_id * 7 + event_id) % 40 + 1 end"),
            "dur": E("cast(floor(value * 20) as int)"),
        }
    )


def _station(side: str, s: str) -> dict:
    return {
        f"id_estacion_{side}": E(s),
        f"nombre_estacion_{side}": E(
            f"case when event_id % 9 = 0 then null when event_id % 7 = 0 then concat('EST-', {s}, ' BIS') else concat('EST-', {s}) end"
        ),
        f"direccion_estacion_{side}": E(f"case when event_id % 5 = 0 then null else concat('CALLE ', {s}) end"),
        f"long_estacion_{side}": E(
            f"case when event_id % 13 = 0 then null when {s} = 40 then 0E0 else -58.36E0 - floor({s} / 10E0) * 0.02E0 end"
        ),
        f"lat_estacion_{side}": E(
            f"case when event_id % 13 = 0 then null when {s} = 40 then 0E0 else -34.52E0 - ({s} % 10) * 0.01E0 end"
        ),
    }


def trips_of(events: DataFrame) -> DataFrame:
    """Trips with typed columns, as the cleaner returns them, but with short trips still in."""
    cols = {
        "id_recorrido": F.col("event_id"),
        "duracion_recorrido": F.col("dur"),
        **_station("origen", "so"),
        **_station("destino", "sd"),
        "id_usuario": F.col("user_id"),
        "modelo_bicicleta": E(
            "case event_type when 'view' then 'ICONIC' when 'purchase' then 'ICONIC' when 'click' then 'FIT' end"
        ),
        "genero": E("case event_id % 3 when 0 then 'FEMALE' when 1 then 'MALE' end"),
        "fecha_origen_recorrido": F.col("ts"),
        "fecha_destino_recorrido": E("ts + make_dt_interval(0, 0, 0, dur)"),
    }
    return _ends(events).select(*[c.alias(n) for n, c in cols.items()])


def trips_view(spark: SparkSession, folder: str) -> DataFrame:
    return trips_of(table(spark, folder, "events"))


def raw_trips_view(spark: SparkSession, folder: str, packed: bool = True) -> DataFrame:
    """The same trips as raw text, with the dirt of the yearly files.

    ``packed`` files hold "lat,long" in the latitude (but for every 11th row); the others use a
    decimal comma in the longitude.
    """

    def lat(s: str) -> str:
        return f"concat('-34.', 52 + {s} % 10)"

    def lng(s: str, mark: str) -> str:
        return f"concat('-58{mark}', 36 + 2 * ({s} div 10))"

    def pair(s: str) -> tuple[str, str]:
        if packed:
            both = f"case when event_id % 11 = 0 then {lat(s)} else concat({lat(s)}, ',', {lng(s, '.')}) end"
            return both, lng(s, ".")
        return lat(s), f"case when event_id % 17 = 0 then 'n/d' else {lng(s, ',')} end"

    def tag(c: str) -> str:
        return f"case when {c} is null then null when event_id % 2 = 0 then concat({c}, 'BAEcobici') else cast({c} as string) end"

    lat_o, long_o = pair("so")
    lat_d, long_d = pair("sd")
    cols = {
        "Id_recorrido": tag("event_id"),
        "duracion_recorrido": "case when event_id % 97 = 0 then 'abc' when dur >= 1000 "
        "then concat(dur div 1000, ',', lpad(cast(dur % 1000 as string), 3, '0')) else cast(dur as string) end",
        "id_estacion_origen": f"case when event_id % 31 = 0 then null else {tag('so')} end",
        "nombre_estacion_origen": "concat('EST-', so)",
        "direccion_estacion_origen": "concat('CALLE ', so)",
        "long_estacion_origen": long_o,
        "lat_estacion_origen": lat_o,
        "id_estacion_destino": tag("sd"),
        "nombre_estacion_destino": "concat('EST-', sd)",
        "direccion_estacion_destino": "concat('CALLE ', sd)",
        "long_estacion_destino": long_d,
        "lat_estacion_destino": lat_d,
        "id_usuario": "concat(user_id, '.0')",
        "modelo_bicicleta": "case event_type when 'view' then 'ICONIC' when 'click' then 'FIT' end",
        "Género": "case event_id % 3 when 0 then 'FEMALE' when 1 then 'MALE' end",
        "fecha_origen_recorrido": "cast(ts as string)",
        "fecha_destino_recorrido": "case when event_id % 41 = 0 then 'sin dato' else cast(ts as string) end",
    }
    return _ends(table(spark, folder, "events")).select(*[E(c).alias(n) for n, c in cols.items()])


def users_view(spark: SparkSession, folder: str) -> DataFrame:
    """Users with ages as text."""
    age = (
        "case when c_custkey % 17 = 0 then 'N/A' when c_custkey % 11 = 0 then '1,0' "
        "else concat(' ', cast(cast(floor(abs(c_acctbal) / 90) as int) as string)) end"
    )
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id_usuario"), E(age).alias("edad_usuario"))


def with_availability(stations: DataFrame, key: str = "id") -> DataFrame:
    """Bikes and docks per station, as a feed of measured availability would give them."""
    s = F.col(key)
    bikes = s * 7 % 30
    return stations.withColumns({"available_bikes": bikes, "total_docks": bikes + s * 5 % 15})
