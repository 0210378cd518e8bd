"""Column names, types and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Names, defaults and constants that results depend on.
SYSTEM_TAG = "BAEcobici"
UNKNOWN_MODEL = "UNKNOWN"
FEMALE = "FEMALE"
NAME_DEFAULT = "Estación "
ADDRESS_DEFAULT = "Dirección no disponible"
DNI_COLUMN = "Customer.Has.Dni..Yes...No."
MIN_TRIP_SECONDS = 60
MIN_AGE, MAX_AGE = 10, 100
CATALOG_BOX = (-35.0, -34.0, -59.0, -58.0)  # lat from/to, long from/to
ANALYSIS_BOX = (-34.8, -34.5, -58.7, -58.3)
VAL_SEED = 42
SLOT_MINUTES = 30
LAGS = 6
# ----------------------------------------------------------------------------

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id_recorrido", T.LongType()),
        T.StructField("duracion_recorrido", T.IntegerType()),
        T.StructField("id_estacion_origen", T.LongType()),
        T.StructField("nombre_estacion_origen", T.StringType()),
        T.StructField("direccion_estacion_origen", T.StringType()),
        T.StructField("long_estacion_origen", T.FloatType()),
        T.StructField("lat_estacion_origen", T.FloatType()),
        T.StructField("id_estacion_destino", T.LongType()),
        T.StructField("nombre_estacion_destino", T.StringType()),
        T.StructField("direccion_estacion_destino", T.StringType()),
        T.StructField("long_estacion_destino", T.FloatType()),
        T.StructField("lat_estacion_destino", T.FloatType()),
        T.StructField("id_usuario", T.LongType()),
        T.StructField("modelo_bicicleta", T.StringType()),
        T.StructField("genero", T.StringType()),
        T.StructField("fecha_origen_recorrido", T.TimestampNTZType()),
        T.StructField("fecha_destino_recorrido", T.TimestampNTZType()),
    ]
)

TAGGED_IDS = ["id_estacion_origen", "id_estacion_destino", "id_recorrido", "id_usuario"]

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("available_bikes", T.LongType()),
        T.StructField("total_docks", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_trips", T.LongType()),
        T.StructField("popularity_score", T.DoubleType()),
    ]
)

STATION_COLUMNS = ["id_estacion", "nombre_estacion", "direccion_estacion", "lat_estacion", "long_estacion"]

CALENDAR = ["hora", "dia_semana", "es_fin_semana", "mes", "dia_mes", "año"]

LAGGED = [
    "despachos_count",
    "duracion_recorrido_mean",
    "duracion_recorrido_std",
    "duracion_recorrido_count",
    "edad_usuario_mean",
    "edad_usuario_std",
    "proporcion_mujeres",
    "arribos_count",
]

TARGET = "arribos_count"

# Durations of the running half hour are known only after the trip ends.
NOT_FEATURES = [
    "timestamp",
    TARGET,
    "duracion_recorrido_mean",
    "duracion_recorrido_std",
    "duracion_recorrido_count",
]

BASE_FEATURES = [
    "id_estacion",
    "lat_estacion",
    "long_estacion",
    "despachos_count",
    "edad_usuario_mean",
    "edad_usuario_std",
    "proporcion_mujeres",
    *CALENDAR,
]


def lag_columns(lags: int = LAGS) -> list[str]:
    return [f"{name}_prev_{k}" for k in range(1, lags + 1) for name in LAGGED]


FULL_FEATURES = [*BASE_FEATURES, "arribos_prev_count", *lag_columns()]
