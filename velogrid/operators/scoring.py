"""Input checks, prediction post-processing and the submission table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.functions.numbers import at_least, half_even
from velogrid.operators.metrics import PREDICTED
from velogrid.schemas import BASE_FEATURES, TRIP_SCHEMA

#: What tells trips from features: where and when each of them starts and ends.
RAW_COLUMNS = [f.name for f in TRIP_SCHEMA.fields if f.name.startswith(("fecha_", "id_estacion_"))]
KEYS = ("id_estacion", "timestamp")


def input_kind(df: DataFrame, features: list[str] = BASE_FEATURES) -> str:
    """``processed`` with all features, ``raw`` with any trip column, else ``unknown``."""
    if set(features) <= set(df.columns):
        return "processed"
    return "raw" if set(RAW_COLUMNS) & set(df.columns) else "unknown"


class InputCheck(NamedTuple):
    """``reason`` is ``ok``, ``unknown_kind``, ``missing_columns``, ``not_numeric`` or ``null_keys``."""

    valid: bool
    reason: str
    columns: tuple[str, ...] = ()


def validate_input(df: DataFrame, features: list[str] = BASE_FEATURES) -> InputCheck:
    """Whether rows can be scored, and which columns stand in the way.

    Names and types are looked at first; only ready-made features that pass need a look at the rows, for null keys.
    """
    kind = input_kind(df, features)
    if kind == "unknown":
        return InputCheck(False, "unknown_kind")
    needed = KEYS[:1] if kind == "processed" else tuple(c for c in RAW_COLUMNS if c.startswith("fecha_"))
    if absent := tuple(c for c in needed if c not in df.columns):
        return InputCheck(False, "missing_columns", absent)
    if kind == "raw":
        return InputCheck(True, "ok")
    if not isinstance(df.schema[KEYS[0]].dataType, T.NumericType):
        return InputCheck(False, "not_numeric", KEYS[:1])
    keys = [c for c in KEYS if c in df.columns]
    bad = df.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in keys]).first()
    holes = tuple(c for c in keys if bad[c])
    return InputCheck(not holes, "null_keys" if holes else "ok", holes)


def clip_predictions(df: DataFrame, column: str = PREDICTED) -> DataFrame:
    """Counts cannot be negative."""
    return df.withColumn(column, at_least(F.col(column), 0.0))


def submission(predicted: DataFrame, column: str = PREDICTED) -> DataFrame:
    """Station, timestamp and the predicted count: clipped, halves to even, whole."""
    return predicted.select(
        "id_estacion", "timestamp", half_even(at_least(F.col(column), 0.0)).cast("bigint").alias(PREDICTED)
    )
