"""Standardising on the train part and the filter of inactive intervals."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.quantiles import exact_percentiles_of
from velogrid.operators.columns import numeric_columns
from velogrid.schemas import CALENDAR, TARGET


def scaled_columns(df: DataFrame, exclude=()) -> list[str]:
    """All numeric columns but the calendar. The target and the station id belong to them unless
    they are named in ``exclude``."""
    return numeric_columns(df, {"timestamp", *CALENDAR, *exclude})


def scaler_stats(train: DataFrame, columns: list[str]) -> DataFrame:
    """One row: per column its mean and population deviation, 1 where the column is constant."""

    def stats(c: str):
        constant = F.min(c) == F.max(c)
        return F.struct(
            F.avg(c).alias("media"), F.when(constant, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias("desvio")
        ).alias(c)

    return train.agg(F.struct(*[stats(c) for c in columns]).alias("escala"))


def scale(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Apply the statistics; the one row joins the plan as a scalar subquery."""
    scaled = {c: (F.col(c) - F.col(f"_escala.{c}.media")) / F.col(f"_escala.{c}.desvio") for c in columns}
    return df.withColumn("_escala", stats.scalar()).withColumns(scaled).drop("_escala")


def standardise(train: DataFrame, val: DataFrame, exclude=()) -> tuple[DataFrame, DataFrame]:
    columns = scaled_columns(train, exclude)
    stats = scaler_stats(train, columns)
    return scale(train, stats, columns), scale(val, stats, columns)


def standardise_parts(rows: DataFrame, exclude=()) -> DataFrame:
    """Both parts of ``with_part``, scaled by the statistics of train: one pass for these, one for the rows."""
    columns = scaled_columns(rows, exclude)
    return scale(rows, scaler_stats(rows.where("parte = 'train'"), columns), columns)


def activity_thresholds(train: DataFrame, share: float = 0.1) -> DataFrame:
    """The low quantile of departures and of arrivals, as one struct."""
    names = ["despachos_count", TARGET]
    found = exact_percentiles_of(train, names, {"low": share})
    return found.select(F.struct(*[F.col(f"{c}.low").alias(c) for c in names]).alias("umbral"))


def not_quiet(low: dict[str, Column]) -> Column:
    """Rows above one of the thresholds at least. A row with a null count is neither quiet nor active; without thresholds nothing is quiet."""
    quiet = [F.col(c) <= v for c, v in low.items()]
    return ~reduce(and_, quiet) if quiet else F.lit(True)


def active_intervals(df: DataFrame, train: DataFrame, share: float = 0.1) -> DataFrame:
    """Rows of ``df`` without those at or below both thresholds of ``train``, whatever their number.

    The thresholds join the plan as a scalar subquery, so nothing runs while a query is built. A row
    with a null count is neither quiet nor active and is dropped.
    """
    low = {c: F.col("_umbral")[c] for c in ("despachos_count", TARGET)}
    return df.withColumn("_umbral", activity_thresholds(train, share).scalar()).filter(not_quiet(low)).drop("_umbral")
