"""Train and validation parts: one validation day per week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velogrid.schemas import VAL_SEED


def validation_days(grid: DataFrame, seed: int = VAL_SEED, column: str = "timestamp") -> DataFrame:
    """One day for every (year, month, ISO week) in the data.

    The day with the smallest hash of seed and date is taken, so the choice depends on nothing but
    the dates present, whatever the order or partitioning of the rows.
    """
    days = grid.select(F.to_date(column).alias("fecha")).filter("fecha is not null").distinct()
    lot = F.md5(F.concat(F.lit(f"{seed}|"), F.col("fecha").cast("string")))
    week = [F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), F.weekofyear("fecha").alias("semana")]
    return days.groupBy(*week).agg(F.min_by("fecha", lot).alias("fecha")).select("fecha")


def _is_on(days: DataFrame, column: str):
    # At most one row per week of the calendar, so the days always fit a broadcast.
    return F.broadcast(days.select(F.col("fecha").alias("_dia"))), F.to_date(column) == F.col("_dia")


def validation_part(grid: DataFrame, days: DataFrame, column: str = "timestamp") -> DataFrame:
    right, on = _is_on(days, column)
    return grid.join(right, on, "left_semi")


def training_part(grid: DataFrame, days: DataFrame, column: str = "timestamp") -> DataFrame:
    right, on = _is_on(days, column)
    return grid.join(right, on, "left_anti")


def with_part(rows: DataFrame, days: DataFrame, column: str = "timestamp") -> DataFrame:
    """``rows`` with ``parte``, 'val' on these days and else 'train', so that one scan serves both parts. Rows without a time are train, as in the split."""
    right, on = _is_on(days, column)
    return rows.join(right, on, "left").withColumn("parte", F.when(F.col("_dia").isNull(), "train").otherwise("val")).drop("_dia")


def split_by_week(grid: DataFrame, seed: int = VAL_SEED, days: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, validation). The days are found from the dates alone, without the other columns."""
    days = validation_days(grid, seed) if days is None else days
    return training_part(grid, days), validation_part(grid, days)


def shared_days(train: DataFrame, val: DataFrame) -> DataFrame:
    """Days that are in both parts; empty for a correct split."""
    return train.select(F.to_date("timestamp").alias("fecha")).intersect(val.select(F.to_date("timestamp").alias("fecha")))


def month_shares(rows: DataFrame) -> DataFrame:
    """Rows per month and part, and the share of each part in all rows; ``rows`` as from ``with_part``."""
    months = rows.groupBy(F.month("timestamp").alias("mes"), "parte").agg(F.count("*").alias("filas"))
    return months.withColumn("pct", F.col("filas") / F.sum("filas").over(Window.partitionBy()) * 100)  # twelve rows a part at most
