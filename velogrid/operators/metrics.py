"""Regression metrics: overall, per station, train against validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.quantiles import brackets, within_brackets
from velogrid.schemas import TARGET

PREDICTED = "arribos_predichos"


def _r2(y: Column, error: Column) -> Column:
    """1 - SSE / SST; a constant target gives 1 when every value is hit and else 0."""
    sse = F.sum(error * error)
    sst = F.count(y) * F.var_pop(y)
    constant = F.min(y) == F.max(y)
    return F.when(constant, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - F.try_divide(sse, sst))


def _basic(y: str, p: str) -> list[Column]:
    truth = F.col(y).cast("double")
    error = truth - F.col(p)
    return [
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        _r2(truth, error).alias("r2"),
    ]


def regression_metrics(df: DataFrame, y: str = TARGET, p: str = PREDICTED) -> DataFrame:
    """One row: mse, mae, rmse, r2 and the mean, median and largest absolute error.

    Two passes over the rows: all sums with the brackets of the median, and the ranks inside the bracket.
    """
    size, half = {"e": F.abs(F.col(y).cast("double") - F.col(p))}, {"mediana": 0.5}
    first = df.agg(F.struct(*_basic(y, p), F.max(size["e"]).alias("error_maximo"), brackets(size, half).alias("cuts")))
    return within_brackets(df, size, half, first, "cuts").select(
        "_first.mse",
        "_first.mae",
        F.sqrt("_first.mse").alias("rmse"),
        "_first.r2",
        F.col("_first.mae").alias("error_promedio"),
        F.col("e.mediana").alias("error_mediano"),
        "_first.error_maximo",
    )


def station_metrics(df: DataFrame, y: str = TARGET, p: str = PREDICTED, by: str = "id_estacion") -> DataFrame:
    return df.groupBy(by).agg(*_basic(y, p))


def best_and_worst(metrics: DataFrame, n: int = 5, by: str = "r2", key: str = "id_estacion") -> DataFrame:
    best = metrics.orderBy(F.desc(by), key).limit(n).withColumn("grupo", F.lit("mejor"))
    return best.unionByName(metrics.orderBy(F.asc(by), key).limit(n).withColumn("grupo", F.lit("peor")))


def overfit_gap_of(rows: DataFrame, y: str = TARGET, p: str = PREDICTED) -> DataFrame:
    """``overfit_gap`` of the parts of ``with_part``, in one pass."""
    by_part = station_metrics(rows, y, p, by="parte").groupBy().agg(
        *[F.max(F.when(F.col("parte") == part, F.struct("mse", "mae"))).alias(name) for part, name in (("train", "t"), ("val", "v"))]
    )
    return _gaps(by_part)


def overfit_gap(train: DataFrame, val: DataFrame) -> DataFrame:
    """Train against validation error in percent of the latter; below -10 counts as overfit."""
    names = ("mse", "mae")
    return _gaps(train.select(F.struct(*names).alias("t")).withColumn("v", val.select(F.struct(*names)).scalar()))


def _gaps(both: DataFrame) -> DataFrame:
    names = ("mse", "mae")
    gaps = [(F.try_divide(F.col(f"t.{n}") - F.col(f"v.{n}"), F.col(f"v.{n}")) * 100).alias(f"brecha_{n}") for n in names]
    return both.select(*gaps).select(
        "*", *[F.when(F.col(f"brecha_{n}") < -10, "Overfitting").otherwise("OK").alias(f"estado_{n}") for n in names]
    )


def residual_stats(df: DataFrame, y: str = TARGET, p: str = PREDICTED, by=()) -> DataFrame:
    """Mean and sample deviation of the target and of the residuals, with the range of the target."""
    rest = F.col(y) - F.col(p)
    return df.groupBy(*by).agg(
        F.avg(y).alias("real_media"),
        F.stddev_samp(y).alias("real_desvio"),
        F.min(y).alias("real_min"),
        F.max(y).alias("real_max"),
        F.avg(p).alias("predicho_media"),
        F.avg(rest).alias("residuo_media"),
        F.stddev_samp(rest).alias("residuo_desvio"),
    )
