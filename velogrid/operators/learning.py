"""Demand models: profile means, boosted trees, count regression, station clusters and
one linear model per station."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velogrid.functions.numbers import at_least
from velogrid.operators.columns import prepare_features
from velogrid.operators.metrics import PREDICTED
from velogrid.schemas import BASE_FEATURES, TARGET

CLUSTERS = 12
SEED = 42


# --- mean demand by station, weekday and hour -------------------------------


def demand_profile(train: DataFrame, y: str = TARGET) -> DataFrame:
    return train.groupBy("id_estacion", "dia_semana", "hora").agg(F.avg(y).alias("_media"))


def predict_from_profile(df: DataFrame, train: DataFrame, y: str = TARGET) -> DataFrame:
    """Mean of the same station, weekday and hour; the overall mean where there is none.

    A station's means travel as one row, at most 168 of them, so the join is by station alone: tables clustered by station are
    grouped and joined where they lie.
    """
    overall = train.agg(F.avg(y))
    known = demand_profile(train, y).where("id_estacion is not null and dia_semana is not null and hora is not null")
    entry = F.struct(F.struct("dia_semana", "hora"), "_media")
    means = known.groupBy("id_estacion").agg(F.map_from_entries(F.collect_list(entry)).alias("_medias"))
    mean = F.try_element_at("_medias", F.struct("dia_semana", "hora"))
    return df.join(means, "id_estacion", "left").withColumn(PREDICTED, F.coalesce(mean, overall.scalar())).drop("_medias")


# --- clusters of station coordinates ----------------------------------------


def fit_station_clusters(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> KMeansModel:
    """K-means on distinct coordinates. Fit once, on train, and use for every part."""
    points = rows.select("lat_estacion", "long_estacion").dropna().distinct()
    vectors = VectorAssembler(inputCols=["lat_estacion", "long_estacion"], outputCol="_punto").transform(points)
    return KMeans(k=k, seed=seed, featuresCol="_punto", predictionCol="cluster_geo").fit(vectors)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"_a": F.round("lat_estacion", 6), "_b": F.round("long_estacion", 6)})


def cluster_lookup(model: KMeansModel, rows: DataFrame) -> DataFrame:
    points = rows.select("lat_estacion", "long_estacion").dropna().distinct()
    vectors = VectorAssembler(inputCols=["lat_estacion", "long_estacion"], outputCol="_punto").transform(points)
    labelled = _rounded(model.transform(vectors))
    return labelled.groupBy("_a", "_b").agg(F.min("cluster_geo").alias("cluster_geo"))


def add_clusters(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Cluster of the row's coordinates; -1 for coordinates that are not in the lookup."""
    return (
        _rounded(df)
        .join(lookup, ["_a", "_b"], "left")
        .withColumn("cluster_geo", F.coalesce("cluster_geo", F.lit(-1)))
        .drop("_a", "_b")
    )


def cluster_sizes(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows per cluster; those whose coordinates have none count under -1."""
    return add_clusters(df, lookup).groupBy("cluster_geo").agg(F.count("*").alias("filas"))


# --- regressors -------------------------------------------------------------


def _vectors(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    ready = prepare_features(df, features, keep)
    # Columns can be both kept and features (the station id); the vector needs all of them.
    return VectorAssembler(inputCols=features, outputCol="_x").transform(ready)


def fit_boosted_trees(
    train: DataFrame,
    val: DataFrame,
    features: list[str] = BASE_FEATURES,
    rounds: int = 1000,
    depth: int = 10,
    step: float = 0.05,
    subsample: float = 0.8,
    columns: str = "0.8",
    bins: int = 128,
    tolerance: float = 1e-5,
    seed: int = SEED,
):
    """Squared-loss trees that stop when the validation rows no longer gain.

    ``rounds`` is a bound: boosting ends at the first round whose gain on the validation rows, as a share of their
    error, is below ``tolerance``. It is sequential: one pass over the cached bins per round.
    """
    both = train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True)))
    gbt = GBTRegressor(
        featuresCol="_x",
        labelCol=TARGET,
        predictionCol=PREDICTED,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=subsample,
        featureSubsetStrategy=columns,
        maxBins=bins,
        validationIndicatorCol="_val",
        validationTol=tolerance,
        seed=seed,
    )
    return gbt.fit(_vectors(both, features, [TARGET, "_val"]))


def require_non_negative(df: DataFrame, y: str = TARGET) -> None:
    low = df.agg(F.min(y)).first()[0]
    if low is not None and low < 0:
        raise ValueError(f"{y} has negative values, which a count model cannot fit")


def varying(df: DataFrame, features: list[str]) -> list[str]:
    """The features that aren't constant in ``df``, missing values taken as 0."""
    kinds = dict(df.dtypes)
    value = {f: F.coalesce(F.col(f), F.lit(0).cast(kinds[f])) for f in features if f in kinds}
    ranges = df.agg(*[(F.min(v) < F.max(v)).alias(f) for f, v in value.items()]).first()
    return [f for f in value if ranges[f]]


def fit_count_model(train: DataFrame, features: list[str] = BASE_FEATURES, rounds: int = 25, ridge: float = 1e-6, val: DataFrame | None = None):
    """Poisson regression with a log link; neither part may have a negative target.

    Features that are constant on train would only repeat the intercept and make the system singular. They are
    left out of the fit, which is a weight of 0; the model scores vectors of all ``features``.
    """
    for part in (train, val):
        if part is not None:
            require_non_negative(part)
    used = varying(train, features)
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="_x", labelCol=TARGET, predictionCol=PREDICTED, maxIter=rounds, regParam=ridge
    )
    places = [features.index(f) for f in used]
    slicer = VectorSlicer(inputCol="_all", outputCol="_x", indices=places)
    rows = slicer.transform(_vectors(train, features, [TARGET]).withColumnRenamed("_x", "_all"))
    model = glm.fit(rows)
    return PipelineModel([VectorSlicer(inputCol="_x", outputCol="_used", indices=places), model.setFeaturesCol("_used")])


def predict(model, df: DataFrame, features: list[str] = BASE_FEATURES) -> DataFrame:
    """``df`` with the clipped prediction; an error stays an error."""
    kinds = dict(df.dtypes)
    inputs = [
        F.coalesce(F.col(f), F.lit(0).cast(kinds[f])).alias(f"_f{i}") if f in kinds else F.lit(0).alias(f"_f{i}")
        for i, f in enumerate(features)
    ]
    names = [f"_f{i}" for i in range(len(features))]
    vectors = VectorAssembler(inputCols=names, outputCol="_x").transform(df.select("*", *inputs))
    scored = model.transform(vectors.drop(*names))
    return scored.withColumn(PREDICTED, at_least(F.col(PREDICTED), 0.0)).drop("_x", "_used")


def feature_importance(model, features: list[str], n: int | None = None) -> DataFrame:
    """One row per feature, the most important first."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    weights = model.featureImportances.toArray()
    table = spark.createDataFrame(
        [(f, float(w)) for f, w in zip(features, weights, strict=True)], "caracteristica string, importancia double"
    ).orderBy(F.desc("importancia"), "caracteristica")
    return table if n is None else table.limit(n)


def shuffled(df: DataFrame, features: list[str], by: list[str], seed: int = SEED, digits: int = 2) -> DataFrame:
    """``df`` with ``_s{i}``, the value that feature i has in the row that follows by hash; the last row of a bucket takes the first one's.

    Rows are ordered by a hash of seed and ``by`` (their key) inside buckets of its first ``digits`` hex digits, so it is always the
    same shuffle, and no task orders more than one row in 16**digits.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in by]))
    bucket = F.substring(key, 1, digits)
    order = Window.partitionBy(bucket).orderBy(key)
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"_s{i}": F.coalesce(F.lead(F.struct(f)).over(order), F.first(F.struct(f)).over(first))[f] for i, f in enumerate(features)})


def permutation_importance(df: DataFrame, features: list[str], score: Callable[[DataFrame], DataFrame], by: list[str], y: str = TARGET, seed: int = SEED, digits: int = 2) -> DataFrame:
    """(caracteristica, error, importancia): what a scorer's squared error gains when one feature is shuffled, the largest first.

    Every row is scored once as it is and once per feature, in a single pass; ``score`` adds the prediction to any such rows.
    """
    rows = shuffled(df, features, by, seed, digits)
    others = [c for c in df.columns if c not in features]

    def variant(name: str | None) -> Column:
        own = [F.col(f"_s{i}" if f == name else f).alias(f) for i, f in enumerate(features)]
        return F.struct(F.lit(name or "").alias("_barajada"), *own)

    many = rows.select(*others, F.inline(F.array(variant(None), *map(variant, features))))
    error = score(many).groupBy("_barajada").agg(F.avg(F.pow(F.col(y) - F.col(PREDICTED), 2)).alias("error"))
    base = F.max(F.when(F.col("_barajada") == "", F.col("error"))).over(Window.partitionBy())  # a row per feature
    table = error.withColumn("importancia", F.col("error") - base).where("_barajada <> ''")
    return table.select(F.col("_barajada").alias("caracteristica"), "error", "importancia").orderBy(F.desc("importancia"), "caracteristica")


# --- one linear model per station -------------------------------------------


def busiest_by_target(df: DataFrame, n: int, y: str = TARGET) -> DataFrame:
    """Every station has the same rows in a dense grid, so stations rank by arrivals."""
    return (
        df.groupBy("id_estacion")
        .agg(F.count("*").alias("filas"), F.sum(y).alias("arribos"))
        .orderBy(F.desc("filas"), F.desc("arribos"), "id_estacion")
        .limit(n)
    )


def _moments(df: DataFrame, features: list[str], y: str) -> DataFrame:
    """Sums that determine a least-squares fit, per station: n, x, y, xx, xy, yy.

    Columns are taken about their overall means (``medias``), so that those with a large level keep their digits.
    """
    plain = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    centre = df.agg(F.struct(*[F.coalesce(F.avg(a), F.lit(0.0)).alias(f"c{i}") for i, a in enumerate(plain)]))
    df = df.withColumn("_medias", centre.scalar())
    x = [a - F.col(f"_medias.c{i}") for i, a in enumerate(plain)]
    t = F.col(y).cast("double")
    sums = [F.sum(a).alias(f"x{i}") for i, a in enumerate(x)]
    sums += [F.sum(x[i] * x[j]).alias(f"x{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    sums += [F.sum(a * t).alias(f"xy{i}") for i, a in enumerate(x)]
    means = [F.max(f"_medias.c{i}").alias(f"c{i}") for i in range(len(x))]
    return df.groupBy("id_estacion").agg(F.count("*").alias("n"), F.sum(t).alias("y"), F.sum(t * t).alias("yy"), *sums, *means)


def fit_station_models(train: DataFrame, features: list[str], ridge: float = 1.0, y: str = TARGET) -> DataFrame:
    """A ridge regression for every station: ``id_estacion, filas, intercepto, coeficientes``.

    The fit needs only sums over a station's rows. Spark builds them with a hash aggregate that
    combines before the shuffle; what reaches Python is one small row per station, never its rows.
    Suited to a few dozen features, as the sums grow with their square.
    """
    p = len(features)
    cross = [f"x{i}_{j}" for i in range(p) for j in range(i, p)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(p)
        for rows in batches:
            n = rows["n"].to_numpy(float)
            mean = rows[[f"x{i}" for i in range(p)]].to_numpy(float) / n[:, None]
            level = rows["y"].to_numpy(float) / n
            gram = np.zeros((len(rows), p, p))
            gram[:, upper[0], upper[1]] = rows[cross].to_numpy(float)
            gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
            gram -= n[:, None, None] * mean[:, :, None] * mean[:, None, :]
            right = rows[[f"xy{i}" for i in range(p)]].to_numpy(float) - (n * level)[:, None] * mean
            weights = np.linalg.solve(gram + ridge * np.eye(p), right[:, :, None])[:, :, 0]
            yield pd.DataFrame(
                {
                    "id_estacion": rows["id_estacion"],
                    "filas": rows["n"],
                    "intercepto": level - (weights * (mean + rows[[f"c{i}" for i in range(p)]].to_numpy(float))).sum(axis=1),
                    "coeficientes": list(weights),
                }
            )

    return _moments(train, features, y).mapInPandas(
        solve, "id_estacion bigint, filas bigint, intercepto double, coeficientes array<double>"
    )


def predict_by_station(df: DataFrame, models: DataFrame, features: list[str]) -> DataFrame:
    """Rows of stations that have a model, scored by it, inside the JVM."""
    terms = F.col("intercepto")
    for i, f in enumerate(features):
        terms = terms + F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * F.get(F.col("coeficientes"), F.lit(i))
    return (
        df.join(models.select("id_estacion", "intercepto", "coeficientes"), "id_estacion")
        .withColumn(PREDICTED, terms)
        .drop("intercepto", "coeficientes")
    )
