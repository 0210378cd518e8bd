"""Boosted trees that stop with patience and keep their best prefix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.operators.columns import prepare_features
from velogrid.operators.learning import predict
from velogrid.operators.metrics import PREDICTED
from velogrid.operators.scaling import activity_thresholds, not_quiet
from velogrid.schemas import BASE_FEATURES, TARGET
from velogrid.sources.models import Saved, load_version, save_version
from velogrid.stages import own_stages, stage

SEED = 42


@dataclass
class Patient:
    """A boosted model cut to its best round, and the validation error of every round up to the stop."""

    model: GBTRegressionModel
    errors: list[float]
    best: int  # rounds that the model keeps

    def curve(self, like: DataFrame) -> DataFrame:
        """(ronda, error_val, elegida) with a row per round that counted."""
        rows = [(i + 1, float(e), i + 1 == self.best) for i, e in enumerate(self.errors)]
        return like.sparkSession.createDataFrame(rows, "ronda int, error_val double, elegida boolean")


def patient_stop(errors: list[float], patience: int, least_gain: float = 1e-9) -> tuple[int, int] | None:
    """(best round, last round) of a sequential fit that ends after ``patience`` rounds without a gain; None if it would go on.

    A gain is an error below the best so far by more than ``least_gain`` of it, so that rounding makes no gain.
    """
    best, low = 0, float("inf")
    for i, e in enumerate(errors, 1):
        if low == float("inf") or e < low - least_gain * abs(low):
            best, low = i, e
        elif i - best >= patience:
            return best, i
    return None


def vectors(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    ready = prepare_features(df, features, keep)
    # Columns can be both kept and features (the station id); the vector needs all of them.
    return VectorAssembler(inputCols=features, outputCol="_x").transform(ready)


def fit_patient_trees(
    train: DataFrame,
    val: DataFrame,
    features: list[str] = BASE_FEATURES,
    rounds: int = 1000,
    patience: int = 25,
    depth: int = 10,
    step: float = 0.05,
    subsample: float = 0.8,
    columns: str = "0.8",
    bins: int = 128,
    seed: int = SEED,
) -> Patient:
    """Squared-loss trees; the fit ends after ``patience`` rounds without a gain on the validation rows, and the rounds after the best go.

    Boosting is sequential and can't be resumed, but its rounds depend on the seed and their number alone: a longer fit begins with
    the trees of a shorter one. So the rounds are doubled until the error of the validation rows, which one pass gives for
    every prefix, tells where a patient fit stops; the best prefix is then fitted once more. That is at most about four times the
    rounds of the sequential fit. Both parts are written once, as vectors.
    """
    with own_stages(train.sparkSession):
        fit_on = stage(vectors(train, features, [TARGET]).select(TARGET, "_x"), "vectors").read()
        judge_on = stage(vectors(val, features, [TARGET]).select(TARGET, "_x"), "vectors").read()
        return _patient(fit_on, judge_on, rounds, patience, depth, step, subsample, columns, bins, seed)


def _patient(fit_on: DataFrame, judge_on: DataFrame, rounds: int, patience: int, depth: int, step: float, subsample: float, columns: str, bins: int, seed: int) -> Patient:

    def fit(n: int) -> GBTRegressionModel:
        gbt = GBTRegressor(
            featuresCol="_x",
            labelCol=TARGET,
            predictionCol=PREDICTED,
            maxIter=n,
            maxDepth=depth,
            stepSize=step,
            subsamplingRate=subsample,
            featureSubsetStrategy=columns,
            maxBins=bins,
            seed=seed,
        )
        return gbt.fit(fit_on)

    judged = judge_on.limit(1).count() > 0
    n = min(rounds, 2 * patience if judged else rounds)
    while True:
        model = fit(n)
        errors = list(model.evaluateEachIteration(judge_on, "squared")) if judged else []
        stop = patient_stop(errors, patience)
        if stop is None and n < rounds and judged:
            n = min(rounds, 2 * n)
            continue
        # Without a stop the bound on rounds ended the fit; without validation rows nothing judges it.
        best, last = stop or (errors.index(min(errors)) + 1 if errors else n, len(errors))
        return Patient(model if best == n else fit(best), errors[:last], best)


# --- a model of the active intervals ----------------------------------------


@dataclass
class ActiveTrees:
    """Trees fitted on the rows above the quiet thresholds of train, and these thresholds, which choose what is scored."""

    model: GBTRegressionModel
    features: list[str]
    thresholds: dict[str, float]
    errors: list[float]

    def active(self, df: DataFrame) -> DataFrame:
        return df.where(not_quiet({c: F.lit(v) for c, v in self.thresholds.items()}))

    def score(self, df: DataFrame) -> DataFrame:
        """The active rows of ``df`` with their prediction, whatever part they come from."""
        return predict(self.model, self.active(df), self.features)

    def save(self, folder: str, train: DataFrame, metrics: dict[str, float] | None = None) -> int:
        return save_version(folder, self.model, train, self.features, metrics or {}, {"thresholds": self.thresholds, "errors": self.errors})

    @classmethod
    def load(cls, spark: SparkSession, folder: str, number: int | None = None) -> ActiveTrees:
        saved: Saved = load_version(spark, folder, GBTRegressionModel, number)
        return cls(saved.model, saved.features, saved.more["thresholds"], saved.more["errors"])


def fit_active_trees(train: DataFrame, val: DataFrame, features: list[str] = BASE_FEATURES, share: float = 0.1, **learner) -> ActiveTrees:
    """The thresholds are the ``share`` quantiles of departures and of arrivals in train; both parts are filtered by them."""
    row = activity_thresholds(train, share).first()
    low = {c: v for c, v in row["umbral"].asDict().items() if v is not None}
    part, judge = (df.where(not_quiet({c: F.lit(v) for c, v in low.items()})) for df in (train, val))
    options = {"depth": 6, "step": 0.1, "subsample": 1.0, "columns": "all"} | learner
    fit = fit_patient_trees(part, judge, features, **options)
    return ActiveTrees(fit.model, features, low, fit.errors)
