"""Model folders: versions of a model, each with a sidecar that is checked before it scores."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.sources.versions import Versions

INFO = "features array<string>, kinds map<string, string>, metrics map<string, double>, more string, train_date timestamp"


class WrongInput(ValueError):
    """Rows that a saved model can't score."""


def kind_of(kind: T.DataType) -> str:
    """Whole, fractional or other: a whole number may stand for a fractional one."""
    if isinstance(kind, T.IntegralType):
        return "whole"
    return "fractional" if isinstance(kind, (T.FractionalType, T.DecimalType)) else kind.simpleString()


@dataclass
class Saved:
    """A loaded version. ``more`` is what the caller stored with it, such as thresholds."""

    model: object
    features: list[str]
    kinds: dict[str, str]
    metrics: dict[str, float]
    more: dict = field(default_factory=dict)
    version: int = 0

    def check(self, df: DataFrame) -> None:
        """Every feature must be there, with a kind that the model was fitted on; the order of columns plays no part."""
        there = {f.name: kind_of(f.dataType) for f in df.schema.fields}
        absent = [f for f in self.features if f not in there]
        if absent:
            raise WrongInput(f"missing features: {', '.join(absent)}")
        other = [f for f in self.features if there[f] != self.kinds[f] and (there[f], self.kinds[f]) != ("whole", "fractional")]
        if other:
            raise WrongInput("features of another kind: " + ", ".join(f"{f} is {there[f]}, not {self.kinds[f]}" for f in other))


def save_version(folder: str, model: MLWritable, train: DataFrame, features: list[str], metrics: dict[str, float], more: dict | None = None, keep: int | None = None) -> int:
    """Write a new version of the model in ``folder`` with its sidecar, and make it the current one; its number.

    ``train`` gives the kinds of the features. Readers see the version when all of it is written.
    """
    spark = train.sparkSession
    kinds = {f.name: kind_of(f.dataType) for f in train.schema.fields if f.name in features}
    absent = [f for f in features if f not in kinds]
    if absent:
        raise WrongInput(f"missing features: {', '.join(absent)}")

    def write(path: str) -> None:
        model.write().save(f"{path}/model")
        row = [(features, kinds, {k: float(v) for k, v in metrics.items() if v is not None}, json.dumps(more or {}))]
        info = spark.createDataFrame(row, INFO.rsplit(", ", 1)[0])
        info.withColumn("train_date", F.current_timestamp()).coalesce(1).write.json(f"{path}/info")

    return Versions(spark, folder).write(write, {"features": len(features)}, keep).number


def load_version(spark: SparkSession, folder: str, kind, number: int | None = None) -> Saved:
    """The current version, or the one of this number; ``kind`` is a model class such as ``GBTRegressionModel``."""
    found = [v for v in Versions(spark, folder).all() if number in (None, v.number)]
    if not found:
        raise FileNotFoundError(f"{folder} holds no version {number or ''}".rstrip())
    at = found[-1]
    row = spark.read.schema(INFO).json(f"{at.path}/info").first()
    return Saved(kind.load(f"{at.path}/model"), row["features"], row["kinds"], row["metrics"], json.loads(row["more"]), at.number)
