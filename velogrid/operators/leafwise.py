"""Boosted trees that grow leaf by leaf, from histograms that Spark sums.

The rows are binned once. A tree starts as one leaf; a queue holds every leaf's best split, and the one with the largest gain is made, until
the tree has its leaves or nothing gains. Both children's histograms (sums and counts by feature and bin) come from one
aggregate over the rows of the split leaf, which combines before its shuffle, so what reaches the driver is a row
per feature and bin. Trees are nested conditions on columns: scoring stays inside the JVM.

Two losses: the squared one, and that of a Poisson count with a log link, where trees add to the logarithm of the expected count and a leaf's
value is a Newton step, the sum of the residuals by the sum of the expected counts.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.numbers import at_least
from velogrid.operators.boosting import patient_stop
from velogrid.operators.learning import require_non_negative
from velogrid.operators.metrics import PREDICTED
from velogrid.schemas import BASE_FEATURES, TARGET
from velogrid.stages import Stage, stage

#: Rounds after which the predictions so far are written, so that no expression holds more trees.
REFRESH = 8


@dataclass(frozen=True)
class Loss:
    """What the sum of trees stands for: the mean from it, the weight of a row in a Newton step, a row's error, and the sum for a mean."""

    mean: Callable[[Column], Column]
    weight: Callable[[Column], Column]
    error: Callable[[Column, Column], Column]
    link: Callable[[float], float]


LOSSES = {
    "squared": Loss(lambda p: p, lambda p: F.lit(1.0), lambda y, p: F.pow(y - p, 2), lambda m: m),
    "poisson": Loss(F.exp, F.exp, lambda y, p: F.exp(p) - y * p, lambda m: math.log(max(m, 1e-12))),
}


@dataclass
class Node:
    """A leaf with a value, or a split: rows with ``feature <= threshold`` go left."""

    value: float = 0.0
    rows: int = 0
    gain: float = 0.0
    feature: str | None = None
    threshold: float = 0.0
    bin: int = 0
    left: Node | None = None
    right: Node | None = None

    def expression(self, go_left, leaf) -> Column:
        if self.feature is None:
            return leaf(self)
        return F.when(go_left(self), self.left.expression(go_left, leaf)).otherwise(self.right.expression(go_left, leaf))

    def leaves(self) -> list[Node]:
        return [self] if self.feature is None else [*self.left.leaves(), *self.right.leaves()]

    def splits(self) -> list[Node]:
        return [] if self.feature is None else [self, *self.left.splits(), *self.right.splits()]

    def plain(self) -> dict:
        if self.feature is None:
            return {"value": self.value, "rows": self.rows}
        return {"feature": self.feature, "threshold": self.threshold, "gain": self.gain, "rows": self.rows, "left": self.left.plain(), "right": self.right.plain()}

    @classmethod
    def of(cls, plain: dict) -> Node:
        if "feature" not in plain:
            return cls(value=plain["value"], rows=plain["rows"])
        return cls(0.0, plain["rows"], plain["gain"], plain["feature"], plain["threshold"], 0, cls.of(plain["left"]), cls.of(plain["right"]))


@dataclass
class LeafwiseModel:
    """The mean of train, and what every tree adds to it."""

    features: list[str]
    base: float
    trees: list[Node]
    errors: list[float] = field(default_factory=list)  # of the validation rows, after each round up to the stop
    loss: str = "squared"

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with the clipped prediction; a missing feature counts as 0."""
        total = F.lit(self.base)
        for i in range(0, len(self.trees), REFRESH):
            for tree in self.trees[i : i + REFRESH]:
                total = total + tree.expression(lambda n: value_of(df, n.feature) <= n.threshold, lambda n: F.lit(n.value))
            df = df.withColumn(PREDICTED, total)
            total = F.col(PREDICTED)
        return df.withColumn(PREDICTED, at_least(LOSSES[self.loss].mean(total), 0.0))

    def importances(self) -> dict[str, float]:
        """The gain of all splits by feature."""
        out = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for n in tree.splits():
                out[n.feature] += n.gain
        return out

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "trees": [t.plain() for t in self.trees], "errors": self.errors, "loss": self.loss})

    @classmethod
    def of_json(cls, text: str) -> LeafwiseModel:
        d = json.loads(text)
        return cls(d["features"], d["base"], [Node.of(t) for t in d["trees"]], d["errors"], d["loss"])


def value_of(df: DataFrame, feature: str) -> Column:
    return F.coalesce(F.col(f"`{feature}`").cast("double"), F.lit(0.0)) if feature in df.columns else F.lit(0.0)


def cut_points(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Per feature the different ones of ``bins`` - 1 evenly spaced quantiles, about; the largest value is no cut, as nothing lies above it."""
    shares = [i / bins for i in range(1, bins)]
    found = df.agg(*[F.struct(F.percentile_approx(value_of(df, f), shares, 10_000).alias("q"), F.max(value_of(df, f)).alias("top")).alias(f"c{i}") for i, f in enumerate(features)]).first()
    out = {}
    for i, f in enumerate(features):
        q, top = found[f"c{i}"]
        out[f] = sorted({x for x in q or [] if x < top})
    return out


def binned(df: DataFrame, cuts: dict[str, list[float]], y: str) -> DataFrame:
    """(y, bins): a feature's bin is the number of cuts below its value."""
    def bin_of(f: str) -> Column:
        x = value_of(df, f)
        return sum((F.when(x > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).cast("smallint")

    return df.where(F.col(y).isNotNull()).select(F.col(y).cast("double").alias("y"), F.array(*[bin_of(f) for f in cuts]).alias("bins"))


#: Of a bin: the sum of residuals, the sum of weights, and the number of rows.
Sums = tuple[float, float, int]


def best_split(histogram: list[dict[int, Sums]], ridge: float, least: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best cut of a leaf, given per feature the sums of each bin; ties go to the first feature and bin.

    Gains are compared after rounding to nine digits, as the order in which Spark adds must not decide.
    """
    best = None
    for f, bins in enumerate(histogram):
        total, weight, n = (sum(x) for x in zip(*bins.values(), strict=True)) if bins else (0.0, 0.0, 0)
        left, light, rows = 0.0, 0.0, 0
        for b in sorted(bins)[:-1]:
            left, light, rows = left + bins[b][0], light + bins[b][1], rows + bins[b][2]
            if rows < least or n - rows < least:
                continue
            gain = left**2 / (light + ridge) + (total - left) ** 2 / (weight - light + ridge) - total**2 / (weight + ridge)
            if gain > 1e-9 and (best is None or round(gain, 9) > round(best[0], 9)):
                best = (gain, f, b)
    return best


def _go_left(features: list[str]):
    return lambda n: F.col("bins")[features.index(n.feature)] <= n.bin


def grow_tree(rows: DataFrame, features: list[str], cuts: dict[str, list[float]], leaves: int, step: float, ridge: float, least: int) -> Node:
    """One tree on ``rows`` (g, h, bins), g the residual and h the weight."""

    def histograms(root: Node, wanted: list[Node]) -> list[list[dict[int, Sums]]]:
        at = {id(n): i for i, n in enumerate(wanted)}
        place = root.expression(_go_left(features), lambda n: F.lit(at.get(id(n), -1)))
        many = rows.select("g", "h", "bins", place.alias("leaf")).where("leaf >= 0").select("g", "h", "leaf", F.posexplode("bins").alias("feature", "bin"))
        out = [[{} for _ in features] for _ in wanted]
        for r in many.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("s"), F.sum("h").alias("w"), F.count("*").alias("n")).collect():  # a row per feature and bin
            out[r["leaf"]][r["feature"]][r["bin"]] = (r["s"], r["w"], r["n"])
        return out

    root, queue, made = Node(), [], 0

    def offer(nodes: list[Node]) -> None:
        nonlocal made
        for node, found in zip(nodes, histograms(root, nodes), strict=True):
            sums = found[0].values() if found else []
            total, weight, node.rows = (sum(x) for x in zip(*sums, strict=True)) if sums else (0.0, 0.0, 0)
            node.value = step * total / (weight + ridge) if node.rows else 0.0
            split = best_split(found, ridge, least)
            if split:
                heapq.heappush(queue, (-round(split[0], 9), made, node, split))
            made += 1

    offer([root])
    while queue and len(root.leaves()) < leaves:
        *_, node, (gain, f, b) = heapq.heappop(queue)
        node.feature, node.bin, node.threshold, node.gain = features[f], b, cuts[features[f]][b], gain
        node.left, node.right = Node(), Node()
        offer([node.left, node.right])
    return root


def fit_leafwise_trees(
    train: DataFrame,
    val: DataFrame | None = None,
    features: list[str] = BASE_FEATURES,
    rounds: int = 100,
    leaves: int = 31,
    step: float = 0.1,
    bins: int = 64,
    ridge: float = 0.0,
    least: int = 20,
    patience: int = 25,
    y: str = TARGET,
    loss: str = "squared",
) -> LeafwiseModel:
    """Trees of up to ``leaves`` leaves with at least ``least`` rows each; with ``val`` the fit stops with patience and keeps its best prefix.

    ``loss`` is "squared" or "poisson"; the latter needs a target without negative values.
    """
    of = LOSSES[loss]
    if loss == "poisson":
        for part in (train, val):
            if part is not None:
                require_non_negative(part, y)
    cuts = cut_points(train.where(F.col(y).isNotNull()), features, bins)
    base = of.link(train.agg(F.avg(F.col(y).cast("double"))).first()[0] or 0.0)
    parts = [binned(p, cuts, y) for p in (train, val) if p is not None]
    tagged = parts[0].withColumn("judge", F.lit(False))
    if val is not None:
        tagged = tagged.unionByName(parts[1].withColumn("judge", F.lit(True)))
    held: Stage = stage(tagged.withColumn("p", F.lit(base)), "bins")
    trees: list[Node] = []
    errors: list[float] = []
    fresh = 0  # trees that the stage's predictions hold
    try:
        while len(trees) < rounds:
            now = held.read()
            p = F.col("p")
            for tree in trees[fresh:]:
                p = p + tree.expression(_go_left(features), lambda n: F.lit(n.value))
            now = now.withColumn("p", p)
            if len(trees) - fresh == REFRESH:
                old, held, fresh = held, stage(now, "bins"), len(trees)
                old.close()
                now = held.read()
            rest = now.where("not judge").select((F.col("y") - of.mean(F.col("p"))).alias("g"), of.weight(F.col("p")).alias("h"), "bins")
            tree = grow_tree(rest, features, cuts, leaves, step, ridge, least)
            if tree.feature is None:
                break  # nothing gains any more
            trees.append(tree)
            if val is not None:
                after = F.col("p") + tree.expression(_go_left(features), lambda n: F.lit(n.value))
                error = now.where("judge").agg(F.avg(of.error(F.col("y"), after))).first()[0]
                if error is not None:
                    errors.append(error)
                if patient_stop(errors, patience):
                    break
    finally:
        held.close()
    best = errors.index(min(errors)) + 1 if errors else len(trees)
    if errors and (stop := patient_stop(errors, patience)):
        best = stop[0]
    return LeafwiseModel(list(features), base, trees[:best], errors, loss)
