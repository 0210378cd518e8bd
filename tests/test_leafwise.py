"""Trees grown leaf by leaf against a grower over plain lists."""

import math
import random

import pytest

from velogrid import stages
from velogrid.operators import leafwise as W

FEATURES = ["a", "b", "c"]


def grown(rows, cuts, leaves, step, least):
    """Best leaf first, over lists of (values, target)."""

    def best(own):
        total, found = sum(g for _, g in own), None
        for f, name in enumerate(FEATURES):
            for cut in cuts[name]:
                left = [g for x, g in own if x[f] <= cut]
                n, k = len(own), len(left)
                if k < least or n - k < least:
                    continue
                s = sum(left)
                gain = s * s / k + (total - s) ** 2 / (n - k) - total**2 / n
                if gain > 1e-9 and (found is None or round(gain, 9) > round(found[0], 9)):
                    found = (gain, f, cut)
        return found

    open_leaves = [(rows, best(rows))]
    while len(open_leaves) < leaves and any(s for _, s in open_leaves):
        at = max((i for i, (_, s) in enumerate(open_leaves) if s), key=lambda i: round(open_leaves[i][1][0], 9))
        own, (_, f, cut) = open_leaves.pop(at)
        for part in ([r for r in own if r[0][f] <= cut], [r for r in own if r[0][f] > cut]):
            open_leaves.append((part, best(part)))
    return {id(r): step * sum(g for _, g in own) / len(own) for own, _ in open_leaves for r in own}


@pytest.mark.parametrize(("leaves", "least", "rounds"), [(2, 1, 1), (5, 1, 1), (8, 10, 1), (4, 5, 3), (64, 30, 1)])
def test_like_a_grower_over_lists(spark, leaves, least, rounds):
    rng = random.Random(leaves * 100 + rounds)
    data = [(i, float(rng.randrange(6)), rng.randrange(4), rng.choice([None, 0.5, 1.5]), 0.0) for i in range(400)]
    data = [(i, a, b, c, 3 * (a > 2) + b * (c is not None) + rng.random()) for i, a, b, c, _ in data]
    df = spark.createDataFrame(data, "id long, a double, b int, c double, arribos_count double").repartition(3)
    cuts = W.cut_points(df, FEATURES, 256)
    assert cuts == {"a": [0.0, 1.0, 2.0, 3.0, 4.0], "b": [0.0, 1.0, 2.0], "c": [0.0, 0.5]}
    model = W.fit_leafwise_trees(df, None, FEATURES, rounds=rounds, leaves=leaves, step=0.5, bins=256, least=least)
    x = {i: (a, b, 0.0 if c is None else c) for i, a, b, c, _ in data}
    mean = sum(y for *_, y in data) / len(data)
    want = {i: mean for i in x}
    for _ in range(rounds):
        rows = [(x[i], y - want[i]) for i, *_, y in data]
        value = grown(rows, cuts, leaves, 0.5, least)
        for r, (i, *_) in zip(rows, data, strict=True):
            want[i] += value[id(r)]
    got = {r.id: r.arribos_predichos for r in model.predict(df).collect()}
    assert got == pytest.approx({i: max(0.0, v) for i, v in want.items()}, abs=1e-9)
    assert all(len(t.leaves()) <= leaves and all(n.rows >= least for n in t.leaves()) for t in model.trees)
    assert sum(n.rows for n in model.trees[0].leaves()) == 400


def test_patience_refresh_and_storage(spark, monkeypatch):
    monkeypatch.setattr(W, "REFRESH", 2)
    rng = random.Random(1)
    rows = [(float(rng.randrange(10)), rng.random()) for _ in range(300)]
    df = spark.createDataFrame([(a, b, 2.0 * (a > 4) + rng.random()) for a, b in rows], "a double, b double, arribos_count double")
    train, val = df.limit(200), df.exceptAll(df.limit(200))
    before = stages.stages(spark)
    model = W.fit_leafwise_trees(train, val, ["a", "b"], rounds=40, leaves=4, step=0.5, patience=3, least=5)
    assert stages.stages(spark) == before
    best = model.errors.index(min(model.errors)) + 1
    assert len(model.trees) == best and len(model.errors) <= best + 3
    scored = model.predict(val).selectExpr("avg(pow(arribos_count - arribos_predichos, 2))").first()[0]
    assert scored == pytest.approx(model.errors[best - 1], abs=1e-9)
    again = W.LeafwiseModel.of_json(model.to_json())
    assert again.to_json() == model.to_json()
    gains = model.importances()
    assert gains["a"] > gains["b"] >= 0


def test_nothing_to_learn(spark):
    schema = "a double, arribos_count double"
    flat = spark.createDataFrame([(1.0, 2.0)] * 30 + [(2.0, 2.0)] * 30 + [(None, None)], schema)
    model = W.fit_leafwise_trees(flat, flat, ["a", "absent"])
    assert model.trees == [] and {r.arribos_predichos for r in model.predict(flat).collect()} == {2.0}
    empty = W.fit_leafwise_trees(flat.limit(0), flat.limit(0), ["a"])
    assert empty.trees == [] and empty.base == 0.0 and empty.predict(flat).count() == 61


def test_poisson_loss(spark):
    """Each leaf's value is the sum of residuals by that of expected counts; many small steps come to the group means."""
    rows = [(float(i % 3), [1, 4, 10][i % 3] + i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, arribos_count int")
    one = W.fit_leafwise_trees(df, None, ["a"], rounds=1, leaves=3, step=0.5, loss="poisson", least=1)
    mean = sum(y for _, y in rows) / 300
    got = {r.a: r.arribos_predichos for r in one.predict(df).collect()}
    for a in range(3):
        own = [y for x, y in rows if x == a]
        assert got[a] == pytest.approx(mean * math.exp(0.5 * (sum(own) - len(own) * mean) / (len(own) * mean)))
    many = W.fit_leafwise_trees(df, df, ["a"], rounds=60, leaves=3, step=0.5, loss="poisson", least=1)
    got = {r.a: r.arribos_predichos for r in many.predict(df).collect()}
    assert got == pytest.approx({0.0: 1.5, 1.0: 4.5, 2.0: 10.5}, abs=1e-3)
    again = W.LeafwiseModel.of_json(many.to_json())
    assert again.to_json() == many.to_json() and {r.a: r.arribos_predichos for r in again.predict(df).collect()} == got
    with pytest.raises(ValueError):
        W.fit_leafwise_trees(df.selectExpr("a", "-arribos_count as arribos_count"), None, ["a"], loss="poisson")
