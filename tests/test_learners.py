"""Patience, saved models, active intervals, importances and hot riders on small cases."""

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from velogrid.operators import boosting as B
from velogrid.operators import enrich as E
from velogrid.operators import learning as L
from velogrid.sources import models as S


@pytest.mark.parametrize(
    ("errors", "patience", "want"),
    [
        ([], 2, None),
        ([5.0], 2, None),
        ([5.0, 4.0, 3.0], 2, None),  # still gaining
        ([5.0, 4.0, 4.5, 4.2], 2, (2, 4)),
        ([5.0, 4.0, 4.5, 3.0, 3.1, 3.2], 2, (4, 6)),
        ([5.0, 4.0, 4.5, 4.2, 1.0], 2, (2, 4)),  # a gain after the stop is never seen
        ([2.0, 2.0 - 1e-12, 2.0], 2, (1, 3)),  # rounding is no gain
        ([0.0, 0.0, 0.0], 2, (1, 3)),
    ],
)
def test_patient_stop(errors, patience, want):
    assert B.patient_stop(errors, patience) == want


def points(spark, n, seed, noise=0.3):
    """Two features; the target is a step of the first one, and noise."""
    rows = spark.range(n).select("id", F.rand(seed).alias("a"), F.rand(seed + 1).alias("b"), (F.rand(seed + 2) * 2 - 1).alias("e"))
    return rows.select("id", "a", "b", (F.when(F.col("a") > 0.5, 3.0).otherwise(1.0) + noise * F.col("e")).alias("arribos_count"))


def test_the_best_prefix_stays(spark):
    train, val = points(spark, 300, 1), points(spark, 200, 7)
    fit = B.fit_patient_trees(train, val, ["a", "b"], patience=3, depth=4, step=0.5, subsample=1.0, columns="all", bins=32)
    assert len(fit.errors) <= fit.best + 3 and min(fit.errors) == fit.errors[fit.best - 1]
    assert fit.model.getNumTrees == fit.best
    again = fit.model.evaluateEachIteration(B.vectors(val, ["a", "b"], ["arribos_count"]), "squared")
    assert again == pytest.approx(fit.errors[: fit.best], abs=1e-9)
    curve = fit.curve(train).collect()
    assert [r.ronda for r in curve if r.elegida] == [fit.best] and [r.error_val for r in curve] == fit.errors
    capped = B.fit_patient_trees(train, val, ["a", "b"], rounds=2, patience=25, depth=2, bins=32)
    assert len(capped.errors) == 2 and capped.best == capped.errors.index(min(capped.errors)) + 1
    unjudged = B.fit_patient_trees(train, val.limit(0), ["a", "b"], rounds=3, depth=2, bins=32)
    assert unjudged.model.getNumTrees == 3 and unjudged.errors == []


def test_a_saved_model_checks_its_input(spark, tmp_path):
    train = points(spark, 100, 1)
    fit = B.fit_patient_trees(train, train, ["a", "b"], rounds=1, depth=2, bins=32)
    folder = str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        S.load_version(spark, folder, GBTRegressionModel)
    assert [S.save_version(folder, fit.model, train, ["a", "b"], {"mse": m, "none": None}, {"note": "x"}) for m in (1.0, 2.0)] == [1, 2]
    saved, first = S.load_version(spark, folder, GBTRegressionModel), S.load_version(spark, folder, GBTRegressionModel, 1)
    assert (saved.version, saved.metrics, first.metrics, saved.more) == (2, {"mse": 2.0}, {"mse": 1.0}, {"note": "x"})
    assert saved.features == ["a", "b"] and saved.kinds == {"a": "fractional", "b": "fractional"}
    saved.check(train.select("b", "a"))
    saved.check(train.select(F.col("id").alias("a"), "b"))  # a whole number serves for a fractional one
    with pytest.raises(S.WrongInput, match="missing features: b"):
        saved.check(train.drop("b"))
    with pytest.raises(S.WrongInput, match="a is string, not fractional"):
        saved.check(train.withColumn("a", F.lit("x")))
    with pytest.raises(S.WrongInput):
        S.save_version(folder, fit.model, train, ["a", "z"], {})
    with pytest.raises(FileNotFoundError):
        S.load_version(spark, folder, GBTRegressionModel, 9)


def test_the_thresholds_of_train_filter_what_is_scored(spark, tmp_path):
    train = points(spark, 400, 1).withColumn("despachos_count", F.col("id") % 10)
    other = train.withColumn("despachos_count", F.lit(0)).limit(50).unionByName(train.where("despachos_count = 9"))
    fit = B.fit_active_trees(train, train, ["a", "b"], share=0.5, rounds=2, depth=2, bins=32)
    assert fit.thresholds["despachos_count"] == 4.5
    kept = lambda df: df.where(f"despachos_count > 4.5 or arribos_count > {fit.thresholds['arribos_count']!r}").count()
    assert fit.score(other).count() == kept(other) < other.count()
    fit.save(str(tmp_path / "m"), train)
    again = B.ActiveTrees.load(spark, str(tmp_path / "m"))
    assert again.thresholds == fit.thresholds and again.errors == fit.errors
    a, b = ({r.id: r.arribos_predichos for r in m.score(train).collect()} for m in (fit, again))
    assert a == b and len(a) == kept(train)
    nothing = B.fit_active_trees(train.limit(0).unionByName(train.limit(5)), train, ["a", "b"], share=0.0, rounds=1, depth=1, bins=32)
    assert nothing.score(train.limit(0)).count() == 0


def test_importance_finds_the_feature_that_matters(spark):
    train = points(spark, 500, 1, noise=0.0)
    model = L.fit_boosted_trees(train, train, ["a", "b"], rounds=3, depth=2, subsample=1.0, columns="all", bins=32)
    score = lambda rows: L.predict(model, rows, ["a", "b"])
    rows = [tuple(r) for r in L.permutation_importance(train, ["a", "b"], score, ["id"], digits=1).collect()]
    assert rows[0][0] == "a" and rows[0][2] > 1 and abs(rows[1][2]) < 0.05
    moved = L.permutation_importance(train.repartition(7), ["a", "b"], score, ["id"], digits=1).collect()
    assert [r[0] for r in rows] == [r[0] for r in moved] and [r[1] for r in rows] == pytest.approx([r[1] for r in moved])
    both = L.shuffled(train, ["a"], ["id"], digits=1)
    assert sorted(r[0] for r in both.select("a").collect()) == sorted(r[0] for r in both.select("_s0").collect())
    assert both.where("a = _s0").count() < 20


def test_hot_riders_are_found_and_split(spark, make_trips):
    """One rider has a third of the trips, some have no rider; no partition gets over twice the mean, and no other rider is copied."""
    n, parts = 6000, 8
    ids = F.when(F.col("i") % 3 == 0, F.lit(7)).when(F.col("i") % 50 == 1, F.lit(None)).otherwise(100 + F.col("i"))
    trips = spark.range(n).select(F.col("id").alias("i")).select(ids.cast("long").alias("id_usuario"), F.col("i").alias("id_recorrido"), F.timestamp_seconds(F.col("i")).alias("fecha_origen_recorrido"))
    users = spark.range(100 + n).select(F.col("id").alias("id_usuario"), (F.col("id") % 80).cast("int").alias("edad_usuario"))
    (hot,) = E.hot_riders(trips, parts).collect()
    assert (hot.id_usuario, hot.viajes) == (7, n // 3) and hot.copias == -(-(n // 3) * E.HOT_PARTS * parts // n)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(c) for c in names]
    try:
        for name, value in zip(names, ("-1", "false", str(parts)), strict=True):
            spark.conf.set(name, value)
        joined = E.add_users_balanced(trips, users)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        plain = [r.n for r in E.add_users(trips, users).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) <= 2 * n / parts < max(plain)
        assert sorted(joined.columns) == sorted(E.add_users(trips, users).columns)
        rows = lambda df: sorted(map(str, df.select("id_recorrido", "id_usuario", "edad_usuario").collect()))
        assert rows(joined) == rows(E.add_users(trips, users))
        twice = users.unionByName(users.withColumn("edad_usuario", F.col("edad_usuario") + 1))
        assert E.add_users_balanced(trips, twice).count() == 2 * trips.where("id_usuario is not null").count() + trips.where("id_usuario is null").count()
        assert rows(E.add_users_balanced(trips, twice, dedupe=True)) == rows(joined)
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert E.add_users_balanced(trips, None) is trips
    assert E.hot_riders(trips.limit(0), parts).count() == 0 and E.add_users_balanced(trips.limit(0), users).count() == 0
