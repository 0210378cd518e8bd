"""Splits, scaling, percentiles, metrics and models on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from velogrid.functions.quantiles import ACCURACY, MARGIN, exact_percentiles, exact_percentiles_of
from velogrid.operators import comparison as K
from velogrid.operators import learning as L
from velogrid.operators import metrics as M
from velogrid.operators import scaling as N
from velogrid.operators import scoring as R
from velogrid.operators import splits as W
from velogrid.plans import flows
from velogrid.registry.queries import grid, trips, users
from velogrid.schemas import BASE_FEATURES, FULL_FEATURES
from velogrid.sources import sinks


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 9, list(range(1000)), [1, 1, 1, 9, 9, None, 4], list(np.random.default_rng(1).normal(size=5000))])
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(5)
    points = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.97, "e": 1.0}
    got = exact_percentiles(df, "v", points).first()
    known = [v for v in values if v is not None]
    for name, p in points.items():
        assert got[name] == pytest.approx(np.percentile(known, p * 100), abs=1e-12)


def test_percentiles_of_nothing(spark):
    assert tuple(exact_percentiles(spark.createDataFrame([], "v double"), "v", {"m": 0.5}).first()) == (None,)


@pytest.mark.parametrize("shape", ["spread", "ties", "mostly one", "two columns"])
def test_percentiles_beyond_the_sketch(spark, shape):
    """More values than the sketch keeps, so that ranks come from brackets."""
    n = 200_000
    x = {"spread": F.expr("cast(xxhash64(id) as double)"), "ties": F.expr("cast(pmod(xxhash64(id), 50) as double)"), "mostly one": F.expr("if(id % 3 = 0, id, 7D)"), "two columns": F.expr("if(id % 5 = 0, null, sqrt(id))")}[shape]
    df = spark.range(n, numPartitions=7).select(x.alias("v"), F.expr("pmod(xxhash64(id, 1), 1000003) / 7D").alias("w"))
    points = {"a": 0.0, "b": 0.001, "c": 0.25, "d": 0.5, "e": 0.50001, "f": 0.99, "g": 1.0}
    got = exact_percentiles_of(df, ["v", "w"], points).first()
    rows = df.collect()
    for c in ("v", "w"):
        known = [r[c] for r in rows if r[c] is not None]
        for name, p in points.items():
            assert got[c][name] == pytest.approx(np.percentile(known, p * 100), rel=1e-12, abs=1e-9), (c, name)


def test_percentiles_take_two_passes(spark):
    df = spark.range(200_000, numPartitions=4).select(F.col("id").cast("double").alias("v"))
    found = exact_percentiles(df, "v", {"m": 0.5})
    assert found.first()["m"] == 99_999.5
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")
    run = [line for part in plan for line in part.split("== Final Plan ==")[-1].splitlines()]
    assert "ReusedExchange" in "\n".join(run)
    assert 1 / (2 * MARGIN / ACCURACY) > 3000  # what one task ranks


def test_weekly_split(spark):
    days = spark.sql("select explode(sequence(date'2024-12-16', date'2025-01-12')) as d").selectExpr("cast(d as timestamp_ntz) as timestamp")
    chosen = [r["fecha"] for r in W.validation_days(days).collect()]
    weeks = {(d.year, d.month, d.isocalendar().week) for d in chosen}
    # 2024-12-30 and 31 are in ISO week 1, but of December 2024: a week of their own
    assert len(chosen) == len(weeks) == 5 and (2024, 12, 1) in weeks and (2025, 1, 1) in weeks
    assert set(chosen) == {r["fecha"] for r in W.validation_days(days.repartition(7)).collect()}
    other = {r["fecha"] for r in W.validation_days(days, seed=7).collect()}
    assert len(other) == 5
    train, val = W.split_by_week(days)
    assert W.shared_days(train, val).count() == 0 and train.count() + val.count() == days.count()


def test_constant_columns_are_only_centred(spark):
    train = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    val = spark.createDataFrame([(7.0, 5.0)], "a double, b double")
    scaled, other = N.standardise(train, val)
    assert tuple(other.first()) == (2.0, 3.0)
    assert sorted(map(tuple, scaled.collect())) == [(0.0, -1.0), (0.0, 1.0)]
    assert N.scaled_columns(train, exclude=["b"]) == ["a"]


def test_inactive_rows_go_at_any_size(spark):
    df = spark.createDataFrame([(0, 0)] * 30 + [(1, 0), (0, 4), (3, 3)], "despachos_count bigint, arribos_count bigint")
    assert N.active_intervals(df, df, 0.1).count() == 3
    few = df.limit(2)
    assert N.active_intervals(few, few, 0.1).count() == 0


def test_percentiles_with_far_more_values_than_ranges(spark):
    df = spark.range(60_000).selectExpr("cast((id * 7919) % 60013 as double) / 7 as a", "if(id % 3 = 0, null, id % 5) as b")
    got = exact_percentiles_of(df, ["a", "b"], {"low": 0.003, "mid": 0.5, "high": 0.999}).first()
    for c in ("a", "b"):
        x = np.sort([r[0] for r in df.select(c).dropna().collect()])
        assert np.allclose(list(got[c]), np.quantile(x, [0.003, 0.5, 0.999]))


def scored(spark, pairs):
    return spark.createDataFrame([(1, float(a), float(b)) for a, b in pairs], "id_estacion bigint, arribos_count double, arribos_predichos double")


def test_metrics(spark):
    row = M.regression_metrics(scored(spark, [(0, 1), (2, 2), (4, 1)])).first()
    assert row["mse"] == pytest.approx(10 / 3) and row["mae"] == pytest.approx(4 / 3) and row["r2"] == pytest.approx(1 - 10 / 8)
    assert (row["error_mediano"], row["error_maximo"]) == (1.0, 3.0)


@pytest.mark.parametrize("pairs, r2", [([(2, 2), (2, 2)], 1.0), ([(2, 2), (2, 3)], 0.0)])
def test_r2_of_a_constant_target(spark, pairs, r2):
    assert M.station_metrics(scored(spark, pairs)).first()["r2"] == r2


def test_rounding_of_submissions(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -0.3, None)], "arribos_predichos double")
    df = df.selectExpr("1 as id_estacion", "current_date() as timestamp", "arribos_predichos")
    assert [r["arribos_predichos"] for r in R.submission(df).collect()] == [0, 2, 2, 0, None]


def test_comparison_truncates_sums_and_clips_accuracy(spark):
    df = spark.createDataFrame(
        [(1, 3, 1, 2.7, -34.5, -58.4), (1, 0, 2, 1.2, -34.5, -58.4), (2, 0, 0, 9.0, None, None)],
        "id_estacion bigint, arribos_count bigint, despachos_count bigint, arribos_predichos double, lat_estacion double, long_estacion double",
    )
    rows = {r["id_estacion"]: r for r in K.compare_stations(df).collect()}
    assert rows[1]["arribos_predichos"] == 3 and rows[1]["total_viajes"] == 6 and rows[1]["nombre_estacion"] == "Estación 1"
    assert rows[1]["accuracy"] == pytest.approx((0.9 + 0.0) / 2)
    assert (rows[2]["lat_estacion"], rows[2]["accuracy"], rows[2]["duracion_promedio"]) == (0.0, 0.0, 0.0)


def test_a_moved_station_is_compared_at_its_first_place(spark):
    rows = [(1, 12, -34.1, None), (1, 11, -34.5, -58.4), (1, 10, None, -58.9), (1, 13, -34.0, -58.0)]
    df = spark.createDataFrame(rows, "id_estacion bigint, h int, lat_estacion double, long_estacion double")
    df = df.selectExpr("*", "timestamp_ntz'2024-03-04 00:00:00' + make_interval(0, 0, 0, 0, h) as timestamp", "0L as arribos_count", "0L as despachos_count", "0d as arribos_predichos")
    with_times, without = (K.compare_stations(x).first() for x in (df, df.drop("timestamp")))
    assert (with_times["lat_estacion"], with_times["lng_estacion"]) == (-34.5, -58.9)
    assert (without["lat_estacion"], without["lng_estacion"]) == (-34.5, -58.9)


def test_input_kinds(spark, make_trips):
    raw = make_trips({})
    assert R.input_kind(raw) == "raw" and R.validate_input(raw)[0]
    ready = spark.createDataFrame([tuple([1] * len(BASE_FEATURES))], ", ".join(f"`{c}` int" for c in BASE_FEATURES))
    assert R.input_kind(ready) == "processed" and R.validate_input(ready)[0]
    assert not R.validate_input(ready.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))[0]
    assert not R.validate_input(ready.withColumn("id_estacion", F.lit("x")))[0]
    assert R.input_kind(ready.select("hora")) == "unknown" and not R.validate_input(ready.select("hora"))[0]
    assert not R.validate_input(raw.drop("fecha_destino_recorrido"))[0]
    with pytest.raises(ValueError):
        flows.scoring_features(ready.select("hora"))


def test_station_models_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(int(s), float(a), float(b), float(3 * a - b + s + e)) for s in (1, 2) for a, b, e in rng.normal(size=(200, 3))]
    df = spark.createDataFrame(rows, "id_estacion bigint, a double, b double, arribos_count double").repartition(6)
    models = {r["id_estacion"]: r for r in L.fit_station_models(df, ["a", "b"], ridge=0.5).collect()}
    for s in (1, 2):
        part = np.array([r[1:] for r in rows if r[0] == s])
        x, y = part[:, :2] - part[:, :2].mean(0), part[:, 2] - part[:, 2].mean()
        weights = np.linalg.solve(x.T @ x + 0.5 * np.eye(2), x.T @ y)
        assert np.allclose(models[s]["coeficientes"], weights)
        assert models[s]["intercepto"] == pytest.approx(part[:, 2].mean() - weights @ part[:, :2].mean(0))
    fitted = L.predict_by_station(df, L.fit_station_models(df, ["a", "b"]), ["a", "b"])
    assert M.station_metrics(fitted).agg(F.min("r2")).first()[0] > 0.8


def test_count_model_needs_counts(spark):
    with pytest.raises(ValueError):
        L.require_non_negative(spark.createDataFrame([(-1,)], "arribos_count bigint"))


def test_clusters_default_to_minus_one(spark):
    points = spark.createDataFrame([(i, -34.5 - 0.01 * i, -58.4) for i in range(20)], "id_estacion bigint, lat_estacion double, long_estacion double")
    lookup = L.cluster_lookup(L.fit_station_clusters(points, 4), points)
    other = points.unionByName(spark.createDataFrame([(99, None, None), (98, 1.0, 1.0)], points.schema))
    got = {r["id_estacion"]: r["cluster_geo"] for r in L.add_clusters(other, lookup).collect()}
    assert got[99] == got[98] == -1 and len({got[i] for i in range(20)}) == 4


def test_train_save_load_and_score(spark, tmp_path):
    from pyspark.ml.regression import GBTRegressionModel

    done = flows.train(trips(spark, FOLDER), users(spark, FOLDER), rounds=2, depth=3)
    metrics = done.val_metrics.first().asDict()
    assert metrics["mse"] > 0
    sinks.save_model(spark, done.model, str(tmp_path / "m"), done.features, metrics)
    model, info = sinks.load_model(spark, GBTRegressionModel, str(tmp_path / "m"))
    assert info["features"] == BASE_FEATURES and info["metrics"]["mse"] == metrics["mse"]
    ready = grid(spark, FOLDER).select("timestamp", "arribos_count", *BASE_FEATURES)
    a = flows.score(model, ready).agg(F.sum("arribos_predichos"), F.min("arribos_predichos"), F.count("*")).first()
    b = flows.score(done.model, trips(spark, FOLDER), users(spark, FOLDER)).agg(F.sum("arribos_predichos"), F.count("*")).first()
    assert a[0] == pytest.approx(b[0]) and a[1] >= 0 and a[2] == b[1]
    assert L.feature_importance(model, done.features, 5).count() == 5
    rows, performance = flows.compare_day(flows.score(model, ready), None, "2024-01-09", 8)
    assert rows.count() == 40 and performance.count() == 1
    none, nothing = flows.compare_day(flows.score(model, ready), None, "2030-01-01", 8)
    assert none.count() == 0 and nothing.count() == 0


def test_feature_lists():
    assert len(BASE_FEATURES) == 13 and len(FULL_FEATURES) == 62
