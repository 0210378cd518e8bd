"""Stages: shared by plan and files, clustered, deleted; versions: whole results only."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from velogrid import stages
from velogrid.operators import learning as L
from velogrid.operators import metrics as M
from velogrid.plans import flows
from velogrid.registry import queries as Q
from velogrid.session import work_path
from velogrid.sources.versions import Versions
from velogrid.sources.views import trips_view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Scans of the staged grid."""
    return [line for line in plan(df).splitlines() if "Scan parquet" in line and "velogrid_grid" in line]


def files(path):
    path = path.removeprefix("file:")
    return [f for _, _, names in os.walk(path) for f in names] if os.path.exists(path) else []


def test_queries_share_a_stage(spark):
    a = Q.staged_grid(spark, FOLDER)
    known = len(stages.stages(spark))
    b = Q.staged_grid(spark, FOLDER)
    assert sorted(a.inputFiles()) == sorted(b.inputFiles()) and len(stages.stages(spark)) == known
    assert Q.staged_grid(spark, FOLDER, lags=2).inputFiles() != a.inputFiles()


def test_a_changed_file_makes_a_new_stage(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t")
    first = stages.stage(spark.read.parquet(f"{tmp_path}/t"), "t")
    assert stages.stage(spark.read.parquet(f"{tmp_path}/t"), "t") is first
    assert stages.stage(spark.read.parquet(f"{tmp_path}/t").where("id > 1"), "t") is not first
    spark.range(7).write.mode("append").parquet(f"{tmp_path}/t")
    second = stages.stage(spark.read.parquet(f"{tmp_path}/t"), "t")
    assert (first.read().count(), second.read().count()) == (5, 12)


@pytest.mark.parametrize("cluster", [None, "id"])
def test_a_failed_write_leaves_no_stage(spark, cluster, monkeypatch):
    paths = []
    monkeypatch.setattr(stages, "work_path", lambda spark, name: paths.append(work_path(spark, name)) or paths[-1])
    before, tables = stages.stages(spark), spark.catalog.listTables()
    bad = spark.range(100, numPartitions=4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("v"))
    with pytest.raises(Exception, match="no"):
        stages.stage(bad, "bad", cluster)
    assert stages.stages(spark) == before and spark.catalog.listTables() == tables and files(paths[0]) == []


def test_what_is_staged_inside_goes_at_the_end(spark):
    before = stages.stages(spark)
    with stages.own_stages(spark):
        made = stages.stage(spark.range(9), "inner", "id")
        assert made.read().count() == 9 and files(made.path)
    assert stages.stages(spark) == before and files(made.path) == [] and made.table not in [t.name for t in spark.catalog.listTables()]


def test_a_clustered_stage_needs_no_exchange_by_station(spark, monkeypatch):
    """Also where nothing is small enough to be broadcast; the models, a row per station, travel to the stage, not the stage to them."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        train, val, _ = Q._parts_for_learning(spark, FOLDER)
        per_station = M.station_metrics(L.predict_from_profile(val, train))
        models = L.fit_station_models(train, Q.STATION_FEATURES)
        scored = M.station_metrics(L.predict_by_station(val, models, Q.STATION_FEATURES))
        for df, exchanges in ((per_station, 0), (models, 0), (scored, 1)):
            text = plan(df)
            assert text.count("Exchange hashpartitioning(id_estacion") == exchanges, text
            assert "Bucketed: true" in text
        after = plan(scored).split("Exchange hashpartitioning(id_estacion")[1]
        assert after.index("MapInPandas") < after.index("FileScan")
        moved = M.station_metrics(L.predict_from_profile(val.repartition(3), train.repartition(5)))
        assert "Exchange hashpartitioning(id_estacion" in plan(moved)
        close = lambda df: sorted((r[0], *[round(x, 9) for x in r[1:]]) for r in df.collect())
        assert close(per_station) == close(moved)
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize(("name", "most"), [("training_and_validation_rows", 1), ("rows_per_month", 1), ("standardised_parts", 2)])
def test_both_parts_come_from_one_scan(spark, name, most):
    assert len(scans(Q.queries()[name](spark, FOLDER))) == most


def test_a_closed_flow_leaves_no_file(spark):
    before = stages.stages(spark)
    with flows.train(trips_view(spark, FOLDER), None, rounds=2, depth=2) as done:
        assert done.val_metrics.first()["mse"] > 0 and done.best == len(done.errors) or done.best < 2
        paths = [s.path for s in done.staged]
        assert all(map(files, paths))
    assert stages.stages(spark) == before and not any(map(files, paths))


def test_versions_are_switched_as_a_whole(spark, tmp_path):
    versions = Versions(spark, f"{tmp_path}/v")
    assert versions.current() is None
    write = lambda n: versions.write(lambda at: spark.range(n).write.parquet(at), {"rows": n}, keep=2)
    assert [write(n).number for n in (1, 2, 3)] == [1, 2, 3]
    now = versions.current()
    assert now.info == {"rows": 3} and spark.read.parquet(now.path).count() == 3

    def half(at):
        spark.range(50).write.parquet(f"{at}/part")
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        versions.write(half, keep=2)
    assert versions.current() == now and [v.number for v in versions.all()] == [2, 3]
    assert len([d for d in os.listdir(f"{tmp_path}/v") if d.startswith("version-")]) == 2
