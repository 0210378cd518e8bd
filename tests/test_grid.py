"""The dense grid on small hand-made trips, and its plan."""

from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import FOLDER, trip
from velogrid.operators import grid as G
from velogrid.operators.cleaning import clean_users, valid_trips
from velogrid.registry import queries
from velogrid.schemas import LAGGED
from velogrid.sources.views import trips_view, users_view


def at(text):
    return datetime.fromisoformat(f"2024-03-04 {text}")


def cells(df, *columns):
    return {(r["timestamp"], r["id_estacion"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_departures_carry_the_end_and_arrivals_the_start(make_trips):
    got = cells(G.station_grid(make_trips(trip("10:05:00", "10:40:00"))), "despachos_count", "arribos_count")
    assert got == {(at("10:30:00"), 1): (1, 0), (at("10:30:00"), 2): (0, 1)}


def test_a_departure_on_the_boundary_belongs_to_the_window_it_opens(make_trips):
    got = cells(G.departures(make_trips(trip("10:00:00", "10:10:00"))), "despachos_count")
    assert got == {(at("10:30:00"), 1): (1,)}


def test_rider_statistics(make_trips):
    trips = make_trips(
        trip("10:05:00", "10:20:00", duracion_recorrido=100, genero="FEMALE", modelo_bicicleta="ICONIC"),
        trip("10:06:00", "10:20:00", duracion_recorrido=300, modelo_bicicleta="FIT"),
        trip("10:07:00", "10:20:00", origin=3, duracion_recorrido=60),
        trip("10:08:00", "10:20:00", origin=4, duracion_recorrido=None, genero="MALE"),
    )
    got = cells(
        G.departures(trips), "duracion_recorrido_mean", "duracion_recorrido_std", "duracion_recorrido_count", "proporcion_mujeres", "modelo_mas_comun"
    )
    t = at("10:30:00")
    assert got[t, 1] == (200.0, 141.4213562373095, 2, 0.5, "FIT")  # a tie goes to the smaller name
    assert got[t, 3] == (60.0, 0.0, 1, 0.0, "UNKNOWN")  # a single trip has no deviation
    assert got[t, 4] == (0.0, 0.0, 0, 0.0, "UNKNOWN")


def test_equal_values_deviate_by_exactly_zero(make_trips):
    rows = [trip("10:05:00", "10:20:00", duracion_recorrido=633, modelo_bicicleta=m) for m in ("A", "B", "B", None, "A", "C", "C")]
    got = cells(G.departures(make_trips(*rows)), "duracion_recorrido_std", "modelo_mas_comun")
    assert got[at("10:30:00"), 1] == (0.0, "A")


def test_grid_is_dense_and_edges_fall_out(make_trips):
    trips = make_trips(
        trip("10:05:00", "10:10:00", 1, 2),  # arrival label 10:00 lies before the first departure label 10:30
        trip("11:40:00", "11:50:00", 2, None),  # last arrival label 11:30 comes from a trip without a destination id
        trip("11:45:00", "11:46:00", 3, 1),
    )
    grid = G.station_grid(trips)
    got = cells(grid, "despachos_count", "arribos_count", "arribos_prev_count", "arribos_count_prev_1")
    assert len(got) == 3 * 3  # 10:30, 11:00, 11:30 for stations 1, 2, 3
    assert got[at("10:30:00"), 1] == (1, 0, 0, 0)
    assert got[at("10:30:00"), 2] == (0, 0, 1, 0)  # known as a previous arrival, but not as a lag
    assert got[at("11:30:00"), 1] == (0, 1, 0, 0)
    assert sum(v[0] for v in got.values()) == 1  # the departures labelled 12:00 are outside


def test_lags_look_back_up_to_six_rows_with_zero_defaults(make_trips):
    leave = [f"{10 + i // 2}:{'05' if i % 2 == 0 else '35'}:00" for i in range(8)]
    trips = make_trips(*[trip(t, t, 1, 2, duracion_recorrido=100 + i) for i, t in enumerate(leave) for _ in range(i + 1)])
    grid = G.station_grid(trips).filter("id_estacion = 1").orderBy("timestamp")
    rows = grid.collect()
    assert sum("_prev_" in c for c in grid.columns) == 48 + 1
    counts = [r["despachos_count"] for r in rows]
    for i, row in enumerate(rows):
        for k in range(1, 7):
            assert row[f"despachos_count_prev_{k}"] == (counts[i - k] if i >= k else 0)
            assert row[f"duracion_recorrido_mean_prev_{k}"] == (rows[i - k]["duracion_recorrido_mean"] if i >= k else 0.0)


def test_short_stretches_give_the_same_grid(spark):
    trips, users = valid_trips(trips_view(spark, FOLDER)), clean_users(users_view(spark, FOLDER))
    one = G.station_grid(trips, users, stretch=10**6)
    many = G.station_grid(trips, users, stretch=7)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    assert one.count() == 57_560


def test_other_window_widths(make_trips):
    got = cells(G.station_grid(make_trips(trip("10:05:00", "11:50:00")), minutes=60, lags=1), "despachos_count", "arribos_count")
    assert got == {(at("11:00:00"), 1): (1, 0), (at("11:00:00"), 2): (0, 1)}


def test_no_trips_give_no_rows(make_trips):
    empty = make_trips(trip("10:05:00", "10:10:00")).filter("1 = 0")
    assert G.station_grid(empty).count() == 0


def test_rows_are_timestamps_times_stations_and_sums_are_kept(spark):
    trips = valid_trips(trips_view(spark, FOLDER))
    grid = G.station_grid(trips, lags=0)
    row = grid.agg(
        F.count("*").alias("n"), F.countDistinct("timestamp").alias("t"), F.countDistinct("id_estacion").alias("s"),
        F.sum("arribos_count").alias("a"), F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"),
    ).first()
    assert row["n"] == row["t"] * row["s"]
    inside = trips.filter((F.col("fecha_destino_recorrido") >= row["lo"]) & F.col("id_estacion_destino").isNotNull())
    assert row["a"] == inside.count()


def test_against_plain_pandas(spark):
    """All 48 lags and the counts, rebuilt with per-station shifts."""
    trips = valid_trips(trips_view(spark, FOLDER))
    full = G.station_grid(trips).toPandas().sort_values(["id_estacion", "timestamp"])
    for k in range(1, 7):
        shifted = full.groupby("id_estacion")[LAGGED].shift(k).fillna(0)
        for c in LAGGED:
            pd.testing.assert_series_equal(full[f"{c}_prev_{k}"].astype(float), shifted[c].astype(float), check_names=False)


def test_plan_has_one_window_one_sort_and_no_python(spark):
    trips, users = valid_trips(trips_view(spark, FOLDER)), clean_users(users_view(spark, FOLDER))
    plan = G.station_grid(trips, users)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert "Python" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert plan.count("REPARTITION_BY_COL") == 2  # the small skeleton table and the stacked rows
    scans = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line}
    assert not any("props" in scan for scan in scans)


def test_range_scan_reads_times_and_filters_only(spark):
    plan = G.slot_span(valid_trips(trips_view(spark, FOLDER)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_a_range_of_the_grid_is_the_grid_cut(spark):
    rows, riders = queries.valid(spark, FOLDER), queries.users(spark, FOLDER)
    since, until = "2024-01-09 10:10:00", "2024-01-10 03:30:00"
    whole = G.station_grid(rows, riders).filter(f"timestamp >= timestamp_ntz '{since}' and timestamp <= timestamp_ntz '{until}'")
    part = G.station_grid(rows, riders, since=since, until=until)
    assert part.count() == whole.count() > 0
    assert part.exceptAll(whole).count() == 0


def test_the_range_reaches_the_scan_of_stored_trips(spark, tmp_path):
    queries.valid(spark, FOLDER).write.parquet(str(tmp_path / "trips"))
    part = G.station_grid(spark.read.parquet(str(tmp_path / "trips")), since="2024-01-09", until="2024-01-09 23:30:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # The six lags reach back to 21:00; departures are labelled a slot later, and arrivals count once more in the next slot.
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "GreaterThanOrEqual(fecha_origen_recorrido,2024-01-08T20:00)" in line]
    assert pushed and all("LessThan(fecha_destino_recorrido,2024-01-10T00:00)" in line for line in pushed)


def test_a_frequent_rider_is_split_by_salt(spark):
    rows = queries.valid(spark, FOLDER).withColumn("id_usuario", F.when(F.col("id_recorrido") % 3 > 0, 7).otherwise(F.col("id_usuario")).cast("bigint"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, salted = (G.station_grid(rows, queries.users(spark, FOLDER), lags=1, salt=n) for n in (1, 8))
        assert "_part" in salted._jdf.queryExecution().executedPlan().toString()
        assert salted.count() == plain.count() and salted.exceptAll(plain).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
