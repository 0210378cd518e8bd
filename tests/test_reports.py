"""Profiles, catalogue, scores, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER, trip
from velogrid.operators import demand_score as S
from velogrid.operators import profile as P
from velogrid.operators import stations as A
from velogrid.registry.queries import grid, stock
from velogrid.sources import files, sinks


def test_age_bands(spark):
    users = spark.createDataFrame([(a,) for a in (10, 20, 21, 100)], "edad_usuario int")
    assert sorted((r["banda"], r["usuarios"]) for r in P.age_bands(users).collect()) == [(1, 2), (2, 1), (9, 1)]


def test_histogram_puts_the_largest_value_in_the_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 399, 400, 401)], "duracion_recorrido int")
    assert {r["bin"]: r["viajes"] for r in P.duration_histogram(df).collect()} == {1: 2, 60: 2}
    same = spark.createDataFrame([(7,), (7,)], "duracion_recorrido int")
    assert [tuple(r) for r in P.duration_histogram(same).collect()] == [(1, 7.0, 2)]


def test_tiers_count_stations_without_trips(spark, make_trips):
    trips = make_trips(*[trip("10:05:00", "10:10:00", 1, 1)] * 3, trip("10:05:00", "10:10:00", 2, None))
    register = spark.createDataFrame([(1,), (2,), (3,)], "id_estacion bigint")
    tiers = {r["nivel"]: r["estaciones"] for r in P.traffic_tiers(P.station_traffic(trips, register), (3, 6)).collect()}
    assert tiers == {"fantasma": 1, "poco_activa": 1, "normal": 1}


def test_first_seen_prefers_origins_then_time(make_trips):
    trips = make_trips(
        trip("10:00:00", "10:10:00", 1, 2, nombre_estacion_origen="late", nombre_estacion_destino="as destination"),
        trip("09:00:00", "10:10:00", 1, 3, nombre_estacion_origen="early", nombre_estacion_destino="three"),
        trip("11:00:00", "11:10:00", 2, 1, nombre_estacion_origen="as origin", nombre_estacion_destino="x"),
        trip(None, "11:10:00", 1, None, nombre_estacion_origen="undated"),
    )
    got = {r["id_estacion"]: r["nombre_estacion"] for r in A.first_seen_stations(trips).collect()}
    assert got == {1: "early", 2: "as origin", 3: "three"}


def test_catalog_drops_stations_whose_first_record_has_no_place(make_trips):
    place = {"lat_estacion_origen": -34.6, "long_estacion_origen": -58.4}
    trips = make_trips(
        trip("09:00:00", "10:10:00", 1, None),
        trip("10:00:00", "10:10:00", 1, None, **place),
        trip("10:00:00", "10:10:00", 2, 1, **place),
        trip("10:00:00", "10:10:00", 3, 2, lat_estacion_origen=0, long_estacion_origen=0),
    )
    rows = A.catalog(trips).collect()
    assert [(r["id"], r["total_trips"], r["popularity_score"]) for r in rows] == [(2, 2, 100.0)]


def test_popularity_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 400), (2, 1), (3, 3)], "id bigint, total_trips bigint")
    got = {r["id"]: r["popularity_score"] for r in A.with_popularity(df).collect()}
    assert got == {1: 100.0, 2: 0.2, 3: 0.8}


def test_status_and_occupancy(spark):
    df = spark.createDataFrame([(0, 9), (8, 10), (7, 10), (0, 0), (1, 8)], "available_bikes int, total_docks int")
    got = [(r["status"], r["ocupacion"]) for r in A.with_station_status(df).collect()]
    assert got == [("empty", 0), ("full", 80), ("active", 70), ("empty", None), ("active", 13)]


STATION = "id bigint, name string, popularity_score double, available_bikes int, total_docks int, total_trips bigint"


@pytest.mark.parametrize(
    "row, instant, arrivals, sure",
    [
        ((1, "a", 100.0, 10, 20, 20000), "2024-01-08 08:00:00", 28, 85),
        ((1, "a", 100.0, 10, 20, 20000), "2024-01-13 18:00:00", 19, 80),
        ((1, "a", None, None, None, None), "2024-01-08 03:00:00", 1, 55),
        ((1, "a", 50.0, 9, 10, 6000), "2024-01-08 12:30:00", 19, 80),
        ((1, "a", 50.0, 1, 0, 6000), "2024-01-08 10:00:00", 10, 65),
    ],
)
def test_demand_score(spark, row, instant, arrivals, sure):
    got = S.score_of(spark.createDataFrame([row], STATION), 1, instant).first()
    assert (got["predicted"], got["confidence"]) == (arrivals, sure)


def test_reasons(spark):
    got = S.score_of(spark.createDataFrame([(1, "a", 11.9, 19, 20, 20000)], STATION), 1, "2024-01-08 08:00:00").first()["factors"]
    assert got == [
        "Popularidad de estación: 11.9%",
        "Hora pico matutina (7-9 AM)",
        "Día laborable (mayor actividad)",
        "Alta disponibilidad de bicis",
        "Estación muy activa (20,000 viajes históricos)",
    ]
    assert S.score_of(spark.createDataFrame([], STATION), 1, "2024-01-08 08:00:00").count() == 0


def test_catalog_json(spark, tmp_path):
    stations = stock(spark, FOLDER)
    sinks.write_catalog(stations, str(tmp_path / "c"), "trips")
    sinks.write_catalog_sample(stations, str(tmp_path / "s"), 5)
    document = json.loads(next((tmp_path / "c").glob("*.json")).read_text(encoding="utf-8"))
    assert document["metadata"]["total_stations"] == len(document["stations"]) == stations.count()
    assert isinstance(document["stations"][0]["id"], str) and all(s["name"] and s["address"] for s in document["stations"])
    sample = json.loads(next((tmp_path / "s").glob("*.json")).read_text(encoding="utf-8"))
    assert len(sample["stations"]) == 5 and sample["metadata"]["note"] == "Sample data for development"
    back = files.read_station_catalog(spark, str(tmp_path / "c"))
    assert back.count() == stations.count() and files.catalog_as_stations(back).columns[0] == "id_estacion"


def test_stage_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "g")
    sinks.write_stage(grid(spark, FOLDER).select("timestamp", "id_estacion", "arribos_count"), path)
    part = files.read_stage(spark, path, "2024-01-10", "2024-01-11")
    assert part.count() == 48 * 40 and part.agg(F.min("timestamp")).first()[0].day == 10
    assert "PartitionFilters: [isnotnull" in part._jdf.queryExecution().executedPlan().toString()
    assert files.read_stage(spark, path, "2030-01-01").count() == 0


def test_submission_file_reads_back(spark, tmp_path):
    df = spark.sql("select 3L as id_estacion, timestamp_ntz '2024-09-09 12:00:00' as timestamp, 2.5D as arribos_predichos")
    sinks.write_submission(df, str(tmp_path / "s"), single_file=True)
    text = next((tmp_path / "s").glob("*.csv")).read_text().split()
    assert text[0] == "id_estacion,timestamp,arribos_predichos" and text[1].startswith("3,2024-09-09T12:00:00") and text[1].endswith(",2")
    assert files.read_scoring_input(spark, str(tmp_path / "s")).schema["timestamp"].dataType.simpleString() == "timestamp_ntz"


def test_inspect(spark):
    first, columns = sinks.inspect(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), 1)
    assert first.count() == 1 and {r["columna"]: (r["tipo"], r["no_nulos"]) for r in columns.collect()} == {"a": ("int", 2), "b": ("string", 1)}
