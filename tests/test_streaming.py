"""Streams against the batch result of the same function."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from velogrid.registry.queries import trip_stream
from velogrid.session import work_path
from velogrid.sources.views import trips_view
from velogrid.streaming import live


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_complete_mode_equals_batch(spark):
    batch = live.live_counts(trips_view(spark, FOLDER))
    assert rows(live.drain(spark, live.live_counts(trip_stream(spark, FOLDER)), "complete")) == rows(batch)


def test_append_mode_emits_closed_windows(spark):
    trips = trips_view(spark, FOLDER)
    last = live.trip_ends(trips).agg(F.max("ts")).first()[0]
    closed = live.live_counts(trips).filter(F.col("fin") <= F.lit(last) - F.expr("interval 1 hour"))
    assert rows(live.drain(spark, live.live_counts(trip_stream(spark, FOLDER)), "append")) == rows(closed)


def test_late_rows_are_dropped_and_a_restart_goes_on(spark):
    base = work_path(spark, "late")
    schema = "fecha_origen_recorrido timestamp_ntz, fecha_destino_recorrido timestamp_ntz, id_estacion_origen bigint, id_estacion_destino bigint"

    def add(*times):
        values = ", ".join(f"(timestamp_ntz '2024-01-01 {t}', null, 1L, null)" for t in times)
        frame = spark.sql(f"select * from values {values} as t(fecha_origen_recorrido, fecha_destino_recorrido, id_estacion_origen, id_estacion_destino)")
        frame.selectExpr(
            "fecha_origen_recorrido", "cast(fecha_destino_recorrido as timestamp_ntz) as fecha_destino_recorrido", "id_estacion_origen",
            "cast(id_estacion_destino as bigint) as id_estacion_destino",
        ).write.mode("append").parquet(f"{base}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        live.start_to_table(live.live_counts(stream), f"{base}/out", f"{base}/log", "append", once=True).awaitTermination()

    add("10:05:00", "10:10:00", "13:00:00")
    run()
    add("10:20:00", "15:00:00")  # 10:20 is behind the watermark of 12:00
    run()
    got = [(r["inicio"].hour, r["salidas"]) for r in spark.read.parquet(f"{base}/out").orderBy("inicio").collect()]
    assert got == [(10, 2), (13, 1)]


def test_kpis(spark):
    kpis = live.live_kpis(live.drain(spark, live.live_counts(trip_stream(spark, FOLDER)), "complete"))
    assert kpis.agg(F.sum("viajes")).first()[0] == trips_view(spark, FOLDER).count()


def test_a_stream_reads_a_table_stored_as_a_folder(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    one, many = (live.drain(spark, live.live_counts(trip_stream(spark, f)), "complete") for f in (FOLDER, str(tmp_path)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count()


def test_a_batch_that_fails_leaves_the_last_result(spark, monkeypatch):
    base = work_path(spark, "failing")
    day = lambda h: spark.sql(f"select timestamp_ntz'2024-01-01 {h}:00:00' as fecha_origen_recorrido, timestamp_ntz'2024-01-01 {h}:10:00' as fecha_destino_recorrido, 1L as id_estacion_origen, 2L as id_estacion_destino")
    day(10).write.parquet(f"{base}/in")

    def run():
        stream = live.live_counts(spark.readStream.schema(day(10).schema).parquet(f"{base}/in"))
        live.start_to_table(stream, f"{base}/out", f"{base}/log", "complete", once=True).awaitTermination()
        return live.live_table(spark, f"{base}/out", stream.schema)

    assert run().count() == 2
    day(12).write.mode("append").parquet(f"{base}/in")
    first, write = live.Versions.write, live.Versions.write

    def fail(self, writer, *rest, **more):
        def half(at):
            writer(at)
            raise RuntimeError("the disk is full")

        return write(self, half, *rest, **more)

    monkeypatch.setattr(live.Versions, "write", fail)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(live.Versions, "write", first)
    schema = live.live_counts(day(10)).schema
    assert live.live_table(spark, f"{base}/out", schema).count() == 2  # the reader still has the first batch
    assert run().count() == 4 and run().count() == 4  # the batch is run again, and once only
    assert live.live_table(spark, f"{base}/nothing", schema).count() == 0
