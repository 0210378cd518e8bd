"""Departures and arrivals per station and half hour, and live key figures, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from velogrid.session import work_path
from velogrid.sources.versions import Versions

LATENESS = "1 hour"
WINDOW = "30 minutes"

#: Versions of a complete result that stay.
KEPT = 2


def trip_ends(trips: DataFrame) -> DataFrame:
    """Two rows per trip: leaving its origin and reaching its destination."""

    def end(kind: str, side: str):
        return F.struct(
            F.col(f"fecha_{side}_recorrido").cast("timestamp").alias("ts"),  # watermarks need a zoned type
            F.col(f"id_estacion_{side}").alias("id_estacion"),
            F.lit(kind).alias("tipo"),
        )

    return trips.select(F.inline(F.array(end("salida", "origen"), end("llegada", "destino")))).filter(
        "ts is not null and id_estacion is not null"
    )


def live_counts(trips: DataFrame, lateness: str = LATENESS, width: str = WINDOW) -> DataFrame:
    """Departures and arrivals per window and station; rows later than the watermark are dropped.

    The same function gives the batch result on a static table.
    """
    ends = trip_ends(trips)
    if trips.isStreaming:
        ends = ends.withWatermark("ts", lateness)
    return (
        ends.groupBy(F.window("ts", width).alias("w"), "id_estacion")
        .agg(F.count_if(F.col("tipo") == "salida").alias("salidas"), F.count_if(F.col("tipo") == "llegada").alias("llegadas"))
        .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fin"), "id_estacion", "salidas", "llegadas")
    )


def live_kpis(counts: DataFrame) -> DataFrame:
    """Trips and active stations per window, exactly, from a table of ``live_counts``.

    That table has one row per window and station, so the figures are a sum and a count of its rows.
    """
    return counts.groupBy("inicio").agg(F.sum("salidas").alias("viajes"), F.count("*").alias("estaciones_activas"))


def start_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    """Write a stream to a parquet table. ``append`` adds closed windows, with the sink's own exactly-once log, to the folder ``path``.

    ``complete`` writes the full result of every batch as a version of its own in ``path`` and then switches to it, so that readers (``live_table``)
    always meet a whole result, and a batch that fails leaves the last one. ``KEPT`` versions stay, for those who are still reading. A batch that is
    run again after a failure finds its number in the log and isn't written twice.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").option("path", path).start()

    def switch(batch: DataFrame, number: int) -> None:
        versions = Versions(batch.sparkSession, path)
        done = versions.current()
        if done is None or done.info["batch"] < number:
            versions.write(lambda at: batch.write.parquet(at), {"batch": number}, keep=KEPT)

    return writer.foreachBatch(switch).start()


def live_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last whole result of a ``complete`` stream; no rows before its first batch."""
    now = Versions(spark, path).current()
    return spark.createDataFrame([], schema) if now is None else spark.read.schema(schema).parquet(now.path)


def drain(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all input available now and return its table."""
    base = work_path(spark, "stream")
    start_to_table(stream, f"{base}/table", f"{base}/checkpoint", mode, once=True).awaitTermination()
    if mode == "complete":
        return live_table(spark, f"{base}/table", stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{base}/table")
