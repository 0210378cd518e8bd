"""Writers for stage tables, submissions, the catalogue, metrics and models."""

from __future__ import annotations

import json

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.operators.scoring import submission
from velogrid.operators.stations import catalog_records
from velogrid.schemas import CATALOG_SCHEMA


def write_stage(df: DataFrame, path: str, column: str = "timestamp", mode: str = "overwrite") -> None:
    """A stage table partitioned by year and month of ``column``.

    Rows are rebalanced by month: small months share a task, a large month is split over several.
    """
    dated = df.withColumns({"anio_p": F.year(column), "mes_p": F.month(column)})
    dated.hint("rebalance", "anio_p", "mes_p").write.mode(mode).partitionBy("anio_p", "mes_p").parquet(path)


def write_submission(predicted: DataFrame, path: str, single_file: bool = False) -> None:
    """The submission as CSV; ``single_file`` is for results that one task can write."""
    rows = submission(predicted)
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("header", True).csv(path)


def catalog_document(stations: DataFrame, source: str = "", limit: int | None = None, order: str = "id") -> DataFrame:
    """One JSON document ``{stations, metadata}``; its size is that of the station list."""
    names = [f.name for f in CATALOG_SCHEMA.fields]
    present = [n for n in names if n in stations.columns]
    rows = stations.orderBy(order).limit(limit) if limit else stations
    records = catalog_records(rows.withColumn("_at", F.col(order)))
    listed = F.sort_array(F.collect_list(F.struct("_at", F.struct(*present).alias("s"))))
    meta = {
        "total_stations": F.size("stations"),
        "last_updated": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
        **(
            {"note": F.lit("Sample data for development")}
            if limit
            else {"data_source": F.lit(source), "coordinate_system": F.lit("WGS84")}
        ),
    }
    return records.agg(F.transform(listed, lambda r: r["s"]).alias("stations")).select(
        "stations", F.struct(*[c.alias(n) for n, c in meta.items()]).alias("metadata")
    )


def write_catalog(stations: DataFrame, path: str, source: str = "") -> None:
    catalog_document(stations, source).coalesce(1).write.mode("overwrite").json(path)


def write_catalog_sample(stations: DataFrame, path: str, n: int = 50) -> None:
    catalog_document(stations, limit=n).coalesce(1).write.mode("overwrite").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_model(spark: SparkSession, model: MLWritable, path: str, features: list[str], metrics: dict[str, float]) -> None:
    """The model and, beside it, its feature order, metrics and training time as one JSON row."""
    model.write().overwrite().save(f"{path}/model")
    info = spark.createDataFrame([(json.dumps(features), json.dumps(metrics))], "features string, metrics string")
    info.withColumn("train_date", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(f"{path}/info")


def load_model(spark: SparkSession, kind, path: str) -> tuple[object, dict]:
    """``(model, info)`` for a model class such as ``GBTRegressionModel``."""
    row = spark.read.schema("features string, metrics string, train_date string").json(f"{path}/info").first()
    info = {"features": json.loads(row["features"]), "metrics": json.loads(row["metrics"]), "train_date": row["train_date"]}
    return kind.load(f"{path}/model"), info


def inspect(df: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """The first rows, and per column its type and number of values."""
    first = df.limit(n)
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    rows = [
        F.struct(F.lit(f.name).alias("columna"), F.lit(f.dataType.simpleString()).alias("tipo"), F.col(f"`{f.name}`").alias("no_nulos"))
        for f in df.schema.fields
    ]
    return first, counts.select(F.inline(F.array(*rows)))
