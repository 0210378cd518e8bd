"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: The folder of each session on one machine that names none.
_own: dict[str, str] = {}


def local_session(cpus: int = 8, app: str = "velogrid", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared folder (``spark.checkpoint.dir``).

    Without that setting a cluster has no folder that all executors see, so this raises; a session
    on one machine gets a folder of its own under the temporary folder. No setting is changed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="velogrid-"))
    return f"{base.rstrip('/')}/velogrid/{name}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df, name: str):
    """Write ``df`` once to the shared folder and read it back, so several consumers scan a table."""
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
