"""Shared intermediate tables with a life cycle: built once a session, listed, and deleted.

A stage is known by the plan that makes it (its inputs and parameters) and by the state of the files that the plan reads. Who asks for
the same plan gets the same table; who asks after a file has changed gets a new one. A stage becomes visible when its
write has ended, so a failed write leaves none, and no files. ``close`` deletes a stage, ``close_all`` those of a
session, which also happens when Python ends.

Tables can be clustered by a column: hash buckets, sorted inside, whose scan serves grouping, joins and windows by that column
without an exchange.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from velogrid.session import work_path


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def fingerprint(spark: SparkSession, df: DataFrame) -> tuple:
    """Names, sizes and times of the files that ``df`` reads."""
    conf, out = spark._jsparkSession.sessionState().newHadoopConf(), []
    for name in sorted(df.inputFiles()):
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = at.getFileSystem(conf).getFileStatus(at)
        out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)


@dataclass(eq=False)
class Stage:
    """A written table: ``name`` as asked for, the plan that it holds, and where it lies."""

    name: str
    plan: DataFrame = field(repr=False)
    files: tuple = field(repr=False)
    clustered: tuple[str, ...]
    path: str
    table: str | None = None

    def read(self) -> DataFrame:
        spark = self.plan.sparkSession
        return spark.table(self.table) if self.table else spark.read.schema(self.plan.schema).parquet(self.path)

    def close(self) -> None:
        spark = self.plan.sparkSession
        if self in _open:
            _open.remove(self)
        if self.table and spark.getActiveSession() is not None:
            spark.sql(f"drop table if exists {self.table}")
        delete(spark, self.path)


_open: list[Stage] = []


def stages(spark: SparkSession) -> list[Stage]:
    """The session's stages, the oldest first."""
    app = spark.sparkContext.applicationId
    return [s for s in _open if s.plan.sparkSession.sparkContext.applicationId == app]


def stage(df: DataFrame, name: str, cluster_by: str | None = None, sort_by: tuple[str, ...] = ()) -> Stage:
    """The stage that holds ``df``: an open one of the same plan over the same files, else a new one.

    With ``cluster_by`` the table has as many buckets as shuffles have partitions, each sorted by that column and ``sort_by``.
    """
    spark, files = df.sparkSession, fingerprint(df.sparkSession, df)
    clustered = (cluster_by, *sort_by) if cluster_by else ()
    for known in stages(spark):
        if known.clustered == clustered and known.files == files and known.plan.columns == df.columns and known.plan.sameSemantics(df):
            return known
    path, table = work_path(spark, name), None
    try:
        if cluster_by:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            table = f"velogrid_{name}_{uuid.uuid4().hex}"
            # Dealt as the buckets are, so that each bucket is one file.
            rows = df.repartition(n, cluster_by).write.bucketBy(n, cluster_by).sortBy(*clustered)
            rows.option("path", path).format("parquet").saveAsTable(table)
        else:
            df.write.parquet(path)
    except BaseException:
        if table:
            spark.sql(f"drop table if exists {table}")
        delete(spark, path)
        raise
    made = Stage(name, df, files, clustered, path, table)
    _open.append(made)
    return made


def close_all(spark: SparkSession | None = None) -> None:
    """Delete the stages of a session, or all."""
    for s in list(_open if spark is None else stages(spark)):
        s.close()


@contextmanager
def own_stages(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end; stages that were there before stay."""
    before = list(stages(spark))
    try:
        yield
    finally:
        for s in stages(spark):
            if s not in before:
                s.close()


@atexit.register
def _at_exit() -> None:
    try:
        close_all()
    except Exception:  # noqa: BLE001  the session may be gone; its own temporary folder goes with it
        _open.clear()
