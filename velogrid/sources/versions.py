"""Versions of a table or model in one folder: written beside each other, switched by a log.

A version is written under a name that nothing else has, then named in the log, which only grows; a reader takes the last entry. So a
reader always meets a whole version, a failed write changes nothing for readers, and what was current stays current.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.stages import delete

LOG = "version bigint, path string, info string, removed boolean"


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    info: dict


class Versions:
    """The versions in ``folder``; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(LOG).json(f"{self.folder}/log")

    def all(self) -> list[Version]:
        """The versions that are still there, the oldest first."""
        try:
            rows = self._log().groupBy("version").agg(F.max("path").alias("path"), F.max("info").alias("info"), F.max("removed").alias("removed"))
            return [Version(r["version"], r["path"], json.loads(r["info"])) for r in rows.where("not removed").orderBy("version").collect()]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []  # nothing was ever written

    def current(self) -> Version | None:
        return (self.all() or [None])[-1]

    def _append(self, version: Version, removed: bool) -> None:
        row = [(version.number, version.path, json.dumps(version.info), removed)]
        self.spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").json(f"{self.folder}/log")

    def write(self, writer: Callable[[str], None], info: dict | None = None, keep: int | None = None) -> Version:
        """``writer`` writes to the path that it is given; then that is the current version. The ``keep`` last ones stay, None keeps all."""
        before = self.all()
        path = f"{self.folder}/version-{uuid.uuid4().hex}"
        try:
            writer(path)
        except BaseException:
            delete(self.spark, path)
            raise
        made = Version(before[-1].number + 1 if before else 1, path, info or {})
        self._append(made, False)
        for old in before[: len(before) + 1 - keep] if keep else []:
            self._append(old, True)  # first out of the log, then out of the store
            delete(self.spark, old.path)
        return made
