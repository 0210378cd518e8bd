"""Bounded, reproducible samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def remainder(divisor: int, name: str = "doc_id") -> Column:
    """crc32 of an id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % divisor


def per_label(rows: DataFrame, label: str, most: int, key: str = "doc_id") -> DataFrame:
    """(``key``, ``label``, label_rows) of up to ``most`` keys of each label: those with the smallest hash.

    ``rows`` needs these two columns only, so no text is moved; label_rows is the label's number of keys. The counts
    thin out large labels by hash before keys are ranked, so no task ranks a whole label. Null labels and keys don't count.
    """
    rows = rows.select(key, label).where(F.col(label).isNotNull() & F.col(key).isNotNull()).distinct()
    totals = rows.groupBy(label).agg(F.count("*").alias("label_rows"))
    h = F.xxhash64(key)
    near = rows.join(F.broadcast(totals), label)  # a row per label
    near = near.where(F.pmod(h, F.lit(1 << 30)) * F.col("label_rows") <= F.lit(float(3 * most + 200)) * (1 << 30))
    rank = Window.partitionBy(label).orderBy(F.pmod(h, F.lit(1 << 30)), h)
    return near.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= most).drop("_rank")


def sample_texts(docs: DataFrame, sample: DataFrame, label: str) -> list:
    """The sampled rows with their ``text``, by hash of doc_id; the sample is bounded by its making.

    Of several texts with one doc_id the smallest counts, so that repeated rows don't add up.
    """
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", label, "label_rows").agg(F.min("text").alias("text"))
    found = texts.select(F.xxhash64("doc_id").alias("h"), "text", label, "label_rows").toLocalIterator()
    return sorted(found, key=lambda r: (r.h, str(r[label])))
