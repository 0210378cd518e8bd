"""A training corpus from the table ``documents``: language, toxicity, near copies, benchmark leaks, pieces.

Every stage works on all rows that the stage before has kept, and decides what goes on; the result of each is written to the
shared folder and read again. Null texts go in the first stage, which rejects what has no letter. Rows with a null doc_id can't
be told apart by id and are never taken for copies; of repeated rows of one doc_id one stays. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.llm import decontaminate, language_id, ngram_join, pieces, toxicity
from velogrid.llm.exchange import BATCH_BYTES
from velogrid.session import staged

#: Documents below this score for every language are rejected, and from this toxicity on.
LEAST_LANGUAGE, TOXIC = 0.3, 0.3

#: No stage but the last two can be written in SQL: the learned scores can't.
ORACLE_SQL = None


def _whole(docs: DataFrame, *more: str) -> DataFrame:
    """The text and ``more`` for an operator, and all other columns in one, so that none clashes with what it adds.

    From here on the session hands texts to Python in batches of ``BATCH_BYTES``, as five stages share the executors' memory.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    rest = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "text", *more)


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return found.select(*[F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language_id.identify(_whole(docs), language_id.train(docs))
    return _back(found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE)), docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _back(toxicity.toxicity(_whole(docs), model).where(F.col("toxic_score") < TOXIC), docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one that names it."""
    joined = staged(spark, ngram_join.ngram_join(docs).where("doc_id is not null"), "groups")
    copies = joined.where("doc_id <> component_id").select("doc_id")
    repeated = joined.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id")).where("n > 1")
    stay = docs.join(copies.unionByName(repeated.select("doc_id")), "doc_id", "left_anti")
    once = docs.join(repeated.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.unionByName(once).select(*docs.columns)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(_whole(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _back(found.where(F.size("matches") == 0), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their sampled pieces, and the text as the pieces give it back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.sample_encode(_whole(docs, "doc_id"), model, decoded="decoded").where("lossless")
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "pieces", "n_pieces")]
    return out.select(*own, F.col("decoded").alias("text"), "pieces", F.size("pieces").cast("long").alias("n_pieces"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("toxicity", clean),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", unleaked),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; each result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
