"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from velogrid.llm import context_mixing, decontaminate, forest, language_id, license_scan, merkle, ngram_join, pieces, quality_rules, spelling, statements, token_counts, toxicity, warc
from velogrid.llm.samples import remainder


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(divisor: int, value: int):
    """True also for a null id, so that such a row is never learned from."""
    return F.coalesce(remainder(divisor) == value, F.lit(True)).alias("held_out")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=512)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_read(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item in it; clean documents have none."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.benchmark_matches(docs, _read(spark, sf_dir, "benchmark"))
    pairs = found.select("doc_id", F.inline("matches"))
    return pairs.select("doc_id", "item_id", F.round("containment", 6).alias("containment"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_pages(_read(spark, sf_dir, "pages"))
    records = warc.page_ids(warc.read_warc(written))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.sample_encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("pieces"))
    return out.select("doc_id", n.cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"), "lossless")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = _held_out(5, 0)
    model = language_id.train(docs.where(~held))
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held, "lang_pred", F.col("lang_score").alias("score"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held = _held_out(4, 2)
    labels = _read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(~held))
    out = toxicity.toxicity(docs, model)
    predicted = (F.col("toxic_score") >= 0.3).cast("int")
    return out.select("doc_id", held, F.col("toxic_score").alias("score"), predicted.alias("predicted"), F.size("offending").alias("n_offending"))


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.mixed_scores(_read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and the root that it folds to when some documents have another n_chars."""
    docs = _read(spark, sf_dir, "documents")
    count = F.col("n_chars").cast("long")
    changed = F.when(remainder(7) == 0, count + 1).otherwise(count)
    fields = [[F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")] for n in (count, changed)]
    made = merkle.manifest(docs, F.col("lang"), *fields)
    return merkle.fold(made).withColumnRenamed("key", "doc_id")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_ngram_join, op3_decontaminate, op4_warc, op5_pieces, op6_language_id, op7_license_scan, op8_quality_rules, op9_toxicity, op10_context_mixing, op11_merkle_manifest, op12_spelling, op13_nearest, pipeline)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[x for x in string_split_regex({}, '[\x20\x09-\x0D]+') if x <> '']"


def _shingles(k: int, words: str) -> str:
    """SQL: the distinct shingles of a list of words; a shorter list is one shingle, an empty one has none."""
    return f"""case when len({words}) = 0 then [] when len({words}) < {k} then [array_to_string({words}, ' ')]
    else list_distinct([array_to_string({words}[i:i + {k - 1}], ' ') for i in range(1, len({words}) - {k} + 2)]) end"""


_JOIN = f"""
with recursive w as (select doc_id, {_WORDS.format(_LOWER)} as w from documents),
s as (select doc_id, {_shingles(4, "w")} as s from w),
u as (select doc_id, unnest(s) as g from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as n from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as d, doc_id as c from s union select r.d, e.b from r join e on e.a = r.c)
select doc_id, cast(len(any_value(s)) as bigint) as n_shingles, min(c) as component_id from s join r on d = doc_id group by doc_id
"""

_PLAIN = _WORDS.format(f"translate({_LOWER}, '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~', '')")
_LEAKS = f"""
with i as (select item_id, least(len(w), 5) as k, {_shingles(5, "w")} as s from (select item_id, {_PLAIN} as w from benchmark)),
g as (select item_id, k, len(s) as n, unnest(s) as g from i),
d as (select doc_id, k, unnest(list_distinct([array_to_string(w[x:x + k - 1], ' ') for x in range(1, len(w) - k + 2)])) as g
  from (select doc_id, {_PLAIN} as w from documents), (select distinct k from g) where len(w) >= k)
select doc_id, item_id, round(count(*) / any_value(n), 6) as containment from d join g using (k, g)
group by doc_id, item_id having count(*) >= 0.8 * any_value(n)
"""

_WARC = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as n, sha1(body) as digest from p),
k as (select *, max(page_id) over (partition by digest, n) as kept from d)
select page_id, n as payload_bytes, digest as payload_digest,
  case when n >= 1000 and page_id <> kept then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> kept then kept end as refers_to, true as digest_ok
from k
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_join": _JOIN, "op3_decontaminate": _LEAKS, "op4_warc": _WARC, "op11_merkle_manifest": statements.MERKLE, "op12_spelling": statements.SPELLING}
