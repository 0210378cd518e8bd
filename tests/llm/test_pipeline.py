"""The pipeline's stages on small tables, and the registered queries."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_operators import ODD, brute_groups
from tools.check import connect, differences
from velogrid.llm import decontaminate, queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    before, after = kept["toxicity"], kept["n-gram Jaccard join"]
    assert set(after) == {i for i, _, c in brute_groups(list(before.items()), 5, 80, 100) if i == c}
    shingle = lambda t: set(decontaminate.item_shingles(t.encode(), 5).tolist())
    sets = [s for r in items.collect() if (s := shingle(r.text))]
    leaks = {i for i, t in after.items() if any(len(s & shingle(t)) >= 0.8 * len(s) for s in sets)}
    assert set(kept["benchmark decontamination"]) == set(after) - leaks
    bad = {r.doc_id for r in labels.where("toxic = 1").collect()}
    first = kept["language ID"]
    assert len(bad & set(before)) <= 0.2 * len(bad & set(first)) + 1 and len(before) >= 0.8 * len(set(first) - bad)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id: r.text for r in last} == kept["benchmark decontamination"]
    assert all(r.n_pieces == len(r.pieces) for r in last)


def test_odd_rows_and_empty_tables(spark, tmp_path):
    clash = ("matches", "pieces", "lossless", "row", "lang_pred", "toxic_score", "offending", "component_id", "decoded")
    odd = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(c) for c in clash})
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["4", "5", "None"]
    odd.limit(0).write.mode("overwrite").parquet(str(tmp_path / "empty/documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"empty/{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    result = connect(FOLDER).execute(queries.oracle_sql()[name])
    assert differences((df.columns, df.collect()), ([d[0] for d in result.description], result.fetchall())) == ""


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_gives_a_row_per_input_row(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = df.collect()
    table = "pages" if name == "op4_warc" else "documents"
    assert json.dumps(df.columns)
    assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count() or name in ("op3_decontaminate", "op12_spelling", "op13_nearest", "pipeline") and rows
