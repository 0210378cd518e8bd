"""The holdout of the quality rules counts independent documents only."""

import random

from pyspark.sql import functions as F

from velogrid.llm import quality_rules

WORDS = [f"wort{i}" for i in range(5000)]


def made(spark, n):
    rng = random.Random(n)
    rows = [(i, " ".join(rng.sample(WORDS, 60)), "de") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), [(i, 1) for i in range(n)]


def cutoffs(docs, labels):
    measured = quality_rules.measures(docs.select("doc_id", "text", F.col("lang").alias("stratum")).withColumns({"text_hash": F.xxhash64("text"), "text_check": F.xxhash64(F.lit(1), "text")}))
    holdout = quality_rules.independent(measured.drop("text"), labels)
    return holdout, {(r.measure, r.cutoff) for r in quality_rules.certified_cutoffs(holdout).collect()}


def test_repeated_labels_and_copies_are_one_draw(spark):
    docs, rows = made(spark, 300)
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    once, certified = cutoffs(docs, labels)
    assert once.count() == 300 and certified == set()  # too few for any certificate
    again, certified = cutoffs(docs, spark.createDataFrame(rows * 6, labels.schema))
    assert again.count() == 300 and certified == set()
    copies = docs
    for k in range(1, 6):
        copies = copies.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000 * k))
    copied, certified = cutoffs(copies, spark.createDataFrame([(i + 1000 * k, 1) for i, _ in rows for k in range(6)], labels.schema))
    assert copied.count() == 300 and certified == set()


def test_many_independent_documents_certify(spark):
    docs, rows = made(spark, 3000)
    assert cutoffs(docs, spark.createDataFrame(rows, "doc_id long, quality int"))[1]


def test_contradicting_labels_count_for_neither(spark):
    docs, rows = made(spark, 20)
    copy = docs.where("doc_id = 3").withColumn("doc_id", F.lit(99).cast("long"))
    labels = spark.createDataFrame([*rows, (1, 0), (99, 0), (2, None), (None, 1), (777, 1)], "doc_id long, quality int")
    holdout, _ = cutoffs(docs.unionByName(copy), labels)
    assert holdout.count() == 18 and holdout.where("quality = 1").count() == 18  # without document 1 and the text of 3 and 99
    both = quality_rules.quality_rules(docs.unionByName(copy).unionByName(copy), labels)
    assert both.count() == 22
