"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a text if a measure is beyond a cutoff. For each stratum and measure the cutoffs are tried
from the mildest to the strictest. A cutoff is certified if the share of good documents it rejects is
proven to be at most ``risk`` / (number of measures): with k of n labelled good documents rejected, the
exact binomial probability of k or fewer at that share must not exceed the level. A sequence stops at its first
failure, which keeps its error at one level; the levels of all sequences add up to ``error`` (Bonferroni).
So with confidence 1 - ``error``, all strata together, the rules reject at most ``risk`` of the good documents of every stratum.

All of it is DataFrame expressions; no text leaves its row, and only counts by stratum are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velogrid.session import staged

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window whose repetition counts.
SPAN = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Measures (whole numbers; rejected above the cutoff) and their cutoffs, mildest first.
CUTOFFS: dict[str, list[int]] = {
    "symbols_per_100_words": [300, 200, 150, 100, 90, 80, 70, 60, 50, 40, 30, 25, 20, 15, 10, 8, 6, 5, 4, 3, 2],
    "repeated_per_100_words": [28, 26, 24, 22, 20, 18, 16, 14, 12, 10, 8, 6, 5, 4, 3, 2, 1],
    "dup_lines_per_100_words": [20, 15, 10, 8, 6, 5, 4, 3, 2, 1, 0],
    "chars_per_10_words": [200, 180, 160, 150, 140, 130, 120, 110, 100, 95, 90, 85],
    "shortness_of_words": [-10, -15, -20, -25, -30, -32, -34, -36, -38, -40],
}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words that lie in a window which occurs twice or more."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - SPAN + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(SPAN))))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(p: Column) -> Column:
            same = lambda e, i, step: (F.get(p, i + step)["x"] == e["x"]) & F.get(p, i + step).isNotNull()
            kept = F.filter(p, lambda e, i: F.coalesce(same(e, i, -1), F.lit(False)) | F.coalesce(same(e, i, 1), F.lit(False)))
            return F.array_sort(F.transform(kept, lambda e: e["i"]))

        first = F.struct(F.lit(-SPAN).alias("at"), F.lit(0).alias("n"))
        total = F.aggregate(_let(placed, starts), first, lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(SPAN), i - a["at"])).alias("n")))
        return total["n"]

    found = _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n < SPAN + 1, F.lit(0)).otherwise(found).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null text has no words, lines or symbols. Columns of these names are replaced, all others stay.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.withColumn("_words", F.filter(F.split(text, BLANK), lambda w: w != ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": _repeated(F.col("_words")),
        }
    ).drop("_words")
    return docs.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _values() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    per = lambda c, k: F.floor(k * F.col(c) / n)
    return {
        "symbols_per_100_words": per("n_symbols", 100),
        "repeated_per_100_words": per("n_repeat_words", 100),
        "dup_lines_per_100_words": per("n_dup_lines", 100),
        "chars_per_10_words": per("word_chars", 10),
        "shortness_of_words": -per("word_chars", 10),
    }


def tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) of a binomial X with n trials: its terms, each from the one before, added as logarithms."""
    odds = F.log(F.lit(share / (1 - share)))
    start = n * F.log(F.lit(1 - share))
    acc = F.struct(start.alias("term"), start.alias("all"))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + odds
        more = F.greatest(term, a["all"]) + F.log1p(F.exp(-F.abs(term - a["all"])))
        return F.struct(term.alias("term"), more.alias("all"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    # Above the mean the probability is over one half at any rate, which no test accepts.
    return F.when(k > n * share + 1, F.lit(1.0)).otherwise(F.exp(F.aggregate(steps, acc, add)["all"]))


def certified_cutoffs(holdout: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """(stratum, measure, cutoff): the strictest certified cutoff; no row where none is.

    ``holdout`` has the columns of ``measures``, ``stratum`` and ``quality``; rows with quality 1 that pass the base rules count.
    """
    good = holdout.where("quality = 1 and not base_failed")
    sums = []
    for name, value in _values().items():
        sums += [F.count_if(value > c).alias(f"{name}/{i}") for i, c in enumerate(CUTOFFS[name])]
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), *sums)
    # A row per stratum, measure and cutoff.
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"`{m}/{i}`").alias("k")) for m in CUTOFFS for i, c in enumerate(CUTOFFS[m])])
    tests = counts.select("stratum", "n", F.inline(rows))
    strata = counts.agg(F.count("*").alias("strata"))
    level = F.lit(error) / (F.lit(len(CUTOFFS)) * F.col("strata"))
    tests = tests.crossJoin(strata).withColumn("passed", tail(F.col("n"), F.col("k"), risk / len(CUTOFFS)) <= level)
    order = Window.partitionBy("stratum", "measure").orderBy("i")
    tests = tests.withColumn("run", F.min(F.col("passed").cast("int")).over(order)).where("run = 1")
    return tests.groupBy("stratum", "measure").agg(F.max_by("cutoff", "i").alias("cutoff"))


def independent(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled ``rows``, one for each text of a stratum, with its ``quality``; without ids and texts that are labelled both ways."""
    agreed = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    labelled = rows.join(agreed.where("quality = other").drop("other"), "doc_id")
    # All other columns follow from the text and its stratum.
    same = [c for c in rows.columns if c not in ("doc_id", "stratum", "text_hash", "text_check")]
    once = labelled.groupBy("stratum", "text_hash", "text_check").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"), *[F.min(c).alias(c) for c in same])
    return once.where("quality = other").drop("other")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """(doc_id, the measures, base_failed, kept) per row of ``docs`` (doc_id, text and ``stratum``).

    ``labels`` is (doc_id, quality). A row fails the base rules with under 20 words or over 30 % repeated ones; else it is kept unless
    a certified cutoff of its stratum rejects it. Strata without enough good labelled documents have no
    cutoffs, so nothing of theirs is rejected; a null stratum is one of its own. The bounds need independent draws, so the holdout has
    every text of a stratum once: repeated labels and exact copies count as one, ids or texts whose labels contradict each other not at all,
    and null ids and labels join nothing. The guarantee covers documents that pass the base rules.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "text_check": F.xxhash64(F.lit(1), "text")})
    rows = staged(spark, measures(rows).drop("text"), "measures")
    cutoffs = certified_cutoffs(independent(rows, labels), risk, error)
    wide = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("measure") == m, F.col("cutoff"))).alias(f"cut_{m}") for m in CUTOFFS])
    wide = staged(spark, wide, "cutoffs")
    beyond = F.lit(False)
    for name, value in _values().items():
        beyond = beyond | F.coalesce(value > F.col(f"cut_{name}"), F.lit(False))
    kept = (~F.col("base_failed") & ~beyond).alias("kept")
    return rows.join(wide, "stratum", "left").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept)
