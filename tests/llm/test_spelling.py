"""Spelling variants against a comparison of all words, with filters in one round and in many, and on odd rows."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from velogrid.llm import spelling
from velogrid.llm.queries import op12_spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def words_of(rows):
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                yield run


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    n = {w: k for w, k in collections.Counter(words_of(rows)).items() if k >= 3}
    others = collections.defaultdict(list)
    for a, b in itertools.combinations(n, 2):
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    form = {}
    for w in n:
        best = min(others[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n[w], len(others[w]), form[w] or "", n.get(form[w], 0), root(w)) for w in n)


def result(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def made_rows(n):
    """Words with near copies of every kind, chains of forms, doubled letters and letters beyond ASCII."""
    rng = random.Random(n)
    stems = ["aaaaa", "aaaaab", "straße", "ÀÀÀÀÀÀ", "letter", "Letters", "leter", "lettter", "ÿþýüû", "abcde÷", "zzzzz"]
    stems += ["".join(rng.choices("abé", k=rng.randint(5, 6))) for _ in range(90)]
    chain = ["chains"] * 64 + ["chain"] * 24 + ["chaim"] * 9 + ["chxim"] * 4
    bag = [w for w in stems for _ in range(rng.choice([1, 3, 4, 9, 20, 41]))] + chain
    rng.shuffle(bag)
    rows = [(i, " ".join(bag[i::n])) for i in range(n)]
    long = "".join(rng.choices("abcdefgh", k=5000))
    odd = [(None, "letter letter 'letter'"), (1, None), (2, ""), (3, "1234 !?"), (3, "letters"), (3, "letters"), (4, f"{long} {long[:-1]}x {long} {long[:-1]}x {long} {long[:-1]}x {long[1:]} {long[1:]} {long[1:]}")]
    return rows + odd


@pytest.mark.parametrize("most", [spelling.FILTER_BYTES, 64])
def test_variants(spark, most):
    rows = made_rows(37)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "key", "length", "form", "root")})
    got = result(spelling.variants(docs.repartition(3), most=most))
    assert got == expected(rows)
    assert sum(r[3] != "" for r in got) > 10 and {r[5] for r in got if r[0] == "chxim"} <= {"chain", "chains", "chxim"}


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op12_spelling(spark, folder)) == expected(rows)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a bc def")], "doc_id long, text string")
    assert spelling.variants(docs).collect() == [] and spelling.variants(docs.limit(0)).collect() == []


def test_forms_lead_to_their_end(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [("x", "w0"), ("y", "w20")]
    got = dict(spelling.followed(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {w: "w21" for w, _ in chain}


def test_an_edit_has_the_key_of_the_word_that_it_makes():
    found = ["abcde", "àbcdÿ", "aabbc"]
    alphabet = np.array(sorted({ord(c) for w in found for c in w}), np.uint16)

    class Everything:
        def __contains__(self, length):
            return True

        def hits(self, key, length):
            return np.arange(len(key))

    (_, letters), made, dropped = next(spelling.by_length(found)), set(), set()
    for w, p, key, length in spelling.positives(letters, alphabet, Everything()):
        for i, at, k in zip(w, p, key, strict=True):
            if length == 4:
                word = found[i][:at] + found[i][at + 1 :]
                dropped.add(word)
                assert spelling.keys([word])[0] == k
            else:
                made.add((i, at, k))
    assert dropped == {w[:i] + w[i + 1 :] for w in found for i in range(5)}
    brute = [(i, at, w[:at] + chr(c) + w[at + 1 :]) for i, w in enumerate(found) for at in range(5) for c in alphabet if c > ord(w[at])]
    assert made == {(i, at, k) for (i, at, _), k in zip(brute, spelling.keys([w for *_, w in brute]), strict=True)}


def test_filters_hold_every_word_and_few_others(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choices(spelling.LOWER, k=rng.randint(5, 9))) for _ in range(20_000)})
    vocab = spark.createDataFrame([(int(k), len(w)) for w, k in zip(words, spelling.keys(words).view(np.int64), strict=True)], "key long, length int")
    counts = collections.Counter(map(len, words))
    for most in (1 << 20, 9000):
        seen = collections.Counter()
        for parts, sizes in spelling.rounds(counts, most):
            assert sum(sizes.values()) * 32 <= most + 32
            filters = spelling.built(vocab, parts, sizes)
            for length in parts:
                own = np.array([k for w, k in zip(words, spelling.keys(words), strict=True) if len(w) == length])
                seen[length] += len(filters.hits(own, length))
                others = spelling.keys(["".join(rng.choices(spelling.UPPER.lower(), k=length + 20)) for _ in range(4000)])
                assert len(filters.hits(others, length)) < 40
        assert seen == counts
