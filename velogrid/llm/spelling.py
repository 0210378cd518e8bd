"""Spelling variants: words that differ in one letter, found by probing edits against Bloom filters of the vocabulary.

Every word's possible neighbours are generated (one letter deleted, or replaced by a later one of the alphabet; the other
directions are the same pairs seen from the other word) and probed, inside the tasks, against filters of the vocabulary: one
filter per word length, made of blocks of 256 bits, so that a probe touches one block. Only positives leave the task, as a pair of
64-bit keys, and meet the vocabulary in an exact join; what has the key is then compared letter by letter, so neither a
filter's false positive nor two words of one key can give a wrong pair, and no pair is lost.

The filters are the only broadcast. They take ``FILTER_BYTES`` at most: a larger vocabulary is probed in rounds, each with the
filters of some lengths, or of a part of the keys of one length. Keys are sums over letters, so an edit's key follows from
the word's by one addition or shift, without making the edited word; a very long word costs its length times the alphabet.

Defined results: null and empty texts have no words; a null doc_id counts as an empty text where it is hashed; repeated rows
count again; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.words import mix
from velogrid.session import staged

#: Most bytes of filters that are broadcast at a time, and bits of a filter per word.
FILTER_BYTES, BITS = 32 << 20, 16

#: Candidates that one task probes, about, and candidates that are made at a time.
TASK_CANDIDATES, CHUNK = 20_000_000, 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_A_LETTER = "[^a-zÀ-ÿ]+"

LANES = 8
_LANE_SALTS = mix(np.arange(1, LANES + 1, dtype=np.uint64)) | np.uint64(1)
_LETTER = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1 << 20))
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def runs(docs: DataFrame) -> DataFrame:
    """(word) once per letter run of ``docs`` (doc_id, text) of five code points or more; some runs lose a letter, as their hash says."""
    text = F.translate(F.col("text"), UPPER, LOWER)
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.split(text, NOT_A_LETTER)).alias("run"))
    run = run.where(F.length("run") >= 5)
    run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return run.select(F.when(F.col("h") % 97 == 0, short).otherwise(F.col("run")).alias("word")).where(F.length("word") >= 5)


def vocabulary(words: DataFrame, least: int = 3) -> DataFrame:
    """(word, n) of the words that occur ``least`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# --- keys -------------------------------------------------------------------


def powers(length: int) -> np.ndarray:
    out = np.full(length, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def by_length(found: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the list, letters as (words, length) code points) for every length."""
    sizes = np.array([len(x) for x in found])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        text = "".join(found[i] for i in at)
        yield at, np.frombuffer(text.encode("utf-16-le"), np.uint16).reshape(len(at), length)


def sums(letters: np.ndarray) -> np.ndarray:
    """The key's sum up to each place, (words, length)."""
    return np.cumsum(_LETTER[letters] * powers(letters.shape[1]), axis=1, dtype=np.uint64)


def keys(found: list[str]) -> np.ndarray:
    out = np.zeros(len(found), np.uint64)
    for at, letters in by_length(found):
        out[at] = mix(sums(letters)[:, -1])
    return out


# --- filters ----------------------------------------------------------------


class Filters:
    """Blocked Bloom filters by (length, part of the keys); ``blocks`` are (n, 8) words of 32 bits."""

    def __init__(self, parts: dict[int, int], blocks: dict[tuple[int, int], np.ndarray]):
        self.parts, self.blocks = parts, blocks

    @staticmethod
    def part(key: np.ndarray, parts: int) -> np.ndarray:
        return (key & np.uint64(0xFFFF)) % np.uint64(parts)

    @staticmethod
    def place(key: np.ndarray, n: int) -> np.ndarray:
        return ((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)

    @staticmethod
    def bit(key: np.ndarray, lane: int) -> np.ndarray:
        """The key's bit in this lane of its block."""
        return np.uint32(1) << ((key * _LANE_SALTS[lane]) >> np.uint64(59)).astype(np.uint32)

    def __contains__(self, length: int) -> bool:
        return length in self.parts

    def hits(self, key: np.ndarray, length: int) -> np.ndarray:
        """Places of the keys that may be in the vocabulary, among those whose part is at hand."""
        found = [np.zeros(0, np.int64)]
        part = self.part(key, self.parts[length])
        for (size, own), blocks in self.blocks.items():
            if size != length:
                continue
            left = np.arange(len(key)) if self.parts[length] == 1 else np.flatnonzero(part == own)
            at = self.place(key[left], len(blocks))
            for lane in range(LANES):
                there = np.flatnonzero(blocks[at, lane] & self.bit(key[left], lane))
                left, at = left[there], at[there]
            found.append(left)
        return np.sort(np.concatenate(found))


def rounds(counts: dict[int, int], most: int) -> Iterator[tuple[dict[int, int], dict[tuple[int, int], int]]]:
    """Filters that fit into ``most`` bytes together: (parts by length, number of blocks by (length, part))."""
    units, parts = [], {}
    for length, n in sorted(counts.items()):
        parts[length] = max(1, -(-n * BITS // 8 // most))
        blocks = max(1, -(-n * BITS // (32 * LANES) // parts[length]))
        units += [((length, p), blocks) for p in range(parts[length])]
    now: dict[tuple[int, int], int] = {}
    for unit, blocks in units:
        if now and 4 * LANES * (sum(now.values()) + blocks) > most + 4 * LANES:
            yield {u[0]: parts[u[0]] for u in now}, now
            now = {}
        now[unit] = blocks
    if now:
        yield {u[0]: parts[u[0]] for u in now}, now


def built(vocab: DataFrame, parts: dict[int, int], sizes: dict[tuple[int, int], int]) -> Filters:
    """The filters of one round: every word sets its bits, blocks are joined by Spark, and their rows fetched."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, length = batch.column("key").to_numpy().view(np.uint64), batch.column("length").to_numpy()
            for size, n in parts.items():
                own = key[length == size]
                part = Filters.part(own, n)
                for p in range(n):
                    if (size, p) in sizes:
                        k = own[part == p]
                        lanes = np.stack([Filters.bit(k, lane) for lane in range(LANES)], axis=1)
                        words = lanes.view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(k), size, np.int32)), pa.array(np.full(len(k), p, np.int32)), pa.array(Filters.place(k, sizes[size, p]).astype(np.int64))]
                            + [pa.array(np.ascontiguousarray(words[:, i])) for i in range(LANES // 2)],
                            names=["length", "part", "block", *[f"b{i}" for i in range(LANES // 2)]],
                        )

    names = [f"b{i}" for i in range(LANES // 2)]
    rows = vocab.select("key", "length").mapInArrow(bits, "length int, part int, block long, " + ", ".join(f"{b} long" for b in names))
    table = rows.groupBy("length", "part", "block").agg(*[F.expr(f"bit_or({b})").alias(b) for b in names]).toArrow()
    length, part, block = (table.column(c).to_numpy() for c in ("length", "part", "block"))
    words = np.stack([table.column(b).to_numpy() for b in names], axis=1) if len(length) else np.zeros((0, len(names)), np.int64)
    blocks = {}
    for unit, n in sizes.items():
        blocks[unit] = np.zeros((n, LANES), np.uint32)
        own = (length == unit[0]) & (part == unit[1])
        blocks[unit][block[own]] = np.ascontiguousarray(words[own]).view(np.uint32)
    return Filters(parts, blocks)


# --- pairs ------------------------------------------------------------------


def positives(letters: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(word, place, key, length) of the edits of equally long words (n, length) that a filter may hold."""
    n, length = letters.shape
    before, power = sums(letters), powers(length)
    if length - 1 in filters:
        # Of neighbours that are equal, the first stands for all: deleting any of them gives the same word.
        first = np.ones(letters.shape, bool)
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]
        word, at = np.nonzero(first)
        for i in range(0, len(word), CHUNK):
            w, p = word[i : i + CHUNK], at[i : i + CHUNK]
            left = np.where(p > 0, before[w, p - 1], np.uint64(0))
            key = mix(left + (before[w, -1] - before[w, p]) * _INVERSE)
            hit = filters.hits(key, length - 1)
            yield w[hit], p[hit], key[hit], length - 1
    if length in filters:
        step = max(1, CHUNK // len(alphabet))
        for i in range(0, n * length, step):
            flat = np.arange(i, min(i + step, n * length))
            w, p = flat // length, flat % length
            old = letters[w, p]
            row, new = np.nonzero(alphabet[None, :] > old[:, None])
            w, p, old = w[row], p[row], old[row]
            key = mix(before[w, -1] + (_LETTER[alphabet[new]] - _LETTER[old]) * power[p])
            hit = filters.hits(key, length)
            yield w[hit], p[hit], key[hit], length


def near_pairs(vocab: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs of ``vocab`` (word, n) that differ in one letter, each pair once; ``vocab`` is a written table."""
    spark = vocab.sparkSession

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys(found).view(np.int64)), pa.array([len(x) for x in found], pa.int32())], names=["word", "n", "key", "length"])

    vocab = staged(spark, vocab.select("word", "n").mapInArrow(keyed, "word string, n long, key long, length int"), "vocabulary")
    counts = {r.length: r.n for r in vocab.groupBy("length").agg(F.count("*").alias("n")).toLocalIterator()}  # a row per word length
    letters = sorted(r.c for r in vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect() if r.c)
    alphabet = np.array([ord(c) for c in letters], np.uint16)  # 90 letters at most
    tasks = max(1, sum(size * n for size, n in counts.items()) * len(alphabet) // 2 // TASK_CANDIDATES)
    spread = vocab.select("word", "key").repartition(int(tasks), "key")
    found = None
    for parts, sizes in rounds(counts, most):
        filters = spark.sparkContext.broadcast(built(vocab, parts, sizes))

        def probe(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("key").to_numpy()
                for at, text in by_length(batch.column("word").to_pylist()):
                    for w, p, key, length in positives(text, alphabet, filters.value):
                        yield pa.RecordBatch.from_arrays([pa.array(own[at[w]]), pa.array(p.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(np.full(len(w), length, np.int32))], names=["of", "place", "key", "length"])

        # Written round by round, so that one round's filters are in memory at a time.
        hits = staged(spark, spread.mapInArrow(probe, "of long, place int, key long, length int"), "positives")
        found = hits if found is None else found.unionByName(hits)
        filters.unpersist()
    if found is None:
        return vocab.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    b = found.join(vocab.select("key", "length", F.col("word").alias("b"), F.col("n").alias("b_n")), ["key", "length"])
    pairs = b.join(vocab.select(F.col("key").alias("of"), F.col("word").alias("a"), F.col("n").alias("a_n")), "of")
    head = F.substring("a", F.lit(1), F.col("place"))
    tail = F.substring("a", F.col("place") + 2, F.length("a"))
    dropped = (F.length("a") > F.length("b")) & (F.concat(head, tail) == F.col("b"))
    other_tail = F.substring("b", F.col("place") + 2, F.length("b"))
    replaced = (F.length("a") == F.length("b")) & (F.col("a") != F.col("b")) & (head == F.substring("b", F.lit(1), F.col("place"))) & (tail == other_tail)
    return pairs.where(dropped | replaced).select("a", "a_n", "b", "b_n")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the end of its forms, by doubling the way that is known."""
    spark = forms.sparkSession
    now = staged(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = staged(spark, step, "roots")
        if step.where("moved").limit(1).count() == 0:
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(docs: DataFrame, least: int = 3, times: int = 2, most: int = FILTER_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs`` (doc_id, text).

    ``n_near`` counts the words that differ in one letter. The form is the one of them that occurs most (then the first in order of code
    points), if ``times`` as often as the word; the root is what forms lead to. A form occurs more often than its
    word, so forms never lead in a circle.
    """
    spark = docs.sparkSession
    vocab = staged(spark, vocabulary(runs(docs.select("doc_id", "text")), least), "words")
    pairs = staged(spark, near_pairs(vocab, most), "pairs")
    ends = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    ends = ends.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = ends.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    known = vocab.join(best, "word", "left")
    leads = -F.col("best.less") >= times * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads, F.col("best.other")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")
    )
    known = staged(spark, known, "forms")
    roots = followed(known.where("form is not null"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
