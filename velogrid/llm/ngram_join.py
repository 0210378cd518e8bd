"""Documents linked by the Jaccard similarity of their word n-grams.

Prefix filtering: order all n-grams from rare to frequent; two sets with similarity t share one of the
first ``n - ceil(t n) + 1`` n-grams of either. So only these are indexed and joined, candidates pass a
length, a positional and a suffix filter, and each pair is verified once, exactly.

How it runs on a cluster:

1. One scan makes the n-gram sets. Their document frequencies come from ``exchange``: each block asks
   once per distinct n-gram, so an n-gram of a third of all documents is one entry per block. N-grams
   that are common inside a block (over ``COMMON`` documents) rank last as a class of their own, and
   what documents hold them never leaves the block.
2. An n-gram of one document can't make a pair. It only moves the others back in the order, so it is
   counted and not sent on; intersections need the repeated n-grams alone.
3. Equal sets are one class, represented by its smallest doc_id.
4. A group of thousands of near copies would give millions of pairs with nothing new in them. Rounds of
   pivot pairs (each set against one other set of an n-gram's group) join most of a group; after that,
   every candidate pair between *different* components is formed and verified. Pairs inside a
   component can't change it, so the components are exact.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velogrid.llm.components import components
from velogrid.llm.exchange import BLOCK_ROWS, OWN, bucket_count, exchange, small_batches, text_bytes_of
from velogrid.llm.words import shingle_set, text_bytes
from velogrid.session import staged

#: N-grams in more documents of one block than this rank last.
COMMON = 64
#: Bits of an n-gram's number inside its bucket.
LOW = np.uint64(40)
_MASK = np.uint64((1 << 40) - 1)
_LAST = np.uint32(0xFFFFFFFF)
#: Rounds of pivot pairs, and pivots of a set in a round. They save work and change no result.
ROUNDS, PIVOTS = 2, 2

SETS = "doc_id long, n long, digest string, unique_n long, prefix array<long>, shared array<long>"
_SETS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("unique_n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("shared", pa.list_(pa.int64()))]
)


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack(f"<{len(arrays)}I", *(a.nbytes for a in arrays)) + b"".join(a.tobytes() for a in arrays)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{len(kinds)}I", body)
    out, at = [], 4 * len(kinds)
    for n, kind in zip(sizes, kinds, strict=True):
        dt = np.dtype(kind)
        out.append(np.frombuffer(body, dt, n // dt.itemsize, at))
        at += n
    return out


def _split(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (low >> np.uint64(32)).astype("u1"), low.astype("u4")


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype("u8") << np.uint64(32)) | low


def _needed(n, num: int, den: int):
    """The least overlap of a set of n with any set similar to it."""
    return -(-num * n // den)


def _runs(ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of consecutive runs given by their starts and lengths."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(ends - np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64), counts) if total else np.zeros(0, np.int64)


def _ask(k: int, buckets: int):
    def ask(block: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        if block.num_rows > BLOCK_ROWS:
            raise ValueError("a block has more documents than their numbers can tell apart")
        sets = [shingle_set(x, k) for x in text_bytes(block.column("text"))]
        sizes = np.array([len(x) for x in sets], np.int64)
        doc = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        number = ((h >> LOW) % np.uint64(buckets)) << LOW | (h & _MASK)
        order = np.argsort(number, kind="stable")
        number, doc = number[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([first, [len(number)]])).astype(np.int64)
        common = counts > COMMON
        held = _runs(first[common], counts[common])
        digests = "".join(hashlib.md5(x.tobytes()).hexdigest() if len(x) else " " * 32 for x in sets)
        ids = pa.BufferOutputStream()
        with pa.ipc.new_stream(ids, pa.schema([("doc_id", pa.int64())])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([block.column("doc_id").cast(pa.int64())], names=["doc_id"]))
        yield OWN, _pack(np.frombuffer(ids.getvalue(), "u1"), sizes.astype("u4"), np.frombuffer(digests.encode(), "u1"), number[held], doc[held])
        keys = number[first]
        of = (keys >> LOW).astype(np.int64)
        cold = ~common
        edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            c = cold[a:b]
            posts = doc[_runs(first[a:b][c], counts[a:b][c])]
            yield int(of[a]), _pack(*_split(keys[a:b] & _MASK), np.where(c, counts[a:b], 255).astype("u1"), posts)

    return ask


def _answer(bodies: list[bytes]) -> list[bytes | None]:
    got = [_unpack(x, "u1", "u4", "u1", "u2") for x in bodies]
    keys = np.concatenate([_whole(h, low) for h, low, _, _ in got])
    counts = np.concatenate([c for _, _, c, _ in got])
    _, at = np.unique(keys, return_inverse=True)
    df = np.bincount(at, counts)
    last = np.bincount(at, counts == 255) > 0
    rank = np.where(last, float(_LAST), np.minimum(df, float(_LAST) - 1)).astype("u4")[at]
    out, start = [], 0
    for high, low, c, posts in got:
        r = rank[start : start + len(low)]
        start += len(low)
        each = np.where(c == 255, 0, c).astype(np.int64)
        keep = (r >= 2) & (each > 0)
        begin = np.cumsum(each) - each
        out.append(_pack(high[keep], low[keep], r[keep], each[keep].astype("u1"), posts[_runs(begin[keep], each[keep])]) if keep.any() else None)
    return out


def _finish(num: int, den: int):
    def finish(own: bytes, replies: dict[int, bytes]) -> pa.Table:
        ids, sizes, digests, held, holders = _unpack(own, "u1", "u4", "u1", "u8", "u2")
        with pa.ipc.open_stream(pa.py_buffer(ids.tobytes())) as s:
            doc_id = s.read_all().column("doc_id").combine_chunks()
        keys, docs, ranks = [held], [holders], [np.full(len(held), _LAST)]
        for bucket, body in replies.items():
            high, low, r, each, posts = _unpack(body, "u1", "u4", "u4", "u1", "u2")
            keys.append(np.repeat(_whole(high, low) | (np.uint64(bucket) << LOW), each))
            ranks.append(np.repeat(r, each))
            docs.append(posts)
        key, doc, rank = np.concatenate(keys).astype(np.int64), np.concatenate(docs).astype(np.int64), np.concatenate(ranks)
        order = np.lexsort((key, rank, doc))
        key, doc = key[order], doc[order]
        n = sizes.astype(np.int64)
        m = np.bincount(doc, minlength=len(n))
        start = np.cumsum(m) - m
        take = np.minimum(np.maximum(n - _needed(n, num, den) + 1 - (n - m), 0), m)
        full = take > 0
        prefix = key[_runs(start[full], take[full])]
        by_key = np.lexsort((key, doc))
        shared = key[by_key][_runs(start[full], m[full])]

        def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum(np.where(full, counts, 0))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))

        text = digests.tobytes().decode()
        digest = [text[32 * i : 32 * i + 32] if n[i] else None for i in range(len(n))]
        return pa.table([doc_id, pa.array(n), pa.array(digest, pa.string()), pa.array(n - m), lists(prefix, take), lists(shared, m)], schema=_SETS)

    return finish


def ngram_sets(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): set size, digest of the set, and its indexed n-grams; a written table.

    ``docs`` is a scan of files or a written table (see ``exchange``).
    """
    size = text_bytes_of(docs)
    b = bucket_count(docs, size)
    return exchange(docs.select(F.col("doc_id").cast("long"), "text"), _ask(k, b), _answer, _finish(num, den), SETS, size, "sets")


def _similar(num: int, den: int):
    pairs = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {f: batch.column(f).to_numpy(zero_copy_only=False) for f in ("a", "b", "n_a", "n_b")}
            sets = [[x.values.to_numpy() for x in batch.column(f)] for f in ("shared_a", "shared_b")]
            keep = []
            for i, (x, y) in enumerate(zip(*sets, strict=True)):
                n, need = int(rows["n_a"][i]) + int(rows["n_b"][i]), 0
                need = _needed(n, num, num + den)
                # Suffix filter: cut both sets at the same n-grams; unequal part sizes are differences.
                cuts = y[[len(y) // 4, len(y) // 2, 3 * len(y) // 4]]
                parts = np.abs(np.diff(np.searchsorted(x, cuts), prepend=0, append=len(x)) - np.diff(np.searchsorted(y, cuts), prepend=0, append=len(y)))
                if n - (n - len(x) - len(y)) - int(parts.sum()) < 2 * need:
                    continue
                if len(np.intersect1d(x, y, assume_unique=True)) >= need:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(rows[f][keep], pa.int64()) for f in ("a", "b")], schema=pairs)

    return verify


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    side = [sets.select(F.col("rep").alias(s), F.col("shared").alias(f"shared_{s}")) for s in "ab"]
    return pairs.join(side[0], "a").join(side[1], "b").mapInArrow(_similar(num, den), "a long, b long")


def _filtered(pairs: DataFrame, num: int, den: int, *also: str) -> DataFrame:
    """One row per pair (and ``also``) that can still reach the similarity; ``pairs`` has one row per shared n-gram.

    Length: the smaller set must be large enough. Position: the first shared n-gram bounds what may follow.
    """
    bound = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    need = F.ceil((F.col("n_a") + F.col("n_b")) * num / (num + den))
    pairs = pairs.where(f"least(n_a, n_b) * {den} >= greatest(n_a, n_b) * {num}")
    pairs = pairs.groupBy("a", "b", "n_a", "n_b", *also).agg(F.min("at_a").alias("at_a"), F.min("at_b").alias("at_b"), F.count("*").alias("common"))
    return pairs.where(bound >= need - 1e-6)


def linked_classes(sets: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """(node, component) of the representatives that have a link; ``sets`` as staged by ``ngram_join``."""
    spark = sets.sparkSession
    reps = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    sets = staged(spark, sets.where("size(prefix) > 0").join(reps, ["digest", "doc_id"]).select(F.col("doc_id").alias("rep"), "n", "unique_n", "prefix", "shared").distinct(), "sets")
    index = sets.select("rep", "n", "unique_n", F.posexplode("prefix").alias("i", "token")).select("rep", "n", (F.col("unique_n") + F.col("i")).alias("at"), "token")
    links, labels = None, sets.select(F.col("rep").alias("node"), F.col("rep").alias("component")).limit(0)
    for r in range(ROUNDS + 1):
        now = index.join(labels, F.col("rep") == F.col("node"), "left").select("rep", "n", "at", "token", F.coalesce("component", "rep").alias("component"))
        # A set with few n-grams rarer than the group's is near the middle of its copies; then any set of the group.
        first = F.struct("at", F.xxhash64("rep", F.lit(r))) if r < ROUNDS - 1 else F.struct(F.lit(0), F.xxhash64("rep", "token"))
        groups = now.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by(F.struct("rep", "n", "at", "component"), first).alias("p"))
        now = now.join(groups.where("low < high"), "token")
        if r < ROUNDS:
            pairs = now.where("component <> p.component").select(
                F.struct("rep", "n", "at").alias("x"), F.struct("p.rep", "p.n", "p.at").alias("y")
            )
            pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.col("x.rep").alias("of"))
            pairs = _filtered(pairs.select("of", *[F.col(f"{s}.{f}").alias(g) for s in "ab" for f, g in (("rep", s), ("n", f"n_{s}"), ("at", f"at_{s}"))]), num, den, "of")
            # Per set, not per pivot: a set has no more pivots than indexed n-grams, a pivot may have any number of sets.
            best = Window.partitionBy("of").orderBy(F.desc("common"), "a", "b")
            pairs = pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PIVOTS).dropDuplicates(["a", "b"])
        else:
            x, y = now.select("token", *[F.col(f).alias(f"{f}_x") for f in ("rep", "n", "at", "component")]), now.select("token", *[F.col(f).alias(f"{f}_y") for f in ("rep", "n", "at", "component")])
            # The smaller set of a similar pair has its first shared n-gram within its first n - 2t/(1+t) n.
            x = x.where(f"({num + den}) * (n_x - at_x) >= {2 * num} * n_x")
            bound = f"({num + den}) * least(n_x - at_x, n_y - at_y) >= {num} * (n_x + n_y)"
            pairs = x.join(y, "token").where(f"component_x <> component_y and (n_x < n_y or n_x = n_y and rep_x < rep_y) and {den} * n_x >= {num} * n_y and {bound}")
            pairs = _filtered(pairs.selectExpr("rep_x a", "rep_y b", "n_x n_a", "n_y n_b", "at_x at_a", "at_y at_b"), num, den)
        with small_batches(spark):  # a pair carries both of its sets
            new = staged(spark, _verified(pairs.select("a", "b", "n_a", "n_b"), sets, num, den), "pairs")
        links = new if links is None else links.unionByName(new)
        labels = components(links)
    return labels


def ngram_join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text; other columns are ignored).

    Words are runs without ASCII white space, A-Z lowered. A document's set holds its distinct k-word
    n-grams, or its whole word sequence if it has fewer than k words. Two documents link when
    den * |intersection| >= num * |union|; ``component_id`` is the smallest doc_id that links reach.
    Without words or text the set is empty, and the row is a component of its own. Equal rows are all
    kept and have the same component; a null doc_id is a member of its class, but doesn't name it.
    """
    sets = ngram_sets(docs, k, num, den)
    labels = linked_classes(sets.where("doc_id is not null"), num, den)
    classes = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = classes.join(labels, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("class"), F.coalesce("component", "rep").alias("component_id"))
    # Rows without words have no class; a key of their own keeps them from meeting in one task.
    key = F.coalesce("digest", F.concat(F.lit("-"), F.monotonically_increasing_id()))
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), key.alias("class"))
    return rows.join(classes, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
