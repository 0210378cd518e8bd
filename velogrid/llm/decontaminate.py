"""Benchmark items inside documents: MinHash containment search by size, verified exactly.

A short item inside a long document has a tiny Jaccard similarity with it, which MinHash can't see. So
items are partitioned by size, and for each size class a document is read in windows about as long as
the class's items: windows of twice the class's largest size, starting at every multiple of that size,
so that a copied item always lies inside one. Windows and items get one-permutation MinHash signatures
(the smallest shingle of each bin); a window and an item are candidates if they agree in any bin. The
number of bins is chosen per class so that a contained item is missed with a chance of one in a million
at most. Each candidate document and item is then verified by exact containment over the whole document.
An item of fewer words than a shingle has no window of its own: it is looked up among all runs of as many words.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.words import chained, hashes, text_bytes, words

#: Most text of benchmark items, in bytes, that is sent to the executors at once.
ITEM_BYTES = 16 << 20
MISSED = 1e-6
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_MARKS = string.punctuation.encode()


def item_words(text: bytes | None) -> np.ndarray:
    """The numbers of a text's words, in order; ASCII punctuation is left out, A-Z is lowered."""
    return hashes(words((text or b"").translate(None, _MARKS)))


def item_shingles(text: bytes | None, k: int) -> np.ndarray:
    """Shingles of a text's words, in order; a shorter text is one shingle, a text without words has none."""
    of = item_words(text)
    return chained(of, min(k, len(of))) if len(of) else of


def bins(largest: int, containment: float) -> int:
    """log2 of the bins for items of up to ``largest`` shingles (and over half of it)."""
    smallest = largest // 2 + 1
    shared = math.ceil(containment * smallest)
    return max(6, math.ceil(math.log2(1.5 * largest / MISSED ** (1 / shared))))


class Items:
    """Signatures of a block of items by size class."""

    def __init__(self, rows: list[tuple], k: int, containment: float):
        self.k, self.containment = k, containment
        numbered = [(i, item_words(t)) for i, t in rows]
        kept = [(i, np.unique(chained(w, k))) for i, w in numbered if len(w) >= k]
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, w in numbered:
            if 0 < len(w) < k:
                self.short.setdefault(len(w), {}).setdefault(int(chained(w, len(w))[0]), []).append(i)
        self.wanted = {n: np.array(sorted(of), np.uint64) for n, of in self.short.items()}
        self.ids, self.sets = [i for i, _ in kept], [s for _, s in kept]
        self.classes = []
        sizes = np.array([1 << (len(s) - 1).bit_length() for s in self.sets])
        for largest in np.unique(sizes):
            bits = np.uint64(64 - bins(int(largest), containment))
            values, owners = [], []
            for i in np.flatnonzero(sizes == largest):
                s = self.sets[i]
                least = s[np.concatenate([[True], s[1:] >> bits != s[:-1] >> bits])]
                values.append(least)
                owners.append(np.full(len(least), i))
            values, owners = np.concatenate(values), np.concatenate(owners)
            order = np.argsort(values, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[values & np.uint64(len(seen) - 1)] = True
            self.classes.append((int(largest), bits, values[order], owners[order], seen))

    def candidates(self, docs: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) positions that agree in a bin of a window."""
        found: set[tuple[int, int]] = set()
        for size, bits, values, owners, seen in self.classes:
            counts = np.array([-(-len(d) // size) for d in docs])
            if not counts.sum():
                continue
            row = np.zeros((int(counts.sum()), size), np.uint64)
            row[:] = _NONE
            flat, starts = row.reshape(-1), (np.cumsum(counts) - counts) * size
            for d, s in zip(docs, starts, strict=True):
                flat[s : s + len(d)] = d
            doc = np.repeat(np.arange(len(docs)), counts)
            after = np.full_like(row, _NONE)
            same = doc[1:] == doc[:-1]
            after[:-1][same] = row[1:][same]
            windows = np.sort(np.hstack([row, after]), axis=1)
            least = np.ones(windows.shape, bool)
            least[:, 1:] = windows[:, 1:] >> bits != windows[:, :-1] >> bits
            least &= seen[windows & np.uint64(len(seen) - 1)] & (windows != _NONE)
            w, _ = np.nonzero(least)
            hits = windows[least]
            a, b = np.searchsorted(values, hits, "left"), np.searchsorted(values, hits, "right")
            for d, i, j in zip(doc[w[a < b]], a[a < b], b[a < b], strict=True):
                found.update((int(d), int(o)) for o in owners[i:j])
        return found

    def matches(self, texts: list[bytes | None]) -> list[list[tuple]]:
        """Per text: (item id, containment) of the items in it."""
        numbered = [item_words(t) for t in texts]
        docs = [chained(w, self.k) if len(w) >= self.k else w[:0] for w in numbered]
        sets: dict[int, np.ndarray] = {}
        out: list[list[tuple]] = [[] for _ in texts]
        for n, wanted in self.wanted.items():
            for found, w in zip(out, numbered, strict=True):
                if len(w) >= n:
                    runs = chained(w, n)
                    hits = np.unique(runs[np.isin(runs, wanted)])
                    found.extend((i, 1.0) for g in hits.tolist() for i in self.short[n][g])
        for d, i in sorted(self.candidates(docs)):
            if d not in sets:
                sets[d] = np.unique(docs[d])
            share = np.isin(self.sets[i], sets[d], assume_unique=True).mean()
            if share >= self.containment:
                out[d].append((self.ids[i], float(share)))
        return out


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    rows, total = [], 0
    for r in items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).where("length(text) > 0").toLocalIterator():
        rows.append((r[0], bytes(r[1])))
        total += len(r[1])
        if total >= ITEM_BYTES:
            yield rows
            rows, total = [], 0
    if rows:
        yield rows


def benchmark_matches(docs: DataFrame, items: DataFrame, k: int = 5, containment: float = 0.8) -> DataFrame:
    """``docs`` with a column ``matches`` (array of item_id and containment, by item_id).

    An item (item_id, text) matches a document if at least ``containment`` of the item's distinct k-word
    shingles occur in the whole document. An item of fewer than k words matches where these words follow one another
    anywhere in a text, so one of a single common word matches many: leave such items out of ``items`` if that isn't
    meant. Null or empty texts and items match nothing. All rows and columns of ``docs`` stay;
    a column ``matches`` that it has already is replaced. The items are a query set: they go to the
    executors in blocks of ``ITEM_BYTES``, one pass over the documents each, and nothing is shuffled.
    """
    spark = docs.sparkSession
    docs = docs.drop("matches").withColumn("matches", F.array().cast("array<struct<item_id:bigint,containment:double>>"))
    for rows in _blocks(items):
        sent = spark.sparkContext.broadcast(rows)
        docs = docs.mapInArrow(_search(sent, k, containment), docs.schema)
    return docs.withColumn("matches", F.array_sort("matches"))


def _search(sent, k: int, containment: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(sent.value, k, containment)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                where = part.schema.get_field_index("matches")
                new = index.matches(text_bytes(part.column("text")))
                had = part.column("matches").to_pylist()
                both = [[*old, *({"item_id": i, "containment": c} for i, c in found)] for old, found in zip(had, new, strict=True)]
                yield part.set_column(where, part.schema.field(where), pa.array(both, part.schema.field(where).type))

    return search


def decontaminate(docs: DataFrame, items: DataFrame, k: int = 5, containment: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns."""
    found = benchmark_matches(docs.withColumnRenamed("matches", "_matches"), items, k, containment)
    return found.where("size(matches) = 0").drop("matches").withColumnRenamed("_matches", "matches")
