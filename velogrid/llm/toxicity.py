"""Toxic documents and the sentences that make them so, learned from labels of whole documents.

Multiple-instance learning: a document is a bag of sentences. Each sentence has a probability
p = sigmoid(bias + sum of the weights of its distinct words), where a word weighs what it and its
character n-grams weigh, so that other endings of a stem count; and the document is toxic unless no sentence
is: P = 1 - prod(1 - p), the noisy-or. The weights maximise the likelihood of the document labels under
that rule, so they learn which sentences carry a label although no sentence is labelled; a proximal step
keeps most weights at zero.
"""

from __future__ import annotations

import math
import re
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.samples import per_label
from velogrid.llm.words import text_bytes
from velogrid.session import staged

_ENDS = re.compile(rb"[.!?\n]+")
_MARKS = string.punctuation.encode()
#: Sentences at or above this probability are named as offending.
OFFENDING = 0.2
GRAMS = (5,)
#: Words whose weight a worker remembers; when full, it starts anew. Longer words than ``LONG`` bytes aren't remembered.
REMEMBERED, LONG = 500_000, 64
#: Features of the sample that one part of a fitting step takes.
PART = 1 << 20


def sentences(text: bytes | None) -> list[tuple[int, int]]:
    """Byte ranges between full stops, exclamation and question marks and line ends."""
    out, at = [], 0
    for m in _ENDS.finditer(text or b""):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if text and len(text) > at:
        out.append((at, len(text)))
    return out


def sentence_words(sentence: bytes) -> set[bytes]:
    return set(sentence.lower().translate(None, _MARKS).split())


def features(word: bytes) -> list[bytes]:
    """The word, and its n-grams of ``GRAMS`` bytes with its ends marked."""
    marked = b"^" + word + b"$"
    return [word, *{marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}]


@dataclass
class Model:
    bias: float
    weights: dict[bytes, float]

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and its offending sentences as byte ranges."""
        known, weigh, clean, found = self._known, self.weigh, 0.0, []
        for a, b in sentences(text):
            hit = [v for w in sentence_words(text[a:b]) if (v := known[w] if w in known else weigh(w))]
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + math.fsum(hit))))) if hit else self._empty
            clean += math.log1p(-min(p, 1 - 1e-12))
            if p >= OFFENDING:
                found.append((a, b, p))
        return -math.expm1(clean), found

    def weigh(self, word: bytes) -> float:
        get = self.weights.get
        out = math.fsum(get(f, 0.0) for f in features(word))
        if len(word) <= LONG:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[word] = out
        return out

    def __post_init__(self):
        self._empty = 1 / (1 + math.exp(-self.bias))
        self._known: dict[bytes, float] = {}


class Bags:
    """Sampled documents as bags of sentences, a sentence as the numbers of its words' features, one after another in one array."""

    def __init__(self, sample: list[tuple[bytes, int, float]], names: list[bytes]):
        """``sample``: (text, label, weight) rows; documents without a sentence are left out."""
        number = {w: i for i, w in enumerate(names)}
        known: dict[bytes, list[int]] = {}
        feature, count = array("i"), array("i")
        bag, y, mass = array("i"), [], []
        for text, label, weight in sample:
            of = sentences(text)
            for a, b in of:
                start = len(feature)
                for w in sentence_words(text[a:b]):
                    if w not in known:
                        known[w] = [number[f] for f in features(w) if f in number]
                    feature.extend(known[w])
                count.append(len(feature) - start)
                bag.append(len(y))
            if of:
                y.append(label)
                mass.append(weight)
        self.feature, self.count = np.frombuffer(feature, np.int32), np.frombuffer(count, np.int32)
        self.bag, self.y, self.mass = np.frombuffer(bag, np.int32), np.array(y), np.array(mass, float)
        self.mass = self.mass / self.mass.sum() if y else self.mass
        self.cut()

    def cut(self) -> None:
        """Runs of sentences of about ``PART`` features, which bound what a step holds besides ``feature``."""
        ends = np.cumsum(self.count, dtype=np.int64)
        edges = np.unique(np.searchsorted(ends, np.arange(PART, ends[-1] if len(ends) else 0, PART)))
        edges = np.concatenate([[0], edges[(edges > 0) & (edges < len(ends))], [len(ends)]])
        starts = np.concatenate([[0], ends])
        self.parts = [(i, j, int(starts[i]), int(starts[j])) for i, j in zip(edges, edges[1:], strict=False)]

    def keep(self, live: np.ndarray) -> None:
        """Features that aren't ``live`` leave all sentences; the others are numbered anew."""
        self.count = np.concatenate([self._sums(live.astype(float), *part) for part in self.parts]).astype(np.int32)
        self.feature = (np.cumsum(live, dtype=np.int32) - 1)[self.feature[live[self.feature]]]
        self.cut()

    def _sums(self, w: np.ndarray, i: int, j: int, a: int, b: int) -> np.ndarray:
        out, some = np.zeros(j - i), self.count[i:j] > 0
        if b > a:
            first = np.cumsum(self.count[i:j], dtype=np.int64) - self.count[i:j]
            out[some] = np.add.reduceat(w[self.feature[a:b]], first[some])
        return out

    def step(self, w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """The gradient of the documents' mean log likelihood, by the features' weights and the bias."""
        z = np.clip(bias + np.concatenate([self._sums(w, *part) for part in self.parts]), -30, 30)
        p = 1 / (1 + np.exp(-z))
        whole = -np.expm1(np.bincount(self.bag, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(self.y)))
        whole = np.clip(whole, 1e-9, 1 - 1e-9)
        g = p * (np.where(self.y == 1, (1 - whole) / whole, -1.0) * self.mass)[self.bag]
        g_w = np.zeros(len(w))
        for i, j, a, b in self.parts:
            g_w += np.bincount(self.feature[a:b], np.repeat(g[i:j], self.count[i:j]), minlength=len(w))
        return g_w, float(g.sum())


def fit(bags: Bags, names: list[bytes], rounds: int = 400, sparse: float = 2e-4) -> Model:
    """Weights by name: steps scaled by a running mean of squared gradients, each followed by a proximal step of ``sparse``."""
    if not len(bags.feature) or len(set(bags.y.tolist())) < 2:
        share = float(np.mean(bags.y)) if len(bags.y) else 0.0
        return Model(float(np.log((share + 1e-6) / (1 - share + 1e-6))), {})
    w, bias = np.zeros(len(names)), -7.0
    sq_w, sq_b = np.zeros(len(names)), 0.0
    for r in range(rounds):
        if r and r % 40 == 0:  # weights that the proximal step holds at zero leave the fit
            live = w != 0
            names = [n for n, keep in zip(names, live, strict=True) if keep]
            bags.keep(live)
            w, sq_w = w[live], sq_w[live]
        g_w, g_b = bags.step(w, bias)
        sq_w, sq_b = 0.95 * sq_w + 0.05 * g_w**2, 0.95 * sq_b + 0.05 * g_b**2
        step = 0.16 / (np.sqrt(sq_w) + 1e-5)
        w = w + step * g_w
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
        bias += 0.16 * g_b / (np.sqrt(sq_b) + 1e-5)
    return Model(float(bias), {n: float(v) for n, v in zip(names, w, strict=True) if v})


def common_features(texts: DataFrame, least: int) -> list[bytes]:
    """The features of at least ``least`` of the texts, in order; each task names those of its texts, Spark counts."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = set().union(*(sentence_words(text[a:b]) for a, b in sentences(text)))
                yield pa.RecordBatch.from_arrays([pa.array({f for w in found for f in features(w)}, pa.binary())], names=["feature"])

    counts = texts.select("text").mapInArrow(named, "feature binary").groupBy("feature").agg(F.count("*").alias("n"))
    return sorted(bytes(r.feature) for r in counts.where(F.col("n") >= least).select("feature").toLocalIterator())


def train(docs: DataFrame, labels: DataFrame, most: int = 1500, least: int = 5) -> Model:
    """Fit on up to ``most`` documents of each label of ``labels`` (doc_id, toxic), a sample by hash of doc_id.

    Only the sample's texts are taken from ``docs`` (doc_id, text). Features of fewer than ``least`` documents of the sample
    are left out. Rows weigh as many rows as they stand for, so probabilities follow the labels' shares. Null texts, labels
    and ids teach nothing, nor do labels but 0 and 1. Of several texts with one doc_id the smallest counts.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    sample = per_label(labels, "toxic", most)  # at most 2 * most rows
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("text is not null").join(F.broadcast(sample), "doc_id")
    texts = staged(docs.sparkSession, texts.groupBy("doc_id", "toxic", "label_rows").agg(F.min("text").alias("text")), "toxic-sample")
    names = common_features(texts, least)
    got = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = texts.select(F.xxhash64("doc_id").alias("h"), "toxic", "label_rows", "text").orderBy("h", "toxic").toLocalIterator()
    return fit(Bags([(bytes(r.text), r.toxic, r.label_rows / got[r.toxic]) for r in rows], names), names)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxic_score`` (0 to 1) and ``offending`` (array of start, stop in bytes, and score), from ``text`` alone.

    Null and empty texts have no sentence and score 0. All rows and other columns stay; columns of these two names are
    replaced. Each row is scored whole and on its own, so nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxic_score", "offending")
    kept = docs.columns
    item = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [sent.value.score(t) for t in text_bytes(part.column("text"))]
                spans = [[{"start": a, "stop": b, "score": p} for a, b, p in x] for _, x in found]
                columns = [*part.columns, pa.array([x for x, _ in found], pa.float64()), pa.array(spans, pa.list_(item))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "toxic_score", "offending"])

    empty = F.array().cast("array<struct<start:bigint,stop:bigint,score:double>>")
    return docs.mapInArrow(score, docs.withColumns({"toxic_score": F.lit(0.0), "offending": empty}).schema)
