"""Language of a text by a string kernel.

Two texts are alike by the n-grams of letters (lengths 1 to 3, the blended spectrum) that both have,
counted once: k(x, y) = |G(x) and G(y)| / sqrt(|G(x)| |G(y)|). Landmark texts give Nyström features
K(x, landmarks) K(landmarks, landmarks)^(-1/2), on which a ridge regression is trained per language
against the rest. All that is linear in the n-grams a text has, so the trained model is one matrix of
n-grams by languages, and a batch of texts is scored by one matrix product of its presence matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.samples import per_label, sample_texts

#: n-grams are numbered by a hash of this many bits.
BITS = 15
UNKNOWN = "und"
# Odd multipliers of the n-gram hash.
_M = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray | None:
    """Numbers of the n-grams (with repeats) of a lower-cased text; runs of other characters are one gap. None without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters()[codes], codes, np.uint32(0))
    if not codes.any():
        return None
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    shift = np.uint32(32 - BITS)
    out, h = [], codes * _M[0]
    out.append((h ^ (h >> np.uint32(15))) * _M[1] >> shift)
    for i in (1, 2):
        h = (h[:-1] ^ (h[:-1] >> np.uint32(13))) * _M[i] + codes[i:] * _M[0]
        out.append((h ^ (h >> np.uint32(15))) * _M[1] >> shift)
    return np.concatenate(out)


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised presence of the n-grams in each text, and whether it has a letter."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    known = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        g = grams(t) if t else None
        if g is not None:
            known[i] = True
            out[i, g] = 1
    out /= np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))
    return out, known


@dataclass
class Model:
    """``weights`` has a row per n-gram and a column per language."""

    languages: list[str]
    weights: np.ndarray

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        x, known = presence(texts)
        f = x @ self.weights
        best = f.argmax(1)
        return [(self.languages[b], float(min(1.0, max(0.0, r[b])))) if k else (UNKNOWN, 0.0) for k, b, r in zip(known, best, f, strict=True)]


def fit(sample: list[tuple[str, str]], landmarks: int = 48, ridge: float = 1e-2) -> Model:
    """``sample``: (text, language) rows. The first ``landmarks`` texts of each language are landmarks."""
    by: dict[str, list[str]] = {}
    for text, lang in sample:
        if text and grams(text) is not None:
            by.setdefault(lang, []).append(text)
    names = sorted(by)
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    base, _ = presence([t for n in names for t in by[n][:landmarks]])
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])  # K(landmarks, landmarks)^(-1/2) on its range
    gram, target, n = 0, 0, 0
    for c, name in enumerate(names):
        y = np.eye(len(names))[c]
        for at in range(0, len(by[name]), 256):
            x, _ = presence(by[name][at : at + 256])
            phi = (x @ base.T).astype(np.float64) @ half
            share = 1 / (len(by[name]) * len(names))  # each language weighs the same
            gram = gram + phi.T @ phi * share
            target = target + np.outer(phi.sum(0), y) * share
    solved = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), target)
    return Model(names, (base.T @ (half @ solved)).astype(np.float32))


def train(rows: DataFrame, most: int = 1000, landmarks: int = 48) -> Model:
    """Fit on up to ``most`` rows of each language of ``rows`` (doc_id, text, lang), a sample by hash of doc_id.

    Rows with a null text, language or id, or without a letter, teach nothing. The number of languages
    is that of the labels; the sample of ``most`` texts each is fetched once to the driver.
    """
    sample = per_label(rows.where("text is not null"), "lang", most)
    return fit([(r.text, r.lang) for r in sample_texts(rows, sample, "lang")], landmarks)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1), from the column ``text`` alone.

    A null text or one without a letter is ``und`` with score 0. All rows and other columns stay; columns of these
    two names are replaced. Each row is scored on its own, whole, so nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "lang_score")
    kept = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = sent.value.score(part.column("text").to_pylist())
                columns = [*part.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "lang_score"])

    schema = docs.withColumns({"lang_pred": F.lit("").cast("string"), "lang_score": F.lit(0.0)}).schema
    return docs.mapInArrow(score, schema)
