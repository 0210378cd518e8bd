"""Exact token counts at every prefix of a text, by dynamic programming over its prefixes.

A byte-pair encoding of a string is the only sequence of tokens in which each neighbouring pair is
stable (encoding the pair's bytes gives the pair back). So the last token of the prefix of length i is
the one token t that ends there and is stable after the last token of the prefix of length i - len(t);
the count is that prefix's count plus one. One pass gives the counts of all prefixes, and a question
about a truncation or a budget is a look-up.

The pre-tokenizer cuts a text into short pieces that are encoded apart, so a text's counts are the
running sums of its pieces' counts. Two cuts depend on what follows: white space before a word (its last
character joins the word) and contractions; their cells are set to what the shorter text itself gives.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published split pattern of byte-level encodings.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces (and token pairs) that a worker remembers in each of two generations; a full generation
#: becomes the old one, and what is met again moves to the new one.
REMEMBERED = 300_000
#: Longer pieces aren't remembered.
SHORT = 64


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in vocabulary files: itself where printable, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts for a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec["pre_tokenizer"], spec["added_tokens"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("needs a byte-level BPE file without normalizer and prefix space")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in their surroundings aren't supported")
        letters = byte_letters()
        of = lambda s: bytes(letters[c] for c in s)
        special = {t["content"] for t in added}
        self.tokens = [of(s) for s in spec["model"]["vocab"] if s not in special]
        self.found = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.found.add_word(t.decode("latin-1"), (i, len(t)))
        self.found.make_automaton()
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(of(a), of(b)): i for i, (a, b) in enumerate(merges)}
        self.pieces = regex.compile(PATTERN)
        self.blanks = regex.compile(r"\s{2,}(?=\S)")
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stable: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Merges in order of rank, leftmost first; used on the bytes of two tokens at most."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, pair: int) -> bool:
        """Whether a pair of tokens is stable; the first is -1 at the start of a piece."""
        before, token = divmod(pair, 1 << 24)
        parts = [self.tokens[token]] if before == 0 else [self.tokens[before - 1], self.tokens[token]]
        if len(self.stable) >= 4 * REMEMBERED:
            self.stable.clear()
        out = self.stable[pair] = self.merged(b"".join(parts)) == parts
        return out

    def byte_prefixes(self, data: bytes) -> list[int]:
        """Token counts of data[:1], data[:2], ..."""
        last, counts = [0] * (len(data) + 1), [0] * (len(data) + 1)
        stable = self.stable
        for end, (token, size) in self.found.iter(data.decode("latin-1")):
            end += 1
            if counts[end] == 0:  # the one stable token that ends here isn't found yet
                pair = (last[end - size] << 24) + token
                ok = stable.get(pair)
                if ok or ok is None and self.follows(pair):
                    last[end] = token + 1
                    counts[end] = counts[end - size] + 1
        if 0 in counts[1:]:
            raise ValueError("a byte is missing in the vocabulary")
        return counts[1:]

    def steps(self, piece: str) -> bytes:
        """What each character adds to the count, as packed numbers."""
        out = self.older.get(piece)
        if out is None:
            out = self._steps(piece)
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[piece] = out
        return out

    def _steps(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        counts = self.byte_prefixes(data)
        if len(data) == len(piece):
            ends = counts
        else:
            ends, at = [], 0
            for c in piece:
                at += len(c.encode("utf-8"))
                ends.append(counts[at - 1])
        if piece in ("'re", "'ve", "'ll"):  # a contraction cut short is an apostrophe and a letter
            ends = [ends[0], 2, ends[2]]
        return array("i", map(sub, ends, [0, *ends[:-1]])).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        steps = self.steps
        known = self.known
        parts = [known.get(p) or steps(p) for p in self.pieces.findall(text)]
        counts = np.cumsum(np.frombuffer(b"".join(parts), "i4"), dtype=np.int64)
        for m in self.blanks.finditer(text):
            run = m.group()
            before = int(counts[m.start() - 1]) if m.start() else 0
            counts[m.end() - 1] = before + int(np.frombuffer(known.get(run) or steps(run), "i4").sum())
        return counts

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of text[:1], text[:2], ..., text."""
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self._plain(text)
        out, at, total = [], 0, 0
        for m in found:
            inner = self._plain(text[at : m.end() - 1])  # a special string cut short is ordinary text
            out.append(total + inner)
            total += (int(inner[m.start() - at - 1]) if m.start() > at else 0) + 1
            out.append(np.array([total]))
            at = m.end()
        out.append(total + self._plain(text[at:]))
        return np.concatenate(out)


def longest_fit(prefixes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(prefixes <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, tokenizer: str, budget: int = 512, keep_prefixes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) per row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a byte-level tokenizer file, shipped to the executors. Counts are
    those of its library without added begin and end tokens; strings of special tokens inside a text
    count as that token. ``fit_chars`` is the length of the longest prefix within ``budget`` tokens;
    with ``keep_prefixes``, ``prefix_tokens`` holds the count of every prefix in characters.
    A null text counts as empty: 0 bytes, 0 tokens, no prefixes. Rows with equal or null ids are all kept,
    other columns are ignored. A row is counted on its own, so no step shuffles.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", prefix_tokens array<int>" * keep_prefixes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(SparkFiles.get(name))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for text in part.column("text").to_pylist():
                    c = counter.prefixes(text or "")
                    n = int(c[-1]) if len(c) else 0
                    rows.append((n, len(c) if n <= budget else longest_fit(c, budget), c if keep_prefixes else None))
                n = pa.array([r[0] for r in rows], pa.int64())
                size = pa.array(part.column("n_bytes"))
                columns = [part.column("doc_id"), size, n, pa.array([r[0] > budget for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.int64())]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
                if keep_prefixes:
                    ends = np.cumsum([0, *(len(r[2]) for r in rows)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[2] for r in rows]).astype(np.int32))))
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select(F.col("doc_id").cast("long"), size, "text").mapInArrow(count, schema)
