"""Words and word shingles as stable 64-bit numbers, the same in every task and session."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Odd multipliers of a 64-bit mixing step; any odd numbers with well spread bits serve.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | bytes | None) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D, with A-Z lowered; other letters stay as they are."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range (one to one)."""
    values = values * _A
    values = (values ^ (values >> np.uint64(29))) * _B
    return values ^ (values >> np.uint64(32))


def hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def chained(of: np.ndarray, k: int) -> np.ndarray:
    """The number of every run of k neighbours, in order of the text."""
    out = of[: len(of) - k + 1]
    for i in range(1, k):
        out = mix(out) + of[i : len(of) - k + 1 + i]
    return mix(out)


def shingles(text: str | bytes | None, k: int) -> np.ndarray:
    """Every k-word shingle in order; a shorter text is one shingle, a text without words has none."""
    of = hashes(words(text))
    if len(of) == 0:
        return of
    return chained(of, min(k, len(of)))


def shingle_set(text: str | bytes | None, k: int) -> np.ndarray:
    return np.unique(shingles(text, k))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()
