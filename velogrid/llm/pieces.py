"""Sampled subword segmentations that can be repeated, and their lossless decoding.

A text's piece lattice has a node between any two characters and an edge for every piece of the model
that fits. A segmentation is a path, weighed by exp(alpha * sum of the pieces' scores). Forward filtering
sums the weights of all paths to each node; backward sampling then walks from the end and picks each
edge with its exact conditional probability. No piece of these models holds a gap mark after another
character, so the lattice falls apart into units (a word with the gap before it), which are filtered
once per distinct unit and sampled for all their occurrences at once. The random numbers come from the row's key,
the unit's place in the row and the step, so a row's segmentation doesn't depend on partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.exchange import blocks, text_sizes
from velogrid.llm.words import mix

GAP = "▁"
#: Units whose lattices a worker remembers; when full, it starts anew.
REMEMBERED = 120_000
#: Characters sampled at once.
CHUNK = 1 << 19
#: Places at which pieces are looked for at once.
PLACES = 1 << 15


class Trie:
    """The places of all pieces in an array of characters, found a character deeper at a time for all places at once."""

    def __init__(self, pieces: dict[str, int]):
        letters = sorted(set().union(*pieces))
        self.classes = np.full(ord(letters[-1]) + 2, -1, np.int64)
        self.classes[[ord(c) for c in letters]] = np.arange(len(letters))
        number, go, ends = {c: i for i, c in enumerate(letters)}, {}, {}
        self.letters = len(letters)
        for piece, i in pieces.items():
            node = 0
            for c in piece:
                node = go.setdefault(node * self.letters + number[c], len(go) + 1)
            ends[node] = i
        self.piece = np.full(len(go) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        # Steps (node and character) by hash: those of one hash follow one another.
        step, after = np.fromiter(go, np.int64, len(go)), np.fromiter(go.values(), np.int64, len(go))
        self.shift = np.uint64(64 - len(go).bit_length() - 1)
        order = np.argsort(self._hash(step), kind="stable")
        self.step, self.after = step[order], after[order]
        self.start = np.searchsorted(self._hash(self.step), np.arange(2 ** (64 - int(self.shift)) + 1))

    def _hash(self, step: np.ndarray) -> np.ndarray:
        return (step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The end of each place (one past it) and its piece; longer pieces come first."""
        letter = np.append(self.classes[np.minimum(chars, len(self.classes) - 1)], -1)
        first, ends, found = np.flatnonzero(letter >= 0), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for i in range(0, len(first), PLACES):  # earlier places have the longer pieces of an end
            got = list(self._walk(letter, first[i : i + PLACES]))[::-1]
            ends += [x for x, _ in got]
            found += [x for _, x in got]
        return np.concatenate(ends), np.concatenate(found)

    def _walk(self, letter: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node = np.zeros(len(at), np.int64)
        while len(at):
            step = node * self.letters + letter[at]
            h = self._hash(step)
            place, stop = self.start[h], self.start[h + 1]
            left = np.flatnonzero(place < stop)
            node = np.full(len(at), -1)
            while len(left):
                here = place[left]
                same = self.step[here] == step[left]
                node[left[same]] = self.after[here[same]]
                left = left[~same]
                place[left] += 1
                left = left[place[left] < stop[left]]
            on = node >= 0
            at, node = at[on] + 1, node[on]
            piece = self.piece[node]
            hit = piece >= 0
            yield at[hit], piece[hit]
            more = letter[at] >= 0
            at, node = at[more], node[more]


class Lattice:
    """The pieces of a model file, with the filtered lattices of the units met so far."""

    def __init__(self, path: str, alpha: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.alpha, n = alpha, model.vocab_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_piece = [0] * 256
        self.sizes, self.scores = np.zeros(n, np.int32), np.zeros(n)
        inside: set[str] = set()
        self.letters = ""
        pieces: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                b = int(piece[3:-1], 16)
                self.byte_piece[b], self.bytes_of[i] = i, bytes([b])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if GAP in piece.lstrip(GAP):
                    raise ValueError("a piece spans two words")
                self.bytes_of[i] = piece.replace(GAP, " ").encode()
                self.sizes[i], self.scores[i] = len(piece), alpha * model.get_score(i)
                pieces[piece] = i
                inside.update(piece)
        if 0 in self.byte_piece:
            raise ValueError("the model has no byte pieces, so not every text can be encoded")
        self.trie = Trie(pieces)
        # Marks that no piece joins to a letter before them end a unit, and so does a line end that no piece holds.
        joined = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        marks = "".join(c for c in ".,;:!?|" if not any(b == c and a.isalpha() for a, b in joined))
        lines = "" if "\n" in inside else "\n"
        ends = re.escape(marks + lines) + GAP
        self.units = re.compile(f"{GAP}*[^\\W\\d_]+(?=[{ends}]|$)|{GAP}*[^{GAP}{lines}]+|{GAP}+|{lines or '(?!)'}")
        self._start()

    def _start(self) -> None:
        self.number: dict[str | None, int] = {}
        self.last = np.zeros(0, np.int64)  # of each unit: its last node
        self.first_edge = np.zeros(0, np.int64)  # of each node; the first node of a unit has no edge
        self.is_first = np.zeros(0, bool)
        self.share = np.zeros(0, np.float32)  # cumulated over a node's edges
        self.edge_piece = np.zeros(0, np.int32)
        self.edge_back = np.zeros(0, np.int32)  # nodes to go back
        self.filter([GAP], spelled=True)
        self.number = {None: 0}

    def filter(self, units: list[str], spelled: bool = False) -> None:
        """Number new units and add their lattices: the sums of all paths to each node, as shares of its edges.

        Laid end to end with a stop after each, character i of the units has node i + 1 behind it, and the
        stop's place is the first node of the next unit. A character that is no piece (or any, if
        ``spelled``) has an edge of its own, for its bytes.
        """
        joined = "\0".join(units) + "\0"
        sizes = np.array([len(u) for u in units], np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        node, piece = self.trie.find(chars if not spelled else chars[:0])
        back = self.sizes[piece]
        lone = np.ones(len(chars), bool)
        lone[begin + sizes] = False
        lone[node[back == 1] - 1] = False
        lone = np.flatnonzero(lone)
        node, piece = np.concatenate([node, lone + 1]), np.concatenate([piece, -1 - chars[lone].astype(np.int32)])
        back, score = np.concatenate([back, np.ones(len(lone), np.int32)]), np.concatenate([self.scores[piece[: len(back)]], np.zeros(len(lone))])
        order = np.argsort(node, kind="stable")
        node, piece, back, score = node[order], piece[order], back[order], score[order]
        starts = np.flatnonzero(np.diff(node, prepend=-1))  # every node but a unit's first has an edge
        counts = np.diff(starts, append=len(node))
        depth = node[starts] - np.repeat(begin, sizes + 1)[node[starts]]
        by_depth = np.argsort(depth.astype(np.uint16) if depth.max() < 1 << 16 else depth, kind="stable")
        levels = np.flatnonzero(np.diff(depth[by_depth], prepend=-1, append=depth.max() + 1))
        sums, weight = np.zeros(len(chars)), np.empty(len(node))
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            of = by_depth[a:b]
            n = counts[of]
            at = np.cumsum(n) - n
            edges = np.arange(int(n.sum())) + np.repeat(starts[of] - at, n)
            w = sums[node[edges] - back[edges]] + score[edges]
            top = np.maximum.reduceat(w, at)
            each = np.exp(w - np.repeat(top, n))
            total = np.add.reduceat(each, at)
            sums[node[starts[of]]] = top + np.log(total)
            weight[edges] = each / np.repeat(total, n)
        run = np.cumsum(weight)
        run -= np.repeat(run[starts] - weight[starts], counts)
        run[starts + counts - 1] = 2.0
        first = np.zeros(len(chars), np.int64)
        first[node[starts]] = starts
        nodes, edges = len(self.first_edge), len(self.share)
        is_first = np.zeros(len(chars), bool)
        is_first[begin] = True
        self.number |= {u: len(self.last) + i for i, u in enumerate(units)}
        self.last = np.concatenate([self.last, begin + sizes + nodes])
        self.first_edge = np.concatenate([self.first_edge, first + edges])
        self.is_first = np.concatenate([self.is_first, is_first])
        self.share = np.concatenate([self.share, run.astype(np.float32)])
        self.edge_piece = np.concatenate([self.edge_piece, piece])
        self.edge_back = np.concatenate([self.edge_back, back])

    def sample(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """A segmentation per text, drawn by its key."""
        if len(self.number) >= REMEMBERED or len(self.share) >= 20 * REMEMBERED:
            self._start()
        split = [self.split(t) for t in texts]
        counts, flat = [len(units) for units in split], list(chain.from_iterable(split))
        numbers = list(map(self.number.get, flat))
        if None in numbers:
            self.filter(list(dict.fromkeys(u for u, n in zip(flat, numbers, strict=True) if n is None)))
            numbers = list(map(self.number.get, flat))
        last, first_edge, share, edge_piece, edge_back, is_first = self.last, self.first_edge, self.share, self.edge_piece, self.edge_back, self.is_first
        node = last[np.array(numbers, np.int64)]
        place = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
        seed = mix(np.repeat(keys, counts) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        active, step, taken, length = np.arange(len(node)), 0, [], np.zeros(len(node), np.int64)
        while len(active):
            u = (mix(seed[active] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = first_edge[node]
            more = np.flatnonzero(share[edge] <= u)
            while len(more):
                edge[more] += 1
                more = more[share[edge[more]] <= u[more]]
            taken.append((active, edge_piece[edge]))
            node = node - edge_back[edge]
            length[active] += 1
            go = ~is_first[node]
            active, node, step = active[go], node[go], step + 1
        ends = np.cumsum(length)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for i, (who, piece) in enumerate(taken):
            out[ends[who] - 1 - i] = piece
        stops = np.cumsum(np.concatenate([[0], np.add.reduceat(np.append(length, 0), np.minimum(np.cumsum(counts) - counts, len(length))) * (np.array(counts) > 0)])).astype(np.int64)
        return [self._bytes(out[a:b]) for a, b in zip(stops[:-1], stops[1:], strict=True)]

    def split(self, text: str) -> list[str | None]:
        """A text's units; None stands for a character of the text that is the gap mark itself."""
        if not text:
            return []
        if GAP not in text:
            return self.units.findall(GAP + text.replace(" ", GAP))
        first, *rest = text.split(GAP)
        out: list[str | None] = self.units.findall(GAP + first.replace(" ", GAP))
        for part in rest:
            out += [None, *self.units.findall(part.replace(" ", GAP))]
        return out

    def _bytes(self, pieces: np.ndarray) -> np.ndarray:
        """Characters that are no piece (as negative code points) become byte pieces."""
        at = np.flatnonzero(pieces < 0)
        if not len(at):
            return pieces
        parts, done = [], 0
        for i in at:
            parts += [pieces[done:i], np.array([self.byte_piece[b] for b in chr(-1 - int(pieces[i])).encode("utf-8", "surrogatepass")], np.int32)]
            done = i + 1
        return np.concatenate([*parts, pieces[done:]])

    def decode(self, pieces) -> bytes:
        """The text of a segmentation; the gap put before the text goes."""
        return b"".join(map(self.bytes_of.__getitem__, pieces))[1:]


def sample_encode(docs: DataFrame, model: str, alpha: float = 1e-3, seed: int = 0, key: str = "doc_id", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``pieces`` (array<int>), a segmentation of ``text`` drawn by ``key`` and ``seed``, and ``lossless``.

    With ``decoded``, a column of that name has the text that decoding gives back, without a second pass.

    ``model`` is the path of a model file with byte pieces; it is shipped to the executors. A large ``alpha`` favours
    the best segmentation, 0 draws all of them evenly. ``lossless`` says whether decoding gave the text
    back. A null text has null pieces, an empty one none; equal keys and texts are drawn alike, and a null key is a
    key of its own. All rows and other columns stay; columns of these two names are replaced.
    Characters that no piece has become byte pieces. Each row is read whole; nothing is shuffled.
    """
    more = [decoded] if decoded else []
    docs = docs.drop("pieces", "lossless", *more)
    docs.sparkSession.sparkContext.addFile(model)
    name, kept = model.rsplit("/", 1)[-1], docs.columns

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(SparkFiles.get(name), alpha)
        for batch in batches:
            for part in blocks(iter([batch]), text_sizes, CHUNK):
                texts = part.column("text").to_pylist()
                keys = np.array([xxhash.xxh3_64_intdigest(repr(k).encode(), seed) for k in part.column(key).to_pylist()], np.uint64)
                got = lattice.sample([t or "" for t in texts], keys)
                back = [lattice.decode(g.tolist()) for g in got]
                same = pa.array([b == (t or "").encode() for t, b in zip(texts, back, strict=True)], pa.bool_())
                new = [pa.array([None if t is None else g for t, g in zip(texts, got, strict=True)], pa.list_(pa.int32())), same]
                if decoded:
                    new.append(pa.array([None if t is None else b for t, b in zip(texts, back, strict=True)], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, "pieces", "lossless", *more])

    kinds = {"pieces": "array<int>", "lossless": "boolean"} | dict.fromkeys(more, "string")
    schema = docs.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()}).schema
    return docs.mapInArrow(encode, schema)


def decode(rows: DataFrame, model: str, into: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``pieces`` in the column ``into``; null for null pieces."""
    rows = rows.drop(into)
    rows.sparkSession.sparkContext.addFile(model)
    name, kept = model.rsplit("/", 1)[-1], rows.columns

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(SparkFiles.get(name), 0.0)
        for batch in batches:
            texts = [None if p is None else lattice.decode(p).decode("utf-8", "replace") for p in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, into])

    return rows.mapInArrow(spell, rows.withColumn(into, F.lit(None).cast("string")).schema)
