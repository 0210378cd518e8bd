"""Merkle manifest of a table: a tree of SHA-256 midstates that folds a changed row without reading what stands left of it.

A row's leaf is the hash of its fields. The leaves of a group, in order, are joined ``arity`` at a time into parents until one
node remains (the group's root), and the groups' roots, in order, likewise into the root of the table. A parent hashes the hex
texts of its children one after another. Such a text is just one block of SHA-256, so a parent can retain a copy of its hash
state before each child. A changed leaf resumes at that state with its replacement and the siblings to its right only.

A tree is kept in written tables of tiles, whatever its size: a tile holds up to ``arity ** levels`` neighbouring nodes, all that is
above them within the tile, and the retained states; tiles' roots are the nodes of the next tier. No task holds more than a tile,
so a group of a third of all rows is as many tiles as it needs, and nothing but a group's size reaches the driver.

Defined results: a null field is hashed as ``-``; nulls come first in the order; rows that are equal in group and order are ordered by
their leaf, so repeated rows are leaves of their own side by side; an empty table has no groups and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velogrid.session import staged

# --- SHA-256 over many blocks at once ---------------------------------------


def _first_primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _fraction(x: float) -> int:
    """The first 32 bits after the point."""
    return int((x - int(x)) * 2**32)


#: Start values and round constants of the standard: fractions of square and cube roots of primes.
START = np.array([_fraction(p**0.5) for p in _first_primes(8)], np.uint32)
ROUNDS = np.array([_fraction(p ** (1 / 3)) for p in _first_primes(64)], np.uint32)

_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def hexed(digests: np.ndarray) -> np.ndarray:
    """(n, 32) bytes as (n, 64) bytes of lower-case hex text."""
    return np.stack([_HEX[digests >> 4], _HEX[digests & 15]], axis=-1).reshape(*digests.shape[:-1], 64)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 64) each."""
    w = [x.copy() for x in np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T]
    a, b, c, d, e, f, g, h = start = [x.copy() for x in states.T]
    for t in range(64):
        if t >= 16:
            x, y = w[(t + 1) % 16], w[(t + 14) % 16]
            w[t % 16] = w[t % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[(t + 9) % 16] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10)))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (w[t % 16] + ROUNDS[t])
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.stack([x + y for x, y in zip(start, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def finish(states: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of states that have taken ``sizes`` whole blocks."""
    last = np.zeros((len(states), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (sizes.astype(np.uint64) * np.uint64(512)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(compress(states, last).astype(">u4")).view(np.uint8).reshape(-1, 32)


# --- a tile -----------------------------------------------------------------


def widths(n: int, arity: int, levels: int | None) -> list[int]:
    """Number of nodes on every level of a tile of ``n``: up to its only node, or ``levels`` levels up."""
    out = [n]
    while (out[-1] > 1) if levels is None else (len(out) <= levels):
        out.append(-(-out[-1] // arity))
    return out


def grow(leaves: np.ndarray, arity: int, levels: int | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """All levels' digests, and for every level of parents the states before each child, (parents, arity, 8)."""
    digests, states = [leaves], []
    for n in widths(len(leaves), arity, levels)[1:]:
        text = hexed(digests[-1])
        sizes = np.minimum(arity, len(text) - np.arange(n) * arity)
        now, kept = np.tile(START, (n, 1)), np.zeros((n, arity, 8), np.uint32)
        for slot in range(arity):
            kept[:, slot] = now
            held = np.flatnonzero(sizes > slot)
            now[held] = compress(now[held], text[held * arity + slot])
        digests.append(finish(now, sizes))
        states.append(kept)
    return digests, states


@dataclass
class Path:
    """For n nodes the way up over some levels: slot and size (n, L), the state before the slot (n, L, 8) and the siblings (n, L, arity-1, 32)."""

    slots: np.ndarray
    sizes: np.ndarray
    states: np.ndarray
    siblings: np.ndarray

    NAMES = ("slots", "sizes", "states", "siblings")

    @classmethod
    def empty(cls, n: int, arity: int) -> Path:
        return cls(np.zeros((n, 0), np.uint16), np.zeros((n, 0), np.uint16), np.zeros((n, 0, 8), np.uint32), np.zeros((n, 0, arity - 1, 32), np.uint8))

    @classmethod
    def within(cls, at: np.ndarray, digests: list[np.ndarray], states: list[np.ndarray], arity: int) -> Path:
        """From the nodes ``at`` of a tile to its top."""
        path = cls.empty(len(at), arity)
        slots, sizes, kept, siblings = [], [], [], []
        for below, before in zip(digests, states, strict=False):
            parent, slot = at // arity, at % arity
            sizes.append(np.minimum(arity, len(below) - parent * arity))
            slots.append(slot)
            kept.append(before[parent, slot])
            others = np.arange(arity - 1)[None, :]
            places = parent[:, None] * arity + others + (others >= slot[:, None])
            siblings.append(below[np.minimum(places, len(below) - 1)])
            at = parent
        if slots:
            path = cls(np.stack(slots, 1).astype(np.uint16), np.stack(sizes, 1).astype(np.uint16), np.stack(kept, 1), np.stack(siblings, 1))
        return path

    def then(self, above: Path) -> Path:
        """Each of these paths, followed by the only one above."""
        n = len(self.slots)
        return Path(*[np.concatenate([getattr(self, k), np.repeat(getattr(above, k), n, axis=0)], axis=1) for k in self.NAMES])

    def packed(self) -> list[pa.Array]:
        return [pa.array([x.tobytes() for x in getattr(self, k)], pa.binary()) for k in self.NAMES]

    @classmethod
    def unpacked(cls, row: list[bytes], arity: int) -> Path:
        slots, sizes, states, siblings = row
        return cls(np.frombuffer(slots, np.uint16)[None], np.frombuffer(sizes, np.uint16)[None], np.frombuffer(states, np.uint32).reshape(1, -1, 8), np.frombuffer(siblings, np.uint8).reshape(1, -1, arity - 1, 32))

    def fold(self, digests: np.ndarray) -> np.ndarray:
        """The roots that ``digests`` (n, 32) give in the place of these nodes."""
        for k in range(self.slots.shape[1]):
            slots, sizes = self.slots[:, k], self.sizes[:, k]
            now = compress(self.states[:, k], hexed(digests))
            for place in range(self.siblings.shape[2]):
                right = np.flatnonzero((place >= slots) & (place < sizes - 1))
                if len(right):
                    now[right] = compress(now[right], hexed(self.siblings[right, k, place]))
            digests = finish(now, sizes)
        return digests

    def proofs(self) -> list[str]:
        """SHA-256 over the hex texts of all siblings, level by level, left to right."""
        there = np.arange(self.siblings.shape[2])[None, None, :] < (self.sizes[:, :, None] - 1)
        text = hexed(self.siblings)
        return [hashlib.sha256(t if m.all() else t[m]).hexdigest() for t, m in zip(text, there, strict=True)]


# --- trees of any size ------------------------------------------------------

_TILE = "grp string, tile long, total long, n int, digests binary, states binary, digest binary"
_PATH = "slots binary, sizes binary, states binary, siblings binary"
_ARROW_TILE = pa.schema([("grp", pa.string()), ("tile", pa.int64()), ("total", pa.int64()), ("n", pa.int32()), ("digests", pa.binary()), ("states", pa.binary()), ("digest", pa.binary())])


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row, as a tile is large."""
    return (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows))


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


@dataclass(frozen=True)
class Shape:
    """What a task knows of a tree: children of a parent, and levels of a tile."""

    arity: int
    levels: int

    @property
    def width(self) -> int:
        return self.arity**self.levels

    def unpacked(self, row: dict) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Digests by level and retained states by level of a tile's row."""
        sizes = widths(row["n"], self.arity, None if row["total"] <= self.width else self.levels)
        flat, kept = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32), np.frombuffer(row["states"], np.uint32).reshape(-1, self.arity, 8)
        return np.split(flat, np.cumsum(sizes)[:-1]), np.split(kept, np.cumsum(sizes[1:]))[:-1]

    def paths(self, row: dict, at: np.ndarray) -> Path:
        """From the nodes ``at`` of a tile to the root: within the tile, then the tile's own path ``up_``."""
        return Path.within(at, *self.unpacked(row), self.arity).then(Path.unpacked([row[f"up_{k}"] for k in Path.NAMES], self.arity))


@dataclass
class Tree:
    """The tiles of one tree per group. ``tiers[k]`` holds (grp, tile, total nodes of the group in this tier, n nodes of the tile, and
    the tile's digests of all levels, retained states and top digest), written in the shared folder."""

    tiers: list[DataFrame]
    shape: Shape

    def roots(self) -> DataFrame:
        """(grp, digest) of every group."""
        done = [t.where(F.col("total") <= self.shape.width).select("grp", "digest") for t in self.tiers]
        out = done[0]
        for more in done[1:]:
            out = out.unionByName(more)
        return out

    def tops(self, above: DataFrame) -> DataFrame:
        """The tiles of the lowest tier, each with the path from its top on; ``above`` has (grp, path, more columns) from each group's root on."""
        shape, width = self.shape, self.shape.width
        more = [f for f in above.schema.fields if f.name not in ("grp", *Path.NAMES)]
        up = [f"up_{k}" for k in Path.NAMES]
        above = above.withColumnsRenamed(dict(zip(Path.NAMES, up, strict=True)))
        schema = f"grp string, tile long, {', '.join(f'{k} binary' for k in up)}" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)

        def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _each(batch):
                    arrays = shape.paths(row, np.arange(row["n"])).packed()
                    tiles = pa.array(row["tile"] * width + np.arange(row["n"]), pa.int64())
                    arrays = [pa.array([row["grp"]] * row["n"], pa.string()), tiles, *arrays, *[pa.array([row[f.name]] * row["n"], batch.schema.field(f.name).type) for f in more]]
                    yield pa.RecordBatch.from_arrays(arrays, names=["grp", "tile", *up, *[f.name for f in more]])

        lower = None
        for k in reversed(range(len(self.tiers))):
            tiles = self.tiers[k].where(F.col("total") <= width).join(above, "grp")
            if lower is not None:
                tiles = tiles.unionByName(self.tiers[k].where(F.col("total") > width).join(lower, ["grp", "tile"]))
            if k == 0:
                return tiles
            lower = tiles.mapInArrow(children, schema)
        raise AssertionError("a tree has a tier")


def grown(nodes: DataFrame, arity: int = 2, levels: int = 12) -> Tree:
    """The trees over ``nodes`` (grp, pos from 0 on, total of the group, digest)."""
    spark, shape = nodes.sparkSession, Shape(arity, levels)
    width = shape.width
    if arity < 2 or levels < 1:
        raise ValueError("a tree needs an arity of two and a level at least")

    def tile(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        first = table.slice(0, 1).to_pylist()[0]
        whole = first["total"] <= width
        digests, states = grow(_digests(table.column("digest")), arity, None if whole else levels)
        flat = b"".join(x.tobytes() for x in digests), b"".join(x.tobytes() for x in states)
        row = [first["grp"], first["tile"], first["total"], table.num_rows, *flat, digests[-1][0].tobytes()]
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW_TILE, strict=True)], schema=_ARROW_TILE)

    most = nodes.agg(F.max("total")).first()[0] or 0
    tiers = []
    while True:
        nodes = nodes.select("grp", "pos", "total", "digest", F.expr(f"pos div {width}").alias("tile"))
        tiers.append(staged(spark, nodes.groupBy("grp", "tile").applyInArrow(tile, _TILE), "tiles"))
        if most <= width:
            return Tree(tiers, shape)
        most = -(-most // width)
        up = tiers[-1].where(F.col("total") > width)
        nodes = up.select("grp", F.col("tile").alias("pos"), F.ceil(F.col("total") / width).cast("long").alias("total"), "digest")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp and more) with ``pos``, from 0 on within the group in this order, and the group's ``total``.

    Rows are dealt by ranges of group, order and row, so a large group lies in many tasks; each task numbers its own rows, and
    their places follow from the tasks' counts, a row per task and group. Null groups are not allowed, nulls in the order come first.
    """
    spark, key = rows.sparkSession, ["grp", *order]
    rows = staged(spark, rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    dealt = rows.repartitionByRange(*key, "_row").sortWithinPartitions(*key, "_row").withColumn("_seq", F.monotonically_increasing_id())
    dealt = staged(spark, dealt.drop("_row").withColumn("_task", F.shiftright("_seq", 33)), "dealt")
    counts = dealt.groupBy("grp", "_task").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    before = Window.partitionBy("grp").orderBy("_task")
    counts = counts.select("grp", "_task", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_off"), F.sum("_n").over(Window.partitionBy("grp")).alias("total"))
    return dealt.join(counts, ["grp", "_task"]).withColumn("pos", F.col("_seq") + F.col("_off")).drop("_seq", "_task", "_off")


# --- the operator -----------------------------------------------------------


def leaf(*fields: Column) -> Column:
    """SHA-256 over the fields: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


@dataclass
class Manifest:
    """``rows``: (grp, doc_id, leaf, changed, pos, total); ``tree``: a tree per group; ``top``: the tree over the groups' roots, in order."""

    rows: DataFrame
    tree: Tree
    top: Tree
    groups: DataFrame


def manifest(docs: DataFrame, group: Column, fields: list[Column], changed: list[Column] | None = None, key: str = "doc_id", arity: int = 2, levels: int = 12) -> Manifest:
    """The written trees of ``docs``: leaves of ``fields`` by ``group``, ascending by ``key``. ``changed`` are the fields to fold instead."""
    spark = docs.sparkSession
    grp = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))  # so that a null group is first, before an empty text
    rows = docs.select(grp.alias("grp"), F.col(key).alias("key"), leaf(*fields).alias("leaf"), leaf(*(changed or fields)).alias("changed"))
    rows = staged(spark, placed(rows, ["key", "leaf"]), "leaves")
    tree = grown(rows.select("grp", "pos", "total", F.col("leaf").alias("digest")), arity, levels)
    roots = tree.roots().select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    groups = staged(spark, placed(roots, ["name"]), "groups")
    return Manifest(rows, tree, grown(groups, arity, levels), groups)


def fold(made: Manifest) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, hashes as lower-case hex.

    ``folded_root`` is what the row's changed leaf gives: every parent on its way resumes at the state before its slot.
    """
    tree, top = made.tree, made.top
    low, high = tree.shape, top.shape
    none = [F.lit(bytearray()).alias(k) for k in Path.NAMES]
    root = top.roots().select("grp", F.col("digest").alias("root"), *none)
    names = made.groups.select("pos", "name", F.col("digest").alias("subroot"))
    below_root = top.tops(root)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                arrays = high.paths(row, np.arange(row["n"])).packed()
                places = pa.array(row["tile"] * high.width + np.arange(row["n"]), pa.int64())
                yield pa.RecordBatch.from_arrays([places, *arrays, pa.array([row["root"]] * row["n"], pa.binary())], names=["pos", *Path.NAMES, "root"])

    paths = below_root.mapInArrow(leaves, f"pos long, {_PATH}, root binary")
    above = names.join(paths, "pos").select(F.col("name").alias("grp"), *Path.NAMES, "subroot", "root")
    tiles = tree.tops(staged(made.rows.sparkSession, above, "paths"))

    def prove(table: pa.Table, tile: pa.Table) -> pa.Table:
        row = tile.to_pylist()[0]
        path = low.paths(row, table.column("pos").to_numpy() - row["tile"] * low.width)
        folded = path.fold(_digests(table.column("changed")))
        n = table.num_rows
        text = lambda found: [x.tobytes().decode() for x in hexed(found)]
        columns = {
            "key": table.column("key"),
            "leaf": text(_digests(table.column("leaf"))),
            "subroot": [row["subroot"].hex()] * n,
            "root": [row["root"].hex()] * n,
            "proof_sha256": path.proofs(),
            "folded_root": text(folded),
            "verified": (folded == np.frombuffer(row["root"], np.uint8)).all(axis=1),
        }
        return pa.table(columns)

    rows = made.rows.select("grp", F.expr(f"pos div {low.width}").alias("tile"), "pos", "key", "leaf", "changed")
    kind = made.rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.groupBy("grp", "tile").cogroup(tiles.groupBy("grp", "tile")).applyInArrow(prove, schema)
