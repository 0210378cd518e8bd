"""Nearest vectors by cosine: a forest of random-projection trees, one priority queue over all of its trees, exact reranking of whole leaves.

A tree splits by hyperplanes through its vectors. Its planes are fitted on a bounded sample; every vector of the table is indexed, once
per tree. A query walks all trees through one queue, ordered by the squared distances to the planes that it has crossed, until it has
met ``visits`` leaves; every vector of these leaves is compared in double precision. ``visits`` is not a guess: a bounded set of queries
is answered by brute force over the whole table, and the least number is taken that finds ``target`` of their neighbours in the forest.

Neighbouring leaves of a tree are a place. Its vectors and the queries that visit it meet in one task, vectors first, queries streamed. Places
with more than ``PLACE_ROWS`` vectors are cut into chunks, and those with more than ``PLACE_QUERIES`` queries serve them in parts, so a leaf of a
third of all vectors is many groups; nothing is capped. Equal vectors are one row with its smallest ids: with k wanted, no
more than k + 1 of them can be in any result.

Defined results: a row takes no part if its id or vector is null, or the vector is empty, zero, or holds a null or a component that is not finite, or
has another length than most vectors (of lengths equally common the smaller counts). Repeated rows of id and vector count once; a query's own row is that
id with that vector, so an id with two vectors is two queries and two candidates. Ties go to the smaller id. Without rows there are none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from velogrid.session import staged

#: Most bytes of vectors that the planes are fitted on, and trees.
SAMPLE_BYTES, TREES = 32 << 20, 4

#: Vectors of a leaf, about, and vectors of the sample that a leaf keeps at least.
LEAF_ROWS, LEAF_SAMPLE = 128, 8

#: Vectors of a group of one task, queries of one, and queries that are compared at a time.
PLACE_ROWS, PLACE_QUERIES, AT_ONCE = 8192, 65536, 256

#: Queries that are answered by brute force to choose the number of visits, and the share of their neighbours that must be met.
TRIAL_QUERIES, TARGET = 256, 0.97


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v, h, g) of the rows that take part, but for their length; h and g are two hashes of the vector."""
    kind = rows.schema[vector].dataType
    v = F.col(vector)
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)):
        v = v.cast("array<double>")
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return rows.where(sound & F.exists("v", lambda x: x != 0)).select("vec_id", "v", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"))


def matrix(column: pa.Array) -> np.ndarray:
    """(rows, length) in double precision; by powers of two, so without rounding, large and small vectors are brought near 1."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    if x.size:
        most = np.abs(x).max(axis=1)
        odd = np.flatnonzero((most > 1e60) | (most < 1e-60))
        if len(odd):
            x[odd] = np.ldexp(x[odd], -np.frexp(most[odd])[1][:, None])
    return x


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


# --- the forest -------------------------------------------------------------


@dataclass
class Forest:
    """Per tree and depth the planes' normals (2**d, length) and thresholds; a node n of depth d has the children 2n and 2n + 1."""

    trees: list[list[tuple[np.ndarray, np.ndarray]]]
    depth: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def leaf(self, tree: int, units: np.ndarray) -> np.ndarray:
        node = np.zeros(len(units), np.int64)
        for normals, thresholds in self.trees[tree]:
            node = 2 * node + (np.einsum("ij,ij->i", units, normals[node]) > thresholds[node])
        return node

    def search(self, unit: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves (tree * leaves + leaf) in order of the shared queue."""
        queue = [(0.0, t, 0, 0) for t in range(len(self.trees))]
        met: list[int] = []
        while queue and len(met) < visits:
            cost, tree, depth, node = heapq.heappop(queue)
            planes = self.trees[tree]
            while depth < self.depth:
                normals, thresholds = planes[depth]
                margin = float(normals[node] @ unit) - thresholds[node]
                node, depth = 2 * node + (margin > 0), depth + 1
                heapq.heappush(queue, (cost + margin * margin, tree, depth, int(node ^ 1)))
            met.append(tree * self.leaves + int(node))
        return met


def fitted(units: np.ndarray, total: int, trees: int = TREES, seed: int = 0) -> Forest:
    """Planes between two random vectors of a node, at the median of its vectors; as deep as ``total`` vectors need and the sample allows."""
    deep = max(0, int(np.ceil(np.log2(max(1, total / LEAF_ROWS)))))
    depth = min(deep, max(0, int(np.log2(max(1, len(units) / LEAF_SAMPLE)))))
    out = []
    for t in range(trees):
        rng, node, planes = np.random.default_rng([seed, t]), np.zeros(len(units), np.int64), []
        for d in range(depth):
            order = np.argsort(node, kind="stable")
            edges = np.searchsorted(node[order], np.arange(2**d + 1))
            normals, thresholds = rng.normal(size=(2**d, units.shape[1])), np.zeros(2**d)
            for n in range(2**d):
                own = order[edges[n] : edges[n + 1]]
                if len(own) > 1:
                    a, b = rng.choice(own, 2, replace=False)
                    if (units[a] != units[b]).any():
                        normals[n] = units[a] - units[b]
            normals /= norms(normals)[:, None]
            far = np.einsum("ij,ij->i", units, normals[node])
            for n in range(2**d):
                own = order[edges[n] : edges[n + 1]]
                if len(own):
                    thresholds[n] = np.median(far[own])
            planes.append((normals, thresholds))
            node = 2 * node + (far > thresholds[node])
        out.append(planes)
    return Forest(out, depth)


# --- comparison -------------------------------------------------------------


def best(queries: np.ndarray, vectors: np.ndarray, first: np.ndarray, seen: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, cosine) of each query's ``keep`` nearest vectors, ties to the smaller ``first``. ``seen`` holds cosines
    up to rounding, -inf where a vector isn't compared; the cosines are taken again, in the same way wherever a pair meets."""
    width = seen.shape[1]
    if not width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.partition(seen, max(0, width - keep), axis=1)[:, max(0, width - keep)]
    q, v = np.nonzero((seen >= least[:, None] - 1e-12) & (seen > -np.inf))
    cosine = (queries[q] * vectors[v]).sum(axis=1) / (norms(queries)[q] * norms(vectors)[v])
    order = np.lexsort((first[v], -cosine, q))
    q, v, cosine = q[order], v[order], cosine[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < keep], v[rank < keep], cosine[rank < keep]


@dataclass
class _Group:
    """The vectors of one chunk of a place, by leaf."""

    key: np.ndarray
    first: np.ndarray
    leaf: np.ndarray
    x: np.ndarray

    def __post_init__(self) -> None:
        order = np.argsort(self.leaf, kind="stable")
        self.key, self.first, self.leaf, self.x = self.key[order], self.first[order], self.leaf[order], self.x[order]
        self.unit = self.x / norms(self.x)[:, None]

    def answer(self, asked: np.ndarray, leaves: list[np.ndarray], keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unit = asked / norms(asked)[:, None]
        seen = np.full((len(asked), len(self.key)), -np.inf)
        query, leaf = np.repeat(np.arange(len(asked)), [len(x) for x in leaves]), np.concatenate(leaves)
        order = np.argsort(leaf, kind="stable")
        query, leaf = query[order], leaf[order]
        there, start = np.unique(leaf, return_index=True)
        for one, own in zip(there, np.split(query, start[1:]), strict=True):
            a, b = np.searchsorted(self.leaf, [one, one + 1])
            if b > a:
                seen[own, a:b] = unit[own] @ self.unit[a:b].T
        return best(asked, self.x, self.first, seen, keep)


_MEETING = "place int, chunk int, part int, side int, key long, first long, leaf int, leaves binary, v array<{}>"


def _met(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Answers of a partition that is sorted by place, chunk, part and side: a group's vectors come first, then its queries."""
    now, parts, group = None, [], None
    for batch in batches:
        names = [batch.column(c).to_numpy() for c in ("place", "chunk", "part", "side")]
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            run, name, side = batch.slice(a, b - a), tuple(int(x[a]) for x in names[:3]), names[3][a]
            if name != now:
                now, parts, group = name, [], None
            if side == 0:
                parts.append([run.column("key").to_numpy(), run.column("first").to_numpy(), run.column("leaf").to_numpy(), matrix(run.column("v"))])
                continue
            if group is None and parts:
                group, parts = _Group(*[np.concatenate(x) for x in zip(*parts, strict=True)]), []
            if group is None:
                continue  # no vector lies there
            for i in range(0, run.num_rows, AT_ONCE):
                some = run.slice(i, AT_ONCE)
                key = some.column("key").to_numpy()
                q, v, cosine = group.answer(matrix(some.column("v")), [np.frombuffer(x, np.int32) for x in some.column("leaves").to_pylist()], keep)
                yield pa.RecordBatch.from_arrays([pa.array(key[q]), pa.array(group.key[v]), pa.array(group.first[v]), pa.array(cosine)], names=["query", "key", "first", "score"])


# --- the operator -----------------------------------------------------------


def _vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(key, h, g, v, first, ids) of every different vector with its ``keep`` smallest ids, written; equal vectors never gather in a task."""
    ids = rows.select("h", "g", "vec_id").distinct()
    rank = F.row_number().over(Window.partitionBy("h", "g").orderBy("vec_id"))
    ids = ids.withColumn("_rank", rank).where(F.col("_rank") <= keep).groupBy("h", "g").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    vectors = rows.groupBy("h", "g").agg(F.first("v").alias("v")).join(ids, ["h", "g"])
    return staged(rows.sparkSession, vectors.withColumn("first", F.col("ids")[0]).withColumn("key", F.monotonically_increasing_id()), "vectors")


def _trial(forest, vectors: DataFrame, trial: pa.Table, keep: int) -> dict[int, list[tuple[int, list[int]]]]:
    """The nearest vectors of a few queries by brute force: by query (key, its leaf in each tree)."""
    spark = vectors.sparkSession
    asked, names = matrix(trial.column("v").combine_chunks()), trial.column("key").to_numpy()
    sent = spark.sparkContext.broadcast((asked, names))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, names = sent.value
        unit = asked / norms(asked)[:, None]
        for batch in batches:
            x = matrix(batch.column("v"))
            own = x / norms(x)[:, None]
            q, v, cosine = best(asked, x, batch.column("first").to_numpy(), unit @ own.T, keep)
            leaves = np.stack([forest.value.leaf(t, own) for t in range(len(forest.value.trees))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[q]), pa.array(batch.column("key").to_numpy()[v]), pa.array(batch.column("first").to_numpy()[v]), pa.array(cosine), pa.array(leaves[v].tolist(), pa.list_(pa.int64()))],
                names=["query", "key", "first", "score", "leaves"],
            )

    found = vectors.select("key", "first", "v").mapInArrow(scan, "query long, key long, first long, score double, leaves array<long>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first", "key"))
    out: dict[int, list[tuple[int, list[int]]]] = {}
    for r in found.withColumn("_rank", rank).where(F.col("_rank") <= keep).collect():  # ``keep`` rows for each trial query
        out.setdefault(r["query"], []).append((r["key"], r["leaves"]))
    sent.unpersist()
    return out


def visits_needed(forest: Forest, trial: pa.Table, nearest: dict[int, list[tuple[int, list[int]]]], target: float) -> int:
    """The least number of visits after which ``target`` of the neighbours lie in visited leaves."""
    every, need = len(forest.trees) * forest.leaves, []
    asked = matrix(trial.column("v").combine_chunks())
    for name, unit in zip(trial.column("key").to_pylist(), asked / norms(asked)[:, None], strict=True):
        at = {leaf: i for i, leaf in enumerate(forest.search(unit, every))}
        for key, leaves in nearest.get(name, []):
            if key != name:  # the query's own vector is met at once
                need.append(min(at[t * forest.leaves + leaf] for t, leaf in enumerate(leaves)) + 1)
    if not need:
        return len(forest.trees)
    return max(len(forest.trees), int(np.quantile(need, target, method="higher")))


def nearest(rows: DataFrame, is_query: Column | str, k: int = 5, key: str = "vec_id", vector: str = "embedding", target: float = TARGET, visits: int | None = None) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` nearest rows found for every row where ``is_query`` (of the column vec_id) holds."""
    spark, keep = rows.sparkSession, k + 1
    rows = usable(rows, key, vector)
    sizes = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(1).collect()
    length = sizes[0]["length"] if sizes else 1
    rows = rows.where(F.size("v") == length)
    vectors = _vectors(rows, keep)
    total = vectors.count()
    wanted = staged(spark, rows.where(is_query).select("vec_id", "h", "g").distinct().join(vectors.select("key", "h", "g"), ["h", "g"]).select("vec_id", "key"), "wanted")

    most = SAMPLE_BYTES // (4 * length)
    chosen = F.lit(True) if total <= most else F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * most / total)
    sample = vectors.where(chosen).select("h", "g", "v").toArrow().sort_by([("h", "ascending"), ("g", "ascending")])
    units = matrix(sample.column("v").combine_chunks()) if sample.num_rows else np.zeros((0, length))
    model = fitted(units / norms(units)[:, None], total)
    del sample, units
    forest = spark.sparkContext.broadcast(model)
    asked = vectors.join(wanted.select("key").distinct(), "key", "left_semi").select("key", "v", "h")
    if visits is None:
        trial = asked.orderBy("h", "key").limit(TRIAL_QUERIES).select("key", "v").toArrow()
        visits = visits_needed(model, trial, _trial(forest, vectors, trial, keep), target) if trial.num_rows else 1

    count, leaves = len(model.trees), model.leaves
    bundle = max(1, PLACE_ROWS // 2 * leaves // max(1, total))  # leaves of a place
    per_tree = -(-leaves // bundle)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"))
            found = [forest.value.search(u, visits) for u in x / norms(x)[:, None]]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("v"), pa.array(found, pa.list_(pa.int32()))], names=["key", "v", "leaves"])

    kind = rows.schema["v"].dataType.simpleString()
    walkers = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (1 << 20))
    asked = staged(spark, asked.select("key", "v").repartition(walkers, "key").mapInArrow(walk, f"key long, v {kind}, leaves array<int>"), "asked")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"))
            unit = x / norms(x)[:, None]
            for t in range(count):
                place, n = np.unique(t * per_tree + forest.value.leaf(t, unit) // bundle, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(n)], names=["place", "n"])

    # A row per place, of which a forest has at most as many as leaves.
    held = vectors.select("v").mapInArrow(tally, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    chunks, parts = np.ones(count * per_tree, np.int64), np.ones(count * per_tree, np.int64)
    chunks[held.column("place").to_numpy()] = -(-held.column("n").to_numpy() // PLACE_ROWS)
    places = F.transform("leaves", lambda x: (F.floor(x / leaves) * per_tree + F.floor(F.pmod(x, F.lit(leaves)) / bundle)).cast("int"))
    heard = asked.select(F.explode(F.array_distinct(places)).alias("place")).groupBy("place").agg(F.count("*").alias("n")).toArrow()
    parts[heard.column("place").to_numpy()] = -(-heard.column("n").to_numpy() // PLACE_QUERIES)

    def repeated(at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row ``times`` times, and which time it is."""
        rows = np.repeat(at, times)
        return rows, np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)

    def spread(key: np.ndarray, over: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % over

    names = ["place", "chunk", "part", "side", "key", "first", "leaf", "leaves", "v"]

    def meeting(place, chunk, part, side, key, first, leaf, visited, v) -> pa.RecordBatch:
        ints = [pa.array(x.astype(np.int32)) for x in (place, chunk, part, np.full(len(place), side))]
        return pa.RecordBatch.from_arrays([*ints, pa.array(key), first, leaf, visited, v], names=names)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector once per tree; once per part of the queries where a place has very many."""
        for batch in batches:
            key, x = batch.column("key").to_numpy(), matrix(batch.column("v"))
            unit = x / norms(x)[:, None]
            for t in range(count):
                leaf = forest.value.leaf(t, unit)
                place = t * per_tree + leaf // bundle
                at, part = repeated(np.arange(len(key)), parts[place])
                rows = pa.array(at)
                yield meeting(place[at], spread(key, chunks[place])[at], part, 0, key[at], batch.column("first").take(rows), pa.array(leaf[at].astype(np.int32)), pa.nulls(len(at), pa.binary()), batch.column("v").take(rows))

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once per place that it visits and chunk of it, with the leaves that it visits there."""
        for batch in batches:
            key, found = batch.column("key").to_numpy(), batch.column("leaves")
            row = np.repeat(np.arange(len(key)), pa.compute.list_value_length(found).to_numpy())
            tree, leaf = np.divmod(found.flatten().to_numpy().astype(np.int64), leaves)
            place = tree * per_tree + leaf // bundle
            order = np.lexsort((leaf, place, row))
            row, place, leaf = row[order], place[order], leaf[order].astype(np.int32)
            start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1])]) if len(row) else np.zeros(0, np.int64)
            visited = [x.tobytes() for x in np.split(leaf, start[1:])] if len(row) else []
            at, chunk = repeated(np.arange(len(start)), chunks[place[start]])
            for i in range(0, len(at), 1 << 14):
                one, c = at[i : i + (1 << 14)], chunk[i : i + (1 << 14)]
                q, p = row[start[one]], place[start[one]]
                none = pa.nulls(len(one), pa.int64()), pa.nulls(len(one), pa.int32())
                yield meeting(p, c, spread(key[q], parts[p]), 1, key[q], *none, pa.array([visited[j] for j in one], pa.binary()), batch.column("v").take(pa.array(q)))

    schema = _MEETING.format(kind[len("array<") : -1])
    both = vectors.select("key", "first", "v").mapInArrow(indexed, schema).unionByName(asked.mapInArrow(visiting, schema))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * count * length * 8 // (64 << 20))
    both = both.repartition(tasks, "place", "chunk", "part").sortWithinPartitions("place", "chunk", "part", "side")
    found = both.mapInArrow(lambda batches: _met(batches, keep), "query long, key long, first long, score double").distinct()

    nearer = Window.partitionBy("query").orderBy(F.desc("score"), "first", "key")
    found = found.withColumn("_rank", F.row_number().over(nearer)).where(F.col("_rank") <= keep).drop("_rank")
    found = found.join(vectors.select("key", "ids"), "key").select("query", "key", "score", F.explode("ids").alias("vec_id"))
    nearer = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "key")
    found = found.withColumn("_rank", F.row_number().over(nearer)).where(F.col("_rank") <= keep).drop("_rank")
    own = wanted.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"))
    pairs = own.join(found, "query").where("vec_id <> query_id or key <> query")
    nearer = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "key")
    return pairs.withColumn("rank", F.row_number().over(nearer)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
