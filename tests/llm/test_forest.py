"""Nearest vectors against brute force: exact where every leaf is visited, by recall where not, with equal and hot vectors and odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from velogrid.llm import forest
from velogrid.llm.queries import op13_nearest

INF, NAN = float("inf"), float("nan")


def brute(rows, k, divisor=50):
    """All pairs, in double precision; ties to the smaller id."""
    rows = sorted(set((i, tuple(v)) for i, v in rows))
    x = np.array([v for _, v in rows], np.float64)
    size = np.sqrt((x * x).sum(axis=1))
    out = []
    for q, (i, _) in enumerate(rows):
        if i % divisor == 0:
            score = (x * x[q]).sum(axis=1) / (size * size[q])
            order = sorted((-s, j, n) for n, (s, (j, _)) in enumerate(zip(score, rows, strict=True)) if n != q)
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(order[:k])]
    return sorted(out)


def answers(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def same(got, want):
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=0, atol=1e-12)


def recall(got, want):
    return len({x[::2][:2] for x in got} & {x[::2][:2] for x in want}) / len(want)


def random_rows(n, length, seed=0, centres=20):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, length))
    x = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, length))
    return [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(n), x.astype(np.float32), strict=True)]


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


QUERY = "vec_id % 50 = 0"


def test_all_leaves_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF_ROWS", 16)
    rows = random_rows(700, 12)
    same(answers(forest.nearest(table(spark, rows), QUERY, visits=10**6)), brute(rows, 5))


def test_hot_places_are_cut_without_loss(spark, monkeypatch):
    """A third of all vectors lie next to each other, in one leaf of every tree; another third are equal."""
    for name, value in (("LEAF_ROWS", 16), ("PLACE_ROWS", 40), ("PLACE_QUERIES", 3), ("AT_ONCE", 2), ("SAMPLE_BYTES", 9600)):
        monkeypatch.setattr(forest, name, value)
    rng = np.random.default_rng(3)
    near = [(i, [float(c) for c in (np.ones(8) + 1e-4 * rng.normal(size=8)).astype(np.float32)]) for i in range(300)]
    equal = [(1000 + i, [1.0, -1.0, 0.5, 0.0, 0.0, 2.0, 0.0, 1.0]) for i in range(300)]
    rows = near + equal + [(2000 + i, v) for i, v in random_rows(300, 8)]
    same(answers(forest.nearest(table(spark, rows), QUERY, visits=10**6)), brute(rows, 5))


@pytest.mark.parametrize("length", [8, 48])
def test_recall(spark, length):
    rows = random_rows(6000, length, seed=length)
    got, want = answers(forest.nearest(table(spark, rows), QUERY)), brute(rows, 5)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    scores = {(q, v): s for q, _, v, s in got}
    assert all(abs(scores[q, v] - s) < 1e-12 for q, _, v, s in want if (q, v) in scores)


def test_the_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = answers(op13_nearest(spark, folder)), brute(rows, 5)
    assert len(got) == len(want) and recall(got, want) >= 0.9


def test_odd_rows(spark):
    sound = random_rows(120, 4)
    double = [(i, [2 * c for c in v]) for i, v in sound[:20]]  # another vector under the same id, of the same direction
    odd = [(None, [1.0, 2.0, 3.0, 4.0]), (500, None), (550, []), (600, [0.0] * 4), (650, [1.0, None, 2.0, 3.0]), (700, [1.0, NAN, 2.0, 3.0]), (750, [INF, 1.0, 1.0, 1.0]), (800, [1.0]), (850, [1.0] * 9)]
    large = [(900, [1e200, 1e200, 0.0, 0.0]), (950, [1e-200, 1e-200, 0.0, 0.0])]
    df = table(spark, sound + sound[:40] + double + odd + large, "double").withColumns({c: F.lit("x") for c in ("key", "v", "h", "g", "first", "ids", "query", "rank", "score", "place")})
    got = answers(forest.nearest(df, QUERY))
    scaled = [(900, [1.0, 1.0, 0.0, 0.0]), (950, [2.0, 2.0, 0.0, 0.0])]
    want = brute(sound + double + scaled, 5)
    assert sorted(x[0] for x in got) == sorted(x[0] for x in want)
    assert np.allclose([x[3] for x in got], [x[3] for x in want], atol=1e-12)
    assert [x[2] for x in got if x[0] == 900][0] == 950
    assert answers(forest.nearest(df.limit(0), QUERY)) == []
    assert answers(forest.nearest(df.where("vec_id = 900"), QUERY)) == []
    assert [x[:3] for x in answers(forest.nearest(df.where("vec_id in (900, 950)"), QUERY))] == [(900, 1, 950), (950, 1, 900)]


def test_the_queue_meets_every_leaf_once_and_the_own_leaves_first():
    units = np.random.default_rng(1).normal(size=(600, 6))
    units /= forest.norms(units)[:, None]
    made = forest.fitted(units, 600 * 16)
    assert made.depth > 3
    others = np.random.default_rng(2).normal(size=(20, 6))
    for u in others / forest.norms(others)[:, None]:
        met = made.search(u, 10**6)
        assert sorted(met) == list(range(len(made.trees) * made.leaves))
        assert sorted(met[: len(made.trees)]) == [t * made.leaves + int(made.leaf(t, u[None])[0]) for t in range(len(made.trees))]


def test_ties_in_a_group_go_to_the_smaller_id():
    x = np.array([[1.0, 0], [2, 0], [4, 0], [0, 1]])
    seen = np.array([[1.0, 1, 1, 0]])
    q, v, _ = forest.best(x[:1], x, np.array([9, 3, 5, 1]), seen, 2)
    assert q.tolist() == [0, 0] and v.tolist() == [1, 2]
    assert pa.array(v).to_pylist() == [1, 2]
