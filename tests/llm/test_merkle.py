"""The Merkle manifest against plain hashing of whole trees, over several tiers of tiles, and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from velogrid.llm import merkle
from velogrid.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n, text = row
    fields = [doc_id, source, lang, None if n is None else n + more, text]
    return digest(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def steps(tree, at, arity):
    """(left siblings, right siblings) on every level."""
    for nodes in tree[:-1]:
        first = at - at % arity
        yield nodes[first:at], nodes[at + 1 : first + arity]
        at //= arity


def expected(rows, arity, hit):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in own], arity)
    top = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            way = [*steps(trees[g], i, arity), *steps(top, k, arity)]
            now = leaf(row, int(hit(row)))
            for left, right in way:
                now = digest(*left, now, *right)
            proof = digest(*[x for left, right in way for x in [*left, *right]])
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 31])
def test_a_tile_hashes_and_folds_like_the_library(arity, n):
    leaves = np.random.default_rng(n).integers(0, 256, (n, 32)).astype(np.uint8)
    digests, states = merkle.grow(leaves, arity, None)
    tree = levels([x.tobytes().hex() for x in leaves], arity)
    assert [[x.tobytes().hex() for x in level] for level in digests] == tree
    path = merkle.Path.within(np.arange(n), digests, states, arity)
    changed = leaves.copy()
    changed[:, 0] ^= 1
    for i, folded in enumerate(path.fold(changed)):
        now = changed[i].tobytes().hex()
        for left, right in steps(tree, i, arity):
            now = digest(*left, now, *right)
        assert folded.tobytes().hex() == now
    # Before its first child a parent has the standard's state; before the second, that of its first child's text.
    if n > 1:
        before = merkle.compress(merkle.START[None], merkle.hexed(leaves[:1]))
        assert (states[0][0, 0] == merkle.START).all() and (states[0][0, 1] == before[0]).all()


def random_rows(n):
    rng = random.Random(n)
    rows = [(i, rng.choice("ab"), rng.choice(["en", "en", "en", "de", "é", "z", "", None]), rng.randint(0, 99), "x" * rng.randint(0, 90)) for i in range(n)]
    odd = [(None, None, None, None, None), (None, "s", "en", 3, None), (5, "a", "en", None, ""), (5, "a", "en", None, ""), (5, "b", "en", 1, "é漢\n"), (6, "a", "long", 7, "word " * 50_000)]
    return rows + odd * (n > 0)


@pytest.mark.parametrize(("n", "arity", "tile"), [(0, 2, 12), (1, 2, 12), (90, 2, 12), (90, 2, 2), (90, 3, 1), (150, 2, 1)])
def test_manifest_of_any_size(spark, n, arity, tile):
    rows = random_rows(n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("grp", "pos", "key", "leaf", "root", "digest", "total")})
    hit = F.col("doc_id") % 3 == 0
    fields = [[F.col("doc_id"), F.col("source"), F.col("lang"), c, F.col("text")] for c in (F.col("n_chars"), F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars")))]
    made = merkle.manifest(docs, F.col("lang"), *fields, arity=arity, levels=tile)
    got = sorted((tuple(r) for r in merkle.fold(made).collect()), key=str)
    assert got == expected(rows, arity, lambda r: r[0] is not None and r[0] % 3 == 0)


def test_the_query_finds_what_was_changed(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in op11_merkle_manifest(spark, folder).collect()), key=str)
    assert got == expected(rows, 2, lambda r: zlib.crc32(str(r[0]).encode()) % 7 == 0)
    assert {r[-1] for r in got} == {True, False}


def test_a_large_group_is_many_tiles(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    made = merkle.manifest(docs, F.col("lang"), [F.col("doc_id")])
    assert [t.count() for t in made.tree.tiers] == [10, 1]
    out = merkle.fold(made)
    assert out.where("verified").count() == 40_000
    assert out.agg(F.countDistinct("proof_sha256")).first()[0] == 40_000
