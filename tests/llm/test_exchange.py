"""Blocks and buckets of the corpus-wide look-ups, at any size of batches."""

import random

import pyarrow as pa
import pytest

from velogrid.llm import exchange, ngram_join


@pytest.fixture
def large_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "200000")
    yield
    spark.conf.set(name, before)


def test_links_are_right_in_batches_of_any_size(spark, tmp_path, large_batches):
    """70,000 short texts in one batch, 4000 of them near copies of earlier ones."""
    rng = random.Random(4)
    texts = [" ".join(f"{i}x{j}" for j in range(20)) for i in range(66_000)]
    copied = rng.sample(range(66_000), 4000)
    rows = [(i, t) for i, t in enumerate(texts)] + [(66_000 + n, texts[i] + " more") for n, i in enumerate(copied)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    got = ngram_join.ngram_join(spark.read.parquet(str(tmp_path / "t")), k=1, num=85, den=100)
    linked = {r.doc_id: r.component_id for r in got.where("doc_id <> component_id").collect()}
    assert linked == {66_000 + n: i for n, i in enumerate(copied)}


def test_blocks_are_cut_by_bytes_and_rows(monkeypatch):
    monkeypatch.setattr(exchange, "BLOCK_ROWS", 4)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (1, 1, 1, 1, 1, 9, 30, 2, 2)]})
    got = [b.column("text").to_pylist() for b in exchange.blocks([batch], exchange.text_sizes, 10)]
    assert [[len(x) for x in b] for b in got] == [[1, 1, 1, 1], [1, 9], [30], [2, 2]]
    for n in (1, 2, 5):  # blocks don't depend on how rows came in batches
        parts = [batch.slice(i, n) for i in range(0, batch.num_rows, n)]
        assert [b.column("text").to_pylist() for b in exchange.blocks(parts, exchange.text_sizes, 10)] == got
    assert list(exchange.blocks([batch.slice(0, 0)], exchange.text_sizes, 10)) == []


def test_the_number_of_buckets_follows_the_bytes(spark):
    df = spark.range(1)
    assert exchange.bucket_count(df, 0) == 128
    assert exchange.bucket_count(df, 30 << 30) == (30 << 30) // exchange.BUCKET_BYTES


def test_a_blocks_own_row_comes_back_whole(spark, monkeypatch):
    monkeypatch.setattr(exchange, "PIECE_BYTES", 1000)
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate((0, 999, 1000, 1001, 50_000, 2_000_000))], "doc_id long, text string").coalesce(1)

    def ask(block):
        yield exchange.OWN, "".join(t + "|" for t in block.column("text").to_pylist()).encode()
        yield 3, b"a"

    def finish(own, replies):
        return pa.table({"n": [len(own)], "replies": [str(sorted(replies.items()))]})

    got = exchange.exchange(df, ask, lambda bodies: [x + str(len(bodies)).encode() for x in bodies], finish, "n long, replies string", 0, "t", 100_000).collect()
    assert sorted(r.n for r in got) == [53_005, 2_000_001] and {r.replies for r in got} == {"[(3, b'a2')]"}
    body = bytes(range(256)) * 5000
    cut = exchange._pieces(exchange.OWN, body)
    assert b"".join(x for _, x in cut) == body and [b for b, _ in cut] == list(range(-1, -1 - len(cut), -1)) and len(cut) < exchange.PIECES
    assert exchange._pieces(exchange.OWN, b"") == [(exchange.OWN, b"")] and exchange._pieces(5, body) == [(5, body)]
