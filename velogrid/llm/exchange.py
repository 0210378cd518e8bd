"""Ask a corpus-wide table about the keys of a block of documents, without shipping every key occurrence.

A block is a run of rows of one scan task. It sorts its distinct keys into buckets and sends one
packed row per bucket; the task of a bucket sums what all blocks sent and answers each block with one
packed row; the block puts the answers together. A key that occurs in a third of all documents is one
entry per block, and no table is sent to the driver or broadcast.

The blocks of a lost task are built again from the same rows, so ``df`` must come from a scan of
files or a written table, whose partitions keep their rows and order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.session import staged

PARCEL = "block string, bucket long, body binary"
ARROW_PARCEL = pa.schema([("block", pa.string()), ("bucket", pa.int64()), ("body", pa.binary())])

#: Bytes of texts whose keys one bucket holds at most, about, those of one task of either exchange, and documents of a block.
BUCKET_BYTES, TASK_BYTES, BLOCK_ROWS = 16 << 20, 8 << 20, 1 << 16

#: Bytes of one Arrow batch, about: buffers of this size are pooled and used again, larger ones are not, which fragments an executor's memory.
BATCH_BYTES = 2 << 20

#: A bucket number of one block's own row, which no bucket reads. It travels in pieces of ``PIECE_BYTES``, up to ``PIECES`` of them:
#: a row of megabytes is a single large allocation wherever it passes.
OWN, PIECE_BYTES, PIECES = -1, 256 << 10, 1000

Row = tuple[int, bytes]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Holds a setting of the session while tables are written."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Holds Arrow batches to ``BATCH_BYTES`` while a table is written."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def text_bytes_of(df: DataFrame) -> int:
    """Bytes of all texts."""
    return df.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def bucket_count(df: DataFrame, size: int) -> int:
    """Follows ``size``, the bytes of all texts, so that a bucket fits into a task however large the corpus; many tasks have one at least."""
    return max(128, 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)


def blocks(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], list[int]], most: int) -> Iterator[pa.RecordBatch]:
    """Cut a run of batches so that a block's sizes sum to ``most`` at most, and its rows to ``BLOCK_ROWS``; a larger row is a block of its own."""
    held: list[pa.RecordBatch] = []
    rows, total = 0, 0
    for batch in batches:
        at = 0
        for i, n in enumerate(size(batch)):
            if rows and (total + n > most or rows == BLOCK_ROWS):
                yield pa.concat_batches([*held, batch.slice(at, i - at)])
                held, at, rows, total = [], i, 0, 0
            rows, total = rows + 1, total + n
        if batch.num_rows > at:
            held.append(batch.slice(at))
    if held:
        yield pa.concat_batches(held)


def text_sizes(batch: pa.RecordBatch) -> list[int]:
    return pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()


def groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple]:
    """(key, rows) of the parcels of each key, which follow one another; a row is (block, bucket, body)."""
    key, rows, place = None, [], 0 if by == "block" else 1
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "body")), strict=True):
            if rows and row[place] != key:
                yield key, rows
                rows = []
            key = row[place]
            rows.append(row)
    if rows:
        yield key, rows


def _pieces(bucket: int, body: bytes) -> list[Row]:
    """A block's own row in pieces, numbered from -1 down; the rows of buckets as they are."""
    if bucket != OWN:
        return [(bucket, body)]
    size = max(PIECE_BYTES, -(-len(body) // (PIECES - 1)))
    return [(OWN - i, body[at : at + size]) for i, at in enumerate(range(0, len(body), size))] or [(OWN, body)]


def exchange(
    df: DataFrame,
    ask: Callable[[pa.RecordBatch], Iterator[Row]],
    answer: Callable[[list[bytes]], list[bytes | None]],
    finish: Callable[[bytes, dict[int, bytes]], pa.Table],
    schema: str,
    size: int,
    name: str,
    block_bytes: int = 3 << 20,
) -> DataFrame:
    """``ask`` gives a block's packed rows, ``answer`` a reply for each row of a bucket (in order),
    ``finish`` the block's result from its own row and the replies by bucket. ``size`` is the bytes of all texts. The result is a
    written table."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for block in blocks(batches, text_sizes, block_bytes):
            rows = [piece for row in ask(block) for piece in _pieces(*row)]
            pa.default_memory_pool().release_unused()
            name = f"{part}-{n}"
            n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rows), pa.string()), pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], schema=ARROW_PARCEL
            )

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groups(batches, "bucket"):
            out = [x for _, _, x in rows] if bucket < 0 else answer([x for _, _, x in rows])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in rows], pa.string()), pa.array([bucket] * len(rows), pa.int64()), pa.array(out, pa.binary())], schema=ARROW_PARCEL)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "block"):
            own = b"".join(x for _, x in sorted((-bucket % PIECES, x) for _, bucket, x in rows if bucket < 0))
            yield from finish(own, {bucket: x for _, bucket, x in rows if bucket >= 0 and x is not None}).to_batches()

    parcels = df.mapInArrow(build, PARCEL)
    # A block's own row travels under numbers of its own, so these rows spread like the others.
    spread = F.when(F.col("bucket") < 0, F.col("bucket") - PIECES * (1 + F.pmod(F.xxhash64("block"), F.lit(1_000_000)))).otherwise(F.col("bucket"))
    # Sorted by block as well, so that every attempt sees a bucket's rows in the same order.
    asked = parcels.withColumn("bucket", spread).repartition(tasks, "bucket").sortWithinPartitions("bucket", "block")
    replies = asked.mapInArrow(reply, PARCEL)
    closed = replies.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(close, schema)
    with small_batches(df.sparkSession):
        return staged(df.sparkSession, closed, name)
