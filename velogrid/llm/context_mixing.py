"""Log-probabilities of texts by logistic context mixing, beside a word frequency score.

A text is coded as its lower-cased words, each followed by a space, and a line end. Every bit of that
stream is predicted from hashed contexts, the last 1 to ``len(ORDERS)`` bytes and the bits of the byte so far: the counts
of zeros and ones that the training documents have after the context give a probability. The predictions are mixed
in the logistic domain by a set of weights, which the longest context with counts and the bit's place
select; an adaptive probability map then corrects the mix by what was seen at such values. All training documents are
counted. Weights and map are fitted to all bytes of the training documents, each predicted from the counts without
those of its own document: Newton steps for the weights, hits per cell for the map, from sums that Spark aggregates. A share
of the bytes, whose inputs are small enough to be kept, only says where the steps over all bytes begin.

How it runs on a cluster: a byte's cost depends on the byte and its longest context alone, so a block of documents
asks once for each distinct (context, byte) of each order (see ``exchange``) and keeps the counts beside its texts, both compressed. Each Newton
step is a pass over these kept blocks, which sums over all training bytes, and so is the scoring, which costs each distinct gram of a block once
and adds up its documents. Counts of words are asked for in the same way, and the inputs of the tuning bytes are read off the kept blocks;
no table of the corpus is broadcast or sent to the driver.

A gram is a byte and the five before it. In most documents what a byte's own one has counted doesn't change a logit; bounds by bit of what it would
take (``_calm``) say where it may, and only there a byte is seen by document (``_left_inputs``).
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.llm.exchange import OWN, bucket_count, exchange, setting, small_batches
from velogrid.llm.samples import remainder
from velogrid.llm.words import mix, words
from velogrid.session import staged

ORDERS = (1, 2, 3, 4, 5)
_TOP = len(ORDERS)
#: One byte in ``TUNING_SHARE`` of the training documents gives the first weights, and more of a small input, so that about ``LEAST_TUNING`` do.
TUNING_SHARE, LEAST_TUNING = 256, 400_000
#: The documents of one hash in ``FIRST_SHARE``, of a large input, hold these bytes and lead from there to the weights from which the steps over all bytes begin.
FIRST_SHARE = 16
PASSES, RIDGE = 10, 1.0
#: The step that gains less than this part of the loss is the last one over all bytes; after it, next to nothing is left to gain.
ENOUGH = 1e-3
BLOCK_BYTES = 8 << 20
#: Logits are kept as whole numbers of 1/15, from -8 to 8.
SCALE, PRIOR = 15.0, 0.05
CELLS = 33
#: Sums over the tuning bytes are kept as whole numbers of 1/FINE.
FINE = float(1 << 16)

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, word_score double, score double, stream_bytes long, n_words_all long, n_distinct long"
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("word_score", pa.float64()), ("score", pa.float64()), ("stream_bytes", pa.int64()), ("n_words_all", pa.int64()), ("n_distinct", pa.int64())]
)


def stream(found: list[bytes]) -> bytes:
    return b" ".join([*found, b"\n"])


def places(streams: list[bytes]) -> np.ndarray:
    """Per byte, as one number: it, the ``_TOP`` bytes before it from the last one on, and in the last 16 bits its document; before a text come line ends."""
    sizes = np.array([len(s) for s in streams])
    out, at = np.empty(sizes.sum(), np.uint64), 0
    for first, group in _groups(streams):
        data = b"".join(b"\n" * _TOP + s for s in group) + b"\n" * 2
        # The eight bytes from the fifth before each byte on; the shift drops the two after it.
        eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
        few = sizes[first : first + len(group)]
        keep, ends = np.ones(len(eight), bool), np.cumsum(few + _TOP)
        for i in range(_TOP):
            keep[ends[:-1] - 1 - i] = False
        part = out[at : at + few.sum()]
        np.left_shift(eight[keep], np.uint64(16), out=part)
        part |= np.repeat(np.arange(first, first + len(group), dtype=np.uint64), few)
        at += len(part)
    return out


#: Bits of a context's number: 5 bytes, and its order above them.
_WIDE = 8 * _TOP + 3


def hashed(context: np.ndarray, order: int) -> np.ndarray:
    """A number of ``_WIDE`` bits for each context of an order, spread over the whole range: one to one, so that no two contexts are taken for one."""
    all_ = np.uint64((1 << _WIDE) - 1)
    out = context + np.uint64(order << 8 * _TOP)
    for odd in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        out = out * np.uint64(odd) & all_
        out ^= out >> np.uint64(_WIDE // 2 + 1)
    return out


#: Random numbers of bytes and their places in a word, of its first 64 bytes.
_LETTERS = mix(mix(np.arange(64 << 8, dtype=np.uint64)))


def word_numbers(streams: list[bytes]) -> np.ndarray:
    """An even number per token, the words of each document and its end: the sum of random numbers of its bytes and their places in it."""
    out = []
    for _, group in _groups(streams):
        data = np.frombuffer(b" ".join(group), np.uint8)
        space = np.flatnonzero(data == ord(" "))
        first = np.concatenate([[0], space + 1])
        letter = np.arange(len(data))
        letter -= np.repeat(first, np.diff(first, append=len(data)))
        letter <<= 8
        letter |= data
        far = np.flatnonzero(letter >= len(_LETTERS))
        number = _LETTERS.take(letter, mode="clip")
        number[far] = mix(mix(letter[far].astype(np.uint64)))
        number[space] = 0
        out.append(np.add.reduceat(number, first))
    return np.concatenate(out) & ~np.uint64(1)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each distinct value begins."""
    new = np.empty(len(sorted_values), bool)
    new[:1] = True
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    return np.flatnonzero(new)


def _lengths(first: np.ndarray, total: int) -> np.ndarray:
    """Of runs that begin at ``first``, the last of which ends at ``total``."""
    out = np.empty(len(first), np.int32 if total < 1 << 31 else np.int64)
    np.subtract(first[1:], first[:-1], out=out[:-1], casting="unsafe")
    out[-1:] = total - first[-1:]
    return out


def _parts(grams: np.ndarray, counts: np.ndarray | None):
    """All distinct (context, byte) of all orders of distinct sorted ``grams``: keys of the context's hash and the byte, counts if there are any, and
    which one each gram has. Those of an order are grams with the same bytes up to its last one, and so follow one another."""
    key, number, at, start = [], [], [], 0
    for order in ORDERS:
        short = grams >> np.uint64(8 * (_TOP - order))
        first = _starts(short)
        at.append((np.repeat(np.arange(len(first)), _lengths(first, len(grams))) + start).astype(np.int32))
        context, byte = short[first] & np.uint64((1 << 8 * order) - 1), short[first] >> np.uint64(8 * order)
        key.append(hashed(context, order) << np.uint64(8) | byte)
        if counts is not None:
            number.append(np.add.reduceat(counts, first))
        start += len(first)
    return np.concatenate(key), np.concatenate(number) if number else None, np.stack(at)


def _short(number: np.ndarray) -> list[np.ndarray]:
    """Numbers as bytes, those from 255 on in full beside them."""
    return [np.minimum(number, 255).astype("u1"), number[number >= 255].astype("i8")]


def _full(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    number = small.astype(np.int64)
    number[small == 255] = large
    return number


def _squeeze(*arrays: np.ndarray) -> np.ndarray:
    return np.frombuffer(zstandard.compress(_pack(*arrays), 1), "u1")


def _steps(numbers: np.ndarray) -> np.ndarray:
    """Steps between sorted numbers, by byte, as the high ones are mostly 0."""
    return np.ascontiguousarray(np.diff(numbers, prepend=np.uint64(0)).view("u1").reshape(-1, 8).T)


def _from_steps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(steps.reshape(8, -1).T).reshape(-1).view("u8"))


def _pack_keys(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sorted keys and their counts: a context once, as the step from the one before it, and how many bytes follow it."""
    context = key >> np.uint64(8)
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(key) else np.zeros(0, np.int64)
    return _squeeze(_steps(context[starts]), (np.diff(starts, append=len(key)) - 1).astype("u1"), key.astype("u1"), *_short(count))


def _unpack_keys(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, more, byte, small, large = _unpack(zstandard.decompress(body), "u1", "u1", "u1", "u1", "i8")
    return np.repeat(_from_steps(steps) << np.uint64(8), more.astype(np.int64) + 1) | byte, _full(small, large)


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack(f"<{len(arrays)}I", *(a.nbytes for a in arrays)) + b"".join(a.tobytes() for a in arrays)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 4 * len(kinds)
    for n, kind in zip(struct.unpack_from(f"<{len(kinds)}I", body), kinds, strict=True):
        out.append(np.frombuffer(body, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _bucket(key: np.ndarray, drop: int, buckets: int) -> np.ndarray:
    """The bucket of keys, from 24 bits above ``drop``: it rises with the key, so that sorted keys follow one another by bucket."""
    return ((key >> np.uint64(drop)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


class Block:
    """What a block of documents asks for, in an order that it finds again from its streams: keys sorted by hash, words by their number."""

    def __init__(self, streams: list[bytes], held: np.ndarray, with_words: bool = True, with_counts: bool = False):
        self.held, self.sizes = held, np.array([len(s) for s in streams])
        where = places(streams)
        where.sort()
        first = _starts(where)
        self.number = _lengths(first, len(where))
        where = where[first]
        # Each gram of each document once, by gram: the document and how often it is there.
        self.doc = (where & np.uint64(0xFFFF)).astype(np.uint16)
        where >>= np.uint64(16)
        self.edges = _starts(where)  # where the rows of each gram begin
        self.grams = where[self.edges]
        del where, first
        counts = np.add.reduceat(np.where(held[self.doc], 0, self.number), self.edges, dtype=np.int64) if with_counts else None
        key, count, at = _parts(self.grams, counts)
        order = np.argsort(key)
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        self.key, self.count, self.at = key[order], count[order] if with_counts else None, back[at]  # ``at``: the key of each gram, by order
        if with_words:
            self.tokens = np.array([s.count(b" ") + 1 for s in streams])
            self.numbers = word_numbers(streams)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct numbers of words, sorted, and their counts."""
        number = self.numbers | np.repeat(~self.held, self.tokens)  # the last bit is free
        number.sort()
        first = _starts(number >> np.uint64(1))
        return number[first] & ~np.uint64(1), np.add.reduceat((number & np.uint64(1)).astype(np.int64), first)

    def summed(self, cost: np.ndarray) -> np.ndarray:
        """The sum of each document's bytes, of a value per distinct gram."""
        return np.bincount(self.doc, np.repeat(cost, _lengths(self.edges, len(self.doc))) * self.number, len(self.sizes))


def _ask(buckets: int):
    def ask(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        streams = [stream(words(x)) for x in batch.column("text").cast(pa.binary()).to_pylist()]
        b = Block(streams, batch.column("held").to_numpy(zero_copy_only=False), with_counts=True)
        batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(streams, pa.binary()))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        del streams
        first = batch.column("first")[0].as_py()  # as all rows of a block
        yield OWN, bytes([first]) + zstandard.compress(sink.getvalue(), 5)
        key, count = b.key, b.count
        distinct, number = b.words()
        edges = np.searchsorted(_bucket(key, _WIDE + 8 - 24, buckets), np.arange(buckets + 1))
        word_edges = np.searchsorted(_bucket(distinct, 40, buckets), np.arange(buckets + 1))
        for i in range(buckets):
            part, own = slice(*edges[i : i + 2]), slice(*word_edges[i : i + 2])
            if part.start < part.stop or own.start < own.stop:
                yield i, _pack(_pack_keys(key[part], count[part]), _squeeze(_steps(distinct[own]), *_short(number[own])))

    return ask


def logits(context: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per distinct (context, byte), sorted: the logit of each of its 8 bits, 0 where the context has no counts."""
    key = context << np.uint64(8) | byte
    out = np.zeros((len(key), 8), np.int8)
    for i, (zeros, ones) in enumerate(nodes(key, np.concatenate([[0], np.cumsum(count)]), key)):
        out[:, i] = logit(zeros, ones)
    return out


def logit(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(np.log((ones + PRIOR) / (zeros + PRIOR)) * SCALE), -120, 120)


def nodes(key: np.ndarray, total: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per bit of the last byte of ``wanted``: the counts of zeros and ones after the bits before it, from sorted keys and their running total."""
    order = np.argsort(wanted, kind="stable")  # neighbours look in the same place
    asked, back = wanted[order], np.empty_like(order)
    back[order] = np.arange(len(order))
    start = asked >> np.uint64(8) << np.uint64(8)
    low, high = (total[np.searchsorted(key, x)] for x in (start, start + np.uint64(256)))
    for i in range(8):
        half = np.uint64(1 << (7 - i))
        middle = total[np.searchsorted(key, start + half)]
        yield (middle - low)[back], (high - middle)[back]
        one = (asked & half) != 0  # the next bit lies in the half that this one chooses
        start, low, high = np.where(one, start + half, start), np.where(one, middle, low), np.where(one, high, middle)


def paths(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(9, n), of distinct sorted keys and their counts: how many have the key's context and the first bits of its byte, but the
    other value of the next bit, for each of the 8; last the key's own count."""
    out, below = np.empty((9, len(key)), count.dtype), count
    out[8] = count
    total = _running(count)
    for i, edges in _nodes(key):
        here = np.repeat(np.diff(total[edges]), np.diff(edges))
        np.subtract(here, below, out=out[i])
        below = here
    return out


def _running(count: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, count.dtype), np.cumsum(count, dtype=count.dtype)])


def _nodes(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each bit from the last one: where the runs of sorted keys with the same context and bits before it begin, and the end."""
    # The highest bit in which neighbours differ says up to which prefix they are one.
    differ = np.concatenate([[np.uint64(255)], key[1:] ^ key[:-1]]).clip(max=np.uint64(256)).astype(np.uint16)
    for i in range(7, -1, -1):
        new = differ >= 1 << (8 - i)
        new[:1] = True
        yield i, np.append(np.flatnonzero(new[: len(key)]), len(key))


def _beside(key: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``paths`` of a part of the keys as what their own counts don't tell: for each bit, what there is beside them, at the first key of a run. Mostly 0."""
    out, told, here = np.zeros_like(table), table[8].copy(), table[8]
    out[8] = table[8]
    for i, edges in _nodes(key):
        here, first = here + table[i], edges[:-1]
        out[i, first] = here[first] - np.diff(_running(told)[edges])
        told[first] += out[i, first]
    return out


def _restore(key: np.ndarray, table: np.ndarray) -> None:
    """Turns what ``_beside`` gives into ``paths`` again."""
    told, below = table[8].copy(), table[8]
    for i, edges in _nodes(key):
        told += table[i]
        here = np.repeat(np.diff(_running(told)[edges]), np.diff(edges))
        np.subtract(here, below, out=table[i])
        below = here


def _answer(bodies: list[bytes]) -> list[bytes]:
    """``paths`` of the asked keys, by level and without what they tell of each other, as they compress better so; counts of the words."""
    got = [_unpack(x, "u1", "u1") for x in bodies]
    keys, counts = zip(*(_unpack_keys(g[0]) for g in got), strict=True)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts), len(distinct))
    table = paths(distinct, total.astype(np.int32 if total.sum() < 1 << 31 else np.int64))
    asked = [_unpack(zstandard.decompress(g[1]), "u1", "u1", "i8") for g in got]
    number = np.concatenate([_full(*x[1:]) for x in asked])
    distinct, word_at = np.unique(np.concatenate([_from_steps(x[0]) for x in asked]), return_inverse=True)
    sums = np.bincount(word_at, number, len(distinct)).astype("i8")
    out, a, b = [], 0, 0
    for i, (key, x) in enumerate(zip(keys, asked, strict=True)):
        n, m = len(key), len(x[1])
        totals = np.array([sums.sum(), (sums > 0).sum()] if i == 0 else [0, 0], "i8")  # told once
        out.append(_pack(_squeeze(*_short(_beside(key, table[:, at[a : a + n]]).reshape(-1))), _squeeze(*_short(sums[word_at[b : b + m]])), totals))
        a, b = a + n, b + m
    return out


COUNTED = "first boolean, texts binary, counts binary"
_COUNTED = pa.schema([("first", pa.bool_()), ("texts", pa.binary()), ("counts", pa.binary())])


def _keep(own: bytes, replies: dict[int, bytes]) -> pa.Table:
    bodies = [replies[i] for i in sorted(replies)]
    return pa.table([[own[0] == 1], [own[1:]], [_pack(np.array([len(x) for x in bodies], "i8"), np.frombuffer(b"".join(bodies), "u1"))]], schema=_COUNTED)


def counted(docs: DataFrame, buckets: int, size: int = 0) -> DataFrame:
    """Per block of rows (doc_id, text, held): its texts, and the counts of all that it asks for in the rows that aren't held.

    The documents of one hash in ``FIRST_SHARE`` have blocks of their own, marked as ``first``.
    """
    block = min(BLOCK_BYTES, max(size // 32, 1 << 18))  # several per core of a small input, too
    first = F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_SHARE)) == 0
    # Read by few tasks, so that their blocks are not smaller than others: a key costs the same in a small block.
    few = docs.where(first).coalesce(max(1, -(-size // (FIRST_SHARE * block))))
    dealt = few.withColumn("first", F.lit(True)).unionAll(docs.where(~first).withColumn("first", F.lit(False)))
    return exchange(dealt, _ask(buckets), _answer, _keep, COUNTED, size, "counted", block)


def _kept_blocks(batches: Iterator[pa.RecordBatch], with_words: bool) -> Iterator[tuple[pa.RecordBatch, Block, np.ndarray, list]]:
    """Rows with streams for texts, block, (9, keys) ``paths`` of its keys, and the answers about words."""
    for kept in batches:
        for own, counts in zip(kept.column("texts"), kept.column("counts"), strict=True):
            with pa.ipc.open_stream(zstandard.decompress(own.as_buffer())) as s:
                batch = s.read_all().combine_chunks().to_batches()[0]
            b = Block(batch.column("text").to_pylist(), batch.column("held").to_numpy(zero_copy_only=False), with_words)
            table, word_counts, start = np.empty((9, len(b.key)), np.int64), [], 0
            sizes, bodies = _unpack(counts.as_buffer(), "i8", "u1")
            for body in np.split(bodies, np.cumsum(sizes)[:-1]):
                keys, of_words, totals = _unpack(body, "u1", "u1", "i8")
                level = _full(*_unpack(zstandard.decompress(keys), "u1", "i8")).reshape(9, -1)
                table[:, start : start + level.shape[1]] = level
                start += level.shape[1]
                if with_words:
                    word_counts.append((_full(*_unpack(zstandard.decompress(of_words), "u1", "i8")), totals))
            _restore(b.key, table)
            yield batch, b, table, word_counts


class Mixer:
    """Weights by gate and bit, and the probability map; both are fitted (``fitted``) or learn online."""

    def __init__(self):
        self.weights = np.full((_TOP + 1, 8, _TOP), 0.3)
        centres = (np.arange(CELLS) - CELLS // 2) / 2.0
        self.map = np.tile(1 / (1 + np.exp(-centres)), (_TOP + 1, 8, 1))

    def predict(self, inputs: np.ndarray):
        """``inputs``: (n, orders, 8) logits. Gates, mixed logits, cells of the map, and probabilities of a one."""
        gate = (np.arange(1, _TOP + 1)[None, :, None] * (inputs != 0)).max(1)
        bit = np.arange(8)[None, :]
        z = np.einsum("nob,nbo->nb", inputs, self.weights[gate, bit])
        z = np.clip(z, -8, 8)
        cell = np.rint(2 * z).astype(np.int64) + CELLS // 2
        p = 0.5 / (1 + np.exp(-z)) + 0.5 * self.map[gate, bit, cell]
        return gate, z, cell, np.clip(p, 1e-5, 1 - 1e-5)

    def learn(self, inputs: np.ndarray, bits: np.ndarray, rate: float = 0.02, batch: int = 512) -> None:
        bit = np.broadcast_to(np.arange(8), bits.shape)
        for at in range(0, len(inputs), batch):
            x, y, b = inputs[at : at + batch], bits[at : at + batch], bit[at : at + batch]
            gate, z, cell, _ = self.predict(x)
            error = y - 1 / (1 + np.exp(-z))
            which = (gate * 8 + b).reshape(-1)
            n = np.bincount(which, minlength=(_TOP + 1) * 8)
            step = np.stack([np.bincount(which, (error * x[:, o]).reshape(-1), len(n)) for o in range(_TOP)], 1)
            self.weights += rate * (step / np.sqrt(np.maximum(n, 1))[:, None]).reshape(self.weights.shape)
            place = which * CELLS + cell.reshape(-1)
            size = (_TOP + 1) * 8 * CELLS
            n, ones = np.bincount(place, minlength=size), np.bincount(place, y.reshape(-1), size)
            flat = self.map.reshape(-1)
            flat += (ones - n * flat) / (n + 30.0)

    def cost(self, inputs: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """log10 of the probability of each byte."""
        p = self.predict(inputs)[3]
        return np.log10(np.where(bits == 1, p, 1 - p)).sum(1)


def gates(inputs: np.ndarray) -> np.ndarray:
    """The last order whose input isn't 0, of (orders, n) inputs; 0 if there is none."""
    out = np.zeros(inputs.shape[1], np.int8)
    for i, x in enumerate(inputs):
        out[x != 0] = i + 1
    return out


def gram_costs(mixer: Mixer, levels: np.ndarray, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """``Mixer.cost`` of bytes, from the whole-number logits (8, keys) of the bits that are there against the other value, and the key of each byte by order."""
    chance = np.ones(len(byte))
    for bit in range(8):
        whole = levels[bit][at]
        gate, one = gates(whole), ((byte >> np.uint8(7 - bit)) & np.uint8(1)).astype(np.int64) * CELLS + CELLS // 2
        found = np.bincount(gate, minlength=_TOP + 1)
        p = np.empty(len(byte))
        for g in np.argsort(-found, kind="stable")[: np.count_nonzero(found)]:
            # That of most bytes for all of them, then the others'.
            some = slice(None) if g == found.argmax() else np.flatnonzero(gate == g)
            z = (mixer.weights[g, bit] / SCALE).astype(np.float32) @ whole[:, some].astype(np.float32)
            np.clip(z, -8, 8, out=z)
            # The map's chance of a zero at the cell of the opposite, and of a one.
            there = np.concatenate([1 - mixer.map[g, bit, ::-1], mixer.map[g, bit]]) / 2
            cell = np.rint(z + z).astype(np.int64) + one[some]
            p[some] = there[cell] + np.float32(0.5) / (1 + np.exp(-z))
        chance *= np.clip(p, 1e-5, 1 - 1e-5, out=p)
    return np.log(chance) / np.log(10.0)


def _bits(grams: np.ndarray) -> np.ndarray:
    return (grams[:, None] >> np.arange(7, -1, -1).astype(np.uint64)[None, :]).astype(np.int64) & 1


def scored(blocks: DataFrame, mixer: Mixer) -> DataFrame:
    """``RESULT`` of the rows of ``counted`` blocks."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, counts, answers in _kept_blocks(batches, True):
            levels, same = np.empty((8, len(b.key)), np.int8), counts[8].astype(np.float64)
            for i in range(7, -1, -1):
                levels[i] = logit(counts[i], same)
                same += counts[i]
            cost, byte = np.empty(len(b.grams)), (b.grams >> np.uint64(8 * _TOP)).astype(np.uint8)
            for a in range(0, len(cost), 100_000):
                part = slice(a, a + 100_000)
                cost[part] = gram_costs(mixer, levels, b.at[:, part], byte[part])
            known = np.concatenate([x for x, _ in answers])
            totals = np.sum([x for _, x in answers], axis=0)
            token_starts = np.cumsum(b.tokens) - b.tokens
            c = known[np.unique(b.numbers, return_inverse=True)[1]]
            word_score = np.add.reduceat(np.log10(c + 0.1), token_starts)
            n_known = np.add.reduceat((c > 0).astype(np.int64), token_starts)
            none = pa.nulls(len(b.tokens), pa.int64())
            columns = [batch.column("doc_id"), pa.array(b.held), *map(pa.array, (b.tokens, n_known, word_score, b.summed(cost), b.sizes)), none, none]
            yield pa.RecordBatch.from_arrays(columns, schema=_RESULT)
            if totals.any():
                more = {f.name: [None] for f in _RESULT} | {"n_words_all": [int(totals[0])], "n_distinct": [int(totals[1])]}
                yield pa.RecordBatch.from_pydict(more, schema=_RESULT)

    with small_batches(blocks.sparkSession):
        return staged(blocks.sparkSession, blocks.mapInArrow(score, RESULT), "scores")


def _groups(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes, and the number of the first."""
    first, total = 0, 0
    for i, x in enumerate(texts):
        n = len(x)
        if i > first and total + n > most:
            yield first, texts[first:i]
            first, total = i, 0
        total += n
    yield first, texts[first:]


def _signs(byte: np.ndarray) -> np.ndarray:
    """(n, 8): 1 for the ones of bytes and -1 for their zeros."""
    return np.unpackbits(byte[:, None], axis=1).view(np.int8) * np.int8(2) - np.int8(1)


TUNING = "inputs binary, bytes binary"
_TUNING = pa.schema([("inputs", pa.binary()), ("bytes", pa.binary())])


def tuning_share(size: int) -> int:
    """One in how many bytes of training texts of ``size`` bytes is a tuning byte."""
    return min(TUNING_SHARE, max(1, size // LEAST_TUNING))


def tuning_inputs(docs: DataFrame, share: int, buckets: int, size: int = 0) -> DataFrame:
    """Per some bytes: the inputs (n, orders, 8) of one in ``share`` of the bytes of training documents, and these bytes.

    The counts are those of all training documents but the byte's own row. ``docs`` may be ``counted`` already.
    """
    blocks = docs if "counts" in docs.columns else counted(docs, buckets, size)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, b, counts, _ in _kept_blocks(batches, False):
            inputs, byte, n = _left_inputs(b, counts, share, pc.fill_null(batch.column("doc_id"), 0).to_numpy().astype(np.uint64))
            at = np.repeat(np.arange(len(n)), n)
            for some in np.split(at, range(20_000, len(at), 20_000)):
                signed = np.ascontiguousarray((inputs[:, some] * _signs(byte[some])).transpose(1, 0, 2))
                yield pa.RecordBatch.from_arrays([pa.array([signed.tobytes()], pa.binary()), pa.array([byte[some].tobytes()], pa.binary())], schema=_TUNING)

    with small_batches(blocks.sparkSession):
        return staged(blocks.sparkSession, blocks.mapInArrow(pick, TUNING), "tuning")


def _without_own(counts: list[np.ndarray], own: np.ndarray) -> np.ndarray:
    """(n, 8): the logits of the bits that are there, from ``paths`` of the rows in all documents and in their own."""
    out, prior = np.empty((own.shape[1], 8), np.int8), np.float32(PRIOR)
    same = counts[8] - own[8]
    for i in range(7, -1, -1):
        other = counts[i] - own[i]
        x = np.log((same + prior) / (other + prior))
        x *= np.float32(SCALE)
        out[:, i] = np.clip(np.rint(x, out=x), -120, 120, out=x)
        same += other
    return out


#: The node of a byte's path in which it parts from another one, by their difference: 0 is the highest bit's.
_PARTING = np.array([8, *(8 - x.bit_length() for x in range(1, 257))], np.int64).clip(0)
#: A number for each of the 8 nodes, in a byte each of one number: their ones, their highest bits, and the nodes from ``a`` on and up to ``b``, at ``a``, ``b``.
_ONES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_BETWEEN = np.ascontiguousarray([[[255 * (a <= i <= b) for i in range(8)] for b in range(8)] for a in range(9)], np.uint8).view(np.uint64)[..., 0] & _ONES


def _calm(counts: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``paths`` of keys and the logits without one of their own: how many more a document can take away at a node of a key's path without another logit, of
    the bits that are there and of the others. (2, keys), the 8 nodes in a byte each, up to 126, and 127 where it doesn't matter; and (2, keys), the least of them.
    Rounded down, and a little less where sums are of seven digits only."""
    parts = [_calm_part(counts[:, a : a + (1 << 15)], once[a : a + (1 << 15)]) for a in range(0, max(len(once), 1), 1 << 15)]  # which stay in a cache
    return tuple(np.concatenate(x, axis=1) for x in zip(*parts, strict=True))


def _calm_part(counts: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, least = np.empty((2, len(once), 8), np.uint8), np.full((2, len(once)), 1 << 30, np.float32)
    same = np.maximum(counts[8], 1) - np.float32(1)
    step = np.exp(np.arange(-121, 122) / SCALE - 0.5 / SCALE).astype(np.float32)  # the lowest ratio of each logit
    prior = np.float32(PRIOR)
    for i in range(7, -1, -1):
        other, place = counts[i], once[:, i].astype(np.int64) + 121
        ones, zeros = same + prior, other + prior
        slack = np.float32(2e-3) + np.float32(4e-6) * (same + other)
        low, high = step.take(place) * zeros, ones / step[1:].take(place)
        for row, left, never in ((0, ones - low - slack, (place == 1) | (same == 0)), (1, zeros - high - slack, (place == 241) | (other == 0))):
            np.maximum(left, 0, out=left)
            np.minimum(least[row], np.where(never, np.float32(1 << 30), left), out=least[row])
            out[row, :, i] = np.where(never, np.float32(127), np.minimum(left, np.float32(126), out=left))
        same = same + other
    return out.view(np.uint64)[..., 0], least.astype(np.int32)


def _unsettled(calm: np.ndarray, ends: np.ndarray, key: np.ndarray, at: np.ndarray, run: np.ndarray, first: np.ndarray, size: np.ndarray, total: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Of the places ``at`` of a document's sorted keys, in contexts ``run``, whether what it has there may change a logit, node by node. From the node on in
    which a byte parts from the last other one, only its own are on its path; others are there from the first node on in which any two of the context part."""
    begin = first[run]
    end = begin + size[run] - 1
    here = key[at]
    byte = ends[here]
    spread = _PARTING[ends[key[begin]] ^ ends[key[end]]]
    near = np.minimum(np.where(at == begin, 256, byte ^ ends[key[at - 1]]), np.where(at == end, 256, byte ^ ends[key[np.minimum(at + 1, len(key) - 1)]]))
    near = _PARTING[near]  # the last node in which another byte is beside it; the first one if it is the only byte
    total, number, others = (np.minimum(x, 127).astype(np.uint64) for x in (total - 1, number - 1, total - number))
    own = _BETWEEN[near, 7]
    same = number * own + total * (_ONES ^ own)
    return ((calm[0][here] | _HIGH) - same & (calm[1][here] | _HIGH) - others * _BETWEEN[spread, near] & _HIGH) != _HIGH


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin, of flags at their first places, and their lengths."""
    first = np.flatnonzero(flags)
    return first, _lengths(first, len(flags))


def _low(values: np.ndarray, bits: int) -> np.ndarray:
    return (values & np.uint64((1 << bits) - 1)).astype(np.int64)


def _in_order(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values of so many bits, and the place of each before."""
    of_place = len(values).bit_length()
    if bits + of_place > 64:
        place = np.argsort(values, kind="stable")
        return values[place], place
    both = values << np.uint64(of_place) | np.arange(len(values), dtype=np.uint64)
    both.sort()  # faster than by place
    return both >> np.uint64(of_place), _low(both, of_place)


class _Contexts:
    """A block's grams and keys by context, the last byte before first, then by byte: what is looked up for neighbours lies together."""

    def __init__(self, b: Block):
        turned = b.grams << np.uint64(8) & np.uint64((1 << 8 * (_TOP + 1)) - 1) | b.grams >> np.uint64(8 * _TOP)
        self.grams, by_gram = _in_order(turned, 8 * (_TOP + 1))
        self.rank = np.empty(len(by_gram), np.uint64)  # of the block's grams
        self.rank[by_gram] = np.arange(len(by_gram), dtype=np.uint64)
        self.at = np.empty((_TOP, len(by_gram)), np.int32)  # the key of each gram
        self.spot = np.empty((_TOP, len(by_gram)), np.uint64)  # its context, and in 8 bits which one of the context's keys it is
        keys, contexts, values, start, contexts_before = [], [], [], 0, 0
        for i, order in enumerate(ORDERS):
            short = b.grams >> np.uint64(8 * (_TOP - order))
            first = _starts(short)
            value = short[first] & np.uint64((1 << 8 * order) - 1)
            value = value << np.uint64(8) | short[first] >> np.uint64(8 * order)
            value, place = _in_order(value, 8 * (order + 1))
            back = np.empty(len(place), np.int64)
            back[place] = np.arange(len(place))
            self.at[i] = np.repeat(back, _lengths(first, len(short)))[by_gram] + start
            begin = _starts(value >> np.uint64(8))
            size = _lengths(begin, len(value))
            spot = np.repeat(np.arange(contexts_before, contexts_before + len(begin)) << 8, size) + np.arange(len(value)) - np.repeat(begin, size)
            self.spot[i] = spot.astype(np.uint64)[self.at[i] - start]
            keys.append(b.at[i][first][place])
            contexts.append(begin + start)
            values.append((value & np.uint64(255)).astype(np.int16))
            start, contexts_before = start + len(value), contexts_before + len(begin)
        self.key = np.concatenate(keys).astype(np.int64)  # which one of the block's keys each is
        self.first = np.concatenate(contexts)  # the first key of each context
        self.ends = np.concatenate(values)  # the byte of each key


def _rows(b: Block, c: _Contexts) -> tuple[np.ndarray, np.ndarray | None, int]:
    """The learned rows of a block, sorted: the context, the document in so many bits and in 8 bits which one of the context's keys it is; below these how often
    it is there, in the last number of bits, or if that doesn't fit, beside them."""
    of_doc, of_n = len(b.sizes).bit_length(), int(b.number.max(initial=0)).bit_length()
    spot = c.spot[_TOP - 1][c.rank.astype(np.int64)]
    if int(c.spot[_TOP - 1].max(initial=0)).bit_length() + of_doc + of_n > 64:
        of_n = 0
    value = np.repeat((spot >> np.uint64(8) << np.uint64(8 + of_doc) | spot & np.uint64(255)) << np.uint64(of_n), _lengths(b.edges, len(b.doc)))
    value |= b.doc.astype(np.uint64) << np.uint64(8 + of_n)
    if of_n:
        value |= b.number.astype(np.uint64)
    learned = ~b.held[b.doc]
    value = value[learned]
    if of_n:
        value.sort()
        return value, None, of_n
    value, place = _in_order(value, 64)
    return value, b.number[learned][place], 0


def _left_inputs(b: Block, counts: np.ndarray, share: int = 1, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all learned bytes of a block: the inputs (orders, n, 8) of the bits that are there against the other value, the byte, and how often this is there;
    of a larger ``share``, of that part of them, by hash. ``counts`` are ``paths`` of the block's keys; those of the byte's own document are left out.

    Where a document has a context once, its own share is the same in all such documents. Mostly a logit is that of this case in the others as well; only where
    what the document has there could change it, it is found from the counts, and the byte told apart from those of other documents.
    """
    c = _Contexts(b)
    rows, beside, of_n = _rows(b, c)
    whole, counts = counts, np.empty(counts.shape, np.float32)
    for level, out in zip(whole, counts, strict=True):
        level.astype(np.float32).take(c.key, out=out, mode="clip")  # one of 2^24 and more to seven digits, far finer than a logit's steps
    del whole
    alone = np.zeros((9, len(b.key)), np.float32)
    alone[8] = 1
    packed = _without_own(np.maximum(counts, alone), alone)
    calm, calmest = _calm(counts, packed)
    once = packed.view(np.uint64)[:, 0]
    del alone, packed
    of_doc = len(b.sizes).bit_length()
    used, told = np.zeros(len(c.grams), np.int64), []
    # All contexts that end with the same byte are seen together.
    lead = np.uint64(of_n + 8 + of_doc)
    last = (c.spot[_TOP - 1] >> np.uint64(8))[_starts(c.grams >> np.uint64(8 * _TOP))]
    starts = np.append(np.searchsorted(rows, last << lead), len(rows))
    cuts = np.unique(starts[np.searchsorted(starts, np.append(np.arange(0, len(rows), 1 << 18), len(rows)))])
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        value = rows[a:z] >> np.uint64(of_n)
        number = beside[a:z] if of_n == 0 else _low(rows[a:z], of_n).astype(np.int32)
        where = value >> np.uint64(8)
        doc = where & np.uint64((1 << of_doc) - 1)
        key = c.first[(where >> np.uint64(of_doc)).astype(np.int64)] + _low(value, 8)  # of each distinct key of a document
        grams = gram = key - (len(c.key) - len(c.grams))  # each is a key of the last order
        weight = number
        if share > 1:
            chance = mix(mix(ids)[doc.astype(np.int64)] + c.grams[gram]) % np.uint64(share)
            weight = (number + chance.astype(np.int64)) // share
        low, high = int(gram.min()), int(gram.max()) + 1
        used[low:high] += np.bincount(gram - low, weight, high - low).astype(np.int64)
        back, changed = [], []
        for i in range(_TOP - 1, -1, -1):
            if i < _TOP - 1:
                spot = c.spot[i][gram]
                least = spot.min() >> np.uint64(8)
                value = ((spot >> np.uint64(8)) - least << np.uint64(of_doc) | doc) << np.uint64(8) | spot & np.uint64(255)
                value, place = _in_order(value, int(value.max()).bit_length())
                first = _starts(value)
                back.append((place, first, _lengths(first, len(value))))
                number, gram, value = np.add.reduceat(number[place], first), gram[place[first]], value[first]
                where = value >> np.uint64(8)
                doc = where & np.uint64((1 << of_doc) - 1)
                key = c.first[((where >> np.uint64(of_doc)) + least).astype(np.int64)] + _low(value, 8)
            new = np.ones(len(key), bool)
            np.not_equal(where[1:], where[:-1], out=new[1:])
            run, size = _runs(new)
            which = np.cumsum(new, dtype=np.int32) - 1
            total = np.add.reduceat(number, run)[which]
            some = np.flatnonzero((total - 1 > calmest[0][key]) | (total - number > calmest[1][key]))
            some = some[_unsettled(calm, c.ends, key, some, which[some], run, size, total[some], number[some])]
            if not len(some):
                continue
            # All bytes of a context are needed to know its bits.
            those = which[some][_starts(which[some])]
            own_size = size[those]
            every = np.repeat(run[those] - np.cumsum(own_size) + own_size, own_size) + np.arange(own_size.sum())
            own = paths(which[every].astype(np.uint64) << np.uint64(8) | c.ends[key[every]].astype(np.uint64), number[every])
            own = own[:, np.searchsorted(every, some)]
            there = key[some]
            logits = _without_own([x[there] for x in counts], own.astype(np.float32)).view(np.uint64)[:, 0]
            other = np.flatnonzero(logits != once[there])
            at, logits = some[other], logits[other]
            for place, first, size in reversed(back):  # the keys of the next order, and at last the rows, that these are of
                size = size[at]
                at = place[np.repeat(first[at] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                logits = np.repeat(logits, size)
            changed.append((i, at, logits))
        if changed:
            mark = np.zeros(z - a, bool)
            for _, at, _ in changed:
                mark[at] = True
            mark &= weight > 0
            place, mark_at = np.cumsum(mark) - 1, np.flatnonzero(mark)
            gram, weight = grams[mark_at], weight[mark_at].astype(np.int64)
            inputs = once[c.at[:, gram]]
            for i, at, logits in changed:
                there = mark[at]
                inputs[i, place[at[there]]] = logits[there]
            told.append((inputs, gram, weight))
            used[low:high] -= np.bincount(gram - low, weight, high - low).astype(np.int64)
    del rows, beside
    some = np.flatnonzero(used)
    told.append((once[c.at[:, some]], some, used[some]))
    inputs, gram, number = (np.concatenate(x, axis=-1) for x in zip(*told, strict=True))
    return np.ascontiguousarray(inputs).view(np.int8).reshape(_TOP, -1, 8), (c.grams[gram] & np.uint64(255)).astype(np.uint8), number


def _merged(inputs: list[np.ndarray], ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a bit and its inputs by order, a byte each from the lowest on, and how often each is there. A few times fewer are left."""
    row = ones.astype(np.uint64)
    for x in reversed(inputs):
        row <<= np.uint64(8)
        row |= x.view(np.uint8)
    free = 63 - 8 * _TOP
    if int(count.max()).bit_length() > free:
        row, at = np.unique(row, return_inverse=True)
        return row, np.bincount(at, count, len(row)).astype(np.float32)
    row = np.sort(row << np.uint64(free) | count.astype(np.uint64))  # faster than by place
    number = (row & np.uint64((1 << free) - 1)).astype(np.int64)
    row >>= np.uint64(free)
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return row[starts], np.add.reduceat(number, starts).astype(np.float32)


def weighed_sums(mixer: Mixer, inputs: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``slopes`` and ``hits`` of whole-number inputs (orders, n, 8), of the bits that are there, and bytes that are there ``count`` times."""
    sums = np.zeros((_TOP + 1, 8, 1 + _TOP + _TOP * _TOP))
    cells = np.zeros((2, _TOP + 1, 8, CELLS))
    bits = np.unpackbits(byte[:, None], axis=1)
    for bit in range(8):
        rows, number = _merged([x[:, bit] for x in inputs], bits[:, bit], count)
        whole = np.stack([(rows >> np.uint64(8 * i)).astype(np.uint8).view(np.int8) for i in range(_TOP)])
        ones = rows >> np.uint64(8 * _TOP) == 1
        gate = gates(whole)
        for g in np.flatnonzero(np.bincount(gate)):
            part = np.flatnonzero(gate == g)
            weights, out = mixer.weights[g, bit].astype(np.float32), sums[g, bit]
            for at in range(0, len(part), 20_000):
                few = part[at : at + 20_000]
                x, y, n = whole[:, few] / np.float32(SCALE), ones[few], number[few]
                z = weights @ x
                e = np.exp(-np.abs(z))
                missed = np.where(z >= 0, e, np.float32(1)) / (1 + e)
                out[0] += (n * (np.maximum(-z, 0) + np.log1p(e))).sum(dtype=np.float64)
                weight = n * missed
                out[1 : 1 + _TOP] -= x @ weight
                weight *= 1 - missed
                out[1 + _TOP :] += ((x * weight) @ x.T).reshape(-1)
                cell = np.rint(2 * np.clip(z, -8, 8)).astype(np.int64)
                cell = np.where(y, cell + CELLS, -cell) + CELLS // 2
                hit = np.bincount(cell, n, 2 * CELLS).reshape(2, CELLS)
                cells[0, g, bit] += hit.sum(0)
                cells[1, g, bit] += hit[1]
    return np.concatenate([sums.reshape(-1), cells.reshape(-1)])


_GATES = (_TOP + 1) * 8
_SLOPES = _GATES * (1 + _TOP + _TOP * _TOP)
_SUMS = _SLOPES + 2 * _GATES * CELLS


def _block_sums(blocks: DataFrame, mixer: Mixer) -> np.ndarray:
    """``slopes`` and ``hits`` of a mixer over all learned bytes of ``counted`` blocks, each without its own row's counts, in whole numbers of 1/FINE."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SUMS, np.int64)
        for _, b, counts, _ in _kept_blocks(batches, False):
            inputs, byte, n = _left_inputs(b, counts)
            del b, counts
            if len(n):
                total += np.rint(weighed_sums(mixer, inputs, byte, n) * FINE).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SUMS)), pa.array(total)], names=["i", "v"])

    with small_batches(blocks.sparkSession):
        return _added(blocks.mapInArrow(add, "i long, v long"))


def whole_sums(learned: DataFrame, mixer: Mixer, buckets: int, size: int = 0) -> np.ndarray:
    """``slopes`` and ``hits`` of a mixer, summed over all bytes of the rows ``learned`` (doc_id, text, held) that aren't held, each without its own row's
    counts; of rows that are ``counted`` already, their blocks."""
    return _block_sums(learned if "counts" in learned.columns else counted(learned, buckets, size), mixer)


def refitted(mixer: Mixer, sums: Callable[[Mixer], np.ndarray]) -> Mixer:
    """Newton steps from the weights of ``mixer`` by sums over all training bytes, and the map by their hits.

    The map's hits are counted with the weights before the last step, which is a small one.
    """
    first, out = Mixer(), Mixer()
    out.weights = mixer.weights
    for _ in range(PASSES):
        got = sums(out)
        by_gate = got[:_SLOPES].reshape(_GATES, -1)
        weights = out.weights.reshape(_GATES, _TOP)
        slope = by_gate[:, 1 : 1 + _TOP] + RIDGE * (weights - first.weights.reshape(_GATES, _TOP))
        curve = by_gate[:, 1 + _TOP :].reshape(_GATES, _TOP, _TOP) + RIDGE * np.eye(_TOP)
        step = -np.linalg.solve(curve, slope[..., None])[..., 0]
        gain = -(slope * step).sum() / 2
        step *= 0.5 / np.maximum(np.abs(step).max(1, keepdims=True), 0.5)  # a few rare bits may lead far
        after = Mixer()
        after.weights = (weights + step).reshape(out.weights.shape)
        number, ones = got[_SLOPES:].reshape(2, *first.map.shape)
        after.map = (ones + 30.0 * first.map) / (number + 30.0)
        out = after
        if gain <= ENOUGH * by_gate[:, 0].sum():
            break
    return out


def _tuning_sums(tuning: DataFrame, mixer: Mixer) -> np.ndarray:
    """``slopes`` and ``hits`` of a mixer over all tuning bytes, in whole numbers of 1/FINE, so that no order of rows matters."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SUMS, np.int64)
        for batch in batches:
            byte = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x.as_buffer(), "u1") for x in batch.column("bytes"))])
            if not len(byte):
                continue
            inputs = np.concatenate([np.frombuffer(x.as_buffer(), "i1").reshape(-1, _TOP, 8) for x in batch.column("inputs")])
            there = inputs.transpose(1, 0, 2) * _signs(byte)
            total += np.rint(weighed_sums(mixer, there, byte, np.ones(len(byte), np.int64)) * FINE).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SUMS)), pa.array(total)], names=["i", "v"])

    return _added(tuning.mapInArrow(add, "i long, v long"))


def _added(sums: DataFrame) -> np.ndarray:
    out = np.zeros(_SUMS)
    for r in sums.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v / FINE
    return out


def slopes(weights: np.ndarray, inputs: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """By gate and bit, summed: the loss, its gradient and its second derivatives by the weights of the orders."""
    gate = (np.arange(1, _TOP + 1)[None, :, None] * (inputs != 0)).max(1)
    bit = np.broadcast_to(np.arange(8), gate.shape)
    z = np.einsum("nob,nbo->nb", inputs, weights[gate, bit])
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss, error, curve = np.logaddexp(0, z) - bits * z, p - bits, p * (1 - p)
    which, n = (gate * 8 + bit).reshape(-1), (_TOP + 1) * 8
    add = lambda x: np.bincount(which, x.reshape(-1), n)
    sums = [add(loss), *(add(error * inputs[:, i]) for i in range(_TOP))]
    sums += [add(curve * inputs[:, i] * inputs[:, j]) for i in range(_TOP) for j in range(_TOP)]
    return np.stack(sums, 1).reshape(-1)


def hits(mixer: Mixer, inputs: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """By gate, bit and cell of the map: the number of bits, and of ones among them."""
    gate, _, cell, _ = mixer.predict(inputs)
    place = ((gate * 8 + np.arange(8)) * CELLS + cell).reshape(-1)
    size = (_TOP + 1) * 8 * CELLS
    return np.concatenate([np.bincount(place, minlength=size), np.bincount(place, bits.reshape(-1), size)])


def fitted(tuning: DataFrame, enough: float = 0.0) -> Mixer:
    """Newton steps from the first weights, with a ridge around them; a step that raises a gate and bit's loss is halved instead. The step that would gain less
    than the part ``enough`` of the loss is not made: more bytes tell better where to go on."""
    mixer, n = Mixer(), (_TOP + 1) * 8
    first = mixer.weights.reshape(n, _TOP)
    best, step, least = first, np.zeros_like(first), np.full(n, np.inf)
    for _ in range(PASSES):
        tried = (best + step).reshape(mixer.weights.shape)
        at = Mixer()
        at.weights = tried
        got = _tuning_sums(tuning, at)[:_SLOPES].reshape(n, -1)
        tried = tried.reshape(n, _TOP)
        loss = got[:, 0] + RIDGE / 2 * ((tried - first) ** 2).sum(1)
        slope = got[:, 1 : 1 + _TOP] + RIDGE * (tried - first)
        curve = got[:, 1 + _TOP :].reshape(n, _TOP, _TOP) + RIDGE * np.eye(_TOP)
        newton = -np.linalg.solve(curve, slope[..., None])[..., 0]
        better = loss <= least
        best, step, least = np.where(better[:, None], tried, best), np.where(better[:, None], newton, step / 2), np.where(better, loss, least)
        if np.abs(step).max() < 1e-3 or -(slope * newton).sum() / 2 < enough * loss.sum():
            break
    mixer.weights = best.reshape(mixer.weights.shape)
    number, ones = _tuning_sums(tuning, mixer)[_SLOPES:].reshape(2, *mixer.map.shape)
    mixer.map = (ones + 30.0 * mixer.map) / (number + 30.0)
    return mixer


def mixed_scores(docs: DataFrame, divisor: int = 10, held: int = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per row of ``docs`` (doc_id, text).

    crc32(doc_id as text) mod ``divisor`` says what a row is used for: ``held`` rows teach nothing, all others are counted and
    fit the mixer. A null id is held out; a null text is empty: one token, its end.
    ``base_score`` is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))); ``score`` is the mixed model's log10
    probability of the text. Equal rows are all counted and scored; other columns are ignored.
    ``docs`` is a scan of files or a written table (see ``exchange``).
    """
    part = remainder(divisor)
    docs = docs.select(F.col("doc_id").cast("long"), "text", (part.isNull() | (part == held)).alias("held"))
    n = F.octet_length("text").cast("long")
    size, learned = (x or 0 for x in docs.agg(F.sum(n), F.sum(F.when(~F.col("held"), n))).first())
    buckets = bucket_count(docs, size)
    share = tuning_share(learned)
    with setting(docs.sparkSession, "spark.sql.shuffleDependency.fileCleanup.enabled", "true"):  # one exchange after the other
        blocks = counted(docs, buckets, size)
        if share > FIRST_SHARE:
            mixer = fitted(tuning_inputs(blocks.where("first"), share // FIRST_SHARE, buckets, size), ENOUGH)
        else:
            mixer = fitted(tuning_inputs(blocks, share, buckets, size), ENOUGH if share > 1 else 0.0)
        if share > FIRST_SHARE:
            mixer = refitted(mixer, lambda m: _block_sums(blocks.where("first"), m))
        if share > 1:
            mixer = refitted(mixer, lambda m: whole_sums(blocks, m, buckets, size))
        out = scored(blocks, mixer)
    totals = out.agg(F.coalesce(F.sum("n_words_all"), F.lit(0)).alias("train_tokens"), F.coalesce(F.sum("n_distinct"), F.lit(0)).alias("v"))
    base = F.col("word_score") - F.col("n_tokens") * F.log10(F.col("train_tokens") + 0.1 * (F.col("v") + 1))
    bpb = -F.col("score") / F.log10(F.lit(2.0)) / F.col("stream_bytes")
    rows = out.where("n_words_all is null").crossJoin(F.broadcast(totals))  # one row
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score", bpb.alias("bits_per_byte"))
