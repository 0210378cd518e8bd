"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Each record is a gzip member of its own. The reader decompresses chunk by chunk, takes the header up to
its empty line, then exactly Content-Length bytes, then the closing line ends, and checks the digests of
block and payload on the way. Archives are opened with ``pyarrow.fs``, which takes local paths and URIs
of remote stores, and lie in the shared folder; a task writes under a name of its own and only
the archives of tasks that succeeded are in the list of archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velogrid.session import staged, work_path

#: A new archive starts once this many bytes are written.
ARCHIVE_BYTES = 64 << 20
#: Payloads of at least this many bytes are stored once.
LEAST = 1000
CHUNK = 1 << 20

RECORDS = "archive string, record_type string, record_id string, refers_to string, target string, content_type string, block_bytes long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, date: str, block: bytes, content_type: str, **more: str) -> bytes:
    """One record as a gzip member."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "Content-Type": content_type, "Content-Length": str(len(block)), "WARC-Block-Digest": _sha1(block)}
    head |= {k.replace("_", "-"): v for k, v in more.items()}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A response, or a revisit: the same without the payload, which ``refers_to`` holds."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    target = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m.group()):02X}", url or record_id)
    more = {"WARC_Target_URI": target, "WARC_Payload_Digest": _sha1(payload)}
    if refers_to is None:
        return record("response", record_id, date, http + payload, "application/http; msgtype=response", **more)
    more |= {"WARC_Refers_To": f"<{refers_to}>", "WARC_Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return record("revisit", record_id, date, http, "application/http; msgtype=response", **more)


def _chunks(source) -> Iterator[bytes]:
    """Decompressed pieces; an empty piece ends each member."""
    unpack, inside = zlib.decompressobj(31), False
    while data := source.read(CHUNK):
        while data:
            inside = True
            if piece := unpack.decompress(data, CHUNK):
                yield piece
            data = unpack.unconsumed_tail
            if unpack.eof:
                data, inside = unpack.unused_data, False
                unpack = zlib.decompressobj(31)
                yield b""
    if inside:
        raise ValueError("the last gzip member is cut short")


def _header(lines: bytes) -> dict[str, str]:
    """Field names in lower case; a line that starts with white space continues the one before."""
    pairs = (line.partition(":") for line in re.sub(r"\r\n[ \t]+", " ", lines.decode("utf-8", "replace")).split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _matches(declared: str | None, digest) -> bool:
    """Base 32 or hex; other algorithms aren't checked."""
    if declared is None or not declared.lower().startswith("sha1:"):
        return True
    value = declared[5:]
    return value.lower() == digest.hexdigest() if len(value) == 40 else value.upper() == base64.b32encode(digest.digest()).decode()


def read_records(source) -> Iterator[dict]:
    """The records of an open file, one after the other; bad framing raises ``ValueError``."""
    pieces = _chunks(source)
    for first in pieces:
        data = first
        while (end := data.find(b"\r\n\r\n")) < 0:
            if not (piece := next(pieces)):
                raise ValueError("a record's header has no end")
            data += piece
        if not data.startswith(b"WARC/"):
            raise ValueError("a gzip member doesn't start with a record")
        head, data = _header(data[:end]), data[end + 4 :]
        length = int(head["content-length"])
        block, got, parts = hashlib.sha1(), 0, []
        while True:
            use = data[: length - got]
            block.update(use)
            parts.append(use)
            got += len(use)
            data = data[len(use) :]
            if got == length:
                break
            if not (data := next(pieces)):
                raise ValueError("a record's block is shorter than its Content-Length")
        while piece := next(pieces):
            data += piece
        if data != b"\r\n\r\n":
            raise ValueError("a record's block is longer than its Content-Length")
        body, size = b"".join(parts), None
        if head.get("content-type", "").startswith("application/http"):
            http, _, body = body.partition(b"\r\n\r\n")
            declared = _header(http).get("content-length")
            size = int(declared) if declared and declared.isdigit() else None
        payload = hashlib.sha1(body)
        declared, kind = head.get("warc-payload-digest"), head.get("warc-type")
        ok = _matches(head.get("warc-block-digest"), block)
        if kind == "revisit":  # the payload is elsewhere; its digest and length are as declared
            value = (declared or "").partition(":")[2]
            digest = base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower() or None
        else:
            ok = ok and _matches(declared, payload) and size in (None, len(body))
            digest, size = payload.hexdigest(), len(body)
        strip = lambda x: x and x.strip("<>")
        yield {
            "record_type": kind, "record_id": strip(head.get("warc-record-id")), "refers_to": strip(head.get("warc-refers-to")), "target": head.get("warc-target-uri"),
            "content_type": head.get("content-type"), "block_bytes": length, "payload_bytes": size, "payload_digest": digest, "digest_ok": ok, "payload": body,
        }


def write_pages(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the archives (archive, n_records).

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least ``LEAST`` bytes the one
    with the largest page_id is the response and the others revisit it; equal page_ids with the same
    payload are all responses, and so is a payload whose page_ids are all null. Other columns are ignored.

    Which rows revisit is found on ids and digests alone: a payload of a third of all rows is one row
    per task before its shuffle. The html itself is not shuffled unless the revisits are many.
    """
    spark = pages.sparkSession
    folder = folder or work_path(spark, "warc")
    body = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long"), "url", body.alias("payload"))
    thin = staged(spark, pages.where(F.length("payload") >= LEAST).select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n")), "digests")
    kept = thin.groupBy("digest", "n").agg(F.max("page_id").alias("kept"), F.count("*").alias("copies")).where("copies > 1 and kept is not null")
    revisits = thin.join(kept, ["digest", "n"]).where("page_id is null or page_id <> kept").select("page_id", "digest", "kept").distinct()
    revisits = staged(spark, revisits, "revisits").withColumnsRenamed({"page_id": "id", "digest": "of"})
    digest = F.when(F.length("payload") >= LEAST, F.sha1("payload"))
    rows = pages.join(revisits, pages.page_id.eqNullSafe(revisits.id) & (digest == revisits.of), "left").select("page_id", "url", "payload", "kept")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        out, name, n, size = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "kept")), strict=True):
                if out is None:
                    name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name.rsplit('/', 1)[1]}", compression=None)
                    out.write(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", date, b"format: WARC File Format 1.1\r\n", "application/warc-fields"))
                i, url, payload, kept = row
                one = page_record(f"urn:x-page:{'' if i is None else i}", url, payload, None if kept is None else f"urn:x-page:{kept}", date)
                out.write(one)
                n, size = n + 1, size + len(one)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((name, n))
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.int64())], names=["archive", "n_records"])

    return staged(spark, rows.mapInArrow(write, "archive string, n_records long"), "archives")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """The archives in a folder, as ``read_warc`` takes them; their contents aren't read here."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(F.col("path").alias("archive"))


def read_warc(files: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the archives in ``files`` (archive: path or URI); see ``RECORDS``.

    ``payload_digest`` is hex SHA-1; of a revisit, digest and length are those that the record declares for the payload it
    refers to. ``digest_ok`` is false if a declared digest or length differs. An empty archive has no
    records; a broken one fails the job. Without ``payloads`` that column is null.
    """
    spark = files.sparkSession
    schema = spark.createDataFrame([], RECORDS).schema
    names = schema.fieldNames()
    kinds = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                store, inner = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
                rows, size = [], 0
                with store.open_input_stream(inner, compression=None) as source:
                    for r in read_records(source):
                        r["archive"] = path
                        if not payloads:
                            r["payload"] = None
                        rows.append(r)
                        size += 200 + len(r["payload"] or b"")
                        if size > 4 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, kinds)

    each = files.select("archive").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return each.mapInArrow(read, schema).select(*names)


def page_ids(records: DataFrame) -> DataFrame:
    """The page records of ``write_pages`` with their ids as numbers."""
    number = lambda c: F.nullif(F.regexp_extract(c, "^urn:x-page:(-?[0-9]+)$", 1), F.lit("")).cast("long")
    kept = records.where(F.col("record_type").isin("response", "revisit"))
    return kept.withColumns({"page_id": number("record_id"), "refers_to": number("refers_to")})
