"""WARC archives compressed with Zstandard and a dictionary of their own.

An archive starts with a skippable frame that holds the dictionary; then each record is one frame. Archives travel as
rows ``(archive, content)`` so that any store Spark can write to holds them; :func:`save_archives` writes them as
``.warc.zst`` files, and :func:`read_archives` also takes what Spark's ``binaryFile`` source reads of such.

Edge cases: a null payload is an empty one; a null id is written as ``null`` and comes back as null; a null address is
written as the record's own id; control characters in an address are percent-encoded; an archive without any payload
bytes has a dictionary frame of length 0; a payload of any length is one record, in an archive that ends with it; an empty table makes no archives; rows that repeat make records that repeat.
A frame, header, length or digest that doesn't hold raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, materialize

#: Fixed values of the format: skippable dictionary frame, Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
ARCHIVE_BYTES = 16 << 20  # payload bytes after which the writer begins the next archive
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20  # the dictionary is fitted on so many bytes of an archive's first payloads
MIN_REVISIT_BYTES = 100

ARCHIVES = "archive string, content binary"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Payload, digest and record type of each page: of equal payloads of at least ``min_bytes``, the one with the
    smallest id is a response (every row that has that id) and the others revisit it; smaller ones are responses."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    first = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = materialize(first, "warc-repeats")
    # Payloads that very many pages have are broadcast (HOT at most); their pages are spread by id instead of by digest.
    hot = F.col("n") > max(1024, pages.count() // HOT)
    heavy = F.broadcast(first.filter(hot).select(F.col("digest").alias("hot_digest"), F.col("first").alias("hot_first")))
    joined = rows.join(heavy, F.col("payload_digest") == F.col("hot_digest"), "left")
    key = F.when(F.col("hot_digest").isNull(), F.col("payload_digest")).otherwise(F.concat_ws(" ", "payload_digest", "page_id"))
    joined = joined.withColumn("key", key).join(first.filter(~hot).select("digest", "first"), F.col("key") == F.col("digest"), "left")
    joined = joined.withColumn("first", F.coalesce("first", "hot_first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def _name(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    if not (name.startswith("<urn:page:") and name.endswith(">")):
        raise ValueError(f"not a page's record id: {name!r}")
    return None if (x := name[10:-1]) == "null" else int(x)


def _record(row: dict) -> bytes:
    size, name = row["payload_bytes"], _name(row["page_id"])
    url = name[1:-1] if row["url"] is None else "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in row["url"])
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % size + (row["payload"] or b"")
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {name}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}"]
    if row["record_type"] == "revisit":
        head += [f"WARC-Refers-To: {_name(row['refers_to'])}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fit_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary fitted on the first SAMPLE_BYTES of payloads; where they are too few to fit one, their own bytes."""
    samples, left = [], SAMPLE_BYTES
    for x in payloads:
        if left <= 0:
            break
        if x:
            samples.append(x[:left][: 64 << 10])
            left -= len(samples[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def write_archive(rows: list[dict]) -> bytes:
    data = fit_dictionary([r["payload"] for r in rows if r["payload"]])
    pack = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(data), write_checksum=True, write_content_size=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data + b"".join(pack.compress(_record(r)) for r in rows)


def frames(content: bytes) -> Iterator[bytes]:
    """The records of an archive, each from a frame of its own."""
    view, at, dictionary = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", view, 4)[0]
        if len(view) < 8 + size:
            raise ValueError("the dictionary frame is cut off")
        data, at = bytes(view[8 : 8 + size]), 8 + size
        if data[:4] == struct.pack("<I", FRAME_MAGIC):
            data = zstandard.ZstdDecompressor().decompress(data, max_output_size=64 << 20)
        dictionary = _dictionary(data)
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        if len(view) - at < 5 or struct.unpack_from("<I", view, at)[0] != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        size, one, parts, step = zstandard.frame_content_size(bytes(view[at : at + 18])), unpack.decompressobj(), [], 1 << 14
        while not one.eof:
            if at >= len(view):
                raise ValueError("the last frame is cut off")
            fed = bytes(view[at : at + step])
            parts.append(one.decompress(fed))
            at += len(fed) - len(one.unused_data)
            step = min(step * 2, 1 << 20)
        record = b"".join(parts)
        if size >= 0 and size != len(record):
            raise ValueError(f"a frame holds {len(record)} bytes and declares {size}")
        yield record


def parse_record(record: bytes) -> dict:
    head, gap, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not gap or not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"a header without a colon: {line!r}")
        fields[key.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - fields.keys()
    if missing:
        raise ValueError(f"headers are missing: {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, its header says {size}")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    declared = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind not in ("response", "revisit") or not gap or len(declared) != 1:
        raise ValueError(f"a {kind} record with {len(declared)} payload lengths")
    if kind == "response" and (declared[0] != len(payload) or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload's length or digest doesn't match its header")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit record with a payload or without a reference")
    return {"page_id": _id(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None, "payload_bytes": declared[0], "payload_digest": digest, "record_type": kind, "refers_to": _id(fields["warc-refers-to"]) if kind == "revisit" else None}


def _write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0

    def archive() -> pa.RecordBatch:
        content = write_archive(rows)
        return pa.RecordBatch.from_pydict({"archive": [hashlib.sha256(content).hexdigest()[:32] + ".warc.zst"], "content": pa.array([content], pa.binary())})

    for batch in batches:
        for row in batch.to_pylist():
            rows.append(row)
            size += len(row["payload"] or b"") + 512
            if size >= ARCHIVE_BYTES:
                yield archive()
                rows, size = [], 0
    if rows:
        yield archive()


def _read(fields: tuple[str, ...], schema: pa.Schema):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found: list[dict] = []
                for record in frames(content.as_py()):
                    row = parse_record(record)
                    found.append({k: row[k] for k in fields})
                    if len(found) >= 2000:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
                yield pa.RecordBatch.from_pylist(found, schema)

    return read


_TYPES = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Archives ``(archive, content)`` of all pages; an archive is named by its content."""
    return with_revisits(pages, min_bytes).mapInArrow(_write, ARCHIVES)


def _save(folder: str):
    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = f"{base}/.{name}.{uuid.uuid4().hex}"  # no file is seen before it is whole; a task that runs again writes the same
                with store.open_output_stream(part) as out:
                    out.write(content.as_buffer())
                store.move(part, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"archive": batch.column(0), "bytes": pc.binary_length(batch.column(1)).cast(pa.int64())})

    return save


def save_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as a file below ``folder``, an address that all executors reach; ``archive, bytes`` of each."""
    return archives.select("archive", "content").mapInArrow(_save(folder), "archive string, bytes long")


def open_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The archives among the files of ``folder``, as rows for :func:`read_archives`."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(F.col("path").alias("archive"), "content")


def read_archives(archives: DataFrame, fields: tuple[str, ...] = tuple(_TYPES)) -> DataFrame:
    """The records of archives: of a ``content`` column with one whole archive a row."""
    kinds = dict(x.split(" ") for x in RECORDS.split(", "))
    return archives.select("content").mapInArrow(_read(fields, pa.schema([(k, _TYPES[k]) for k in fields])), ", ".join(f"{k} {kinds[k]}" for k in fields))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into archives in the shared folder, then read the archives back."""
    stored = materialize(write_archives(pages), "warc")
    return read_archives(stored, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
m AS (SELECT payload_digest AS d, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM q LEFT JOIN m ON payload_digest = d
"""
