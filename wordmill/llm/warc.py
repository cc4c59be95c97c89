"""WARC: write archives, normalise whole-file gzip streams to a member per record, read back by offset.

A writer task streams its pages into archives that are one gzip stream each.
The normaliser inflates such a stream once, rewrites every record as a gzip
member of its own and writes a sidecar index of offsets; records whose payload
has an earlier copy become revisits.  A reader then seeks single records.
Archives live in the shared folder, under names that are new for each attempt
of a task, so a retried or doubled task cannot damage what another reads.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm.common import settle, shared_folder

# Payload bytes or records after which a writer begins another archive, and bytes moved at a time.
ARCHIVE_BYTES, ARCHIVE_RECORDS, CHUNK = 64_000_000, 50_000, 1 << 20
LEVEL = 6  # of gzip
# Record versions and header names of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = "urn:wordmill:record:"

RECORD_SCHEMA = "archive string, ordinal bigint, page_id bigint, payload_bytes bigint, payload_digest string"
INDEX_SCHEMA = "archive string, ordinal bigint, offset bigint, length bigint, type string"
READ_SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
               "refers_to bigint, payload binary")


def open_fs(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address such as ``file:/x``, ``hdfs://host/x`` or ``s3://bucket/x``."""
    scheme, colon, rest = address.partition(":")
    if colon and not rest.startswith("//"):
        address = f"{scheme}://{rest}"
    return fs.FileSystem.from_uri(address)


def record_name(archive: str, ordinal: int) -> str:
    return f"{RECORD_ID}{archive.rpartition('/')[2]}:{ordinal}"


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record(kind: str, record_id: str, url: str, digest: str, block: bytes, extra: tuple[tuple[str, str], ...] = ()) -> bytes:
    """One uncompressed WARC record."""
    fields = (("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
              ("WARC-Payload-Digest", "sha256:" + digest), *extra, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))))
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Split an inflated stream into (header fields, block) records; one record is held at a time."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        at = 0
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(buffer) - 3)
            if not fill(len(buffer) + 1):
                if buffer.strip():
                    raise ValueError("WARC stream ends inside a record header")
                return
        version, *lines = buffer[:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("WARC stream ends inside a record")
        block = bytes(buffer[end + 4:end + 4 + size])
        del buffer[:end + 8 + size]
        yield fields, block


def inflate(source, size: int = CHUNK) -> Iterator[bytes]:
    """Inflate a gzip file chunk by chunk: one stream over the whole file, or members one after another."""
    inflater = zlib.decompressobj(31)
    while data := source.read(size):
        while data:
            out = inflater.decompress(data, size)
            if out:
                yield out
            data = inflater.unconsumed_tail
            if inflater.eof:
                data = inflater.unused_data
                inflater = zlib.decompressobj(31)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a response record per row into archives that are one gzip stream each; returns ``RECORD_SCHEMA`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = deflater = None
        archive, rows, written = "", [], 0

        def close():
            sink.write(deflater.flush())
            sink.close()

        for b in batches:
            for page_id, url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                if sink is None:
                    archive = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    files, path = open_fs(folder)
                    files.create_dir(path, recursive=True)
                    sink = files.open_output_stream(f"{path}/{archive.rpartition('/')[2]}", compression=None)
                    deflater, rows, written = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), [], 0
                digest = hashlib.sha256(payload).hexdigest()
                name = record_name(archive, len(rows))
                sink.write(deflater.compress(record("response", name, url or "", digest, http_head(len(payload)) + payload,
                                                    (("X-Page-ID", str(page_id)),))))
                rows.append((archive, len(rows), page_id, len(payload), digest))
                written += len(payload)
                if written >= archive_bytes or len(rows) >= ARCHIVE_RECORDS:
                    close()
                    sink = None
                    yield batch(rows, RECORD_SCHEMA)
        if sink is not None:
            close()
            yield batch(rows, RECORD_SCHEMA)

    rows = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string").cast("binary"))
    return rows.mapInArrow(run, RECORD_SCHEMA)


TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], TYPES[t]) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def revisits(records: DataFrame, least_bytes: int = 100) -> DataFrame:
    """``(archive, ordinal, refers_to, response)`` of the records that revisit the smallest page_id of their payload.

    ``response`` is the record that holds it, as a struct (archive, ordinal).
    """
    copies = records.where(F.col("payload_bytes") >= least_bytes)
    here = F.struct("page_id", "archive", "ordinal")
    first = copies.groupBy("payload_digest").agg(F.min(F.when(F.col("page_id").isNotNull(), here)).alias("first"))
    return (copies.join(first, "payload_digest").where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id")))
            .select("archive", "ordinal", F.col("first.page_id").alias("refers_to"), F.struct("first.archive", "first.ordinal").alias("response")))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives ``(archive, revisits)`` to one gzip member per record; returns ``INDEX_SCHEMA`` rows.

    ``revisits`` lists structs (ordinal, refers_to, response) of records to
    rewrite without their payload; their WARC-Refers-To names the response's
    record, X-Refers-To-Page its page_id.  The same rows are written beside each new archive
    as ``<archive>.idx``, one JSON object per line.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield batch(rewrite(source, {r["ordinal"]: r for r in found or ()}), INDEX_SCHEMA)

    def rewrite(source: str, refers: dict[int, dict]) -> list[tuple]:
        files, path = open_fs(source)
        out_files, out_path = open_fs(folder)
        out_files.create_dir(out_path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        rows, offset = [], 0
        with files.open_input_stream(path, compression=None) as f, out_files.open_output_stream(f"{out_path}/{name}", compression=None) as out:
            for ordinal, (fields, block) in enumerate(records_of(inflate(f))):
                kind, extra = fields["warc-type"], tuple(("X-Page-ID", fields["x-page-id"]) for _ in range("x-page-id" in fields))
                if ordinal in refers:
                    kind = "revisit"
                    block = block[:block.index(b"\r\n\r\n") + 4]
                    extra += (("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_name(**refers[ordinal]['response'])}>"),
                              ("X-Refers-To-Page", str(refers[ordinal]["refers_to"])))
                raw = record(kind, fields["warc-record-id"].strip("<>"), fields["warc-target-uri"], fields["warc-payload-digest"].removeprefix("sha256:"), block, extra)
                deflater = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = deflater.compress(raw) + deflater.flush()
                out.write(member)
                rows.append((f"{folder}/{name}", ordinal, offset, len(member), kind))
                offset += len(member)
        with out_files.open_output_stream(f"{out_path}/{name}.idx", compression=None) as out:
            names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")][1:]
            out.write("".join(json.dumps(dict(zip(names, r[1:]))) + "\n" for r in rows).encode())
        return rows

    return archives.mapInArrow(run, INDEX_SCHEMA)


def read_records(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """Read the records ``wanted(archive, spots)`` back, spots being (offset, length) structs; returns ``READ_SCHEMA`` rows.

    Each record is sought, inflated alone and checked: a response's payload
    must have the digest and length that its header names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, spots in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                files, path = open_fs(archive)
                with files.open_input_file(path) as f:
                    for at in range(0, len(spots), 256):
                        yield batch([read(f, s["offset"], s["length"]) for s in spots[at:at + 256]], READ_SCHEMA)

    def read(f, offset: int, length: int) -> tuple:
        f.seek(offset)
        [(fields, block)] = records_of(iter([zlib.decompress(f.read(length), 31)]))
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
        page = fields.get("x-page-id", "None")
        refers = int(fields["x-refers-to-page"]) if revisit else None
        return (None if page == "None" else int(page), fields["warc-target-uri"], size, digest, fields["warc-type"], refers,
                None if revisit else payload)

    return wanted.mapInArrow(run, READ_SCHEMA)


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of a folder as ``(archive, offset, length, type)``, read by Spark."""
    lines = spark.read.schema("ordinal bigint, offset bigint, length bigint, type string").json(f"{folder}/*.idx")
    return lines.select(F.regexp_replace(F.input_file_name(), r"\.idx$", "").alias("archive"), "ordinal", "offset", "length", "type")


def warc_round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 100, id_col: str = "page_id",
                    url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive every row of ``pages``, normalise the archives and read all records back (``READ_SCHEMA``).

    A null html is an empty payload, a null url an empty target.  Of equal
    payloads of at least ``least_bytes`` bytes the smallest page_id holds the
    response; a row repeated with that page_id is a response too, and rows
    without a page_id revisit it, or are responses if no copy has one.  An
    empty table gives no archive and an empty result.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    records = settle(write_archives(pages, folder + "/streams", id_col, url_col, html_col, archive_bytes))
    found = revisits(records, least_bytes).groupBy("archive").agg(F.collect_list(F.struct("ordinal", "refers_to", "response")).alias("revisits"))
    archives = records.select("archive").distinct().join(found, "archive", "left")
    tasks = max(1, records.select("archive").distinct().count())  # a number, so that one archive's few rows are one task
    index = settle(normalise(archives.repartition(tasks), folder + "/records"))
    wanted = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("spots"))
    return read_records(spark, wanted.repartition(tasks))
