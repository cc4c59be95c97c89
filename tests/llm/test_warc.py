"""WARC: exact round trip, one gzip member per record, sidecar offsets, revisits."""

import gzip
import hashlib
import io
import zlib

import pytest

from wordmill.llm.common import settle
from wordmill.llm.warc import inflate, normalise, record, records_of, revisits, sidecars, warc_round_trip, write_archives

BIG = "<html>" + "long page é " * 20
ROWS = [(5, "http://a/", BIG), (3, "http://b/", BIG), (9, "http://c/", BIG), (3, "http://b/", BIG), (1, "http://d/", "short"), (2, "http://e/", "short"), (4, None, None),
        (6, "http://f/\r\nX: y é", ""), (None, "http://g/", BIG), (None, "http://h/", BIG + "only without id"), (7, "http://i/", "x" * 100), (8, "http://j/", "x" * 100),
        (10, "http://k/", "y" * 99), (11, "http://l/", "y" * 99), (12, "http://m/", "WARC/1.1\r\n\r\n" * 50), (13, "http://n/", "z\u2028" * 300_000)]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, payload string")


def slow(rows):
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and raw in first and first[raw] != i
        out.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", str(first[raw] if revisit else None)))
    return sorted(out)


@pytest.mark.parametrize("archive_bytes", [64_000_000, 300])
def test_round_trip(spark, archive_bytes):
    got = warc_round_trip(pages_of(spark, ROWS).repartition(3), archive_bytes=archive_bytes).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == slow(ROWS)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc_round_trip(pages_of(spark, [])).count() == 0


def test_normaliser_members_and_index(spark, tmp_path):
    records = settle(write_archives(pages_of(spark, ROWS).coalesce(1), f"file:{tmp_path}/streams"))
    [source] = [r[0] for r in records.select("archive").distinct().collect()]
    whole = open(source.removeprefix("file:"), "rb").read()
    one = zlib.decompressobj(31)
    assert len(list(records_of(iter([one.decompress(whole)])))) == len(ROWS) and one.eof and not one.unused_data
    found = revisits(records).groupBy("archive").agg({"ordinal": "count"}).select("archive")
    assert found.count() == 1
    spots = spark.createDataFrame([(source, [])], "archive string, revisits array<struct<ordinal: bigint, refers_to: bigint, response: struct<archive: string, ordinal: bigint>>>")
    index = settle(normalise(spots, f"file:{tmp_path}/records")).orderBy("ordinal").collect()
    raw = open(index[0].archive.removeprefix("file:"), "rb").read()
    assert [r.offset for r in index] == [sum(x.length for x in index[:i]) for i in range(len(index))]
    for r in index:
        [(fields, block)] = records_of(iter([gzip.decompress(raw[r.offset:r.offset + r.length])]))
        assert fields["warc-type"] == "response"
    assert list(records_of(inflate(io.BytesIO(raw), 100))) == list(records_of(inflate(io.BytesIO(whole), 1000)))
    beside = sidecars(spark, f"file:{tmp_path}/records").orderBy("ordinal").collect()
    assert [(r.offset, r.length) for r in beside] == [(r.offset, r.length) for r in index]


def test_damaged_streams_are_refused():
    good = record("response", "urn:x", "http://a/", "0", b"HTTP/1.1 200 OK\r\n\r\nbody")
    assert len(list(records_of(iter([good[:30], good[30:], good])))) == 2
    for bad in (good[:-20], good[:25], b"HTTP/1.1 200\r\n\r\n" + good):
        with pytest.raises(ValueError):
            list(records_of(iter([bad])))


def test_every_reference_names_a_response_with_the_payload(spark, tmp_path):
    warc_round_trip(pages_of(spark, ROWS).repartition(3), f"file:{tmp_path}", archive_bytes=300).collect()
    kinds, refers = {}, {}
    for name in tmp_path.glob("records/*.gz"):
        for fields, _ in records_of(inflate(open(name, "rb"))):
            kinds[fields["warc-record-id"]] = fields["warc-type"], fields["warc-payload-digest"]
            if fields["warc-type"] == "revisit":
                refers[fields["warc-record-id"]] = fields["warc-refers-to"]
    assert refers and all(kinds[to] == ("response", kinds[of][1]) for of, to in refers.items())


def test_archives_are_read_by_tasks_of_their_own(spark):
    read = warc_round_trip(pages_of(spark, [(i, "u", "x" * 50) for i in range(40)]).repartition(8), archive_bytes=1000)
    assert read.rdd.getNumPartitions() >= 8
