import base64
import glob
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from haulage.llm import op08_warc as op
from haulage.session import scratch_path

PAGES = "page_id long, url string, html string"
ROWS = [(5, "http://a/x", "<p>same</p>"), (3, "http://a/y\r\nX: 1", "<p>same</p>"), (9, None, "<p>same</p>"), (4, "http://b/é", "größe 🙂" * 2000),
        (6, "u", None), (7, "u", ""), (None, "u", "<p>same</p>"), (None, "v", "alone"), (None, "w", "alone"), (8, "z", "x"), (8, "z", "x"),
        (10, "g", "\x1f\x8b\x08 not a member"), (11, "h", "WARC/1.1\r\n\r\n")]


def _round_trip(spark, rows, min_bytes=0, range_bytes=op.RANGE_BYTES, parts=3):
    path = scratch_path(spark, "warc")
    op.write_archives(spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).repartition(parts), path, min_bytes=min_bytes)
    return path, op.read_archives(spark, path, range_bytes=range_bytes).collect()


def _want(rows, min_bytes=0):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(ids, default=None) if len(raw) >= min_bytes else None
        again = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def _got(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


@pytest.mark.parametrize("range_bytes", [50, 333, 1000, 1 << 20])
def test_round_trip_over_any_ranges(spark, range_bytes):
    _, rows = _round_trip(spark, ROWS, range_bytes=range_bytes)
    assert _got(rows) == _want(ROWS)
    for r in rows:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).digest() == base64.b32decode(r.payload_digest)


def test_small_payloads_are_never_revisits(spark):
    assert _got(_round_trip(spark, ROWS, min_bytes=10)[1]) == _want(ROWS, 10)


def test_archives_are_gzip_files_of_warc_records(spark):
    path, _ = _round_trip(spark, ROWS)
    names = glob.glob(path.replace("file:", "") + "/part-*")
    records = sum(gzip.open(n).read().count(b"WARC-Type: ") for n in names)
    assert names and records == len(ROWS)


def test_places_that_only_look_like_members():
    inner = op.member(b"not a record")
    raw = b"junk" + op.MAGIC + b"junk" + inner + op.member(op.record(1, "u", b"p", None)) + op.EMPTY + op.member(op.record(2, "u", b"q", None)) + b"tail"
    f = io.BytesIO(raw)
    for step in (1, 7, 64, len(raw)):
        got = [op.parse(x)["page_id"] for s in range(0, len(raw), step) for x in op.members_in(f, s, min(s + step, len(raw)))]
        assert got == [1, 2]


def test_magic_over_the_edge_of_a_window():
    raw = b"x" * ((1 << 20) - 1) + op.member(op.record(1, "u", b"p", None))
    assert len(list(op.members_in(io.BytesIO(raw), 0, len(raw)))) == 1


def test_damage_is_noticed():
    good = op.record(1, "u", b"payload", None)
    with pytest.raises(ValueError):
        op.parse(good.replace(b"\r\n\r\npayload", b"\r\n\r\npayloaD"))
    assert op.parse(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n\r\n") is None


def test_empty_table(spark):
    assert _round_trip(spark, [])[1] == []
