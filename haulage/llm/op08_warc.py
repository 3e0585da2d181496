"""WARC archives: write pages as gzip members, read them back by byte ranges.

Writing. Each record is one gzip member. A task packs members into blocks of
about a megabyte; Spark's text writer stores a block as one value, with an
empty gzip member as the separator, so the files are valid archives and come
from Spark's own commit protocol (a lost executor leaves no half file). Of
records with equal payloads the one with the smallest page id is a response;
the others are revisits: headers only, with the digest and the id they refer to.

Reading. Files are cut into byte ranges. A task looks for the gzip magic from
the start of its range, and takes a place as a member if it decodes to a WARC
header (or to an empty member). It owns the members that start inside its
range and reads the last one past the end. Payload digests are checked.

Edge rows: a null html is an empty payload, a null url leaves the target out,
a null page id comes back null. Rows repeated in full stay rows: those with
the smallest id of their payload are all responses. A payload whose rows all
have a null id is a response in each. An empty table makes an empty result;
other columns are not read. One record is held in memory at a time.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.blocked_bloom import may_hold
from haulage.llm.common import open_file, prepare, store
from haulage.llm.registry import query, table
from haulage.session import scratch_path

BLOCK_BYTES = 1 << 20   # members packed into one value
RANGE_BYTES = 8 << 20   # bytes of an archive that one task row scans
MAX_BLOCKS = 1 << 20    # words of the filter on repeated digests: 8 MiB
MIN_BYTES = 0           # payloads of fewer bytes are never revisits
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"  # the same for all, so that a repeated task writes the same bytes


def member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


EMPTY = member(b"")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, whose length field is that of the full payload."""
    digest = digest_of(payload)
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    name = f"x-page:{page_id}" if page_id is not None else f"sha1:{digest}"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{name}>", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict | None:
    """Fields of a record; None for one that is neither response nor revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if kind == "response" and (digest_of(payload) != digest or len(payload) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
            "target_uri": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers[len("<urn:x-page:"):-1]) if refers else None,
            "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_BYTES) -> None:
    """Write one record per row of ``pages`` to archives under ``path``."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # digests that occur again, one narrow row for each
    again = store(rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
                  .agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1").select("digest", "first"), "repeated-payloads")
    blocks = min(MAX_BLOCKS, max(64, 1 << (again.count() // 4).bit_length()))
    marked = rows.withColumn("maybe", may_hold(F.col("digest"), again, "digest", blocks))
    # a payload travels only if its digest may occur again; the others are written where they are read
    hits = (marked.where("maybe").join(again, "digest", "left")
            .select("page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to")))
    rows = marked.where("not maybe").select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to")).unionByName(hits)

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for i, u, h, r in zip(*(c.to_pylist() for c in batch.columns)):
                m = member(record(i, u, h.encode(), r))
                held.append(m)
                size += len(m)
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])

    # the text writer stores a value's bytes as they are, then the separator
    (rows.mapInArrow(pack, "members binary").select(F.col("members").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).text(path))


def _decode(f, at: int, first: bytes = b"") -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at a place, None if there is none that holds a record."""
    z = zlib.decompressobj(31)
    f.seek(at)
    out, seen = [], 0
    try:
        while not z.eof:
            raw = f.read(1 << 16)
            if not raw:
                return None
            seen += len(raw)
            out.append(z.decompress(raw))
            if not z.eof and len(out) == 1 and not out[0].startswith(b"WARC/1."):
                return None  # its header decides before the rest is read
    except zlib.error:
        return None
    content = b"".join(out)
    if content and not content.startswith(b"WARC/1."):
        return None
    return content, at + seen - len(z.unused_data)


def members_in(f, start: int, end: int):
    """Contents of the members that start in [start, end)."""
    at, synced = start, False
    while at < end:
        if not synced:
            f.seek(at)
            window = f.read(min(1 << 20, end - at + len(MAGIC) - 1))
            hit = window.find(MAGIC)
            if hit < 0:
                if at + len(window) >= end or not window:
                    return
                at += max(1, len(window) - len(MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
        found = _decode(f, at)
        if found is None:  # not a member: look on from the next byte
            at, synced = at + 1, False
            continue
        content, at = found
        synced = True
        if content:
            yield content


_RECORD = ("page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary")


def read_archives(spark: SparkSession, path: str, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per response or revisit record of the archives under ``path``."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = _RECORD if payloads else _RECORD.replace(", payload binary", "")
    schema = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
                       + [("payload", pa.binary())] * payloads)

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(name) as f:
                    held, size = [], 0
                    for content in members_in(f, start, start + range_bytes):
                        row = parse(content)
                        if row is None:
                            continue
                        if not payloads:
                            row.pop("payload")
                        held.append(row)
                        size += len(content)
                        if len(held) >= 1000 or size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return ranges.repartition(parts, "path", "start").mapInArrow(read, fields)


SQL = """
with p as (select page_id, encode(coalesce(html, '')) payload from pages),
d as (select page_id, octet_length(payload) payload_bytes, sha1(payload) hex from p),
b as (select hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
        (strpos('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1) * 16
        + greatest(strpos('0123456789abcdef', substr(hex, 2 + (5 * i) // 4, 1)) - 1, 0)
      ) // (8 >> ((5 * i) % 4)) % 32, 1), '' order by i) payload_digest
      from (select distinct hex from d), (select unnest(range(32)) i) group by hex),
m as (select hex, min(page_id) first_id from d group by hex)
select d.page_id, d.payload_bytes, b.payload_digest,
       case when m.first_id is null or m.first_id is not distinct from d.page_id then 'response' else 'revisit' end record_type,
       case when m.first_id is not distinct from d.page_id then null else m.first_id end refers_to
from d join b using (hex) join m using (hex)"""


@query("op8_warc", SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
