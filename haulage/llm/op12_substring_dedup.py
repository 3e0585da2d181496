"""Removal of repeated passages: windows of words counted by a count-min sketch, then exactly.

A window is a run of consecutive words of one document; a word goes if a window
that covers it starts anywhere else too, in the same document or another one.

1. Documents are packed into batches in the shared folder, each with a name.
2. Every batch makes a partial count-min sketch of its windows: per row of the
   sketch the cells that it fills, once or more than once. The sketch is cut by a
   hash of the window into segments of a fixed size, as many as the corpus needs,
   so neither its share of filled cells nor the memory of a task grows with the
   input. The partial sketches of a segment are merged in one task, which sends
   back to each batch, cell by cell, whether the merged count is above one. A
   count is never too low, so no repeated window is lost.
3. A second pass sends only the windows estimated repeated, as 128-bit
   fingerprints, each once per batch and dealt by hash. Equal ones are grouped
   exactly, and the batches learn which are repeated.
4. A last pass removes the covered words.

A window in a third of all documents is one entry per batch. What travels is the
cells, the fingerprints and bits; texts are not shuffled. Answers are written to
the shared folder, one folder per batch, and read there by the tasks (any store
that pyarrow opens). All tables are written before they are read, and batch
names are kept in the packs, so a lost executor costs its tasks only.

Edge rows: a null or empty text has no words. A text with fewer words than a
window is kept as it is. A null id stays null; repeated rows count as further
places, so their windows are repeated. An empty table gives no rows; other columns
are not read. A batch holds at least one document: a text above the batch size is
a batch of its own and needs some 40 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import _BYTE, _powers, WHITE, chunks, mix, prepare, store, text_buffer
from haulage.llm.packs import pack_sorted, unpack_sorted
from haulage.llm.registry import query, table
from haulage.session import scratch_path

WINDOW = 35
BATCH_BYTES = 8 << 20
DEPTH = 2              # rows of the sketch
CELL_BITS = 23         # cells of a row in one segment: 2**23 bytes in the task that merges them
SEGMENT = 1 << 20      # windows in a segment on average, so 1 cell in 8 is filled

U64 = np.uint64
_WORD = U64(0xD6E8FEB86659FD93)   # fixed multipliers of the hashes; any odd numbers do
_SECOND = U64(0xA0761D6478BD642F)
_SALT = [U64(0x9E3779B97F4A7C15 * (2 * r + 1) & (1 << 64) - 1) for r in range(16)]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word in text order, number of words per text)."""
    found, count = [np.zeros(0, U64)], np.zeros(len(off) - 1, np.int64)
    for a, b in chunks(off):
        part, at = data[off[a]:off[b]], off[a:b + 1] - off[a]
        if len(part) == 0:
            continue
        inside = ~WHITE[part]
        first = np.zeros(len(part) + 1, bool)
        first[at] = True
        before, after = np.concatenate(([False], inside[:-1])), np.concatenate((inside[1:], [False]))
        start = np.flatnonzero(inside & (~before | first[:-1]))
        end = np.flatnonzero(inside & (~after | first[1:])) + 1
        power, inverse = _powers(len(part))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE[part] * power[:len(part)], out=total[1:])
        found.append(mix((total[end] - total[start]) * inverse[start] ^ (end - start).astype(U64) * _WORD))
        count[a:b] = np.diff(np.searchsorted(start, at))
    return np.concatenate(found), count


def window_hashes(word: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, fingerprint, second fingerprint) of every window inside one text."""
    ends = np.repeat(np.cumsum(count), count)
    first = np.flatnonzero(np.arange(len(word), dtype=np.int64) + width <= ends)
    power, inverse = _powers(len(word) + 1)
    out = []
    for w in (word, mix(word * _SECOND)):
        total = np.zeros(len(word) + 1, U64)
        np.cumsum(w * power[:len(word)], out=total[1:])
        out.append(mix((total[first + width] - total[first]) * inverse[first]))
    return first, out[0], out[1]


@dataclass
class Windows:
    """The windows of one batch: ``first`` word of each place, ``which`` distinct window it holds, and those, sorted."""
    first: np.ndarray
    which: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(word: np.ndarray, count: np.ndarray, width: int) -> Windows:
        first, h1, h2 = window_hashes(word, count, width)
        order = np.argsort(h1, kind="stable")
        a, b = h1[order], h2[order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        return Windows(first, which, a[at], b[at], np.diff(np.append(at, len(a))))


def _segment(h1: np.ndarray, segments: int) -> np.ndarray:
    return mix(h1 ^ _SALT[0]) % U64(segments)


def _cells(h1: np.ndarray, row: int) -> np.ndarray:
    return mix(h1 + _SALT[row + 1]) >> U64(64 - CELL_BITS)


class Sketch:
    """Partial count-min sketch of a batch: per row the filled cells, ordered by segment and cell."""

    def __init__(self, w: Windows, segments: int, depth: int):
        self.segments = segments
        where = _segment(w.h1, segments) << U64(CELL_BITS)
        self.rows = []
        for r in range(depth):
            cell, of, n = np.unique(where | _cells(w.h1, r), return_inverse=True, return_counts=True)
            twice = n > 1
            twice[of[w.times > 1]] = True
            cut = np.searchsorted(cell >> U64(CELL_BITS), np.arange(segments + 1, dtype=np.uint64))
            self.rows.append((cell, of, twice, cut))

    def parts(self, batch: str):
        """(batch, segment, cells of each row, whether filled more than once)."""
        mask = U64((1 << CELL_BITS) - 1)
        for s in range(self.segments):
            here = [(cell[cut[s]:cut[s + 1]] & mask, twice[cut[s]:cut[s + 1]]) for cell, _, twice, cut in self.rows]
            if len(here[0][0]):
                yield {"batch": batch, "bucket": s, "cells": [pack_sorted(c.astype(np.uint32)) for c, _ in here],
                       "twice": [np.packbits(t).tobytes() for _, t in here]}

    def repeated(self, answer: dict[int, list[bytes]]) -> np.ndarray:
        """For each distinct window whether its estimate is above one: all its cells are, in the merged sketch."""
        out = None
        for r, (cell, of, _, cut) in enumerate(self.rows):
            above = np.zeros(len(cell), bool)
            for s in range(self.segments):
                n = cut[s + 1] - cut[s]
                if n:
                    above[cut[s]:cut[s + 1]] = np.unpackbits(np.frombuffer(answer[s][r], np.uint8), count=n)
            out = above[of] if out is None else out & above[of]
        return out


def merge_sketches(rows: pa.Table) -> pa.Table:
    """Merge the partial sketches of one segment; answer each batch with a bit per cell that it sent."""
    cells, twice = rows.column("cells").to_pylist(), rows.column("twice").to_pylist()
    answers: list[list[bytes]] = [[] for _ in cells]
    for r in range(len(cells[0])):
        count = np.zeros(1 << CELL_BITS, np.uint8)
        for c, t in zip(cells, twice):
            at = unpack_sorted(c[r], np.uint32)
            more = np.unpackbits(np.frombuffer(t[r], np.uint8), count=len(at))
            count[at] = np.minimum(count[at] + 1 + more, 2)  # one and above one is all that is asked
        for i, c in enumerate(cells):
            answers[i].append(np.packbits(count[unpack_sorted(c[r], np.uint32)] > 1).tobytes())
    return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "bits": pa.array(answers, pa.list_(pa.binary()))})


def count_exactly(rows: pa.Table) -> pa.Table:
    """Group the fingerprints of one part; answer each batch with a bit per window that it sent."""
    h1 = [unpack_sorted(x, np.uint64) for x in rows.column("h1").to_pylist()]
    sizes = [len(x) for x in h1]
    a = np.concatenate(h1)
    b = np.frombuffer(b"".join(rows.column("h2").to_pylist()), U64)
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(rows.column("twice").to_pylist(), sizes)])
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=1 + twice[order])
    repeated = np.empty(len(a), bool)
    repeated[order] = total[group] > 1
    bits = [[np.packbits(x).tobytes()] for x in np.split(repeated, np.cumsum(sizes)[:-1])]
    return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "bits": pa.array(bits, pa.list_(pa.binary()))})


_ANSWER = "batch string, bucket int, bits array<binary>"


def _answers(root: str, batch: str) -> dict[int, list[bytes]]:
    """The answers to one batch, by part; none if it had nothing to ask."""
    folder = f"{root}/batch={batch}"
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    store_, path = (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)
    out: dict[int, list[bytes]] = {}
    for f in store_.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if f.is_file and f.path.endswith(".parquet"):
            with store_.open_input_file(f.path) as source:
                t = pq.read_table(source, columns=["bucket", "bits"])
            out |= zip(t.column("bucket").to_pylist(), t.column("bits").to_pylist())
    return out


def _write_answers(answers: DataFrame) -> str:
    """The answers in one folder per batch."""
    root = scratch_path(answers.sparkSession, "repeats")
    answers.repartition("batch").write.partitionBy("batch").option("compression", "zstd").parquet(root)
    return root


def _ipc(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _packs(batch_bytes: int, width: int):
    """Documents in batches of about ``batch_bytes`` of text: (name, number of windows, the documents)."""
    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        _, count = word_hashes(*text_buffer(t.column("text")))
        return pa.RecordBatch.from_pylist([{"batch": uuid.uuid4().hex, "windows": int(np.maximum(count - width + 1, 0).sum()),
                                            "docs": _ipc(t)}],
                                          schema=pa.schema([("batch", pa.string()), ("windows", pa.int64()), ("docs", pa.binary())]))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            at = 0
            while at < batch.num_rows:
                room = batch_bytes - size + (ends[at - 1] if at else 0)
                end = int(np.searchsorted(ends, room, side="right"))
                if end <= at:
                    if held:
                        yield row(held)
                        held, size = [], 0
                        continue
                    end = at + 1  # one document above the batch size
                held.append(batch.slice(at, end - at))
                size += int(ends[end - 1] - (ends[at - 1] if at else 0))
                at = end
        if held:
            yield row(held)
    return run


def _documents(raw: bytes, width: int):
    t = pa.ipc.open_stream(raw).read_all()
    word, count = word_hashes(*text_buffer(t.column("text")))
    return t, count, Windows.of(word, count, width)


def _remove(t: pa.Table, count: np.ndarray, w: Windows, repeated: np.ndarray, width: int) -> pa.RecordBatch:
    """Documents of a batch without the words that repeated windows cover."""
    n = int(count.sum())
    cover = np.zeros(n + 1, np.int64)
    at = w.first[repeated[w.which]] if len(w.which) else w.first
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    gone = np.cumsum(cover[:-1]) > 0
    begin = np.cumsum(count) - count
    total = np.concatenate(([0], np.cumsum(gone)))
    removed = total[begin + count] - total[begin]
    kept, spans = [], []
    for raw, b, c, r in zip(t.column("text").to_pylist(), begin.tolist(), count.tolist(), removed.tolist()):
        words = raw.encode().split() if raw else []
        if r:
            here = gone[b:b + c]
            words = compress(words, (~here).tolist())
            change = np.flatnonzero(np.diff(np.concatenate(([False], here, [False])).astype(np.int8)))
            spans.append([{"first": x, "end": y} for x, y in change.reshape(-1, 2).tolist()])
        else:
            spans.append([])
        kept.append(b" ".join(words).decode())
    return pa.RecordBatch.from_arrays(
        [t.column("id").combine_chunks(), pa.array(count), pa.array(removed), pa.array(kept, pa.string()),
         pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
        names=["id", "n_words", "n_removed", "kept", "spans"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, depth: int = DEPTH,
                   segment: int = SEGMENT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept, spans), one row per row of ``df``.

    ``kept`` holds the words that stay, joined by one space; ``spans`` the removed
    runs of words as (first, end), end exclusive.
    """
    spark = df.sparkSession
    prepare(spark)
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    packs = store(src.mapInArrow(_packs(batch_bytes, width), "batch string, windows long, docs binary"), "repeat-packs", "uncompressed")
    segments = max(1, -(-(packs.agg(F.sum("windows")).first()[0] or 0) // segment))
    work = packs.select("batch", "docs")

    def each(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield b.column(0)[i].as_py(), b.column(1)[i].as_py()

    def sketch(batches):
        schema = pa.schema([("batch", pa.string()), ("bucket", pa.int32()), ("cells", pa.list_(pa.binary())), ("twice", pa.list_(pa.binary()))])
        for name, raw in each(batches):
            _, _, w = _documents(raw, width)
            rows = list(Sketch(w, segments, depth).parts(name))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    parts = work.mapInArrow(sketch, "batch string, bucket int, cells array<binary>, twice array<binary>")
    estimates = _write_answers(parts.groupBy("bucket").applyInArrow(merge_sketches, _ANSWER))

    def candidates(batches):
        schema = pa.schema([("batch", pa.string()), ("bucket", pa.int32()), ("h1", pa.binary()), ("h2", pa.binary()), ("twice", pa.binary())])
        for name, raw in each(batches):
            _, _, w = _documents(raw, width)
            at, cut = _dealt(w, _estimated(w, estimates, name, segments, depth), segments)
            rows = [{"batch": name, "bucket": s, "h1": pack_sorted(w.h1[x]), "h2": w.h2[x].tobytes(),
                     "twice": np.packbits(w.times[x] > 1).tobytes()}
                    for s in range(segments) if len(x := at[cut[s]:cut[s + 1]])]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    sent = work.mapInArrow(candidates, "batch string, bucket int, h1 binary, h2 binary, twice binary")
    exact = _write_answers(sent.groupBy("bucket").applyInArrow(count_exactly, _ANSWER))

    def remove(batches):
        for name, raw in each(batches):
            t, count, w = _documents(raw, width)
            at, cut = _dealt(w, _estimated(w, estimates, name, segments, depth), segments)
            repeated = np.zeros(len(w.h1), bool)
            for s, bits in _answers(exact, name).items():
                repeated[at[cut[s]:cut[s + 1]]] = np.unpackbits(np.frombuffer(bits[0], np.uint8), count=cut[s + 1] - cut[s])
            yield _remove(t, count, w, repeated, width)

    return work.mapInArrow(remove, "id long, n_words long, n_removed long, kept string, spans array<struct<first:long,end:long>>")


def _estimated(w: Windows, estimates: str, batch: str, segments: int, depth: int) -> np.ndarray:
    """The distinct windows of a batch that the merged sketch estimates repeated."""
    if len(w.h1) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(Sketch(w, segments, depth).repeated(_answers(estimates, batch)))


def _dealt(w: Windows, chosen: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The chosen windows ordered by part (and fingerprint inside it), and where each part begins."""
    part = (mix(w.h1[chosen] ^ _SALT[-1]) % U64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return chosen[order], np.searchsorted(part[order], np.arange(parts + 1))


SQL = f"""
with d as materialized (select row_number() over () n, doc_id,
           coalesce(list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x <> ''), []::varchar[]) w from documents),
p as (select n, unnest(range(1, len(w) - {WINDOW - 2})) p, w from d where len(w) >= {WINDOW}),
s as (select n, p, count(*) over (partition by array_to_string(w[p:p + {WINDOW - 1}], ' ')) c from p),
g as (select n, list(distinct q) q from (select n, unnest(range(p, p + {WINDOW})) q from s where c > 1) group by n),
k as (select d.doc_id, len(w) n_words, coalesce(len(q), 0) n_removed,
             case when q is null then w else list_filter(w, lambda x, i: not list_contains(q, i)) end kept from d left join g using (n))
select doc_id, n_words::bigint n_words, n_removed::bigint n_removed, sha256(array_to_string(kept, ' ')) kept_sha256 from k"""


@query("op12_substring_dedup", SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
