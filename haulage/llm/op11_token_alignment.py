"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Both tokenizers cut " " + text into tokens. Places where tokens of both end cut
them into groups; a link is a pair of tokens (one of each) whose bytes overlap.
Wanted per document: its groups and links, and how often the id pairs of its
links are linked in the whole corpus.

Neither tokenizer joins anything across a single space between two characters
that are not white space. So a text is cut there into chunks, and each distinct
chunk is encoded and aligned once per worker; a document is a list of chunk
codes. The identity map gives for each id of A the id of B with the same bytes.
Groups of one token each, paired as the map says, are counted in one vector of
the vocabulary's length per task. Only the pairs of the other groups enter the
pair shuffle: each batch of documents sends its distinct pairs with their
numbers, dealt by a hash of the pair, and gets the corpus-wide numbers back. The
identity totals and the best number of each B id go to all tasks; both are as
long as a vocabulary, whatever the corpus.

Edge rows: a null or empty text, or one that either tokenizer does not give
back byte by byte, has no tokens: zeros and empty groups. A null id stays null;
repeated rows count each; an empty table gives no rows; other columns are not
read. Special strings inside texts are plain text. A batch holds at least one
document, and a text without single spaces is one chunk, so a very long text
makes a large batch.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import mix, prepare, store
from haulage.llm.packs import pack, pack_sorted, unpack, unpack_sorted
from haulage.llm.registry import query, table

BATCH_BYTES = 8 << 20     # text of one batch
BUCKETS = 8               # parts that the pairs are dealt to, at least
REMEMBERED = 500_000      # distinct chunks that a worker remembers between batches, at most: some 170 MB
REMEMBERED_BYTES = 64 << 20
B_BITS = 32               # a pair is one number: A id << 32 | B id

# A chunk ends before a single space between characters outside this class: all
# white space of either pattern language, what some versions count as such, and
# the pieces' own mark.
_SPACES = "\\s\\x00-\\x20\\x7f-\\xa0\\u180e\\u200b\\u2581\\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACES}]) (?=[^{_SPACES}])")
_RARE = re.compile(f" [{_SPACES}]|[{_SPACES}] |^ | $")


def chunks_of(text: str) -> list[str]:
    """The chunks of " " + text, each without its leading space."""
    return _CUT.split(text) if _RARE.search(text) else text.split(" ")


# Fixed value: the pattern by which byte-level tokenizers of A's kind split a text.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LATIN = re.compile("[\x00-\u024f]*").fullmatch
_EDGE = re.compile(f"[{_SPACES}]")


def _byte_level() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
    return table


def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes one after the other, start, length)."""
    length = np.fromiter(map(len, strings), np.int64, len(strings))
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(length) - length, length


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i] + 1, ... of all i, one range after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum()), dtype=np.int64) + np.repeat(start - before, length)


def _counted(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(length of each list, all items)."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return n, np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))


def _per(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given lengths."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(length)
    return total[ends] - total[ends - length]


class Tokenizers:
    """The two vocabularies: A byte-level BPE (``tokenizers``), B pieces with byte fallback (``sentencepiece``)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = _byte_level()
        vocab = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece that joins words: texts can't be cut at spaces")
        if any(self._b_text(x) != f" {x}" for x in ("a b", "  a  \n b ", "ﬁ Å")):
            raise ValueError("a piece model that changes texts")
        b_bytes = [self._piece(p) for p in pieces]
        self.a_bytes, self.b_bytes = _flat(a_bytes), _flat(b_bytes)
        self.a_names, self.b_names = list(map(str, range(len(a_bytes)))), list(map(str, range(len(b_bytes))))
        by_bytes = {}
        for i, raw in enumerate(b_bytes):
            # a byte's own piece and its fallback have equal bytes; the map takes the piece
            if self.b.is_control(i) or self.b.is_unknown(i) or raw in by_bytes and self.b.is_byte(i):
                continue
            if raw not in by_bytes or self.b.is_byte(by_bytes[raw]):
                by_bytes[raw] = i
        self.identity = np.array([by_bytes.get(raw, -1) if raw else -1 for raw in a_bytes], np.int64)
        self._encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        self.fast = self._ranked(a_path, a_bytes)

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def _b_text(self, text: str) -> str:
        return b"".join(self._piece(self.b.id_to_piece(i)) for i in self.b.encode(text)).decode(errors="replace")

    def _ranked(self, path: str, a_bytes: list[bytes]):
        """A as ranks for the faster library, if its merges come in the order of their
        ids and every whole token is reached by them; else None. Used for Latin text only."""
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return None
        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        if model.get("type") != "BPE" or model.get("ignore_merges") or made != sorted(made) or -1 in made:
            return None
        own = {i for i in model["vocab"].values()} - {t["id"] for t in spec["added_tokens"]}
        fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks={a_bytes[i]: i for i in own}, special_tokens={})
        whole = [(i, a_bytes[i].decode()) for i in own if _LATIN(a_bytes[i].decode(errors="replace"))]
        slow = self._encode([x for _, x in whole], add_special_tokens=False)
        return fast if all(e.ids == fast.encode_ordinary(x) for e, (_, x) in zip(slow, whole)) else None

    def encode(self, chunks: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(number of ids per chunk, all ids) of " " + chunk under A, and of chunk under B, which adds the space."""
        return self._a_ids(chunks), _counted(self.b.encode(chunks, num_threads=1))

    def _a_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Latin chunks are encoded as one text: nothing is joined across their single spaces."""
        latin = [bool(c and self.fast and _LATIN(c) and not _EDGE.match(c[0]) and not _EDGE.match(c[-1])) for c in chunks]
        easy = np.array(latin, bool)
        n, at = np.zeros(len(chunks), np.int64), np.flatnonzero(easy)
        flat = {True: np.zeros(0, np.int64), False: np.zeros(0, np.int64)}
        if len(at):
            text = [chunks[i] for i in at.tolist()]
            flat[True] = self.fast.encode_to_numpy(" " + " ".join(text), disallowed_special=()).astype(np.int64)
            ends = np.cumsum([len(c.encode()) + 1 for c in text])
            n[at] = np.diff(np.searchsorted(np.cumsum(self.a_bytes[2][flat[True]]), ends, side="right"), prepend=0)
        at = np.flatnonzero(~easy)
        if len(at):
            found = self._encode([" " + chunks[i] for i in at.tolist()], add_special_tokens=False)
            n[at], flat[False] = _counted([e.ids for e in found])
        out = np.zeros(int(n.sum()), np.int64)
        side = np.repeat(easy, n)
        out[side], out[~side] = flat[True], flat[False]
        return n, out


@dataclass
class Aligned:
    """Aligned chunks: ``ok`` (both gave the bytes back), counts per chunk, link keys of all chunks in order, groups as text.

    The key of a link in a group of one token each, paired by the identity map, is -1 - A id.
    """
    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    keys: np.ndarray
    groups: list[str]


def align(t: Tokenizers, chunks: list[str]) -> Aligned:
    """Alignment of distinct chunks, all in one line of bytes."""
    raw, _, size = _flat([b" " + c.encode() for c in chunks])
    ok = np.ones(len(chunks), bool)
    sides = []
    for (n, flat), (data, start, length) in zip(t.encode(chunks), (t.a_bytes, t.b_bytes)):
        sides.append((n, flat))
        got = _per(length[flat], n)
        same = np.flatnonzero(got == size)
        here = _ranges((np.cumsum(size) - size)[same], size[same])
        there = data[_ranges(start[flat], length[flat])][_ranges((np.cumsum(got) - got)[same], got[same])]
        bad = _per((raw[here] != there).astype(np.int64), size[same]) > 0
        equal = np.zeros(len(chunks), bool)
        equal[same[~bad]] = True
        ok &= equal
    (n_a, a), (n_b, b) = ((np.where(ok, n, 0), flat[np.repeat(ok, n)]) for n, flat in sides)
    end_a, end_b = np.cumsum(t.a_bytes[2][a]), np.cumsum(t.b_bytes[2][b])
    cut = np.intersect1d(end_a, end_b, assume_unique=True)
    ends = np.union1d(end_a, end_b)  # between two of these ends, one A token overlaps one B token
    link_a, link_b = a[np.searchsorted(end_a, ends)], b[np.searchsorted(end_b, ends)]
    chunk_end = np.cumsum(np.where(ok, size, 0))
    group = np.searchsorted(cut, ends)
    alone = np.bincount(group, minlength=len(cut)) == 1
    known = alone[group] & (t.identity[link_a] == link_b)
    keys = np.where(known, -1 - link_a, link_a << B_BITS | link_b)

    def per_chunk(points):
        return np.diff(np.searchsorted(points, chunk_end, side="right"), prepend=0)

    text_a, text_b = [t.a_names[i] for i in a.tolist()], [t.b_names[i] for i in b.tolist()]
    upto_a, upto_b = (np.searchsorted(e, cut, side="right").tolist() for e in (end_a, end_b))
    groups, i, j = [], 0, 0
    for p, q in zip(upto_a, upto_b):
        left = text_a[i] if p == i + 1 else ",".join(text_a[i:p])
        groups.append(left + "|" + (text_b[j] if q == j + 1 else ",".join(text_b[j:q])))
        i, j = p, q
    n_groups = per_chunk(cut)
    upto = np.concatenate(([0], np.cumsum(n_groups))).tolist()
    joined = [groups[p] if q == p + 1 else ";".join(groups[p:q]) for p, q in zip(upto[:-1], upto[1:])]
    return Aligned(ok, n_a, n_b, n_groups, per_chunk(ends), keys, joined)


class _Codes(dict):
    """Numbers chunks in the order in which they are first seen."""

    def __init__(self):
        self.fresh = []

    def __missing__(self, chunk):
        code = self[chunk] = len(self)
        self.fresh.append(chunk)
        return code


class _Memory:
    """Aligned chunks of a worker, by code."""

    def __init__(self, t: Tokenizers):
        self.t = t
        self.clear()

    def clear(self) -> None:
        zero = np.zeros(0, np.int64)
        self.code, self.bytes = _Codes(), 0
        self.all = Aligned(np.zeros(0, bool), zero, zero, zero, zero, zero, [])
        self.start = zero

    def codes(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.code.__getitem__, chunks), np.int64, len(chunks))

    def learn(self) -> None:
        if not self.code.fresh:
            return
        new, old = align(self.t, self.code.fresh), self.all
        join = lambda f: np.concatenate((getattr(old, f), getattr(new, f)))
        before = np.cumsum(new.n_links) - new.n_links + len(old.keys)
        self.start = np.concatenate((self.start, before))
        self.bytes += sum(map(len, self.code.fresh)) + sum(map(len, new.groups))
        old.groups.extend(new.groups)
        self.all = Aligned(*(join(f) for f in ("ok", "n_a", "n_b", "n_groups", "n_links", "keys")), old.groups)
        self.code.fresh = []

    def full(self) -> bool:
        return len(self.code) > REMEMBERED or self.bytes > REMEMBERED_BYTES


# By vocabulary files; it outlives a task where Spark reuses the Python worker.
_MEMORY: dict[tuple[str, str], _Memory] = {}


def _memory(a_path: str, b_path: str) -> _Memory:
    if (a_path, b_path) not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[a_path, b_path] = _Memory(Tokenizers(a_path, b_path))
    return _MEMORY[a_path, b_path]


_PARTS = ("batch string, bucket int, pairs binary, times binary, docs binary, chunk binary, chunk_times binary, "
          "n_links binary, links binary, pair_b binary, identity array<struct<a:int,n:long>>")
_ARROW = pa.schema([("batch", pa.string()), ("bucket", pa.int32()), ("pairs", pa.binary()), ("times", pa.binary()),
                    ("docs", pa.binary()), ("chunk", pa.binary()), ("chunk_times", pa.binary()), ("n_links", pa.binary()),
                    ("links", pa.binary()), ("pair_b", pa.binary()),
                    ("identity", pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int64())])))])
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class _Batch:
    """Documents of one batch as chunk codes, with their counts and groups."""

    def __init__(self, memory: _Memory, digest: bool):
        if memory.full():
            memory.clear()
        self.memory, self.digest, self.size = memory, digest, 0
        self.rows: dict[str, list] = {c: [] for c in ("id", *_COUNTS, "groups", "n_distinct")}
        self.chunk, self.times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, ids: list, texts: list) -> None:
        """Rows of one Arrow batch, so that their new chunks are encoded together."""
        memory = self.memory
        coded = [memory.codes(chunks_of(x)) if x else np.zeros(0, np.int64) for x in texts]
        memory.learn()
        known = memory.all
        for i, x, codes in zip(ids, texts, coded):
            self.size += len(x or "") + 64
            good = len(codes) and known.ok[codes].all()
            chunk, times = np.unique(codes, return_counts=True) if good else (codes[:0], codes[:0])
            row = {"id": i, "n_distinct": len(chunk), "groups": ""} | {c: int((getattr(known, c)[chunk] * times).sum()) for c in _COUNTS}
            if good:
                row["groups"] = ";".join(map(known.groups.__getitem__, codes.tolist()))
                if self.digest:
                    row["groups"] = hashlib.sha256(row["groups"].encode()).hexdigest()
            for c, held in self.rows.items():
                held.append(row[c])
            self.chunk.append(chunk)
            self.times.append(times)

    def parts(self, buckets: int, identity: np.ndarray) -> pa.RecordBatch:
        """One row with the documents, and one per bucket with its pairs; identity links are added to the vector."""
        known, name = self.memory.all, uuid.uuid4().hex
        flat, times = np.concatenate(self.chunk), np.concatenate(self.times)
        used, code = np.unique(flat, return_inverse=True)
        total = np.zeros(len(used), np.int64)
        np.add.at(total, code, times)
        n_links = known.n_links[used]
        keys = known.keys[_ranges(self.memory.start[used], n_links)]
        of = np.repeat(total, n_links)
        alone = keys < 0
        np.add.at(identity, -1 - keys[alone], of[alone])
        pairs, where = np.unique(keys[~alone], return_inverse=True)
        number = np.zeros(len(pairs), np.int64)
        np.add.at(number, where, of[~alone])
        bucket = (mix(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(len(pairs))
        links = keys.copy()
        links[~alone] = rank[where]
        small = lambda a: pack(a.astype(np.int32))
        docs = pa.table({c: pa.array(v, pa.string() if c == "groups" else pa.int64()) for c, v in self.rows.items()})
        out = [{"batch": name, "docs": _ipc(docs), "chunk": small(code), "chunk_times": small(times), "n_links": small(n_links),
                "links": small(links), "pair_b": small(pairs[order] & (1 << B_BITS) - 1)}]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in range(buckets):
            if cut[k + 1] > cut[k]:
                here = order[cut[k]:cut[k + 1]]
                out.append({"batch": name, "bucket": k, "pairs": pack_sorted(pairs[here].astype(np.uint64)), "times": pack(number[here])})
        return pa.RecordBatch.from_pylist(out, schema=_ARROW)


def _ipc(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


@dataclass
class Alignment:
    """``rows``: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one per document;
    ``best``: (b_id, a_id, n), for each B id its most linked A id, ties to the smaller, and how often they are linked."""
    rows: DataFrame
    best: DataFrame


def alignment(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
              batch_bytes: int = BATCH_BYTES, buckets: int = BUCKETS) -> Alignment:
    """Align the texts of ``df`` under the two vocabulary files.

    ``groups`` is text like ``a1,a2|b1;a3|b2,b3``, or its SHA-256 in hex if ``digest``
    (empty for a document without tokens).
    """
    spark = df.sparkSession
    prepare(spark)
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # parts grow with the batches, so that a part stays small
    buckets = max(buckets, 2 * src.rdd.getNumPartitions())

    def split(batches):
        memory = _memory(a_path, b_path)
        identity = np.zeros(len(memory.t.identity), np.int64)
        held = _Batch(memory, digest)
        for batch in batches:
            held.add(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if held.size >= batch_bytes:
                yield held.parts(buckets, identity)
                held = _Batch(memory, digest)
        if held.rows["id"]:
            yield held.parts(buckets, identity)
        seen = np.flatnonzero(identity)
        if len(seen):
            yield pa.RecordBatch.from_pylist([{"identity": [{"a": int(a), "n": int(identity[a])} for a in seen]}], schema=_ARROW)

    # written down, as the batch names are made up: a lost executor must not make others
    parts = store(src.mapInArrow(split, _PARTS), "alignment", "zstd")
    identity = Tokenizers(a_path, b_path).identity
    alone = np.zeros(len(identity), np.int64)
    for r in (parts.where("identity is not null").select(F.explode("identity").alias("x"))
              .groupBy("x.a").agg(F.sum("x.n").alias("n")).collect()):  # one row per A id at most
        alone[r.a] = r.n

    def add_up(rows: pa.Table) -> pa.Table:
        keys = [unpack_sorted(x, np.uint64).astype(np.int64) for x in rows.column("pairs").to_pylist()]
        numbers = [unpack(x, np.int64) for x in rows.column("times").to_pylist()]
        pairs, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, where, np.concatenate(numbers))
        a, b = pairs >> B_BITS, pairs & (1 << B_BITS) - 1
        same = identity[a] == b  # linked in other groups too
        also = [{"a": int(x), "n": int(n)} for x, n in zip(a[same], total[same])]
        total[same] += alone[a[same]]
        order = np.lexsort((a, -total, b))
        first = order[np.concatenate(([True], b[order][1:] != b[order][:-1]))]
        top = [{"b": int(y), "a": int(x), "n": int(n)} for y, x, n in zip(b[first], a[first], total[first])]
        ends = np.cumsum([len(k) for k in keys])
        back = [pack(t) for t in np.split(total[where], ends[:-1])]
        n = len(back)
        entry = pa.struct([("b", pa.int32()), ("a", pa.int32()), ("n", pa.int64())])
        return pa.table({"batch": pa.array(rows.column("batch").to_pylist() + [None], pa.string()),
                         "bucket": pa.array(rows.column("bucket").to_pylist() + [None], pa.int32()),
                         "totals": pa.array(back + [None], pa.binary()),
                         "top": pa.array([None] * n + [top], pa.list_(entry)),
                         "also": pa.array([None] * n + [also], pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int64())])))})

    totals = store(parts.where("bucket is not null").select("batch", "bucket", "pairs", "times").groupBy("bucket")
                   .applyInArrow(add_up, "batch string, bucket int, totals binary, top array<struct<b:int,a:int,n:long>>, "
                                         "also array<struct<a:int,n:long>>"), "alignment-totals", "zstd")
    linked = alone.copy()
    for r in totals.where("also is not null").select(F.explode("also").alias("x")).select("x.*").collect():  # an A id is in one bucket once
        linked[r.a] += r.n
    best: dict[int, tuple[int, int]] = {}
    order = F.max(F.struct(F.col("x.n").alias("n"), (-F.col("x.a")).alias("a"))).alias("m")
    for r in (totals.where("top is not null").select(F.explode("top").alias("x")).groupBy(F.col("x.b").alias("b")).agg(order)
              .collect()):  # one row per B id at most
        best[r.b] = (r.m.n, r.m.a)
    for a in np.flatnonzero(linked).tolist():
        b = int(identity[a])
        best[b] = max(best.get(b, (0, 0)), (int(linked[a]), -a))
    highest = np.zeros(max([*best, 0]) + 1, np.int64)
    for b, (n, _) in best.items():
        highest[b] = n

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        docs = pa.ipc.open_stream(row["docs"]).read_all()
        found = sorted(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist()))
        total = np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for _, x in found)])
        small = lambda c: unpack(row[c], np.int32).astype(np.int64)
        links, n_links = small("links"), small("n_links")
        known = links < 0
        count, top = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        a = -1 - links[known]
        count[known], top[known] = linked[a], highest[identity[a]]
        count[~known], top[~known] = total[links[~known]], highest[small("pair_b")[links[~known]]]
        chunk, times = small("chunk"), small("chunk_times")
        n_distinct = np.asarray(docs.column("n_distinct"), np.int64)
        per_doc = lambda v: pa.array(_per(_per(v, n_links)[chunk] * times, n_distinct))
        out = {c: docs.column(c) for c in ("id", *_COUNTS)}
        return pa.table(out | {"n_best": per_doc((count == top).astype(np.int64)), "count_sum": per_doc(count),
                               "groups": docs.column("groups")})

    docs = parts.where("docs is not null").select("batch", "docs", "chunk", "chunk_times", "n_links", "links", "pair_b")
    sent = totals.where("totals is not null").select("batch", "bucket", "totals")
    rows = (docs.groupBy("batch").cogroup(sent.groupBy("batch"))
            .applyInArrow(finish, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"))
    pairs = spark.createDataFrame([(b, -a, n) for b, (n, a) in sorted(best.items())], "b_id int, a_id int, n long")
    return Alignment(rows, pairs)


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    found = alignment(table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"), digest=True)
    return found.rows.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})
