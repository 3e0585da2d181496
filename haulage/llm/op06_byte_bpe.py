"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash (hash and displace) over the vocabulary's
byte strings resolves each pre-token that is itself in the vocabulary. Second
tier: the others are merged with a heap over a linked list of bytes, lowest
rank first, leftmost among equals. A Python worker remembers the pre-tokens
that it has resolved; when there are too many, those used most stay.

Edge rows: a null or empty text encodes to an empty list and decodes to empty
bytes; a null list decodes to null; an id outside the vocabulary is an error.
An empty table gives an empty result; an input column named like a result
column is replaced; repeated rows are encoded each. A long text without
breaks costs n log n.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import _BYTE, _powers, annotate, mix, remembered
from haulage.llm.registry import query, table

REMEMBERED = 100_000  # distinct pre-tokens that a Python worker remembers, some 430 bytes each
U64 = np.uint64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string data[off[i]:off[i + 1]]."""
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    return mix((total[off[1:]] - total[off[:-1]]) * inverse[off[:-1]] ^ (off[1:] - off[:-1]).astype(U64))


def _strings(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(keys) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)), out=off[1:])
    return np.frombuffer(b"".join(keys), np.uint8), off


def _gather(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i] + 1, ... of all i, one range after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum()), dtype=np.int64) + np.repeat(start - before, length)


class PerfectHash:
    """Minimal perfect hash of n byte strings onto 0..n-1, with the strings themselves to reject others."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        data, off = _strings(keys)
        h = hashes(data, off)
        bucket = (h % U64(self.buckets)).astype(np.int64)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate(bucket.tolist()):
            members[b].append(i)
        self.shift = np.zeros(self.buckets, np.int64)
        place = np.full(n, -1, np.int64)  # slot -> key
        free = np.ones(n, bool)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        for b in order:
            if len(members[b]) < 2:
                break
            hb = h[members[b]]
            d = -1
            for first in range(0, 1 << 40, 32):  # 32 displacements at a time
                slots = self._slots(hb[None, :], np.arange(first, first + 32)[:, None])
                fits = np.flatnonzero(free[slots].all(axis=1))
                d = next((first + int(t) for t in fits if len(set(slots[t].tolist())) == len(hb)), -1)
                if d >= 0:
                    break
            slots = slots[d - first]
            self.shift[b] = d
            free[slots] = False
            place[slots] = members[b]
        left = iter(np.flatnonzero(free).tolist())
        for b in order:
            if len(members[b]) == 1:  # a lone key takes any free slot, named directly
                s = next(left)
                self.shift[b] = -1 - s
                place[s] = members[b][0]
        self.data, self.off, self.key = data, off, place

    def _slots(self, h: np.ndarray, d) -> np.ndarray:
        return (mix(h + np.asarray(d).astype(U64) * U64(0x9E3779B97F4A7C15)) % U64(self.n)).astype(np.int64)

    def find(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Index of each given string among the keys, -1 if it isn't one."""
        h = hashes(data, off)
        d = self.shift[(h % U64(self.buckets)).astype(np.int64)]
        key = self.key[np.where(d < 0, -1 - d, self._slots(h, np.maximum(d, 0)))]
        length = off[1:] - off[:-1]
        same = (self.off[key + 1] - self.off[key]) == length
        rows = np.flatnonzero(same & (length > 0))
        equal = data[_gather(off[rows], length[rows])] == self.data[_gather(self.off[key[rows]], length[rows])]
        where = np.repeat(np.arange(len(rows)), length[rows])
        bad = np.bincount(where, weights=~equal, minlength=len(rows)) > 0
        out = np.full(len(length), -1, np.int64)
        out[rows[~bad]] = key[rows[~bad]]
        return out


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: join the neighbouring pair of lowest rank until none is in the vocabulary.

    A heap entry is one integer: rank, where the pair begins, where it ends.
    """
    n = len(word)
    bits = n.bit_length()
    low = (1 << bits) - 1
    end = list(range(1, n + 1))  # end of the part that begins here, 0 once it is joined to another
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = []
    for i in range(n - 1):
        r = get(word[i:i + 2])
        if r is not None:
            heap.append((r << bits | i) << bits | i + 2)
    heapify(heap)
    while heap:
        e = heappop(heap)
        stop = e & low
        i = e >> bits & low
        mid = end[i]
        if mid == 0 or mid >= n or end[mid] != stop:
            continue  # one of the two has changed since
        end[i] = stop
        end[mid] = 0
        if stop < n:
            before[stop] = i
            r = get(word[i:end[stop]])
            if r is not None:
                heappush(heap, (r << bits | i) << bits | end[stop])
        if i:
            j = before[i]
            r = get(word[j:stop])
            if r is not None:
                heappush(heap, (r << bits | j) << bits | stop)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class _Codes(dict):
    """Numbers words in the order in which they are first seen."""

    def __init__(self):
        self.fresh = []

    def __missing__(self, word):
        code = self[word] = len(self)
        self.fresh.append(word)
        return code


class _Memory:
    """Ids of the pre-tokens seen so far."""

    def __init__(self):
        self.code, self.ids = _Codes(), np.zeros(0, np.int32)
        self.start, self.length, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def used(self, of: np.ndarray) -> None:
        times = np.bincount(of, minlength=len(self.length))
        times[:len(self.uses)] += self.uses
        self.uses = times

    def shrink(self, size: int) -> None:
        """Keep the ``size`` pre-tokens that were used most."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:size])
        stays = np.zeros(len(self.uses), bool)
        stays[keep] = True
        words = [w for w, s in zip(self.code, stays.tolist()) if s]  # in the order of their codes
        self.code = _Codes()
        for word in words:
            self.code[word] = len(self.code)
        self.ids = self.ids[_gather(self.start[keep], self.length[keep])]
        self.length = self.length[keep]
        self.start = np.cumsum(self.length) - self.length
        self.uses = self.uses[keep] // 2  # what is no longer used gives way

    def add(self, found: list[list[int]]) -> None:
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(length) - length))
        self.length = np.concatenate((self.length, length))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(length.sum()))))
        self.code.fresh = []


OWNER = "op06_byte_bpe"

# By vocabulary; it outlives a task where Spark reuses the Python worker.
_MEMORY: dict[str, _Memory] = remembered(OWNER)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        keys = sorted(ranks, key=ranks.__getitem__)
        self.name = hashlib.sha256(b"\0".join(keys) + pattern.encode()).hexdigest()
        self.ranks, self.pattern = ranks, pattern
        self.table = PerfectHash(keys)
        self.id_of_key = np.array([ranks[k] for k in keys], np.int32)
        data, off = _strings(keys)
        size = int(self.id_of_key.max()) + 1
        self.start, self.length = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.start[self.id_of_key], self.length[self.id_of_key], self.bytes = off[:-1], off[1:] - off[:-1], data

    def resolve(self, words: list[str]) -> tuple[list, int]:
        """Ids of each distinct pre-token, and how many the first tier found."""
        raw = [w.encode() for w in words]
        data, off = _strings(raw)
        key = self.table.find(data, off)
        whole = key >= 0
        ids = np.where(whole, self.id_of_key[np.maximum(key, 0)], -1).tolist()
        return [[i] if i >= 0 else merge_bytes(raw[j], self.ranks) for j, i in enumerate(ids)], int(whole.sum())

    def batch_encoder(self):
        """Function from a text array to a list<int> array; it remembers pre-tokens between calls."""
        split = regex.compile(self.pattern).findall

        def encode(texts: pa.Array) -> pa.Array:
            memory = _MEMORY.get(self.name)
            if memory is None:
                _MEMORY.clear()
                memory = _MEMORY[self.name] = _Memory()
            elif len(memory.code) > REMEMBERED:
                memory.shrink(REMEMBERED // 2)
            words = [split(t) if t else [] for t in texts.to_pylist()]
            n_words = np.fromiter(map(len, words), np.int64, len(words))
            of = np.fromiter(map(memory.code.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
            if memory.code.fresh:
                memory.add(self.resolve(memory.code.fresh)[0])
            memory.used(of)
            length = memory.length[of]
            flat = memory.ids[_gather(memory.start[of], length)]
            ends = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(n_words)))]
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

        return encode

    def decode(self, ids: pa.Array) -> pa.Array:
        """Bytes of each id list."""
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        off = np.asarray(ids.offsets, np.int64)
        flat = np.asarray(ids.values.fill_null(-1), np.int64)[off[0]:off[-1]]
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.length) or (self.length[flat] < 0).any()):
            raise ValueError("an id outside the vocabulary")
        length = self.length[flat]
        out = self.bytes[_gather(self.start[flat], length)] if len(flat) else np.zeros(0, np.uint8)
        ends = np.concatenate(([0], np.cumsum(length)))[off - off[0]]
        if ids.null_count:
            return pa.array([out[a:b].tobytes() if ok else None
                             for a, b, ok in zip(ends[:-1], ends[1:], ids.is_valid().to_pylist())], pa.binary())
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                             pa.py_buffer(out.tobytes())])


def encode(df: DataFrame, encoder: Encoder, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` plus ``ids array<int>``."""
    def make():
        fn = encoder.batch_encoder()
        return lambda texts: [fn(texts)]
    return annotate(df, text_col, make, "ids array<int>", keep, OWNER)


def decode(df: DataFrame, encoder: Encoder, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` plus ``decoded binary``."""
    return annotate(df, ids_col, lambda: lambda ids: [encoder.decode(ids)], "decoded binary", keep, OWNER)


def round_trip(df: DataFrame, encoder: Encoder, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` plus ``ids array<int>`` and ``decoded binary``, the ids decoded again, in one pass."""
    def make():
        fn = encoder.batch_encoder()

        def both(texts):
            ids = fn(texts)
            return [ids, encoder.decode(ids)]
        return both
    return annotate(df, text_col, make, "ids array<int>, decoded binary", keep, OWNER)


def public_encoder() -> Encoder:
    import public_tokenizers
    return Encoder(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def digests(docs: DataFrame, encoder: Encoder) -> DataFrame:
    rows = round_trip(docs.select("doc_id", "text"), encoder, keep=["doc_id"])
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_encoder())
