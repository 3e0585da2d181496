"""Benchmark decontamination: item-sized windows, SimHash, exact check.

A window is a run of as many words of a document as the benchmark item has
(the whole document, if that is shorter). Words are runs of letters and digits
in lower case. The steps for a document and an item:

1. A window can only be similar if it shares a five-word shingle with the
   item, so windows are taken around shared shingles. This loses nothing: a
   window without a shared shingle has similarity 0.
2. Each window gets a 64-bit SimHash over its weighted shingles. Multi-index
   lookup: the 64 bits are cut into 7 blocks, and two fingerprints within
   RADIUS = 20 bits agree up to 2 bits in at least one block, so looking up
   each block's values with up to 2 changed bits finds every item within the
   radius. The full distance is then checked.
3. Exact weighted-shingle similarity, sum of minima over sum of maxima of the
   shingles' multiplicities, decides at 0.8.

The items are read in blocks of at most BLOCK_ITEMS, which bounds what is sent
to the tasks; each block scans the documents once. The scan is map-only: no
shuffle, so frequent passages and large groups of copies cost no more than
other documents.

Edge rows: a null or empty document, or a null or empty item, matches
nothing. An item of fewer than five words is one shingle, its whole sequence;
windows of that many words are compared. Repeated items and documents are
each reported. An empty table on either side gives no hits; an input column
that is named like the result column is replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import annotate, chunks, mix, shingles_of, text_buffer, words_of
from haulage.llm.registry import query, table

K = 5               # words in a shingle
SIMILARITY = 0.8
RADIUS = 20         # bits; 0.8 weighted Jaccard of equal sizes flips 9.7 of 64 bits on average, deviation 2.9
BLOCK_BITS = (10, 9, 9, 9, 9, 9, 9)
BLOCK_RADIUS = 2    # 7 blocks * (2 + 1) > RADIUS, so one block differs in at most 2 bits
BLOCK_ITEMS = 20_000  # items of about 50 words: 20,000 * 50 shingles * 8 bytes = 8 MB

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def shingle_lists(texts: pa.Array, k: int = K):
    """Per chunk of rows: (first row, words per row, shingle row, hash, first word of each shingle)."""
    lower = pa.array([t.lower() if t else "" for t in texts.to_pylist()], pa.string())
    data, off = text_buffer(lower)
    for a, b in chunks(off):
        _, _, row, word = words_of(data[off[a]:off[b]], off[a:b + 1] - off[a], _WORD)
        n = np.bincount(row, minlength=b - a)
        yield a, n, row, word


def simhash(counts: np.ndarray) -> np.ndarray:
    """Fingerprints from signed sums, one row of 64 each."""
    return ((counts > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _bits(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of a shingle hash's 64 bits."""
    h = mix(h ^ np.uint64(0x6A09E667F3BCC908))
    return ((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32) * 2 - 1


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of ``size`` shingles."""
    total = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_bits(h), axis=0, dtype=np.int32)))
    return simhash(total[size:] - total[:-size])


class MultiIndex:
    """Fingerprints found by block values with up to BLOCK_RADIUS changed bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.tables = []
        shift = 0
        for bits in BLOCK_BITS:
            value = ((prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            change = [x for x in range(1 << bits) if x.bit_count() <= BLOCK_RADIUS]
            near: dict[int, list[int]] = {}
            for i, v in enumerate(value.tolist()):
                for c in change:
                    near.setdefault(v ^ c, []).append(i)
            self.tables.append((shift, bits, {v: np.array(x) for v, x in near.items()}))
            shift += bits

    def within(self, prints: np.ndarray, radius: int = RADIUS):
        """Pairs (position, item) of all fingerprints within the radius."""
        out = []
        for shift, bits, near in self.tables:
            value = ((prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            for v in np.unique(value).tolist():
                items = near.get(v)
                if items is not None:
                    at = np.flatnonzero(value == v)
                    far = np.bitwise_count(prints[at][:, None] ^ self.prints[items][None, :])
                    p, i = np.nonzero(far <= radius)
                    out.append(np.stack((at[p], items[i]), axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both) if both else 0.0


class Items:
    """A block of benchmark items, by window size."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.by_size: dict[int, dict] = {}
        hashes, sizes, owners = [], [], []
        for a, n, row, word in shingle_lists(pa.array(texts, pa.string())):
            for size in np.unique(n[n > 0]).tolist():
                group = self.by_size.setdefault(size, {"items": [], "bags": [], "prints": []})
                k = min(K, size)
                for i in np.flatnonzero(n == size).tolist():
                    _, h, _ = shingles_of(np.zeros(size, np.int64), word[row == i], 1)
                    group["items"].append(a + i)
                    group["bags"].append(Counter(h.tolist()))
                    group["prints"].append(windows(h, len(h))[0])
                    hashes.append(h)
                    sizes.append(np.full(len(h), size))
                    owners.append(np.full(len(h), k))
        for group in self.by_size.values():
            group["index"] = MultiIndex(np.array(group.pop("prints"), np.uint64))
        all_h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        all_s = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        # per shingle the window sizes of the items that hold it
        order = np.lexsort((all_s, all_h))
        pair = np.stack((all_h[order], all_s[order].astype(np.uint64)), axis=1)
        pair = np.unique(pair, axis=0) if len(pair) else pair
        self.seed, self.seed_size = pair[:, 0], pair[:, 1].astype(np.int64)
        self.some = np.zeros(1 << 20, bool)  # most shingles are told apart by 20 of their bits
        self.some[(self.seed >> np.uint64(44)).astype(np.int64)] = True
        self.short = sorted(s for s in self.by_size if s < K)


def _shared(items: Items, h: np.ndarray):
    """(position, window size) for each shingle that an item holds too."""
    at = np.flatnonzero(items.some[(h >> np.uint64(44)).astype(np.int64)])
    lo = np.searchsorted(items.seed, h[at], side="left")
    hi = np.searchsorted(items.seed, h[at], side="right")
    many = hi - lo
    start = np.repeat(lo - (np.cumsum(many) - many), many)
    return np.repeat(at, many), items.seed_size[start + np.arange(int(many.sum()))]


def _scan(items: Items, h: np.ndarray, n_words: int, size: int, at: np.ndarray, k: int, best: dict) -> None:
    """Windows of ``size`` words around the shared shingles at ``at`` of one document."""
    run = min(size, n_words) - k + 1  # shingles in a window
    first, last = np.maximum(at - run + 1, 0), np.minimum(at, len(h) - run)
    group = items.by_size[size]
    joined = np.maximum.accumulate(last)
    cut = np.flatnonzero(first[1:] > joined[:-1] + 1) + 1  # runs of window starts that don't touch
    for a, b in zip(np.append(0, cut), np.append(cut, len(first))):
        lo, hi = int(first[a]), int(joined[b - 1])
        part = h[lo:hi + run]
        bag_at, bag = None, None
        for p, i in group["index"].within(windows(part, run)).tolist():
            if p != bag_at:
                bag_at, bag = p, Counter(part[p:p + run].tolist())
            s = weighted_similarity(bag, group["bags"][i])
            key = group["items"][i]
            if s >= SIMILARITY and s > best.get(key, (0.0, 0))[0]:
                best[key] = (s, lo + p)


def leaks_in(items: Items, texts: pa.Array) -> list[list[dict]]:
    """Per text its items with the best window: item, similarity, first word, words."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for a, n, row, word in shingle_lists(texts):
        n_rows = len(n)
        found: dict[int, dict] = {}
        plans = [(K, None)] + [(s, s) for s in items.short]
        for k, only in plans:
            s_row, h, _ = shingles_of(row, word, n_rows, k) if only is None else _exact_runs(row, word, n_rows, k)
            begin = np.concatenate(([0], np.cumsum(np.bincount(s_row, minlength=n_rows))))
            at, size = _shared(items, h)
            keep = size >= K if only is None else size == only
            at, size = at[keep], size[keep]
            if only is None:  # a document of fewer words has one shingle, which no longer item holds
                keep = n[s_row[at]] >= K
                at, size = at[keep], size[keep]
            order = np.lexsort((at, size, s_row[at]))
            at, size = at[order], size[order]
            r = s_row[at]
            edge = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (size[1:] != size[:-1])))) if len(at) else []
            for lo, hi in zip(edge, np.append(edge[1:], len(at)) if len(at) else []):
                d = int(r[lo])
                _scan(items, h[begin[d]:begin[d + 1]], int(n[d]), int(size[lo]), at[lo:hi] - begin[d], k, found.setdefault(d, {}))
        for d, best in found.items():
            out[a + d] = [{"item_id": items.ids[i], "similarity": s, "first_word": w} for i, (s, w) in sorted(best.items())]
    return out


def _exact_runs(row: np.ndarray, word: np.ndarray, n_rows: int, k: int):
    """Hashes of all runs of k < K words, made as the shingle of a text of k words is."""
    n = np.bincount(row, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(len(word))
    first = at[at + k <= begin[row + 1]] if len(word) else at
    text = word[(first[:, None] + np.arange(k)).reshape(-1)]
    r, h, _ = shingles_of(np.repeat(np.arange(len(first)), k), text, len(first)) if len(first) else (at, np.zeros(0, np.uint64), at)
    return row[first], h, first


_FOUND = "leaks array<struct<item_id: bigint, similarity: double, first_word: bigint>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", keep: list[str] | None = None, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` plus ``leaks``: the items found in each text, with the best window of each."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))
    bench = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    n_blocks = max(1, -(-bench.count() // block_items))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out, names = docs, list(docs.columns if keep is None else keep)
    own = "leaks"  # a prefix that no column of the input begins with
    while any(c.lower().startswith(own) for c in docs.columns):
        own = "_" + own
    for b in range(n_blocks):
        rows = bench.where(part == b).collect()  # at most about block_items rows
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows])

        def make(items=items):
            return lambda texts: [pa.array([[{x: y[x] for x in ("item_id", "similarity", "first_word")} for y in f]
                                            for f in leaks_in(items, texts)], kind)]
        held = [c for c in out.columns if c in names or c == text_col or c.startswith(f"{own}_")]
        out = annotate(out, text_col, make, _FOUND, keep=held).withColumnRenamed("leaks", f"{own}_{b}")
    blocks = [F.col(f"{own}_{b}") for b in range(n_blocks)]
    merged = blocks[0] if n_blocks == 1 else F.concat(*blocks)
    return out.select(*[F.col(f"`{c}`") for c in names if c.lower() != "leaks"], merged.alias("leaks"))


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
