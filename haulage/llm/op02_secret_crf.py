"""Secret scan: fixed patterns plus a linear-chain conditional random field.

The patterns give the base spans (assign, access, hex). The field reads a text
as tokens (runs of word characters, runs of other characters) and tags each as
secret begin, inside or outside. Features: the token's shape (length, kinds of
characters, how often they change), the words around it, their shapes, and the
file's density of digits and punctuation. Tags come from Viterbi decoding.
What runs of tokens tagged begin or inside hold outside the base spans is added
as spans of kind ``crf``, if it has at least LEAST_CHARS (8) characters.

Training. The field learns from the base spans of a bounded sample. Documents
are sorted by the kinds of base spans that they hold anywhere in the corpus, or
as clean; of each sort the distinct texts with the smallest hash are taken, at
most SAMPLE_DOCS in all. Of their windows of WINDOW tokens at most
SAMPLE_WINDOWS are used. Each kind of base span, harmless tokens beside them
and clean documents have an equal share of both bounds, and what one leaves
open goes to the others. A document gives DOC_WINDOWS windows of a kind at
most, and its second one only after the first one of every other. The keyword and the quotes
before a value are seen by their hash only, the value by its shape, so it tags
values of the same make in other surroundings.

Decoding is exact. Where a token's score for outside exceeds its other scores
by more than any choice of neighbouring tags can win back, every best path
tags it outside; Viterbi runs over the stretches between such tokens, all
stretches of a batch side by side.

Edge rows: a null or empty text has no spans. Without any base span in the
table there is nothing to learn and the field adds nothing. Repeated rows are
scanned each, a null id changes nothing; an empty table gives an empty result;
an input column named like a result column is replaced. Whole texts are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import _BYTE, _LOWER, _powers, annotate, chunks, lean, mix, prepare, store, text_buffer
from haulage.llm.registry import query, table

KINDS = ("assign", "access", "hex", "crf")

# The patterns of the base spans and their least lengths.
_ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_LEAST = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more; a shorter match has no longer one inside
_HEX = re.compile(r"[0-9a-f]{24,}")         # 24 or more, likewise
# In Spark: true wherever there is a base span, and for a few other texts.
_ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
CLEAN = 3       # sort of a document without a base span
HARMLESS = 4    # kind of a window around a harmless token of a document that has base spans

SAMPLE_DOCS = 10_000
SAMPLE_WINDOWS = 6_000
DOC_WINDOWS = 64   # windows of one kind from a document, at most
WINDOW = 21        # tokens of a training window, the labelled one in the middle
EPOCHS = 12
LEAST_CHARS = 8    # characters of a span that the field adds, at least
OUT, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, sorted."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def value_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the secrets themselves: an assignment's value, else the match."""
    return [(a, b) for a, b, _ in _values(text)]


def _values(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the secrets themselves."""
    out = [(*m.span(2), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    return out + [(*m.span(), 1) for m in _ACCESS.finditer(text)] + [(*m.span(), 2) for m in _HEX.finditer(text)]


# --- tokens and features ----------------------------------------------------

_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 digit, 2 upper, 3 other, 4 lower, 5 joining signs, 6 beyond ASCII
_KIND[:33] = 0
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 1, 2, 4, 6
_KIND[[ord(c) for c in "+/._-"]] = 5
_CLASS = np.array([0, 1, 1, 2, 1, 1, 1], np.uint8)  # of a kind: space, word, punctuation
_VOWEL = np.zeros(256, bool)
_VOWEL[[ord(c) for c in "aeiouAEIOU"]] = True
_HEXDIGIT = np.zeros(256, bool)
_HEXDIGIT[[ord(c) for c in "0123456789abcdef"]] = True

_WORDS = 1 << 12  # buckets of a neighbour's word
# sizes of the feature groups, in the order in which features() makes them
_SIZES = [1, 41, 400, 45, 30, 10, 36, _WORDS, _WORDS, _WORDS, 400, 400, 40, 16]
_FIRST = np.concatenate(([0], np.cumsum(_SIZES)))
PAD = int(_FIRST[-1])
N_FEATURES = PAD + 1


def tokens_of(data: np.ndarray, off: np.ndarray):
    """(start, end, row) of the tokens of a chunk of texts."""
    cls = _CLASS[_KIND[data]]
    new = np.ones(len(data), bool)
    new[1:] = cls[1:] != cls[:-1]
    new[off[:-1][off[:-1] < len(data)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(data))
    real = cls[start] != 0
    start, end = start[real], end[real]
    return start, end, np.searchsorted(off, start, side="right") - 1


def features(data: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Feature numbers, one row of them for each token."""
    n = len(start)
    kind = _KIND[data]

    def count(flags):
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
        return total[end] - total[start], total
    digits, digit_total = count(kind == 1)
    upper, _ = count(kind == 2)
    lower, _ = count(kind == 4)
    vowels, _ = count(_VOWEL[data])
    hexes, _ = count(_HEXDIGIT[data])
    puncts, punct_total = count((kind == 3) | (kind == 5))
    change = np.zeros(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    changes, _ = count(change)
    changes = changes - change[start]
    length = end - start
    power, inverse = _powers(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * power[:len(data)])))
    word = (mix((total[end] - total[start]) * inverse[start]) % np.uint64(_WORDS - 1)).astype(np.int64) + 1
    size = np.searchsorted([4, 8, 16, 24], length, side="left")  # 0..4
    turn = np.searchsorted([1, 2, 4, 8], changes, side="right")  # 0..4
    other = length - digits - upper - lower
    shape = ((((digits > 0) * 2 + (upper > 0)) * 2 + (lower > 0)) * 2 + (other > 0)) * 25 + turn * 5 + size

    def near(values, by):
        """Values of the token ``by`` places on, 0 beyond the document's ends."""
        out = np.zeros(n, np.int64)
        if by < 0 and n > -by:
            out[-by:] = np.where(row[-by:] == row[:by], values[:by], 0)
        elif 0 < by < n:
            out[:-by] = np.where(row[:-by] == row[by:], values[by:], 0)
        return out
    file_bytes = np.maximum(off[1:] - off[:-1], 1)
    dense = np.minimum(40 * (digit_total[off[1:]] - digit_total[off[:-1]]) // file_bytes, 7)[row]
    marks = np.minimum(40 * (punct_total[off[1:]] - punct_total[off[:-1]]) // file_bytes, 7)[row]
    columns = [np.zeros(n, np.int64), np.minimum(length, 40), shape, (8 * digits // length) * 5 + size,
               np.minimum(5 * vowels // length, 5) * 5 + size, (hexes == length) * 5 + size,
               np.minimum(8 * changes // length, 6) * 5 + size, near(word, -1), near(word, -2), near(word, 1),
               near(shape, -1), near(shape, 1), dense * 5 + size, marks * 2 + (digits > 0)]
    return np.stack(columns, axis=1) + _FIRST[:-1]


# --- the field --------------------------------------------------------------

class Field:
    """Weights of a linear-chain conditional random field with three tags."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights.astype(np.float32), steps.astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 3), np.float32)
        for j in range(x.shape[1]):
            out += self.weights[x[:, j]]
        return out

    def decode(self, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best tags of the tokens; the tokens of a row are one sequence, bounded by outside."""
        tags = np.zeros(len(e), np.int8)
        swing = 2 * (self.steps.max() - self.steps.min())
        open_ = np.flatnonzero(e[:, OUT] - e[:, 1:].max(axis=1) <= swing)
        if len(open_) == 0:
            return tags
        begins = np.concatenate(([True], (open_[1:] != open_[:-1] + 1) | (row[open_[1:]] != row[open_[:-1]])))
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(open_)))
        first, size = open_[first], size
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        best = self.steps[OUT][None, :] + e[first]
        back = []
        for s in range(1, int(size[0])):  # stretches that have an s-th token come first
            m = int(np.searchsorted(-size, -s, side="left"))
            way = best[:m, :, None] + self.steps[None]
            back.append(way.argmax(axis=1))
            best[:m] = way.max(axis=1) + e[first[:m] + s]
        tag = (best + self.steps[:, OUT][None, :]).argmax(axis=1)
        # every stretch is followed back from its own last token
        for s in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -s, side="left"))
            tags[first[:m] + s] = tag[:m]
            if s:
                tag[:m] = back[s - 1][np.arange(m), tag[:m]]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by adaptive gradient steps, with marginals from the forward-backward recursion.

    ``x`` (windows, tokens, features) and ``y`` (windows, tokens).
    """
    weights, steps = np.zeros((N_FEATURES, 3)), np.zeros((3, 3))
    weights[0, OUT] = 2.0
    past_w, past_s = np.full(weights.shape, 1e-2), np.full(steps.shape, 1e-2)
    rng = np.random.default_rng(7)
    length = y.shape[1]
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            xs, ys = x[part].astype(np.int64), y[part].astype(np.int64)
            m = len(part)
            e = weights[xs].sum(axis=2)
            fwd, bwd = [e[:, 0]], [np.zeros((m, 3))]
            for t in range(1, length):
                fwd.append(_log_sum(fwd[-1][:, :, None] + steps[None], 1) + e[:, t])
                bwd.append(_log_sum(steps[None] + (e[:, length - t] + bwd[-1])[:, None, :], 2))
            bwd = bwd[::-1]
            z = _log_sum(fwd[-1], 1)
            g = np.eye(3)[ys] - np.exp(np.stack(fwd, 1) + np.stack(bwd, 1) - z[:, None, None])
            gs = np.zeros((3, 3))
            for t in range(1, length):
                pair = fwd[t - 1][:, :, None] + steps[None] + (e[:, t] + bwd[t])[:, None, :] - z[:, None, None]
                gs -= np.exp(pair).sum(axis=0)
                np.add.at(gs, (ys[:, t - 1], ys[:, t]), 1.0)
            gw = np.zeros_like(weights)
            np.add.at(gw, xs.reshape(-1, xs.shape[2]), np.repeat(g.reshape(-1, 3)[:, None, :], xs.shape[2], axis=1))
            gw, gs = gw / m - 1e-4 * weights, gs / m - 1e-4 * steps
            past_w += gw * gw
            past_s += gs * gs
            weights += 0.3 * gw / np.sqrt(past_w)
            steps += 0.3 * gs / np.sqrt(past_s)
    return Field(weights, steps)


def _byte_places(text: str, values: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Byte spans of sorted values, in one walk along the text."""
    place, at = {0: 0}, 0
    for p in sorted({p for a, b, _ in values for p in (a, b)}):
        place[p] = place[at] + len(text[at:p].encode())
        at = p
    return [(place[a], place[b]) for a, b, _ in values]


def training_windows(text: str) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, number within the kind, features, tags) around base spans and around one harmless token.

    Feature numbers stay below 2**16 and are kept in two bytes.
    """
    data, off = text_buffer(pa.array([text]))
    start, end, row = tokens_of(data, off)
    if len(start) == 0:
        return []
    x = features(data, off, start, end, row)
    y = np.zeros(len(start), np.int64)
    middles: list[list[int]] = [[], [], []]
    values = sorted(_values(text))
    for (_, _, kind), (a, b) in zip(values, _byte_places(text, values)):
        first, last = int(np.searchsorted(end, a, side="right")), int(np.searchsorted(start, b, side="left"))
        y[first:last] = INSIDE
        y[first:min(first + 1, last)] = BEGIN
        middles[kind].extend([first] if last > first else [])
    digits = np.flatnonzero(x[:, 2] >= _FIRST[2] + 200)  # tokens with a digit, often alike but harmless
    plain = digits[y[digits] == OUT]
    harmless = int(plain[len(text) % len(plain)]) if len(plain) else len(text) % len(start)
    out = []
    for kind, places in [*enumerate(middles), (HARMLESS if values else CLEAN, [harmless])]:
        # evenly over the document, if it has more
        spread = np.unique(np.linspace(0, len(places) - 1, min(len(places), DOC_WINDOWS)).astype(int)) if places else []
        for i, c in enumerate(places[j] for j in spread):
            at = np.arange(c - WINDOW // 2, c + WINDOW // 2 + 1)
            inside = (at >= 0) & (at < len(start))
            xs = np.full((WINDOW, x.shape[1]), PAD, np.uint16)
            ys = np.zeros(WINDOW, np.uint8)
            xs[inside], ys[inside] = x[at[inside]], y[at[inside]]
            out.append((kind, i, xs, ys))
    return out


def shares(sizes: list[int], total: int) -> list[int]:
    """Equal shares of ``total``; what one doesn't need goes to the others."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: sizes[k])
    for at, k in enumerate(order):
        out[k] = min(sizes[k], -(-(total - sum(out)) // (len(sizes) - at)))
    return out


def _sorts(batches):
    """(sort, h) of rows (h, text); a null text stands for a clean one."""
    for batch in batches:
        found = set()
        for h, text in zip(*(c.to_pylist() for c in batch.columns)):
            kinds = {k for _, _, k in _values(text)} if text else ()
            found.update((k, h) for k in kinds or (CLEAN,))
        if found:
            kind, h = zip(*sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(h, pa.int64())], names=["sort", "h"])


def _cut(batches):
    for batch in batches:
        for h, text in zip(*(c.to_pylist() for c in batch.columns)):
            for kind, i, xs, ys in training_windows(text):
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([kind], pa.int32()), pa.array([i], pa.int32()),
                                                  pa.array([xs.tobytes()]), pa.array([ys.tobytes()])], names=["h", "kind", "i", "x", "y"])


def sample(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> list:
    """Rows (kind, x, y) of the windows to learn from; none if no document has a base span."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(text.alias("text")).where("text <> ''").select("text", F.xxhash64("text").alias("h"))
    sorts = store(rows.select("h", F.when(F.col("text").rlike(_ANY), F.col("text")).alias("text"))
                  .mapInArrow(lean(_sorts), "sort int, h long").distinct(), "secret-sorts")
    first = [[r["h"] for r in sorts.where(F.col("sort") == k).select("h").orderBy("h").limit(sample_docs).collect()] for k in range(CLEAN + 1)]
    if not any(first[:CLEAN]):
        return []
    taken = sorted({h for f, n in zip(first, shares([len(f) for f in first], sample_docs)) for h in f[:n]})
    # at most sample_docs hashes; equal texts count once
    chosen = F.broadcast(spark.createDataFrame(pa.table({"h": pa.array(taken, pa.int64())})))
    made = store(rows.join(chosen, "h", "left_semi").dropDuplicates(["h"]).select("h", "text")
                 .mapInArrow(lean(_cut), "h long, kind int, i int, x binary, y binary"), "secret-windows")
    held = {r["kind"]: r["count"] for r in made.groupBy("kind").count().collect()}
    sizes = [held.get(k, 0) for k in range(HARMLESS + 1)]
    # in an order that depends on the texts alone
    return [r for k, n in enumerate(shares(sizes, sample_windows)) if n
            for r in made.where(F.col("kind") == k).orderBy("i", "h").limit(n).select("kind", "x", "y").collect()]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_windows: int = SAMPLE_WINDOWS) -> Field | None:
    """The field trained on a bounded sample of ``docs``; None if no document holds a secret."""
    prepare(docs.sparkSession)
    kept = sample(docs, text_col, sample_docs, sample_windows)
    if not kept:
        return None
    x = np.frombuffer(b"".join(r["x"] for r in kept), np.uint16).reshape(len(kept), WINDOW, -1)
    return train(x, np.frombuffer(b"".join(r["y"] for r in kept), np.uint8).reshape(len(kept), WINDOW))


def field_spans(field: Field, texts: pa.Array) -> list[list[tuple[int, int]]]:
    """Byte spans that the field tags, per text."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    data, off = text_buffer(texts)
    for a, b in chunks(off):
        part, part_off = data[off[a]:off[b]], off[a:b + 1] - off[a]
        start, end, row = tokens_of(part, part_off)
        if len(start) == 0:
            continue
        tags = field.decode(field.scores(features(part, part_off, start, end, row)), row)
        hit = np.flatnonzero(tags)
        last = None
        for i in hit.tolist():
            r = int(row[i])
            base = int(part_off[r])
            if tags[i] == INSIDE and last == (i - 1, r) and start[i] == end[i - 1]:
                out[a + r][-1] = (out[a + r][-1][0], int(end[i]) - base)
            else:
                out[a + r].append((int(start[i]) - base, int(end[i]) - base))
            last = (i, r)
    return out


def _outside(s: int, e: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of s..e that no base span (sorted by start) covers."""
    out = []
    for s2, _, e2 in base:
        if s2 >= e:
            break
        if s2 > s:
            out.append((s, s2))
        s = max(s, e2)
    return [*out, (s, e)] if s < e else out


def all_spans(field: Field | None, texts: pa.Array) -> list[list[dict]]:
    """Base spans and the field's, per text, by start and kind; places count code points."""
    tagged = field_spans(field, texts) if field is not None else [[] for _ in range(len(texts))]
    out = []
    for text, extra in zip(texts.to_pylist(), tagged):
        spans = base_spans(text) if text else []
        base = list(spans)
        if extra:
            raw = text.encode()
            for s, e in extra:
                s = len(raw[:s].decode())
                e = s + len(raw[len(text[:s].encode()):e].decode())
                spans.extend((a, 3, b) for a, b in _outside(s, e, base) if b - a >= LEAST_CHARS)
            spans.sort()
        out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
    return out


def find_secrets(docs: DataFrame, field: Field | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``spans array<struct<kind, start, end>>``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def make():
        return lambda texts: [pa.array(all_spans(field, texts), kind)]
    return annotate(docs, text_col, make, "spans array<struct<kind: string, start: bigint, end: bigint>>", keep)


def mask(text, spans, mark: str = "[secret]"):
    """Column: ``text`` with each span replaced by ``mark`` (overlapping spans by one mark)."""
    step = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                     F.when(s["start"] >= acc["at"], F.lit(mark)).otherwise(F.lit(""))).alias("out"), s["end"].alias("at"))))
    return F.when(F.size(spans) > 0, F.concat(step["out"], F.substring(text, (step["at"] + 1).cast("int"), F.length(text)))).otherwise(text)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op2_secret_crf")
def op2_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, learn(docs), keep=["doc_id"])
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), n("crf"))
