"""Token counts without token ids.

Each batch of documents is split into pre-tokens; it keeps a dictionary of its
distinct pre-tokens and, per document, their frequencies. The dictionaries
are dealt by a hash of the pre-token, so each distinct pre-token of the corpus
is counted once, in one place. The counts go back to their batches and are
summed over the frequencies. No list of ids is ever built for a text.

The vocabulary is a word BPE in the ``tokenizers`` format: NFC, lower case,
a splitting pattern, and byte-level merges with word ends. Special strings
inside a text count as one token each, as the library does by default.

Edge rows: a null or empty text has 0 bytes and 0 tokens; a null id stays
null; repeated rows are counted each; an empty table gives no rows; other
columns are not read. A batch holds at least one document, so one very long
text makes a large batch.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import prepare, store
from haulage.llm.registry import query, table

BATCH_BYTES = 32 << 20  # text of one batch
BUCKETS = 16            # parts that the dictionaries are dealt to, at least

# White space below U+0250 as the vocabulary's pattern language has it.
_SPACE = "\\t-\\r \\x85\\xa0"


class Splitter:
    """Pre-tokens of a text, as the vocabulary's normalizer and pattern give them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        first, second = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or first["type"] != "Split" or second["type"] != "ByteLevel":
            raise ValueError("a vocabulary of another kind")
        pattern = first["pattern"]["Regex"]
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # for Latin text the same rules in Python, about five times as fast
        self.latin = regex.compile(pattern.replace("\\s", _SPACE)).findall
        self.other = re.compile("[^\x00-ɏ]").search
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special) or "(?!)")

    def words(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of special strings)."""
        if "<|" in text:
            parts = self.special.split(text)
            return list(chain.from_iterable(map(self._words, parts))), len(parts) - 1
        return self._words(text), 0

    def _words(self, text: str) -> list[str]:
        if self.other(text):
            plain = self.tokenizer.normalizer.normalize_str(text)
            return [w for w, _ in self.split.pre_tokenize_str(plain)]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.latin(text.lower())

    def pieces(self, word: str) -> int:
        """Tokens of one pre-token."""
        model = self.tokenizer.model
        return sum(len(model.tokenize(w)) for w, _ in self.byte_level.pre_tokenize_str(word))


_BATCHES = ("batch string, bucket int, words array<string>, ids array<long>, n_bytes array<long>, "
               "n_special array<long>, n_distinct array<long>, codes binary, times binary")


class _Codes(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word):
        code = self[word] = len(self)
        return code


class _Batch:
    """Documents of one batch: word frequencies as codes into the batch's dictionary."""

    def __init__(self):
        self.code, self.size = _Codes(), 0
        self.ids, self.n_bytes, self.n_special, self.n_distinct, self.codes, self.times = [], [], [], [], [], []

    def add(self, i, words: list[str], n_bytes: int, n_special: int) -> None:
        of = np.fromiter(map(self.code.__getitem__, words), np.int32, len(words))
        codes, times = np.unique(of, return_counts=True)
        for part, x in ((self.ids, i), (self.n_bytes, n_bytes), (self.n_special, n_special), (self.n_distinct, len(codes)),
                        (self.codes, codes), (self.times, times.astype(np.int32))):
            part.append(x)
        self.size += n_bytes + 64

    def rows(self, buckets: int) -> pa.RecordBatch:
        """One row with the documents, and one per bucket with its part of the dictionary."""
        name = uuid.uuid4().hex
        words = list(self.code)
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int64, len(words))
        by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        order = by_word[np.argsort(bucket[by_word], kind="stable")]
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        zstd = pa.Codec("zstd", compression_level=1)
        pack = lambda a: len(a).to_bytes(8, "little") + zstd.compress(a.tobytes(), asbytes=True)
        flat = lambda parts: np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)
        out = [{"batch": name, "ids": self.ids, "n_bytes": self.n_bytes, "n_special": self.n_special,
                "n_distinct": self.n_distinct, "codes": pack(rank[flat(self.codes)]), "times": pack(flat(self.times))}]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            if cut[b + 1] > cut[b]:
                out.append({"batch": name, "bucket": b, "words": [words[i] for i in order[cut[b]:cut[b + 1]].tolist()]})
        return pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("batch", pa.string()), ("bucket", pa.int32()), ("words", pa.list_(pa.string())), ("ids", pa.list_(pa.int64())),
            ("n_bytes", pa.list_(pa.int64())), ("n_special", pa.list_(pa.int64())), ("n_distinct", pa.list_(pa.int64())),
            ("codes", pa.binary()), ("times", pa.binary())]))


def _unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(raw[8:], n * 4, asbytes=True), np.int32)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = BATCH_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_bytes, n_tokens), one row per row of ``df``, for the vocabulary file at ``path``."""
    spark = df.sparkSession
    prepare(spark)
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    # parts grow with the batches, so that a part stays small
    buckets = max(buckets, 2 * src.rdd.getNumPartitions())

    def split(batches):
        splitter = Splitter(path)
        held = _Batch()
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for i, text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), lengths):
                if held.size and held.size + n > batch_bytes:
                    yield held.rows(buckets)
                    held = _Batch()
                words, special = splitter.words(text or "")
                held.add(i, words, n, special)
        if held.ids:
            yield held.rows(buckets)

    # written down, as the batch names are made up: a lost executor must not make others
    parts = store(src.mapInArrow(split, _BATCHES), "token-counts", "zstd")

    def count(rows: pa.Table) -> pa.Table:
        splitter = Splitter(path)
        known: dict[str, int] = {}
        out = []
        for words in rows.column("words").to_pylist():
            for w in words:
                if w not in known:
                    known[w] = splitter.pieces(w)
            out.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)).tobytes())
        return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "pieces": pa.array(out, pa.binary())})

    pieces = (parts.where("bucket is not null").select("batch", "bucket", "words").groupBy("bucket")
              .applyInArrow(count, "batch string, bucket int, pieces binary"))

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sorted(zip(right.column("bucket").to_pylist(), right.column("pieces").to_pylist()))
        count_of = np.frombuffer(b"".join(p for _, p in found), np.int32).astype(np.int64)
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        codes, times = _unpack(row["codes"]), _unpack(row["times"])
        of = np.repeat(np.arange(len(row["ids"])), row["n_distinct"])
        total = np.zeros(len(row["ids"]), np.int64)
        np.add.at(total, of, count_of[codes] * times)
        total += np.asarray(row["n_special"], np.int64)
        return pa.table({"id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(row["n_bytes"], pa.int64()),
                         "n_tokens": pa.array(total)})

    docs = parts.where("bucket is null").select("batch", "ids", "n_bytes", "n_special", "n_distinct", "codes", "times")
    return (docs.groupBy("batch").cogroup(pieces.groupBy("batch"))
            .applyInArrow(add_up, "id long, n_bytes long, n_tokens long"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
