import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from haulage.llm import op06_byte_bpe as op

from helpers import LONG, ROWS, docs

SF = "/root/testdata/sf0.001"
ENCODER = op.public_encoder()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.ranks, special_tokens={})
TEXTS = ["", " ", "a", "hello world", "  two  spaces ", "don't 'LL", "日本語 🙂👍🏽", "é" * 50, "ab" * 4000, "\x00\xff\x1c\x85", "1234567890 ½²",
         "<|endoftext|>", "\r\n\t\n", LONG]


def _encode(texts):
    return ENCODER.batch_encoder()(pa.array(texts, pa.string()))


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(text):
    ids = _encode([text])
    assert ids.to_pylist() == [LIBRARY.encode_ordinary(text)]
    assert ENCODER.decode(ids).to_pylist() == [text.encode()]


def test_random_bytes_merge_as_in_the_library():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("etaoin shrdlu'éß") for _ in range(rng.randint(1, 30)))
        assert _encode([word]).to_pylist() == [LIBRARY.encode_ordinary(word)]


def test_perfect_hash_is_minimal_and_rejects_others():
    keys = sorted(ENCODER.ranks, key=ENCODER.ranks.__getitem__)
    t = ENCODER.table
    assert sorted(t.key.tolist()) == list(range(len(keys)))
    data, off = op._strings(keys)
    assert t.find(data, off).tolist() == list(range(len(keys)))
    data, off = op._strings([b"notinvocabulary!", b"", b"zzzzqq", keys[300]])
    assert t.find(data, off).tolist() == [-1, -1, -1, 300]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_perfect_hash_of_few_keys(n):
    keys = [f"key{i}".encode() for i in range(n)]
    assert op.PerfectHash(keys).find(*op._strings(keys)).tolist() == list(range(n))


def test_memory_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 3)
    fn = ENCODER.batch_encoder()
    for text in ("one two three four", "five six", "one two"):
        assert fn(pa.array([text])).to_pylist() == [LIBRARY.encode_ordinary(text)]


def test_memory_keeps_what_is_used_most_when_full(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 4)
    op._MEMORY.clear()
    fn = ENCODER.batch_encoder()
    for text in ("often again often again often", "rare seldom scarce", "often again"):
        assert fn(pa.array([text])).to_pylist() == [LIBRARY.encode_ordinary(text)]
    memory = op._MEMORY[ENCODER.name]
    assert {" often", " again"} <= set(memory.code) and " rare" not in memory.code
    assert list(memory.code.values()) == list(range(len(memory.code))) == list(range(len(memory.uses)))


def test_memory_of_a_worker_stays_bounded(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 50)
    op._MEMORY.clear()
    fn = ENCODER.batch_encoder()
    for i in range(40):
        text = " ".join(f"w{i}x{j}" for j in range(20))
        assert fn(pa.array([text, None])).to_pylist() == [LIBRARY.encode_ordinary(text), []]
    memory = op._MEMORY[ENCODER.name]
    assert len(memory.code) == len(memory.start) == len(memory.length) <= 200 and len(memory.ids) <= 1000


def test_decode_nulls_and_unknown_ids():
    assert ENCODER.decode(pa.array([[64], None, []], pa.list_(pa.int32()))).to_pylist() == [ENCODER.bytes[ENCODER.start[64]:ENCODER.start[64] + 1].tobytes(), None, b""]
    with pytest.raises(ValueError):
        ENCODER.decode(pa.array([[10 ** 6]], pa.list_(pa.int32())))


def test_edge_rows_and_clashing_names(spark):
    df = docs(spark).withColumn("IDS", F.lit("x")).withColumn("decoded", F.lit(1))
    out = op.decode(op.encode(df, ENCODER), ENCODER).collect()
    again = op.round_trip(df, ENCODER)
    assert again.columns == op.decode(op.encode(df, ENCODER), ENCODER).columns
    assert sorted(map(str, again.collect())) == sorted(map(str, out))
    assert len(out) == len(ROWS)
    for r in out:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_empty_table(spark):
    assert op.digests(docs(spark, []), ENCODER).collect() == []


def test_query_against_the_library(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    out = {r.doc_id: r for r in op.op6_byte_bpe(spark, SF).collect()}
    assert len(out) == len(t)
    for row in t:
        ids, r = LIBRARY.encode_ordinary(row["text"] or ""), out[row["doc_id"]]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((row["text"] or "").encode()).hexdigest()
