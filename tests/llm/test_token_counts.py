import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulage.llm import op05_token_counts as op

from helpers import ROWS, docs

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def _want(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["<|endoftext|> a <|startoftext|>b<|x|>", " <|endoftext|>", "ΑΣ Σ aΣ", "İi", "e\u0301 é", "a\x1cb\x85c\xa0d",
                                  "don't 'S we'LL", "１２ ½ ²", "日本語 🙂👍🏽", "a" * 5000, "\x00\x01", "ß ŉ Ǆ"])
def test_splitting_equals_the_library(text):
    s = op.Splitter(PATH)
    words, special = s.words(text)
    assert sum(map(s.pieces, words)) + special == _want(text)


def test_every_latin_character_in_context():
    s = op.Splitter(PATH)
    for c in range(0x250):
        text = f"a{chr(c)}{chr(c)}b '{chr(c)}1{chr(c)} {chr(c)}"
        words, special = s.words(text)
        assert sum(map(s.pieces, words)) + special == _want(text), hex(c)


def test_edge_rows_and_small_batches(spark):
    want = sorted(((r[0], len((r[1] or "").encode()), _want(r[1])) for r in ROWS), key=str)
    for batch in (1, 1 << 20):
        out = op.count_tokens(docs(spark).withColumn("bucket", F.lit(1)), PATH, batch_bytes=batch, buckets=3).collect()
        assert sorted(((r.id, r.n_bytes, r.n_tokens) for r in out), key=str) == want


def test_empty_table(spark):
    assert op.count_tokens(docs(spark, []), PATH).collect() == []


def test_query_against_the_library(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {r["doc_id"]: (len((r["text"] or "").encode()), _want(r["text"])) for r in t}
    out = op.op5_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in out} == want and len(out) == len(t)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in out)
