import tiktoken
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from haulage.llm import op02_secret_crf, op06_byte_bpe

from helpers import ROWS, classes, docs
from test_decontaminate import _bag, _words, brute
from test_secret_crf import plain_spans

SF = "/root/testdata/sf0.001"


def _masked(text):
    out, at = [], 0
    for s, _, e in plain_spans(text or ""):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], "[secret]"]
        at = e
    return "".join(out) + (text or "")[at:] if out else text


def test_run_against_a_brute_force_version(spark):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    ids = classes([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r, c in zip(rows, ids) if c == r["doc_id"]]
    seeds = {g for _, t in bench for g in _bag(_words(t), 5)}
    rows = [r for r in rows if not (seeds & set(_bag(_words(r["text"]), 5)) and brute(r["text"], bench))]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=op06_byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {}
    for r in rows:
        text = _masked(r["text"])
        want[r["doc_id"]] = (r["lang"], r["source"], len(text) if text != r["text"] else r["n_chars"], library.encode_ordinary(text or ""))
    out = pipe.run(spark, SF).collect()
    got = {r.doc_id: (r.lang, r.source, r.n_chars, r.ids) for r in out}
    assert len(out) == len(got) and set(got) == set(want)
    assert sum(got[i] == want[i] for i in want) == len(want)  # the field adds no span here
    assert all(r.intact and r.n_tokens == len(r.ids) for r in out)


def test_each_stage_on_edge_rows(spark):
    df = docs(spark).withColumn("IDS", F.lit(1)).withColumn("row_key", F.lit("x")).withColumn("spans", F.lit(0)).withColumn("leaks", F.lit(0))
    for name, stage in pipe.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == pipe.COLUMNS, name
        assert out.dtypes == docs(spark).dtypes, name
    rows = pipe.byte_bpe(spark, df, SF).collect()
    assert len(rows) == len(ROWS) and all(r.intact for r in rows)


def test_near_duplicates_keep_one_of_each(spark):
    out = pipe.near_duplicates(spark, docs(spark), SF).collect()
    ids = sorted((r.doc_id for r in out if r.doc_id is not None))
    assert ids == [1, 4, 5, 6, 7, 9, 10, 11] and sum(r.doc_id is None for r in out) == 1


def test_repeated_rows_leave_one(spark):
    rows = [(7, "alpha beta gamma delta epsilon zeta", "en", "a", 1)] * 3
    assert pipe.near_duplicates(spark, docs(spark, rows), SF).count() == 1


def test_language_stage_rejects_only_rows_without_evidence(spark):
    out = pipe.language_id(spark, docs(spark), SF).collect()
    with_words = lambda t: bool(t and t.strip())
    assert sorted(str(r.doc_id) for r in out if with_words(r.text)) == sorted(str(r[0]) for r in ROWS if with_words(r[1]))
    assert all(not (r.text is None and r.lang is None) for r in out)


def test_empty_documents(spark):
    df = docs(spark, [])
    for _, stage in pipe.STAGES:
        assert stage(spark, df, SF).count() == 0


def test_stages_are_five_and_named():
    assert [n for n, _ in pipe.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "byte_bpe"]
    assert op02_secret_crf.KINDS[:3] == ("assign", "access", "hex")
