import pyarrow as pa
import pytest

import numpy as np

from haulage.llm import common

from helpers import DOCS, docs


def test_word_hashes_tell_words_apart_and_ignore_case():
    texts = pa.array(["ab ba", "AB\tab", None, "", "a b ab é É"])
    data, off = common.text_buffer(texts)
    start, end, row, h = common.words_of(data, off, ~common.WHITE)
    words = [bytes(data[a:b]).lower() if max(data[a:b]) < 128 else bytes(data[a:b]) for a, b in zip(start, end)]
    assert row.tolist() == [0, 0, 1, 1, 4, 4, 4, 4, 4]
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            assert (x == y) == (h[i] == h[j])


def test_words_do_not_run_over_rows():
    data, off = common.text_buffer(pa.array(["ab", "cd"]))
    start, end, row, _ = common.words_of(data, off, ~common.WHITE)
    assert list(zip(start, end, row)) == [(0, 2, 0), (2, 4, 1)]


def test_short_rows_have_one_shingle():
    row = np.array([0, 0, 1, 1, 1, 1, 1, 1])
    word = np.arange(8).astype(np.uint64)
    r, h, first = common.shingles_of(row, word, 3)
    assert r.tolist() == [0, 1, 1] and first.tolist() == [0, 2, 3] and len(set(h.tolist())) == 3


def test_slices_of_arrays():
    whole = pa.array(["aa", "bb", None, "cc"])
    data, off = common.text_buffer(whole.slice(1, 2))
    assert bytes(data) == b"bb" and off.tolist() == [0, 2, 2]


def test_a_worker_forgets_what_other_work_remembered():
    a, b = common.remembered("test-a"), common.remembered("test-b")
    a["x"], b["x"] = 1, 2
    assert list(common.lean(lambda batches: (2 * x for x in batches), "test-a")([1, 2])) == [2, 4]
    assert a == {"x": 1} and b == {} and common.remembered("test-a") is a
    assert list(common.lean(iter)([3])) == [3]
    assert a == {}


def test_other_work_empties_the_encoder_memory():
    from haulage.llm import op06_byte_bpe as op06
    op06._MEMORY["vocabulary"] = "pre-tokens"
    list(common.lean(iter)([]))
    assert not op06._MEMORY


def test_annotate_replaces_clashing_names(spark):
    df = docs(spark).withColumnRenamed("source", "SPANS")
    out = common.annotate(df, "text", lambda: lambda t: [pa.array([0] * len(t))], "spans long")
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "spans"] and out.count() == df.count()


def test_no_local_checkpoint_cross_join_or_machine_folder():
    import pathlib
    import re
    top = pathlib.Path(common.__file__).parent
    for f in [*top.glob("*.py"), top.parents[1] / "corpus_pipeline.py"]:
        assert not re.search(r"localCheckpoint\(|crossJoin\(|except ImportError", f.read_text()), f


def test_native_operator_has_no_python_on_its_path():
    import inspect

    from haulage.llm import blocked_bloom, op10_url_filter
    for module in (op10_url_filter, blocked_bloom):
        assert not any(x in inspect.getsource(module) for x in ("mapIn", "applyIn", "udf(", ".rdd", "pandas", "pyarrow"))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_components_of_paths_and_loops(spark, n):
    from haulage.llm.components import components
    edges = [(i, i + 1) for i in range(n)] + [(100 + i, 100) for i in range(n)] + [(7, 7)] * n
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {x for x in got if x < 100} == set(range(n + 1) if n else ())
    assert all(got[x] == (0 if x < 100 else 100) for x in got)
