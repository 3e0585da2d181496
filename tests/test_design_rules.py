"""Guards for the design rules: no lineage-less checkpoints, no cross joins,
no Python UDFs, no driver-side collection in library code."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parents[1] / "haulage"
# haulage/llm has rules of its own (tests/llm)
SOURCES = {p: p.read_text() for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts}


def _hits(pattern):
    rx = re.compile(pattern)
    return [f"{p.relative_to(LIB)}:{i + 1}" for p, s in SOURCES.items()
            for i, line in enumerate(s.splitlines()) if rx.search(line) and not line.strip().startswith("#")]


def test_no_local_checkpoint_or_cross_join():
    assert _hits(r"localCheckpoint\(") == []
    assert _hits(r"\.crossJoin\(") == []


def test_no_python_udfs():
    assert _hits(r"@F\.udf|F\.udf\(|pandas_udf|\.udf\.register") == []


def test_no_driver_collection_in_library():
    # allowed: a row per pair of columns, and the bins of a histogram scan (bins x ranges x columns rows)
    hits = _hits(r"\.collect\(\)|\.toPandas\(\)|\.take\(")
    assert sorted(h.split(":")[0] for h in hits) == ["operators/gram.py", "operators/selection.py"], hits


def test_unpartitioned_windows_are_only_over_bounded_inputs():
    # Window.orderBy without partitionBy is allowed only in the known spots:
    # per-slice offsets (one row per range partition), the yearly table and
    # a 10-row top list.
    allowed = {"operators/ranking.py", "operators/freight.py", "plans/q_freight.py"}
    hits = {h.split(":")[0] for h in _hits(r"Window\.orderBy\(")}
    assert hits <= allowed, hits
