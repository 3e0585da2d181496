import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_mod  # noqa: E402


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 100
    assert df.columns == ["origin", "destination", "commodity", "mode", "tons_latest", "tons_m"]
    tons = [r.tons_latest for r in rows]
    assert tons == sorted(tons, reverse=True)


def test_registry_and_oracles_line_up():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert len(q) >= 100 and set(o) <= set(q)
