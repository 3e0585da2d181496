"""Registered names, and every oracle on the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as entry
from haulage.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = sorted(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(entry.__file__), "tools"))
    from oracle_check import check, duck
    r = check(spark, duck(SF), SF, name, queries.queries()[name], queries.oracle_sql()[name])
    assert r["status"] == "OK", r
