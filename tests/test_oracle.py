"""Every registered query against its SQL oracle on the smallest driver data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from haulage.plans.catalog import oracle_sql, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    from oracle_check import duck
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    from oracle_check import check
    r = check(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert r["status"] in ("OK", "rows-only"), r


def test_every_query_has_an_oracle():
    missing = sorted(set(queries()) - set(oracle_sql()))
    assert missing == [], missing
