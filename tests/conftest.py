import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from haulage.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session("local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})


@pytest.fixture
def shipping(spark):
    # The five-state fixture of the published tests.
    rows = [(1, "CA", "CA", 38802500.0, 38802500.0), (2, "TX", "TX", 26956958.0, 13478479.0),
            (3, "FL", "FL", 19893297.0, 6631099.0), (4, "NY", "NY", 19746227.0, 4936556.75),
            (5, "IL", "IL", 12880580.0, 2576116.0)]
    return spark.createDataFrame(rows, "rank int, state string, postal string, population double, "
                                      "population_per_rank double")


@pytest.fixture
def fuel(spark):
    rows = [("CA", 5.368, 5.589, 5.774, 6.209), ("TX", 3.262, 3.763, 4.128, 4.567),
            ("FL", 3.718, 4.155, 4.475, 5.074), ("NY", 3.521, 4.006, 4.395, 4.993),
            ("IL", 3.662, 4.213, 4.688, 4.773)]
    return spark.createDataFrame(rows, "state string, regular double, mid_grade double, premium double, diesel double")
