"""Layer 2: every registered query against its SQL oracle (DuckDB) on the
smallest driver tables; the same check runs at sf0.01 with
``python tools/check_oracle.py``."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
import check_oracle as CO  # noqa: E402
from plotwise.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return CO.duck(SF)


NAMES = set(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert NAMES == set(catalog.ORACLE)
    assert NAMES <= set(E.queries())


@pytest.mark.parametrize("name", sorted(NAMES))
def test_query_matches_oracle(spark, con, name):
    sp = CO.spark_pandas(E.queries()[name](spark, SF))
    dk = con.execute(E.oracle_sql()[name]).df()
    assert CO.compare(sp, dk) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["year", "climate", "treatment", "removed_fg", "biomass"]
