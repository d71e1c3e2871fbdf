"""Every registered query gives the rows of its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.EXTRA_SQL)))
def test_query_matches_sql(spark, duck, name):
    problem = compare(spark, duck, name, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    # A few queries find nothing in tables this small; the larger ones are compared by the script.
    assert problem in ("", "the SQL gives no rows")


def test_every_query_has_sql():
    own = set(contract.queries()) - set(contract.EXTRA)
    assert own == set(contract.oracle_sql()) - set(contract.EXTRA_SQL)


def test_entry_runs(spark):
    cube = contract.entry(spark)
    assert cube.columns[:4] == ["product", "reporter", "partner", "year"]
    assert not cube.isEmpty()
