"""Every registered query against its oracle SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare  # noqa: E402
from tidemark.plans import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


#: Queries whose result is rightly empty on the smallest tables.
EMPTY = set()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_oracle(spark, name):
    problem = compare(spark, FOLDER, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None or problem == "no rows" and name in EMPTY, problem


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "dt"
