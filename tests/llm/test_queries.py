"""Every corpus query against its SQL, and the rest for whole results, on the smallest tables."""

import pytest

import oracle_check
from leadpanel.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle_check.compare(spark, FOLDER, queries.QUERIES[name], queries.ORACLES[name], con) is None


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_entry_has_them_all():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
