"""Every registered query beside its SQL, and what each is registered with."""

import pytest

from rowloom.plans import ORACLES, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert differences(frame, connection, ORACLES[name]) == []
    else:
        assert frame.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["name", "purchases"]
    assert set(entry.queries()) >= set(QUERIES) and entry.oracle_sql().items() >= ORACLES.items()
    assert set(entry.oracle_sql()) <= set(entry.queries())
