"""Every query against its SQL on the smallest tables."""

import os

import pytest
from checks import all_checks
from checks.verify import collect, compare, database, oracle

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", [check.name for check in all_checks()])
def test_query(spark, connection, name):
    import __spark_entry__ as entry

    rows = collect(entry.queries()[name](spark, SMALL))
    assert len(rows) > 0
    assert compare(rows, oracle(connection, entry.oracle_sql()[name])) == ""


def test_flagship(spark):
    import __spark_entry__ as entry

    assert len(entry.entry(spark).columns) == 74


@pytest.mark.parametrize("cause, code", [("PlatformFailure", "CACHE_FAILURE"), ("AgentLost", "OWNER_TIMEDOUT")])
def test_a_wrong_code_turns_a_query_red(spark, connection, monkeypatch, cause, code):
    import __spark_entry__ as entry
    from slotviews.functions import flags

    monkeypatch.setitem(flags.CAUSES, cause, tuple(c for c in flags.CAUSES[cause] if c != code))
    rows = collect(entry.queries()["termination_stage_flags"](spark, SMALL))
    assert compare(rows, oracle(connection, entry.oracle_sql()["termination_stage_flags"])) != ""
