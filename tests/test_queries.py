"""Every registered query beside its SQL, on whole tables; and properties of all plans."""

from __future__ import annotations

import pytest

from courtside.queries import ORACLE, QUERIES
from tests.compare import differences

SF = "/root/testdata/sf0.001"

WRITES = {n for n in QUERIES if n.startswith("streamed_")} | {"reporting_refresh", "game_run_log", "refreshed_games", "refreshed_player_facts", "landed_widening"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(spark, name, SF) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_pairing_without_keys_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.limit(1).count() == 1
    assert set(QUERIES) <= entry.queries().keys() and set(ORACLE) <= entry.oracle_sql().keys()
