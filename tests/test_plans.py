"""What the physical plans must look like at scale."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from courtside.functions.ordering import latest_first
from courtside.operators import windows as w
from courtside.queries import QUERIES
from courtside.queries.league import League
from courtside.queries.refreshing import landed_tables
from courtside.queries.rosters import landed_players
from courtside.session import RUNTIME, TASK_BYTES, fresh_path, ready, shared_dir

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_row_is_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["latest_event"](spark, SF))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert len(limits) == 2 and limits[0] < plan.index("Exchange hashpartitioning") < limits[1]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["pending_games"](spark, SF))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    lines = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in lines and "o_orderpriority" not in orders
    plan = plan_of(landed_players(League(spark, SF), dt.date(1996, 6, 30)))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "LessThan(o_orderdate,1996-07-01T00:00)" in orders


def test_groups_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["split_by_half"](spark, SF))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_global_order_sorts_a_summary_only(spark):
    plan = plan_of(QUERIES["global_previous"](spark, SF))
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    # directly above an aggregate over the first prefix, not above the rows
    assert re.search(r"Aggregate\(keys?=\[event_type#\d+\]", lines[single[0] + 1])


def test_no_query_puts_rows_in_one_partition(spark):
    single = {}
    for name in sorted(n for n in QUERIES if not n.startswith("streamed_") and n not in ("reporting_refresh", "game_run_log", "refreshed_games", "refreshed_player_facts", "landed_widening")):
        plan = plan_of(QUERIES[name](spark, SF)).splitlines()
        for i, line in enumerate(plan):
            if "SinglePartition" in line and "Aggregate" not in plan[i + 1]:
                single[name] = plan[i + 1]
    assert single == {}


def test_windows_have_one_plan_and_no_broadcast_hint(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id", F.col("id").alias("v"))
    windowed = w.rolling(df, ["k"], ["id"], {"s": ("sum", "v", 5)}, F.floor(F.col("id") / 100))
    assert "hashpartitioning(k" in plan_of(windowed) and "Broadcast" not in plan_of(windowed)
    assert "strategy=broadcast" not in windowed._jdf.queryExecution().analyzed().toString()
    assert windowed.count() == 1000


def test_hot_join_key_is_split_at_run_time(spark):
    """One player with two thirds of the rows: the join runs in more tasks than it has keys' partitions."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in changed}
    ready(spark)
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 500).alias("player_id"), F.col("id").alias("v")
        )
        out = w.with_group_stats(rows, ["player_id"], total=F.sum("v"))
        path = fresh_path(spark, "skew")
        out.write.parquet(path)
        joined = out.join(out.groupBy("player_id").agg(F.max("v").alias("m")), "player_id")
        assert joined.where("player_id = 7").count() == out.where("player_id = 7").count()
        df = w.with_group_stats(rows, ["player_id"], total=F.sum("v"))
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_runtime_settings(spark):
    ready(spark)
    for key, value in RUNTIME.items():
        assert spark.conf.get(key) == value


def test_bytes_of_a_task_are_bounded_and_never_raised(spark):
    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    try:
        for key, most in TASK_BYTES.items():
            spark.conf.set(key, "1g")
            ready(spark)
            assert spark.conf.get(key) == str(most)
            spark.conf.set(key, "20KB")
            ready(spark)
            assert spark.conf.get(key) == "20KB"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_tables_read_several_times_are_worked_out_once(spark):
    landed = landed_tables(League(ready(spark), SF))
    league = League(spark, SF).settled("games", "box")
    for rows in (landed["player_box"], landed["team_box"], landed["header"], landed["player_common"], league.facts, league.team_facts, league.schedule):
        assert "Join" not in plan_of(rows) and "Aggregate" not in plan_of(rows)


def test_global_order_shuffles_its_rows_once(spark):
    rows = spark.createDataFrame(
        [("a", 1, i, None if i % 3 == 0 else i * 10) for i in range(6)] + [("b", p, i, i) for p in (1, 2, 3) for i in range(3)],
        "team string, player long, t int, v int",
    )
    found = w.global_previous(rows, [["team"], ["team", "player"]], ["t"], "v", "before", F.floor(F.col("t") / 2))
    assert "_r_player" not in found._jdf.queryExecution().analyzed().toString()
    ordered = sorted(rows.collect(), key=lambda r: (r.team, r.player, r.t))
    wanted = {(r.team, r.player, r.t): b.v if b else None for b, r in zip([None, *ordered], ordered)}
    assert {(r.team, r.player, r.t): r.before for r in found.collect()} == wanted and found.count() == len(ordered)
    # the value may be a column of the order
    days = w.global_previous(rows, [["team"], ["team", "player"]], ["t"], "t", "before", F.floor(F.col("t") / 2))
    wanted = {(r.team, r.player, r.t): b.t if b else None for b, r in zip([None, *ordered], ordered)}
    assert {(r.team, r.player, r.t): r.before for r in days.collect()} == wanted


def test_width_is_set_on_request_only(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    ready(spark)
    assert spark.conf.get(key, None) is None
    ready(spark, width=64)
    assert spark.conf.get(key) == "64"
    spark.conf.unset(key)


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_no_machine_local_folder_on_a_cluster(spark):
    class Context:
        master = "yarn"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_latest_by_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k int, t int")
    assert w.latest_by(df, ["k"], latest_first("t")).count() == 1
