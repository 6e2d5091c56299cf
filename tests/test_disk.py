"""What a run holds on disk: shuffle files and settled tables leave it once they are of no use."""

from __future__ import annotations

import datetime as dt
import os
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from courtside.plans import marts, refresh
from courtside.queries import QUERIES
from courtside.queries.league import TABLES, League
from courtside.queries.refreshing import landed_tables
from courtside.session import FREES_SHUFFLES, passing, ready, settle, shared_dir
from courtside.sources.published import publish_parts, read_parts


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def left(spark, before: set[str]) -> set[str]:
    """Shuffle files that came since, once those that are being removed are gone."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


def settled(spark) -> set[str]:
    return set(os.listdir(urlparse(shared_dir(spark)).path))


@pytest.fixture
def tables(spark, tmp_path):
    """Two players and a visitor's number, ten games of two lines each, some news."""
    day = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(days=40 * n)
    rows = {
        "region": [(0, "R")],
        "nation": [(0, "N", 0), (1, "M", 0)],
        "customer": [(1, "Customer#1", 0, 10.5, "A"), (2, "Customer#2", 1, -3.0, "B")],
        "orders": [(n, 1 + n % 2, "FOP"[n % 3], 100.0 * n, day(n), f"{1 + n % 5}-X") for n in range(1, 11)],
        "lineitem": [(n, 1, 1, i, 5.0 * i, 1.0, 0.1, 0.05, "ARN"[n % 3], "OF"[i % 2], day(n)) for n in range(1, 11) for i in (1, 2)],
        "events": [(n, dt.datetime(2024, 1, n), n % 3, "click", 1.0, '{"k": 1}') for n in range(1, 7)],
    }
    spark = ready(spark)
    for name, values in rows.items():
        spark.createDataFrame(values, TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_write_leaves_no_shuffle_files(spark, scratch):
    rows = spark.range(5000).groupBy((F.col("id") % 7).alias("season")).agg(F.count(F.lit(1)).alias("n"))
    was, before = spark.conf.get(FREES_SHUFFLES), shuffle_files(spark)
    kept = settle(rows, "counts")
    assert left(spark, before) == set()
    assert publish_parts(rows, scratch, "t", "v1", "season") == 7
    assert left(spark, before) == set()
    # only writes do so: rows that are run twice keep their shuffles
    assert spark.conf.get(FREES_SHUFFLES) == was == "false"
    assert sorted(rows.collect()) == sorted(rows.collect()) == sorted(kept.collect())


def test_passing_tables_are_removed(spark):
    before = settled(spark)
    with passing(spark):
        with passing(spark):
            inner = settle(spark.range(3), "inner")
            result = settle(inner.select((F.col("id") + 1).alias("id")), "result", stays=True)
        assert sorted(r.id for r in result.collect()) == [1, 2, 3]
        assert [n.split("-")[0] for n in settled(spark) - before] == ["result"]
        kept = settle(result, "kept", stays=True)
    assert [n.split("-")[0] for n in settled(spark) - before] == ["kept"] and kept.count() == 3
    before = settled(spark)
    with pytest.raises(RuntimeError, match="lost"), passing(spark):
        settle(spark.range(3), "inner")
        raise RuntimeError("lost")
    assert settled(spark) == before


def test_a_refresh_leaves_its_published_tables_only(spark, tables, scratch):
    landed = landed_tables(League(spark, tables))
    files, before = shuffle_files(spark), settled(spark)
    counts = refresh.refresh_all(spark, landed, f"{scratch}/root", "v1", dt.datetime(2002, 1, 1))
    assert settled(spark) == before and left(spark, files) == set()
    assert counts["fct_game_player"] == counts["dim_game"] == 10
    assert read_parts(spark, f"{scratch}/root", "player_time").count() == counts["player_time"] > 0


def test_legs_without_a_player_are_left_out_early(spark):
    day = dt.date(2000, 1, 1)
    games = spark.createDataFrame(
        [(n, f"g{n}", day, status, 1, 2, "s") for n, status in ((1, "Final"), (2, "Final"), (3, "PPD"))],
        "id int, game_code string, game_date date, game_status string, home_team_id int, visitor_team_id int, season string",
    )
    teams = spark.createDataFrame([(1, "one", "A"), (2, "two", "B")], "id int, team_name string, team_abbreviation string")
    facts = spark.createDataFrame(
        [(1, 7, 1, 2, "H", "V", "s")], "game_id int, player_id int, team_id int, opp_team_id int, team_loc string, opp_team_loc string, season string"
    )
    history = spark.createDataFrame([(8, "s", 2, day)], "player_id int, season string, team_id int, rec_start_date date")
    people = spark.createDataFrame([(7, "a", "b", day, True)], "id int, first_name string, last_name string, birthdate date, is_rec_active boolean")
    whole = marts.schedule(games, teams, facts, history, people)
    listed = marts.schedule(games, teams, facts, history, people, players_only=True)
    assert whole.where("player_id is null").count() == 2
    assert sorted(map(str, listed.collect())) == sorted(map(str, whole.where("player_id is not null").collect()))
    assert sorted((r.game_id, r.player_id, r.team_loc) for r in listed.collect()) == [(1, 7, "H"), (3, 8, "V")]


def test_team_numbers_are_the_last_shuffle_of_features(spark, tables):
    before, size = settled(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = QUERIES["played_game_features_across"](spark, tables)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(game_id") == 2
    # games, box scores and the rows are still read
    assert {n.split("-")[0] for n in settled(spark) - before} == {"games", "box", "named"}
    assert len(settled(spark) - before) == 3
    # the tenth game is after the last day asked for
    assert sorted(r.pts for r in rows.collect()) == [100.0 * n for n in range(1, 10)]
