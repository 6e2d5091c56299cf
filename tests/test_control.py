from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.plans import control

D = dt.date
TODAY = D(2017, 1, 10)
CALENDAR = "season string, season_type string, start_date date, end_date date, is_current boolean"
HEADER = "game_id string, gamecode string, game_date date, game_status_text string, _season string, _season_type string"


def pull(spark, games, current=True, full=False, end=D(2017, 4, 12)):
    calendar = spark.createDataFrame([("2016-17", "R", D(2016, 10, 25), end, current)], CALENDAR)
    header = spark.createDataFrame([(str(i), "x", d, s, "2016-17", "R") for i, (d, s) in enumerate(games)], HEADER)
    marks = control.watermarks(header, F.lit(TODAY))
    row = control.schedule_range(marks, calendar, F.lit(TODAY), full).first()
    return row and (row.pull_from, row.pull_to)


def test_nothing_landed_yet(spark):
    assert pull(spark, []) == (D(2016, 10, 25), D(2017, 4, 12))


def test_no_final_game_keeps_the_whole_season(spark):
    assert pull(spark, [(D(2016, 11, 1), "7:00 pm ET")]) == (D(2016, 10, 25), D(2017, 4, 12))


def test_day_after_the_last_final_until_today(spark):
    games = [(D(2017, 1, 3), "Final"), (D(2017, 1, 4), "Final"), (D(2017, 1, 20), "7:00 pm ET")]
    assert pull(spark, games) == (D(2017, 1, 5), TODAY)
    assert pull(spark, games, current=False) == (D(2017, 1, 5), D(2017, 4, 12))


def test_unfinished_past_game_comes_first(spark):
    games = [(D(2017, 1, 4), "Final"), (D(2017, 1, 2), "Halftime"), (D(2017, 1, 1), "PPD")]
    assert pull(spark, games) == (D(2017, 1, 2), TODAY)


def test_a_single_day_is_not_pulled(spark):
    assert pull(spark, [(D(2017, 1, 9), "Final")]) is None
    assert pull(spark, [(D(2017, 1, 8), "Final")]) == (D(2017, 1, 9), TODAY)


def test_full_schedule(spark):
    assert pull(spark, [(D(2017, 1, 9), "Final")], full=True) == (D(2017, 1, 10), D(2017, 4, 12))
    assert pull(spark, [], full=True) == (D(2016, 10, 25), D(2017, 4, 12))
    assert pull(spark, [(D(2017, 4, 12), "7:00 pm ET")], full=True) is None


def test_date_spine(spark):
    ranges = spark.createDataFrame([(D(2016, 12, 30), D(2017, 1, 2))], "pull_from date, pull_to date")
    assert [r.node_key for r in control.date_spine(ranges).orderBy("game_date").collect()] == ["20161230", "20161231", "20170101", "20170102"]


def test_pending_games(spark):
    header = spark.createDataFrame(
        [
            ("1", "20170101/AAABBB", D(2017, 1, 2), "Final", "2016-17", "R"),
            ("2", "20170101/AAABBB", D(2017, 1, 1), "Final", "2016-17", "R"),
            ("3", "20170219/ESTWST", D(2017, 2, 19), "Final", "2016-17", "R"),
            ("4", "20170219/WSTEST", D(2017, 2, 19), "Final", "2016-17", "R"),
            ("5", "20170101/AAABBB", D(2017, 1, 1), "Halftime", "2016-17", "R"),
            ("6", "20170101/AAABBB", D(2017, 1, 1), "Final", "2016-17", "R"),
            ("7", None, D(2017, 1, 1), "Final", "2016-17", "R"),
            ("8", "20170101/AAABBB", D(2017, 1, 1), "Final", "2015-16", "R"),
        ],
        HEADER,
    )
    log = spark.createDataFrame(
        [("game", "1", "COMPLETED", "FAILED"), ("game", "6", "COMPLETED", "COMPLETED"), ("team", "2", "COMPLETED", "COMPLETED")],
        "node string, node_key string, node_status string, group_status string",
    )
    got = [r.game_id for r in control.pending_games(header, log, "2016-17", "R").collect()]
    assert got == ["2", "1"]  # by day; a NULL code drops out of NOT LIKE


def test_not_done_is_this_run_or_today(spark):
    log = spark.createDataFrame(
        [
            ("player", "1", "10", 5, dt.datetime(2017, 1, 1), "COMPLETED", "2016-17", "R"),  # this run
            ("player", "2", "10", 4, dt.datetime(2017, 1, 10, 23), "COMPLETED", "2016-17", "R"),  # today
            ("player", "3", "10", 4, dt.datetime(2017, 1, 9), "COMPLETED", "2016-17", "R"),  # earlier
            ("player", "4", "10", 5, dt.datetime(2017, 1, 10), "FAILED", "2016-17", "R"),
            ("player", "5", "11", 5, dt.datetime(2017, 1, 10), "COMPLETED", "2016-17", "R"),  # for another team
            ("team", "6", "10", 5, dt.datetime(2017, 1, 10), "COMPLETED", "2016-17", "R"),
            ("player", "7", "10", 5, dt.datetime(2017, 1, 10), "COMPLETED", "2016-17", "P"),
        ],
        "node string, node_key string, parent_key string, run_id int, end_dtm timestamp, node_status string, season string, season_type string",
    )
    candidates = spark.createDataFrame([(str(i), "10") for i in range(1, 8)], "node_key string, parent_key string")
    left = control.not_done(candidates, log, "player", 5, F.lit(TODAY), ("node_key", "parent_key"), "2016-17", "R")
    assert sorted(r.node_key for r in left.collect()) == ["3", "4", "5", "6", "7"]


def test_log_status_keeps_the_node_status(spark):
    at = dt.datetime(2017, 1, 1)
    events = spark.createDataFrame(
        [
            (1, "game", "g", "IN PROGRESS", "IN PROGRESS", 0, at, 0),
            (1, "game", "g", "COMPLETED", "IN PROGRESS", 9, at, 1),
            (1, "game", "g", None, "FAILED", 0, at, 2),
        ],
        "run_id int, node string, node_key string, node_status string, group_status string, measure_count int, at timestamp, seq int",
    )
    row = control.log_status(events.withColumn("parent_key", F.lit(None).cast("string"))).first()
    assert (row.node_status, row.group_status, row.measure_count) == ("COMPLETED", "FAILED", 0)


def test_single_measure_must_be_unique(spark):
    nodes = spark.createDataFrame(
        [("team", "E", "m", "t1", True, 1996), ("team", "E", "m", "t2", True, 2017), ("team", "E", "m", "t3", True, 1996), ("team", "F", "m", "t3", True, 1996)],
        "node string, endpoint string, measure string, table_name string, active boolean, available_year int",
    )
    assert control.single_measure(nodes, "2016-17", "t1").endpoint == "E"
    for name in ("t2", "t3", "t4"):
        with pytest.raises(ValueError):
            control.single_measure(nodes, "2016-17", name)


def test_seasons_times_teams(spark):
    teams = spark.createDataFrame([(1, "AAA"), (1, "AAA"), (2, None), (3, "CCC")], "team_id int, team_abbrv string")
    assert control.season_teams(teams).count() == 24


def test_find_player(spark):
    players = spark.createDataFrame([(1, "Doe, Jane"), (2, "Nene"), (3, "Doe, John")], "person_id int, display_last_comma_first string")
    assert [r.person_id for r in control.find_player(players, "JANE", "doe").collect()] == [1]
    assert [r.person_id for r in control.find_player(players, "nene").collect()] == [2]
    assert control.find_player(players, "Jane").count() == 0


def test_names_default(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "player_id int, team_id int")
    stats = spark.createDataFrame([(1, "B"), (1, "A")], "player_id int, player_name string")
    teams = spark.createDataFrame([(5, "AAA"), (5, "AAA")], "team_id int, team_abbrv string")
    got = {r.player_id: (r.player_name, r.team_abbrv) for r in control.with_names(df, stats, teams).collect()}
    assert got == {1: ("A", "AAA"), 2: ("Unknown Player (for now)", None)}


def test_latest_team_null_start_is_latest(spark):
    history = spark.createDataFrame(
        [(1, "s", 10, D(2017, 1, 1)), (1, "s", 11, None), (2, "s", 10, D(2017, 1, 1)), (2, "s", 12, D(2017, 2, 1))],
        "player_id int, season string, team_id int, rec_start_date date",
    )
    assert {r.player_id: r.team_id for r in control.latest_team(history).collect()} == {1: 11, 2: 12}
