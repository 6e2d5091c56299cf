from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtside.operators.scd2 import duplicate_keys, open_versions
from courtside.plans import refresh
from courtside.queries.league import League
from courtside.queries.refreshing import landed_tables
from courtside.session import ready
from courtside.sources.published import NotPublished, publish_parts, read_parts

SF = "/root/testdata/sf0.001"


def test_second_refresh_changes_nothing(spark, scratch):
    landed = landed_tables(League(ready(spark), SF))
    first = refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1))
    again = refresh.refresh_all(spark, landed, scratch, "v2", dt.datetime(2002, 1, 2), before="v1")
    assert tuple(first) == refresh.ORDER and again == first
    people = read_parts(spark, scratch, "dim_player", "v2")
    assert open_versions(people, "id").count() == 0 and duplicate_keys(people, "dim_player_guid").count() == 0
    assert people.where("updated_at is not null").count() == 0


def test_a_changed_player_gets_a_new_version(spark, scratch):
    landed = landed_tables(League(ready(spark), SF))
    first = refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1))
    one = landed["player_common"].agg(F.min("person_id").alias("p")).first().p
    landed["player_common"] = landed["player_common"].withColumn(
        "school", F.when(F.col("person_id") == one, "Elsewhere").otherwise(F.col("school"))
    )
    again = refresh.refresh_all(spark, landed, scratch, "v2", dt.datetime(2002, 1, 2), before="v1")
    assert again["dim_player"] == first["dim_player"] + 1
    versions = read_parts(spark, scratch, "dim_player", "v2").where(F.col("id") == one).orderBy("rec_start_date").collect()
    assert [(v.is_rec_active, v.school) for v in versions] == [(False, "-"), (True, "Elsewhere")]
    # the version before is still there for its readers
    assert read_parts(spark, scratch, "dim_player", "v1").count() == first["dim_player"]


def test_clock_text_is_playing_time(spark):
    box = spark.createDataFrame(
        [("g", 1, 10, "AAA", "34:12", "F", None, 1, 2, 3, 4, 5, 6, 1)],
        "game_id string, player_id int, team_id int, team_abbreviation string, min string, start_position string, comment string,"
        " ast int, reb int, pts int, stl int, blk int, tov int, _create_date int",
    )
    games = spark.createDataFrame(
        [("g", "s", dt.date(2017, 1, 1), 20, 10)], "id string, season string, game_date date, home_team_id int, visitor_team_id int"
    )
    D = dt.date
    people = spark.createDataFrame(
        [(1, D(2017, 2, 1), 99), (1, D(2016, 12, 1), 98), (1, D(2016, 1, 1), 97), (2, D(2016, 1, 1), 96)],
        "id int, rec_start_date date, dim_player_guid int",
    )
    row = refresh.player_game_facts(box, games, people).collect()
    assert len(row) == 1
    # the version of the game day, not the open one
    assert (row[0].seconds, row[0].team_loc, row[0].opp_team_id, row[0].dim_player_guid) == (2052, "V", 20, 98)
    early = games.withColumn("game_date", F.lit(D(2015, 5, 5)))
    assert refresh.player_game_facts(box, early, people).first().dim_player_guid == 97


def files(scratch):
    return {str(p.relative_to(scratch)) for p in Path(scratch).rglob("*.parquet") if "__parts" not in str(p)}


def test_a_refresh_of_one_season_leaves_the_files_of_others(spark, scratch):
    landed = landed_tables(League(ready(spark), SF))
    refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1))
    before = files(scratch)
    tables = ("dim_game", "fct_game_team", "fct_game_player", "dim_player_schedule", "player_time")
    whole = {t: sorted(map(str, read_parts(spark, scratch, t).drop("created_at").collect())) for t in tables}
    one = read_parts(spark, scratch, "dim_game").agg(F.max("season").alias("s")).first().s
    written = refresh.refresh_all(spark, landed, scratch, "v2", dt.datetime(2002, 1, 2), before="v1", seasons=[one])
    after = files(scratch)
    assert before <= after
    for t in tables:
        new = {f for f in after - before if f.startswith(f"{t}/")}
        assert new and all(f"_version=v2/season={one}/" in f for f in new), t
        # rows of a season are the same whether it is refreshed alone or with the others
        assert sorted(map(str, read_parts(spark, scratch, t).drop("created_at").collect())) == whole[t], t
        assert written[t] == read_parts(spark, scratch, t).where(F.col("season") == one).count()
    # no season but the one asked for is read
    rows = read_parts(spark, scratch, "fct_game_player").where(F.col("season") == one)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [" in plan and f"(season#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_closed_history_is_written_once(spark, scratch):
    landed = landed_tables(League(ready(spark), SF))
    refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1))
    one = landed["player_common"].agg(F.min("person_id").alias("p")).first().p
    changed = {
        **landed, "player_common": landed["player_common"].withColumn("school", F.when(F.col("person_id") == one, "Elsewhere").otherwise(F.col("school")))
    }
    refresh.refresh_all(spark, changed, scratch, "v2", dt.datetime(2002, 1, 2), before="v1")
    refresh.refresh_all(spark, changed, scratch, "v3", dt.datetime(2002, 1, 3), before="v2")
    refresh.refresh_all(spark, landed, scratch, "v4", dt.datetime(2002, 1, 4), before="v3")
    closed = {f.split("/")[1] for f in files(scratch) if f.startswith("dim_player/") and "is_rec_active=false" in f}
    assert closed == {"_version=v2", "_version=v4"}
    def schools(version):
        rows = read_parts(spark, scratch, "dim_player", version).where(F.col("id") == one).orderBy("rec_start_date").collect()
        return [(v.is_rec_active, v.school) for v in rows]
    assert schools("v1") == [(True, "-")]
    assert schools("v2") == schools("v3") == [(False, "-"), (True, "Elsewhere")]
    assert schools("v4") == [(False, "-"), (False, "Elsewhere"), (True, "-")]


def test_a_broken_run_goes_on_after_its_last_table(spark, scratch, monkeypatch):
    landed = landed_tables(League(ready(spark), SF))
    other = f"{scratch}-whole"
    refresh.refresh_all(spark, landed, other, "v1", dt.datetime(2002, 1, 1))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "team_game_facts", fail)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1), resume=True)
    early = files(scratch)
    assert {f.split("/")[0] for f in early} == set(refresh.ORDER[:3])
    left = refresh.refresh_all(spark, landed, scratch, "v1", dt.datetime(2002, 1, 1), resume=True)
    assert early <= files(scratch) and [t for t in refresh.ORDER if left[t] == 0] == list(refresh.ORDER[:3])
    for table in refresh.ORDER:
        ours, whole = (read_parts(spark, root, table).drop("created_at") for root in (scratch, other))
        assert sorted(map(str, ours.collect())) == sorted(map(str, whole.collect())), table


def test_a_broken_table_does_not_become_current(spark, scratch):
    good = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "id int, name string, season string")
    assert publish_parts(good, scratch, "t", "v1", "season", required=["id"]) == 2
    bad = spark.createDataFrame([(None, "c", "x"), (3, "d", "y")], "id int, name string, season string")
    with pytest.raises(NotPublished, match="id.: 1"):
        publish_parts(bad, scratch, "t", "v2", "season", required=["id"])
    assert sorted(map(tuple, read_parts(spark, scratch, "t").collect())) == [(1, "a", "x"), (2, "b", "x")]
    with pytest.raises(ValueError, match="v2"):
        read_parts(spark, scratch, "t", "v2")
    # the run is repeated under its version
    assert publish_parts(bad.where("id is not null"), scratch, "t", "v2", "season", ["y", "z"], ["id"]) == 1
    assert sorted(map(tuple, read_parts(spark, scratch, "t").collect())) == [(1, "a", "x"), (2, "b", "x"), (3, "d", "y")]
    # a touched part without rows is empty, and a whole run forgets parts it does not have
    assert publish_parts(good.where("false"), scratch, "t", "v3", "season", ["x"]) == 0
    assert [r.id for r in read_parts(spark, scratch, "t").collect()] == [3]
    more = spark.createDataFrame([(9, "e", 1.5, "w")], "id int, name string, more double, season string")
    publish_parts(more, scratch, "t", "v4", "season")
    assert [tuple(r) for r in read_parts(spark, scratch, "t").collect()] == [(9, "e", 1.5, "w")]
    assert sorted(r.id for r in read_parts(spark, scratch, "t", "v2").collect()) == [1, 2, 3]
    publish_parts(good, scratch, "t", "v5", "season", ["x"])
    # a column that only other parts have stays
    rows = read_parts(spark, scratch, "t").select("id", "more").collect()
    assert sorted(map(tuple, rows)) == [(1, None), (2, None), (9, 1.5)]
