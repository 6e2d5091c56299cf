from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from courtside.sources import documents, landing
from courtside.streaming import news

ITEM = "player string, headline string, at timestamp, priority int"


def at(hour):
    return dt.datetime(2017, 1, 1, hour)


def poll(spark, folder, rows):
    spark.createDataFrame(rows, ITEM).coalesce(1).write.mode("append").parquet(folder)


def landed(spark, scratch):
    stream = spark.readStream.schema(ITEM).parquet(f"{scratch}/in")
    unique = news.without_repeats(stream, ["player", "headline", "at"], "at")
    news.append_stream(unique, f"{scratch}/out", f"{scratch}/cp").awaitTermination()
    return sorted((r.player, r.headline) for r in spark.read.parquet(f"{scratch}/out").collect())


def test_later_polls_repeat_items(spark, scratch):
    poll(spark, f"{scratch}/in", [("1", "a", at(1), 1), ("1", "a", at(1), 1), ("2", "b", at(2), 1)])
    assert landed(spark, scratch) == [("1", "a"), ("2", "b")]
    poll(spark, f"{scratch}/in", [("1", "a", at(1), 1), ("2", "b", at(2), 1), ("1", "c", at(3), 1)])
    assert landed(spark, scratch) == [("1", "a"), ("1", "c"), ("2", "b")]
    assert landed(spark, scratch) == [("1", "a"), ("1", "c"), ("2", "b")]  # a restart adds nothing


def test_latest_equals_the_batch_answer(spark, scratch):
    polls = [
        [("1", "a", at(1), 2), ("1", "b", at(1), 1), ("2", "c", at(5), 1)],
        [("1", "d", at(0), 1), ("2", "e", at(6), 3), ("3", "f", at(2), 1)],
    ]
    for rows in polls:
        poll(spark, f"{scratch}/in", rows)
        stream = spark.readStream.schema(ITEM).parquet(f"{scratch}/in")
        order = F.struct("at", -F.col("priority"))
        latest = news.latest_per_player(stream, "player", order, ["headline", "at"])
        news.publish_stream(latest, f"{scratch}/view", f"{scratch}/cp").awaitTermination()
    versions = spark.read.parquet(f"{scratch}/view")
    last = versions.agg(F.max(F.col("batch").cast("int")).alias("b")).first().b
    got = {r.player: r.headline for r in versions.where(F.col("batch").cast("int") == last).collect()}
    assert got == {"1": "b", "2": "e", "3": "f"}


def unseen(spark, scratch):
    stream = spark.readStream.schema(ITEM).parquet(f"{scratch}/in")
    news.append_unseen(stream, ["player", "headline", "at"], f"{scratch}/out", f"{scratch}/cp").awaitTermination()
    return sorted((r.player, r.headline) for r in spark.read.parquet(f"{scratch}/out").collect())


def test_late_items_are_kept(spark, scratch):
    poll(spark, f"{scratch}/in", [("1", "a", at(1), 1), ("1", "a", at(1), 1), ("2", "b", dt.datetime(2017, 2, 1), 1)])
    assert unseen(spark, scratch) == [("1", "a"), ("2", "b")]
    poll(spark, f"{scratch}/in", [("1", "a", at(1), 1), ("3", "old", dt.datetime(2016, 1, 1), 1)])
    assert unseen(spark, scratch) == [("1", "a"), ("2", "b"), ("3", "old")]
    assert unseen(spark, scratch) == [("1", "a"), ("2", "b"), ("3", "old")]


def test_a_batch_repeated_from_the_start_changes_nothing(spark, scratch):
    poll(spark, f"{scratch}/in", [("1", "a", at(1), 1), ("2", "b", at(2), 1)])
    first = unseen(spark, scratch)
    stream = spark.readStream.schema(ITEM).parquet(f"{scratch}/in")
    news.append_unseen(stream, ["player", "headline", "at"], f"{scratch}/out", f"{scratch}/cp-lost").awaitTermination()
    assert sorted((r.player, r.headline) for r in spark.read.parquet(f"{scratch}/out").collect()) == first


def feed(spark, folder, *items):
    body = json.dumps({"ListItems": list(items)})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("append").text(folder)


def item(player, day, caption, **more):
    return {"PlayerID": player, "Date": day, "ListItemCaption": caption, **more}


KEYS = ["playerid", "date", "listitemcaption"]


def land_polls(spark, scratch, checkpoint="cp"):
    polled = spark.readStream.schema("value string").text(f"{scratch}/in")
    news.land_unseen(
        documents.news_items(polled, "value"), KEYS, F.to_timestamp_ntz("date"), f"{scratch}/out", f"{scratch}/{checkpoint}", "2016-17",
        "Regular Season", lambda: at(1),
    ).awaitTermination()
    return landing.read_landed(spark, f"{scratch}/out")


def kept(rows):
    return {(r.playerid, r.listitemcaption, r["_day"], r["_batch"]) for r in rows.collect()}


def test_items_land_once_by_day_with_stamps_and_new_fields(spark, scratch):
    feed(spark, f"{scratch}/in", item("1", "2017-01-02", "a"), item("1", "2017-01-02", "a"), item(None, None, "b"))
    first = {("1", "a", "2017-01-02", 0), (None, "b", news.NO_DAY, 0)}
    rows = land_polls(spark, scratch)
    assert kept(rows) == first and rows.count() == 2
    # all again, a late item, and a field the feed did not have
    feed(
        spark, f"{scratch}/in", item("1", "2017-01-02", "a", TeamCode="X"), item(None, None, "b"), item("1", "2017-01-02", "c", TeamCode="Y"),
        item("2", "2015-05-05", "late", TeamCode="Z"),
    )
    rows = land_polls(spark, scratch)
    assert kept(rows) == first | {("1", "c", "2017-01-02", 1), ("2", "late", "2015-05-05", 1)} and rows.count() == 4
    assert {(r.listitemcaption, r.teamcode) for r in rows.collect()} == {("a", None), ("b", None), ("c", "Y"), ("late", "Z")}
    assert {(r["_season"], r["_season_type"], r["_create_date"]) for r in rows.collect()} == {("2016-17", "Regular Season", at(1))}
    assert land_polls(spark, scratch).count() == 4  # a restart adds nothing


def test_a_repeated_batch_replaces_its_own_rows(spark, scratch):
    feed(spark, f"{scratch}/in", item("1", "2017-01-02", "a"), item("2", "2017-01-03", "b"))
    first = kept(land_polls(spark, scratch))
    rows = land_polls(spark, scratch, "cp-lost")
    assert kept(rows) == first and rows.count() == 2


def test_a_batch_reads_its_own_days_only(spark, scratch):
    feed(spark, f"{scratch}/in", item("1", "2017-01-02", "a"), item("2", "2017-01-03", "b"))
    land_polls(spark, scratch)
    seen = news.landed_on(spark, f"{scratch}/out", ["2017-01-03"], 1)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.playerid for r in seen.collect()] == ["2"]


def change(spark, scratch, rows, whole_every=96):
    poll(spark, f"{scratch}/in", rows)
    stream = spark.readStream.schema(ITEM).parquet(f"{scratch}/in")
    latest = news.latest_per_player(stream, "player", F.struct("at", -F.col("priority")), ["headline", "at"])
    news.publish_changes(latest, "player", f"{scratch}/view", f"{scratch}/cp", whole_every=whole_every).awaitTermination()
    return {r.player: r.headline for r in news.read_changes(spark, f"{scratch}/view", latest.schema, "player").collect()}


def written(spark, scratch, batch):
    rows = spark.read.parquet(f"{scratch}/view").where(F.col("_batch").cast("long") == batch)
    return {(r.player, r.headline) for r in rows.collect()}


def test_batches_write_changed_players_only(spark, scratch):
    assert change(spark, scratch, [("1", "a", at(1), 1), ("2", "b", at(5), 1), (None, "n", at(1), 1)]) == {"1": "a", "2": "b", None: "n"}
    # known items again, an older one, a newer one and a new player
    rows = [("1", "a", at(1), 1), ("2", "old", at(2), 1), (None, "n", at(1), 1), ("1", "c", at(3), 1), ("3", "d", at(1), 1)]
    assert change(spark, scratch, rows) == {"1": "c", "2": "b", "3": "d", None: "n"}
    assert written(spark, scratch, 1) == {("1", "c"), ("3", "d")}


def test_whole_tables_between_changes(spark, scratch):
    change(spark, scratch, [("1", "a", at(1), 1), ("2", "b", at(1), 1)], 2)
    assert change(spark, scratch, [("1", "c", at(2), 1)], 2) == {"1": "c", "2": "b"}
    assert written(spark, scratch, 1) == {("1", "c"), ("2", "b")}
    assert change(spark, scratch, [("2", "d", at(2), 1)], 2) == {"1": "c", "2": "d"}
    assert written(spark, scratch, 2) == {("2", "d")}
