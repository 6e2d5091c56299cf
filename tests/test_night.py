from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.plans import night, refresh
from courtside.queries.league import League
from courtside.queries.refreshing import night_tables
from courtside.session import ready
from courtside.sources import published

SF, DAY = "/root/testdata/sf0.001", dt.datetime(2002, 1, 1)
EVENT = "node string, node_status string, group_status string"


def rows_of(spark, root, name):
    """All rows of the eight tables but for the keys that are drawn anew."""
    found = {}
    for table in refresh.ORDER:
        rows = published.read_parts(spark, f"{root}/reporting", table, name)
        text = rows.select(F.to_json(F.struct(*[c for c in rows.columns if not c.endswith("guid")])).alias("row"))
        found[table] = sorted(r.row for r in text.collect())
    return found


def test_a_broken_night_ends_with_the_same_tables(spark, scratch, monkeypatch):
    tables = night_tables(League(ready(spark), SF))
    calls = []

    def games():
        calls.append("games")
        return spark.createDataFrame([("game", "COMPLETED", "COMPLETED")], EVENT)

    whole = night.run_night(spark, f"{scratch}/whole", "n1", DAY, {"games": games}, tables)
    assert list(whole) == ["games", *[f"snapshot {t}" for t in tables], "refresh"] and set(whole.values()) == {"COMPLETED"}

    publish, done = published.publish_parts, []

    def breaking(df, root, table, *rest):
        if len(done) == 3 and not broken:
            broken.append(table)
            raise ConnectionError(table)
        done.append(table)
        return publish(df, root, table, *rest)

    broken = []
    monkeypatch.setattr(published, "publish_parts", breaking)
    with pytest.raises(ConnectionError):
        night.run_night(spark, f"{scratch}/broken", "n1", DAY, {"games": games}, tables)
    again = night.run_night(spark, f"{scratch}/broken", "n1", DAY, {"games": games}, tables)
    assert again == whole and done == list(refresh.ORDER) and calls == ["games", "games"]
    assert rows_of(spark, f"{scratch}/broken", "n1") == rows_of(spark, f"{scratch}/whole", "n1")


@pytest.mark.parametrize("event", [("player", "FAILED", "N/A"), ("game", None, "FAILED")])
def test_nothing_is_refreshed_after_a_failed_load(spark, scratch, event):
    loads = {"games": lambda: spark.createDataFrame([event], EVENT), "news": lambda: None}
    assert night.run_night(spark, scratch, "n1", DAY, loads, {}) == {"games": "FAILED", "news": "COMPLETED"}


def test_a_snapshot_keeps_the_latest_row_of_a_key(spark, scratch, monkeypatch):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, _create_date int")
    seen = {}
    monkeypatch.setattr(night, "refresh_all", lambda spark, taken, *rest, **more: seen.update(taken))
    night.run_night(spark, scratch, "n1", DAY, {}, {"x": night.Landed(lambda: rows, ["k"]), "y": night.Landed(lambda: rows)})
    assert sorted(r.v for r in seen["x"].collect()) == ["b", "c"] and seen["y"].count() == 3
