from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.functions import scalars as fn


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, inches", [("6-10", 82), ("5-0", 60), ("6", None), ("", None), ("-5", None), ("7-", None), (None, None)]
)
def test_height(spark, text, inches):
    df = spark.createDataFrame([(text,)], "h string")
    assert df.select(fn.height_inches("h").alias("x")).first().x == inches


def test_height_that_is_no_number_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.height_inches("h"), h="six-ten")


def test_clock_is_twelve_hours(spark):
    at = F.lit("2017-03-01 13:05:09").cast("timestamp")
    assert one(spark, fn.clock_text(at)) == "2017-03-01 01:05:09"
    assert one(spark, fn.clock_text(F.lit("2017-03-01 00:05:09").cast("timestamp"))) == "2017-03-01 12:05:09"


def test_version_text_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([(None, "x"), (5, "x")], "id int, t string")
    assert [r.x for r in df.select(fn.version_text(["id", "t"], F.lit("now")).alias("x")).collect()] == [None, "5|x|now"]


def test_text_key_is_stable(spark):
    import hashlib

    want = int(hashlib.md5("5|x".encode()).hexdigest()[:15], 16)
    assert one(spark, fn.text_key("t"), t="5|x") == want


@pytest.mark.parametrize("text, want", [("", -2), ("   ", -2), (" 12 ", 12), ("7", 7), (None, None)])
def test_blank_player_is_the_sentinel(spark, text, want):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(fn.player_or_sentinel("p").alias("x")).first().x == want


@pytest.mark.parametrize("text, want", [("Y", True), ("y", False), ("N", False), (None, False)])
def test_flag(spark, text, want):
    df = spark.createDataFrame([(text,)], "f string")
    assert df.select(fn.yes_flag("f").alias("x")).first().x is want


@pytest.mark.parametrize(
    "news, comment, want",
    [
        ("YES", "DNP - Coach's Decision", "YES"),
        ("NO", "DND - Injury/Illness", "NO"),
        ("", "DND - Injury/Illness", ""),  # a present but empty flag still decides
        (None, "DNP - Coach's Decision", "NO"),
        (None, "DND - Injury/Illness", "YES"),
        (None, "dnd - injury", "NO"),  # the injury mark is case sensitive
        (None, "DND - suspended by league", "NO"),  # harmless marks are not, and come first
        (None, "Did not dress", "NO"),
        (None, None, "NO"),
    ],
)
def test_injury_flag(spark, news, comment, want):
    df = spark.createDataFrame([(news, comment)], "n string, c string")
    assert df.select(fn.injury_flag("n", "c").alias("x")).first().x == want


def test_epoch_is_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame([("1483228800",), ("1483228799.5",)], "s string")
    rows = df.select(fn.epoch_instant("s").alias("t"), fn.epoch_day("s").alias("d")).collect()
    assert rows[0].t == dt.datetime(2017, 1, 1) and rows[0].d == dt.date(2017, 1, 1)
    assert rows[1].d == dt.date(2016, 12, 31)


def test_labels(spark):
    day = F.lit(dt.date(2016, 10, 25))
    assert one(spark, fn.month_label(day)) == "OCT"
    assert one(spark, fn.weekday_label(day)) == "tue"
    assert one(spark, fn.date_key(day)) == "20161025"
    assert one(spark, fn.season_text(F.lit(dt.date(1999, 5, 1)))) == "1999-00"
    assert one(spark, fn.first_year(F.lit("2016-17"))) == 2016
    assert one(spark, fn.schedule_key(F.lit("20161025/NYKCLE"))) == "20161025"
    assert one(spark, fn.landed_date(F.lit("2016-10-25T00:00:00"))) == dt.date(2016, 10, 25)


def test_points_are_null_when_a_part_is(spark):
    df = spark.createDataFrame([(2, 10, 20, 1, 1, 3), (2, None, 20, 1, 1, 3)], "ast int, reb int, pts int, stl int, blk int, tov int")
    assert [r.x for r in df.select(fn.fantasy_points().alias("x")).collect()] == [36.0, None]


def test_shares(spark):
    df = spark.createDataFrame([(5, 10), (5, 0), (5, None), (None, 10)], "a int, b int")
    guarded = [r.x for r in df.select(fn.guarded_share(F.col("a"), F.col("b")).alias("x")).collect()]
    assert guarded == [0.5, 0.0, 0.0, None]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(fn.strict_share(F.col("a"), F.col("b")).alias("x")).collect()


def test_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(0.0001,), (0.0002,)], "v double")
    assert float(df.agg(fn.mean4(F.col("v")).alias("x")).first().x) == 0.0002


def test_null_is_no_difference(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 2)], "a int, b int")
    assert [r.x for r in df.select(fn.differs([F.col("a")], [F.col("b")]).alias("x")).collect()] == [False, False, False, True]


@pytest.mark.parametrize("text, want", [("34:12", 2052), ("0:05", 5), ("", None), ("34", None), (None, None)])
def test_clock(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.clock_seconds("t").alias("x")).first().x == want
