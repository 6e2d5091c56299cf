"""The window operators, cut into blocks of several grains, against plain windows and brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from courtside.functions.ordering import earliest_first, latest_first
from courtside.operators import windows as w


@pytest.fixture(params=[1, 7, 100])
def block(request):
    """Days to blocks of so many days; the coarsest holds all of them."""
    return F.floor(F.col("day") / request.param)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key, some keys are NULL, days repeat and may be NULL."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        day = rng.choice([None, *range(40)])
        rows.append((key, day, i, rng.choice([None, rng.randint(0, 50)])))
    return spark.createDataFrame(rows, "k string, day int, id int, v int").cache()


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def plain(order=("day", "id")):
    return Window.partitionBy("k").orderBy(*earliest_first(*order))


def test_rolling_equals_a_plain_window(skewed, block):
    frames = {"s5": ("sum", "v", 5), "s10": ("sum", "v", 10), "a5": ("avg", "v", 5)}
    got = w.rolling(skewed, ["k"], ["day", "id"], frames, block=block)
    want = skewed.withColumns({n: getattr(F, f)(c).over(plain().rowsBetween(-d, -1)) for n, (f, c, d) in frames.items()})
    same(got, want)


def test_first_row_has_no_frame(skewed, block):
    got = w.rolling(skewed, ["id"], ["day"], {"s": ("sum", "v", 5)}, block=block)
    assert got.where("s is not null").count() == 0


def test_previous_equals_lag(skewed, block):
    got = w.previous(skewed, ["k"], ["day", "id"], "v", "p", block)
    same(got, skewed.withColumn("p", F.lag("v").over(plain())))


def test_numbered_equals_row_number(skewed, block):
    got = w.numbered(skewed, ["k"], ["day", "id"], "n", block)
    want = skewed.withColumn("n", F.row_number().over(plain()))
    assert sorted((r.id, r.n) for r in got.collect()) == sorted((r.id, r.n) for r in want.collect())


def test_global_previous_equals_an_unpartitioned_lag(skewed, block):
    rows = skewed.na.drop(subset=["k", "day"]).withColumn("g", F.substring("k", 1, 1))
    got = w.global_previous(rows, [["g"], ["g", "k"]], ["day", "id"], "v", "p", block)
    want = rows.withColumn("p", F.lag("v").over(Window.orderBy("g", "k", "day", "id")))
    same(got.select("id", "p"), want.select("id", "p"))


def test_ranked_equals_rank(skewed):
    got = w.ranked(skewed, ["k"], "v", "r", F.floor(F.col("v") / 10))
    want = skewed.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first())))
    assert sorted((r.id, r.r) for r in got.collect()) == sorted((r.id, r.r) for r in want.collect())


def test_group_stats_keep_null_keys_together(skewed):
    got = w.with_group_stats(skewed, ["k"], m=F.max("id"), n=F.count(F.lit(1)))
    whole = Window.partitionBy("k")
    same(got, skewed.withColumn("m", F.max("id").over(whole)).withColumn("n", F.count(F.lit(1)).over(whole)))


def test_null_sorts_as_largest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", 3, 3), ("b", 4, 4)], "k string, t int, id int")
    newest = w.latest_by(df, ["k"], latest_first("t", "id"))
    assert sorted(r.id for r in newest.collect()) == [1, 4]
    oldest = w.latest_by(df, ["k"], earliest_first("t", "id"))
    assert sorted(r.id for r in oldest.collect()) == [2, 3]
