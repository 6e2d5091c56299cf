from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from courtside.operators.scd2 import open_versions, scd2

DIM = "guid string, id int, a string, b int, rec_start_date date, rec_end_date date, is_rec_active boolean, created_at timestamp, updated_at timestamp"
NEW = "guid string, id int, a string, b int"
THEN, NOW = dt.datetime(2016, 1, 1), dt.datetime(2017, 1, 1)


def version(guid, id, a, b, active=True):
    return (guid, id, a, b, THEN.date(), None, active, THEN, None)


def refresh(spark, dim, new, **options):
    after, inserted = scd2(
        spark.createDataFrame(dim, DIM), spark.createDataFrame(new, NEW), "id", ["a", "b"], F.lit(NOW), **options
    )
    return after, inserted


def state(df):
    return sorted(((r.guid, r.is_rec_active) for r in df.collect()), key=str)


def test_change_closes_and_inserts(spark):
    after, inserted = refresh(spark, [version("v1", 1, "x", 1)], [("v2", 1, "y", 1)])
    assert state(after) == [("v1", False), ("v2", True)]
    old, new = sorted(after.collect(), key=lambda r: r.guid)
    assert old.updated_at == NOW and old.rec_end_date == NOW.date() and old.created_at == THEN
    assert new.updated_at is None and new.rec_start_date == new.rec_end_date == NOW.date()
    assert inserted.count() == 1


@pytest.mark.parametrize("before, after", [((None, 1), ("x", 1)), (("x", 1), (None, 1)), ((None, None), (None, None))])
def test_null_is_never_a_change(spark, before, after):
    rows, inserted = refresh(spark, [version("v1", 1, *before)], [("v2", 1, *after)])
    assert state(rows) == [("v1", True)] and inserted.count() == 0


def test_key_with_closed_versions_only_stays_away(spark):
    rows, inserted = refresh(spark, [version("v1", 1, "x", 1, active=False)], [("v2", 1, "y", 1)])
    assert state(rows) == [("v1", False)] and inserted.count() == 0


def test_unknown_key_is_inserted_with_all_its_rows_but_no_copies(spark):
    rows, inserted = refresh(spark, [], [("v2", 1, "y", 1), ("v2", 1, "y", 1), ("v3", 1, "z", 1)])
    assert state(rows) == [("v2", True), ("v3", True)]


def test_one_of_several_source_rows_differs(spark):
    rows, _ = refresh(spark, [version("v1", 1, "m", 5)], [("n1", 1, "m", 5), ("n2", 1, "a", 5), ("n3", 1, None, 5)])
    assert state(rows) == [("n1", True), ("n2", True), ("n3", True), ("v1", False)]


def test_a_value_between_the_extremes_counts(spark):
    # neither extreme equals the old value, though one row between them does
    rows, _ = refresh(spark, [version("v1", 1, "m", 5)], [("n1", 1, "a", 5), ("n2", 1, "z", 5), ("n3", 1, "m", 5)])
    assert ("v1", False) in state(rows)


def test_closed_versions_are_not_touched(spark):
    rows, _ = refresh(spark, [version("v0", 1, "w", 1, active=False), version("v1", 1, "x", 1)], [("v2", 1, "y", 1)])
    old = {r.guid: r for r in rows.collect()}["v0"]
    assert old.updated_at is None and old.rec_end_date is None


def test_kept_dates_are_for_unknown_keys_only(spark):
    schema = NEW + ", rec_start_date date, rec_end_date date"
    start, end = dt.date(2010, 1, 1), dt.date(2011, 1, 1)
    new = spark.createDataFrame([("n1", 1, "y", 1, start, end), ("n2", 2, "q", 1, start, None)], schema)
    after, _ = scd2(spark.createDataFrame([version("v1", 1, "x", 1)], DIM), new, "id", ["a", "b"], F.lit(NOW), keep_dates=True)
    rows = {r.guid: r for r in after.collect()}
    assert rows["n1"].rec_start_date == rows["n1"].rec_end_date == NOW.date()
    assert rows["n2"].rec_start_date == start and rows["n2"].rec_end_date is None and rows["n2"].is_rec_active


value = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
number = st.one_of(st.none(), st.integers(0, 2))


def by_hand(dim, new):
    """The refresh read off its rules, row by row."""
    def changed(d):
        return d[6] and any(
            n[1] == d[1] and any(p is not None and q is not None and p != q for p, q in zip(d[2:4], n[2:4])) for n in new
        )

    closed = {d[1] for d in dim if changed(d)}
    known = {d[1] for d in dim}
    kept = [(d[0], d[6] and not changed(d)) for d in dim]
    return sorted(kept + sorted({(n[0], True) for n in new if n[1] not in known or n[1] in closed}), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 4), value, number, st.booleans()), max_size=8),
    st.lists(st.tuples(st.integers(1, 4), value, number), max_size=8),
)
def test_against_the_rules_by_hand(spark, old, source):
    dim = [version(f"d{i}", *row[:3], active=row[3]) for i, row in enumerate(old)]
    new = [(f"n{i}", *row) for i, row in enumerate(source)]
    after, _ = refresh(spark, dim, new)
    assert state(after) == by_hand(dim, new)


def test_second_run_adds_nothing_and_one_version_is_open(spark):
    new = [(f"n{i}", i, "x", i) for i in range(20)]
    first, _ = refresh(spark, [], new)
    rows = [tuple(r) for r in first.collect()]
    again, inserted = refresh(spark, rows, new)
    assert inserted.count() == 0 and again.count() == 20
    assert open_versions(again, "id").count() == 0
