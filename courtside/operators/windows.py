"""Window operators that stay spread out when one key holds a large part of the rows.

A plain ``Window.partitionBy(key)`` puts all rows of a key in one task. Here the rows of every
key are cut into blocks along the sort order, months by default (``by_month``). Rows of a block
meet in one task; what a block needs from earlier blocks comes from a summary with few rows per
block. There is one plan at every size. Results equal the plain window.

``block`` is always a column that never decreases along ``order``. Its grain is a choice: a
coarse one repeats fewer rows before each block, a fine one cuts a hot key smaller.
Orders must be total (end them with a unique column) so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.functions.ordering import earliest_first, latest_first
from courtside.session import settle

BLOCK = "_block"

def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key under ``order``.

    Plans as a group limit before the shuffle, so a hot key ships n rows per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def by_month(day: Column | str) -> Column:
    """The default block: the month of a day or an instant."""
    return F.trunc(day, "month")


def in_ranges(column: Column | str, width: int) -> Column:
    """Ranges of whole numbers, as a level between a prefix and its many children."""
    return F.floor((F.col(column) if isinstance(column, str) else column) / width)


def looking_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    depth: int,
    reads: Sequence[str],
    build: dict[str, Callable[[object], Column]],
) -> DataFrame:
    """Add columns whose frames reach at most ``depth`` rows back inside a key.

    Each block is padded with the ``depth`` rows before it, computed from per-block tails; the
    padding leaves again after the window. ``reads`` names the columns
    that ``build`` uses besides keys and order.
    """
    keys, order, cell = list(keys), list(order), [*keys, BLOCK]
    carried = list(dict.fromkeys([*order, *reads]))
    rows = df.withColumn(BLOCK, block)

    tail = latest_by(
        rows.select(*cell, *[c for c in carried if c not in cell]), cell, latest_first(*order), depth
    )
    # at most depth rows per block reach the list
    tail = tail.groupBy(*cell).agg(
        F.array_sort(F.collect_list(F.struct(*_nulls_large(order), F.struct(*carried).alias("row")))).alias("rows")
    )
    before = Window.partitionBy(*keys).orderBy(F.col(BLOCK).asc_nulls_last()).rowsBetween(-depth, -1)
    pad = (
        tail.select(*cell, F.flatten(F.collect_list("rows").over(before)).alias("rows"))
        .where(F.size("rows") > 0)
        .select(*cell, F.explode(F.slice("rows", -F.least(F.size("rows"), F.lit(depth)), F.lit(depth))).alias("r"))
        .select(*cell, "r.row.*")
    )
    filled = [
        F.col(f.name) if f.name in pad.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in rows.schema.fields
    ]
    padded = rows.withColumn("_pad", F.lit(False)).unionByName(pad.select(*filled).withColumn("_pad", F.lit(True)))
    window = Window.partitionBy(*cell).orderBy(*earliest_first(*order))
    # the explicit repartition keeps a join's coarser partitioning (key only) from being reused
    return (
        padded.repartition(*cell)
        .withColumns({name: make(window) for name, make in build.items()})
        .where(~F.col("_pad"))
        .drop("_pad", BLOCK)
    )


def _nulls_large(order: Sequence[str]) -> list[Column]:
    """Struct fields that sort like ``order`` with NULL last."""
    out: list[Column] = []
    for i, name in enumerate(order):
        out += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"o{i}")]
    return out


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frames: dict[str, tuple[str, str, int]],
    block: Column | None = None,
) -> DataFrame:
    """Aggregates over the n rows before the current one, current row excluded.

    ``frames`` maps an output name to (aggregate, column, n). Without ``block`` this is a
    plain window: only for groups with a proven small bound (one row per calendar day).
    """

    def make(agg: str, column: str, n: int):
        return lambda w: getattr(F, agg)(column).over(w.rowsBetween(-n, -1))

    build = {name: make(*spec) for name, spec in frames.items()}
    if block is None:
        window = Window.partitionBy(*keys).orderBy(*earliest_first(*order))
        return df.withColumns({name: f(window) for name, f in build.items()})
    depth = max(n for _, _, n in frames.values())
    reads = list(dict.fromkeys(column for _, column, _ in frames.values()))
    return looking_back(df, keys, order, block, depth, reads, build)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, block: Column
) -> DataFrame:
    """Value of the row before, inside the key."""
    return looking_back(
        df, keys, order, block, 1, [value], {name: lambda w: F.lag(value, 1).over(w)}
    )


def global_previous(
    df: DataFrame, levels: Sequence[Sequence[str]], order: Sequence[str], value: str, name: str, block: Column
) -> DataFrame:
    """Value of the row before under one global order that crosses key borders.

    ``levels`` are growing column prefixes of the order, coarse to fine, for example
    [season, team] then [season, team, player]; ``order`` holds the columns after them.
    No step sorts the rows globally: only the coarsest summary, one row per distinct
    first prefix, is ordered as a whole. Each finer level is one window per parent prefix, so a
    prefix with very many children wants a level between: a range of the next column, which
    never decreases with it (``in_ranges``). Prefix and order columns must not be NULL.
    """
    key = list(levels[-1])
    levels = [*map(list, levels), [*key, BLOCK]]
    rows = df.withColumn(BLOCK, block)
    # the newest row under a prefix is the greatest struct in order; its value rides along
    newest = F.max(F.struct(*levels[-1], *order, F.col(value).alias("_value"))).alias("_last")
    summaries = [settle(rows.groupBy(*levels[-1]).agg(newest), "last-rows")]
    for level in reversed(levels[1:-1]):
        # every level reads the one below it, so each is worked out once
        summaries.insert(0, settle(summaries[0].groupBy(*level).agg(F.max("_last").alias("_last")), "last-rows"))
    summaries.insert(0, summaries[0].groupBy(*levels[0]).agg(F.max("_last").alias("_last")))

    carried = None
    for depth, summary in enumerate(summaries):
        parent = levels[depth - 1] if depth else []
        own = [c for c in levels[depth] if c not in parent]
        window = Window.partitionBy(*parent).orderBy(*own)
        step = summary.select(
            *levels[depth],
            F.lag("_last._value", 1).over(window).alias("_lag"),
            F.row_number().over(window).alias("_rn"),
        )
        if carried is None:
            carried = step.select(*levels[0], F.col("_lag").alias("_carry"))
        else:
            carried = step.join(carried, parent, "left").select(
                *levels[depth], F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag")).alias("_carry")
            )

    # the carried value comes first in its block, as one row more, so that the rows are shuffled once
    cell = levels[-1]
    first = carried.where(F.col("_carry").isNotNull()).select(*cell, F.col("_carry").alias(value))
    padded = rows.withColumn("_pad", F.lit(False)).unionByName(
        first.withColumn("_pad", F.lit(True)), allowMissingColumns=True
    )
    window = Window.partitionBy(*cell).orderBy(F.col("_pad").desc(), *earliest_first(*order))
    return (
        padded.repartition(*cell)
        .withColumn(name, F.lag(value, 1).over(window))
        .where(~F.col("_pad"))
        .drop("_pad", BLOCK)
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, block: Column) -> DataFrame:
    """row_number inside the key: the number inside the block plus the sizes of earlier blocks."""
    keys, cell = list(keys), [*keys, BLOCK]
    blocked = df.withColumn(BLOCK, block)
    before = Window.partitionBy(*keys).orderBy(F.col(BLOCK).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocked.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).select(
        *cell, F.sum("_n").over(before).alias("_start")
    )
    window = Window.partitionBy(*cell).orderBy(*earliest_first(*order))
    return (
        _join_null_safe(blocked.repartition(*cell), starts, cell)
        .withColumn(name, F.row_number().over(window) + F.coalesce("_start", F.lit(0)))
        .drop("_start", BLOCK)
    )


def ranked(df: DataFrame, keys: Sequence[str], value: str, name: str, band: Column) -> DataFrame:
    """rank() by ``value`` descending inside the key (1 + rows with a greater value).

    NULL is the greatest value, and NULL keys belong together, as in a window. Equal values
    collapse to one row with a count first. ``band`` is a column over ``value`` that never
    decreases with it; it cuts a key's values into tasks.
    """
    keys = list(keys)
    cell = [*keys, BLOCK]
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")).withColumn(BLOCK, band)
    above_band = Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    bands = counts.groupBy(*cell).agg(F.sum("_n").alias("_n")).select(
        *cell, F.coalesce(F.sum("_n").over(above_band), F.lit(0)).alias("_above")
    )
    above = Window.partitionBy(*cell).orderBy(F.col(value).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    places = _join_null_safe(
        counts.repartition(*cell).withColumn("_inside", F.coalesce(F.sum("_n").over(above), F.lit(0))), bands, cell
    ).select(*keys, value, (F.col("_above") + F.col("_inside") + 1).alias(name))
    return _join_null_safe(df, places, [*keys, value])


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Whole-group aggregates next to every row: aggregate first, then join one row per key back.

    The join can split a hot key; a window without an order could not.
    """
    keys = list(keys)
    return _join_null_safe(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), keys)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where NULL keys match each other, as they do in a window partition."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])
