"""Split tables: sums of game, period, shot or tracking rows by a derived key.

Rows are one per player (or team) and game unless a function says otherwise. Every
split is one grouped aggregation, combined on the map side, over one scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.functions.ordering import latest_first
from courtside.operators.windows import numbered, ranked

# Clutch windows as (seconds left, lowest margin, highest margin).
CLUTCH = {
    "last5min_deficit_5point": (300, -5, 0),
    "last3min_deficit_5point": (180, -5, 0),
    "last1min_deficit_5point": (60, -5, 0),
    "last30sec_deficit_3point": (30, -3, 0),
    "last10sec_deficit_3point": (10, -3, 0),
    "last5min_plusminus_5point": (300, -5, 5),
    "last3min_plusminus_5point": (180, -5, 5),
    "last1min_plusminus_5point": (60, -5, 5),
    "last30sec_plusminus_5point": (30, -3, 3),
}

LAST_GAMES = (5, 10, 15, 20)


# -- aggregation ----------------------------------------------------------------------

def totals(
    rows: DataFrame, by: Sequence[Column | str], stats: Sequence[str], per_mode: str = "Totals", seconds: str = "seconds"
) -> DataFrame:
    """Sums per group as Totals, PerGame (by row count) or Per36 (by minutes played)."""
    games = F.count(F.lit(1))
    if per_mode == "Totals":
        scaled = {s: F.sum(s) for s in stats}
    elif per_mode == "PerGame":
        scaled = {s: F.sum(s).cast("double") / games for s in stats}
    elif per_mode == "Per36":
        played = F.sum(seconds)
        scaled = {
            s: F.when(played != 0, F.sum(s).cast("double") * (36 * 60) / played.cast("double")) for s in stats
        }
    else:
        raise ValueError(f"unknown per_mode {per_mode}")
    return rows.groupBy(*by).agg(games.alias("gp"), *[c.alias(s) for s, c in scaled.items()])


def narrowed(
    rows: DataFrame,
    *,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    month: int | None = None,
    shot_clock_range: tuple[float, float] | None = None,
    last_n_games: int | None = None,
    entity: str = "player_id",
    **equals: object,
) -> DataFrame:
    """The filter set all splits share. ``equals`` are plain column = value tests (season,
    season_type, outcome, location, opp_team_id, opp_conference, opp_division, game_segment,
    period, po_round, ...); None means no test. The last-N filter comes after all others."""
    tests = [F.col(name) == value for name, value in equals.items() if value is not None]
    if date_from is not None:
        tests.append(F.col("game_date") >= F.lit(date_from))
    if date_to is not None:
        tests.append(F.col("game_date") <= F.lit(date_to))
    if month is not None:
        tests.append(F.month("game_date") == month)
    if shot_clock_range is not None:
        low, high = shot_clock_range
        tests.append((F.col("shot_clock") >= low) & (F.col("shot_clock") < high))
    for test in tests:
        rows = rows.where(test)
    return last_games(rows, [entity], last_n_games) if last_n_games else rows


def last_games(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The newest n rows per key, numbered from the newest in ``games_back``."""
    window = Window.partitionBy(*keys).orderBy(*latest_first("game_date", "game_id"))
    return rows.withColumn("games_back", F.row_number().over(window)).where(F.col("games_back") <= n)


# -- split keys -----------------------------------------------------------------------

def season_half(cut: dt.date) -> Column:
    """Before or after the break; a game without a date is in neither half."""
    day = F.col("game_date")
    return F.when(day < F.lit(cut), "Pre All-Star").when(day >= F.lit(cut), "Post All-Star")


def rest_bucket(rest: Column | str, most: int = 6) -> Column:
    """Days without a game between two games: 0 for back to back, ``most``+ pooled."""
    free = (F.col(rest) if isinstance(rest, str) else rest) - 1
    return (
        F.when(free.isNull(), "First Game")
        .when(free >= most, f"{most}+ Days Rest")
        .otherwise(F.concat(F.greatest(free, F.lit(0)).cast("string"), F.lit(" Days Rest")))
    )


def band(value: Column | str, width: float) -> Column:
    """Lower edge of the band a value falls into."""
    return (F.floor((F.col(value) if isinstance(value, str) else value) / width) * width).cast("bigint")


def labelled(value: Column | str, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the range a value falls into; names has one entry more than edges."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.when(value < edges[0], names[0])
    for edge, name in zip(edges[1:], names[1:-1]):
        out = out.when(value < edge, name)
    return out.when(value.isNotNull(), names[-1])


# -- splits that need more than a key -------------------------------------------------

def by_opponent(rows: DataFrame, teams: DataFrame, level: str, entity: str, stats: Sequence[str], **options) -> DataFrame:
    """By the opponent's ``level``: conference, division or the team itself (id)."""
    side = teams.select(F.col("id").alias("opp_team_id"), F.col(level).alias(f"opp_{level}"))
    return totals(rows.join(side, "opp_team_id"), [entity, f"opp_{level}"], stats, **options)


def by_last_games(
    rows: DataFrame, entity: str, stats: Sequence[str], sizes: Sequence[int] = LAST_GAMES, **options
) -> DataFrame:
    """Sums over the newest 5, 10, 15 and 20 games, all sizes from one pass."""
    inside = F.filter(F.array(*map(F.lit, sizes)), lambda n: F.col("games_back") <= n)
    recent = last_games(rows, [entity], max(sizes)).withColumn("last_n", F.explode(inside))
    return totals(recent, [entity, "last_n"], stats, **options)


def by_game_number(
    rows: DataFrame, entity: Sequence[str], stats: Sequence[str], block: Column, width: int = 10, **options
) -> DataFrame:
    """By blocks of consecutive games: 1-10, 11-20, ... of an entity."""
    counted = numbered(rows, entity, ["game_date", "game_id"], "_game", block)
    first = ((F.floor((F.col("_game") - 1) / width)) * width + 1).cast("bigint")
    return totals(counted.withColumn("first_game", first), [*entity, "first_game"], stats, **options)


def by_clutch(rows: DataFrame, entity: str, stats: Sequence[str], windows: dict = CLUTCH, **options) -> DataFrame:
    """Event rows with ``seconds_left`` and ``margin``: sums per clutch window a row falls into."""
    hits = [
        F.when(
            (F.col("seconds_left") <= left) & F.col("margin").between(low, high), F.lit(name)
        )
        for name, (left, low, high) in windows.items()
    ]
    longest = max(left for left, _, _ in windows.values())
    inside = rows.where(F.col("seconds_left") <= longest).withColumn(
        "clutch", F.explode(F.array_compact(F.array(*hits)))
    )
    return totals(inside, [entity, "clutch"], stats, **options)


def by_year_with_career(rows: DataFrame, entity: str, stats: Sequence[str]) -> DataFrame:
    """One row per season, and one over all of them (season NULL). The career row adds up the
    season rows, so the detail is read once."""
    years = totals(rows, [entity, "season"], stats)
    return years.unionByName(
        years.groupBy(entity).agg(
            F.lit(None).cast("string").alias("season"), F.sum("gp").alias("gp"), *[F.sum(s).alias(s) for s in stats]
        )
    )


def rankings(season_totals: DataFrame, stat: str, width: float) -> DataFrame:
    """Rank of each row inside its season by a stat, greatest first; ``width`` cuts the stat
    into bands so that no season is ranked by a single task."""
    return ranked(season_totals, ["season"], stat, f"{stat}_rank", F.floor(F.col(stat) / width))


def highs(rows: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Greatest value of each stat and the first game day it was reached."""
    best = [
        F.max(F.struct(F.col(s).alias("v"), F.negative(F.datediff("game_date", F.lit(dt.date(1970, 1, 1)))).alias("d"))).alias(s)
        for s in stats
    ]
    return rows.groupBy(*keys).agg(*best).select(
        *keys,
        *[
            c
            for s in stats
            for c in (
                F.col(f"{s}.v").alias(f"{s}_high"),
                F.date_add(F.lit(dt.date(1970, 1, 1)), -F.col(f"{s}.d")).alias(f"{s}_date"),
            )
        ],
    )


def next_game(rows: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """First scheduled day after a given one, per key."""
    return rows.where(F.col("game_date") > as_of).groupBy(*keys).agg(F.min("game_date").alias("next_game"))


def pass_pairs(passes: DataFrame, made_by: str, received_by: str) -> DataFrame:
    """Passes per ordered pair that really occurs."""
    return passes.where(F.col(made_by).isNotNull() & F.col(received_by).isNotNull()).groupBy(
        made_by, received_by
    ).agg(F.count(F.lit(1)).alias("passes"))


def on_off(segments: DataFrame, presence: DataFrame, team: str, player: str, stats: Sequence[str]) -> DataFrame:
    """Team numbers with a player on and off the court.

    ``segments`` has one row per team and segment, ``presence`` the players of each segment.
    Off is the team total less on, so nothing is paired with the players that were absent.
    """
    keys = ["segment_id", team]
    on = (
        presence.select(*keys, player).distinct()
        .join(segments.select(*keys, *stats), keys)
        .groupBy(team, player)
        .agg(F.count(F.lit(1)).alias("on_gp"), *[F.sum(s).alias(f"on_{s}") for s in stats])
    )
    whole = segments.groupBy(team).agg(F.count(F.lit(1)).alias("gp"), *[F.sum(s).alias(s) for s in stats])
    return on.join(whole, team).select(
        team, player, "on_gp", *[f"on_{s}" for s in stats],
        (F.col("gp") - F.col("on_gp")).alias("off_gp"),
        *[(F.col(s) - F.col(f"on_{s}")).alias(f"off_{s}") for s in stats],
    )


def versus(
    rows: DataFrame, presence: DataFrame, entity: str, player: str, vs_player: object, stats: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """An entity's numbers in games with and without one named player."""
    games = presence.where(F.col(player) == vs_player).select("game_id").distinct().withColumn("_met", F.lit(True))
    met = rows.join(games, "game_id", "left").withColumn(
        "court_status", F.when(F.col("_met"), "On").otherwise("Off")
    )
    return totals(met, [entity, "court_status", *by], stats)


def lineups(presence: DataFrame, segment: Sequence[str], player: str, size: int = 5) -> DataFrame:
    """How often each group of exactly ``size`` players was together.

    Segments of another size go before any list is built, so a list never exceeds ``size``.
    """
    there = presence.select(*segment, player).distinct()
    full = there.groupBy(*segment).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == size).drop("_n")
    groups = (
        there.join(full, list(segment), "left_semi")
        .groupBy(*segment)
        .agg(F.array_sort(F.collect_list(player)).alias("lineup"))
    )
    return groups.groupBy("lineup").agg(F.count(F.lit(1)).alias("segments"))


def line_score(rows: DataFrame, keys: Sequence[str], period: str, points: str, periods: Sequence[int]) -> DataFrame:
    """Points per period next to each other; periods are named, so no extra pass finds them."""
    return rows.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(period) == p, F.col(points))), F.lit(0)).alias(f"pts_{p}")
            for p in periods
        ],
        F.sum(points).alias("pts"),
    )
