"""The reporting refresh: every table in its fixed order, each published before the next reads it.

Published tables, not cached plans, connect the steps: a lost executor costs a task, and a failed run is repeated, or gone
on with, under the same version without touching what was published before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from courtside.functions import scalars as fn
from courtside.functions.ordering import latest_first
from courtside.operators.scd2 import scd2
from courtside.operators.windows import by_month, latest_by, previous
from courtside.plans import marts
from courtside.session import passing, settle
from courtside.sources import published
from courtside.sources.landing import conform
from courtside.sources.schemas import compared_columns, dim_player

# Tables in refresh order.
ORDER = (
    "dim_player", "dim_game", "dim_player_team_history", "fct_game_team", "fct_game_player",
    "dim_player_schedule", "player_time", "player_latest_news",
)


def game_dimension(header: DataFrame) -> DataFrame:
    return header.select(
        F.col("game_id").alias("id"), F.col("gamecode").alias("game_code"), "game_date",
        F.col("game_status_text").alias("game_status"), "home_team_id", "visitor_team_id",
        F.col("_season").alias("season"), F.col("_season_type").alias("season_type"),
    )


def team_game_facts(team_box: DataFrame, games: DataFrame) -> DataFrame:
    """Landed team box scores of known games, one row per game and team."""
    known = games.select(F.col("id").alias("game_id"), "season", "game_date")
    return latest_by(team_box, ["game_id", "team_id"], latest_first("_create_date")).join(known, "game_id")


def player_game_facts(player_box: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """Landed player box scores of known games with side, opponent and the player version of the game day.

    That is the version that started last on or before the day; a game before the first version has the first.
    Playing time is taken from ``seconds``, or from the clock text ``min`` where there is none.
    """
    if "seconds" not in player_box.columns:
        player_box = player_box.withColumn("seconds", fn.clock_seconds("min"))
    home = F.col("team_id") == F.col("home_team_id")
    known = games.select(F.col("id").alias("game_id"), "season", "game_date", "home_team_id", "visitor_team_id")
    # as many versions of a player as there were refreshes with a change
    versions = players.groupBy(F.col("id").alias("player_id")).agg(
        F.sort_array(F.collect_list(F.struct("rec_start_date", "dim_player_guid"))).alias("versions")
    )
    started = F.filter("versions", lambda v: v["rec_start_date"] <= F.col("game_date"))
    version = F.coalesce(F.get(F.reverse(started), F.lit(0)), F.get("versions", F.lit(0)))["dim_player_guid"]
    # the shuffles that find the games leave the disk before that of the players comes
    lines = settle(
        latest_by(player_box, ["game_id", "player_id"], latest_first("_create_date"))
        .join(known, "game_id")
        .select(
            "game_id", "player_id", "season", "team_id", "team_abbreviation",
            F.when(home, "H").otherwise("V").alias("team_loc"),
            F.when(home, F.col("visitor_team_id")).otherwise(F.col("home_team_id")).alias("opp_team_id"),
            F.when(home, "V").otherwise("H").alias("opp_team_loc"),
            "game_date", "seconds", "start_position", "comment", *fn.FANTASY_WEIGHTS,
        ),
        "lines",
    )
    first, *others = [c for c in lines.columns if c not in ("game_id", "player_id")]
    return lines.join(versions, "player_id", "left").select(
        "game_id", "player_id", version.alias("dim_player_guid"), first, *others
    )


def player_schedule_dimension(schedule: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The schedule with each player's game before and the days since."""
    rested = previous(
        schedule.where(F.col("player_id").isNotNull()), ["player_id"], ["game_date", "game_id", "team_loc"], "game_date",
        "player_previous_game_date", by_month("game_date"),
    )
    return rested.withColumns(
        {"days_rest": fn.days_rest("game_date", "player_previous_game_date"), "created_at": F.lit(as_of)}
    )


def _scd2_parts(table: DataFrame, source: DataFrame, compare: list[str], now: Column, keep_dates: bool = False) -> DataFrame:
    """Rows of a slowly changing table that a refresh writes: all open versions, and those it closes.

    Versions closed before only matter by their keys: a key that has nothing else is left alone.
    """
    active = F.coalesce(F.col("is_rec_active"), F.lit(False))
    opened = table.where(active)
    ended = table.where(~active).select("id").distinct().join(opened.select("id"), "id", "left_anti")
    return scd2(opened, source.join(ended, "id", "left_anti"), "id", compare, now, keep_dates=keep_dates)[0]


# Columns that no row of a refreshed table may lack.
REQUIRED = {
    "dim_player": ("dim_player_guid", "rec_start_date", "is_rec_active", "created_at"), "dim_game": ("id",),
    "dim_player_team_history": ("dim_player_guid", "is_rec_active"), "fct_game_team": ("game_id", "team_id"),
    "fct_game_player": ("game_id", "player_id"), "dim_player_schedule": ("player_id", "game_id"), "player_time": ("player_id", "game_date"),
}
# Parts of a slowly changing table, as folder names.
OPEN, CLOSED = "true", "false"


def refresh_all(
    spark: SparkSession,
    landed: Mapping[str, DataFrame],
    root: str,
    version: str,
    as_of: dt.datetime,
    before: str | None = None,
    seasons: Sequence[str] | None = None,
    resume: bool = False,
) -> dict[str, int]:
    """Publish a new version of every reporting table under ``root``; returns rows written per table, in order.

    ``landed`` holds player_common (snapshot), player_common_all, team, header, player_box,
    team_box and news. ``before`` names the version the slowly changing tables start from.

    Slowly changing tables write their open versions and add those closed by this run; the closed history stays as it is.
    Tables of games write the seasons of the games, or only ``seasons``, whose other inputs are then not read either; the
    parts of other seasons stay (a later season's first days of rest are those of when it was refreshed). A table becomes
    current if its required columns hold, see ``sources.published``. With ``resume`` tables that this version has already
    published are not written again, so that a broken run goes on where it ended; their rows written count as 0.
    """
    now = F.lit(as_of)
    counts: dict[str, int] = {}

    def done(table: str) -> bool:
        return resume and version in published.versions(spark, root, table)

    def write(table: str, rows: Callable[[], DataFrame], part: str, parts: Sequence[str] | None, adds: Sequence[str] = ()) -> DataFrame:
        counts[table] = 0
        if not done(table):
            # what a table is worked out from leaves the disk once the table is published
            with passing(spark):
                counts[table] = published.publish_parts(rows(), root, table, version, part, parts, REQUIRED.get(table, ()), adds)
        return published.read_parts(spark, root, table, version)

    def versioned(table: str, source: Callable[[], DataFrame], history: bool) -> DataFrame:
        def rows() -> DataFrame:
            # the limit shows the planner that a first run has no versions to compare with
            old = spark.createDataFrame([], dim_player(history)).limit(0) if before is None else published.read_parts(spark, root, table, before)
            return _scd2_parts(old, settle(source(), table), compared_columns(history), now, keep_dates=history)

        return write(table, rows, "is_rec_active", [OPEN, CLOSED], adds=[CLOSED])

    def by_season(table: str, rows: Callable[[], DataFrame]) -> DataFrame:
        found = write(table, rows, "season", seasons)
        return found if seasons is None else found.where(F.col("season").isin(list(seasons)))

    people = versioned("dim_player", lambda: conform(marts.player_versions(landed["player_common"], landed["team"], now).withColumns(
        {"rec_start_date": now.cast("date"), "is_rec_active": F.lit(True), "created_at": now}
    ), dim_player()), False)
    people = people.withColumns({"pos": F.col("nba_pos"), "fd_pos": F.col("nba_pos")})

    games = by_season("dim_game", lambda: game_dimension(landed["header"]))

    history = versioned("dim_player_team_history", lambda: conform(marts.team_history(
        landed["player_common_all"], landed["team"], landed["player_box"], landed["header"], now,
    ).withColumn("created_at", now), dim_player(history=True)), True)

    teams = landed["team"].select(
        F.col("team_id").alias("id"), "team_name", F.col("team_abbrv").alias("team_abbreviation")
    )
    by_season("fct_game_team", lambda: team_game_facts(landed["team_box"], games))
    facts = by_season("fct_game_player", lambda: player_game_facts(landed["player_box"], games, people))

    def listed() -> DataFrame:
        roster = history.select(F.col("id").alias("player_id"), "season", "team_id", "rec_start_date")
        # the lag reads the rows twice; a leg without a player is no row of the table
        rows = settle(marts.schedule(games, teams, facts, roster, people, players_only=True), "schedule")
        if seasons is None or before is None:
            return player_schedule_dimension(rows, as_of)
        # the days of rest of a player's first game need the games of other seasons
        others = published.read_parts(spark, root, "dim_player_schedule", before).where(~F.col("season").isin(list(seasons)))
        return player_schedule_dimension(rows.unionByName(others.select(*rows.columns)), as_of)

    schedule = by_season("dim_player_schedule", listed)
    by_season("player_time", lambda: marts.player_time(schedule, facts, people, landed["news"]))
    counts["player_latest_news"] = 0
    if not (resume and version in published.versions(spark, root, "player_latest_news")):
        news = marts.latest_news(landed["news"]).withColumn("feed", F.lit("news"))
        counts["player_latest_news"] = published.publish_parts(news, root, "player_latest_news", version, "feed")
    return {table: counts[table] for table in ORDER}
