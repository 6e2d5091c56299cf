"""What to load next: measure catalogue, calendar, pending work, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions import scalars as fn
from courtside.functions.ordering import earliest_first, latest_first
from courtside.operators.windows import latest_by

# Seasons covered by the player-list and roster backfills, newest first.
SEASONS = (
    "2016-17", "2015-16", "2014-15", "2013-14", "2012-13", "2011-12",
    "2010-11", "2009-10", "2008-09", "2007-08", "2006-07", "2005-06",
)

# Status words.
FINAL, POSTPONED, COMPLETED, FAILED = "Final", "PPD", "COMPLETED", "FAILED"

# Game-code marks of the exhibition game, and its team abbreviations.
EXHIBITION_CODES = ("WSTEST", "ESTWST")
EXHIBITION_TEAMS = ("EST", "WST")


def active_measures(
    nodes: DataFrame, season: str, node: str | None = None, table_name: str | None = None
) -> DataFrame:
    """Active measures the season already had, in load order; once-a-day ones marked 'pass' stay out
    of the per-node loop (see ``per_entity``)."""
    rows = nodes.where(F.col("active") & (F.col("available_year") <= fn.first_year(F.lit(season))))
    if node is not None:
        rows = rows.where(F.col("node") == node)
    if table_name is not None:
        rows = rows.where(F.col("table_name") == table_name)
    return rows.orderBy("endpoint", "measure", "table_name")


def per_entity(measures: DataFrame) -> DataFrame:
    return measures.where(F.col("measure_type") != "pass")


def single_measure(nodes: DataFrame, season: str, table_name: str):
    """The one measure that loads a table; anything but exactly one match is an error."""
    found = active_measures(nodes, season, table_name=table_name).take(2)
    if len(found) != 1:
        raise ValueError(f"invalid measure {table_name}, or not available in {season}")
    return found[0]


def season_dates(seasons: DataFrame, season: str, season_type: str) -> DataFrame:
    return seasons.where((F.col("season") == season) & (F.col("season_type") == season_type)).select(
        "start_date", "end_date", "is_current"
    )


def season_teams(teams: DataFrame, seasons: Sequence[str] = SEASONS) -> DataFrame:
    """Every (season, team) pair to backfill. The season list is a literal, so this is an
    explode over the teams and not a cross join."""
    return (
        teams.where(F.col("team_abbrv").isNotNull())
        .select("team_id", "team_abbrv")
        .distinct()
        .withColumn("season", F.explode(F.lit(list(seasons))))
    )


def watermarks(header: DataFrame, as_of: Column) -> DataFrame:
    """Last final day, first unfinished past day and last day of all, per season and season type,
    in one pass over the headers."""
    day, status = F.col("game_date"), F.col("game_status_text")
    return header.groupBy(F.col("_season").alias("season"), F.col("_season_type").alias("season_type")).agg(
        F.max(F.when(status == FINAL, day)).alias("last_final"),
        F.min(F.when((day < as_of) & ~status.isin(FINAL, POSTPONED), day)).alias("first_unfinished"),
        F.max(day).alias("last_game"),
    )


def schedule_range(marks: DataFrame, calendar: DataFrame, as_of: Column, full: bool = False) -> DataFrame:
    """First and last day still to pull per calendar row; no row where nothing is left.

    Nothing is left when start >= end, so a range of a single day is not pulled either.
    ``calendar`` has season, season_type, start_date, end_date and is_current.
    """
    keys = ["season", "season_type"]
    both = calendar.join(marks, keys, "left")
    opening, closing = F.col("start_date"), F.col("end_date")
    if full:
        start = F.least(F.date_add(F.coalesce("last_game", F.date_sub(opening, 1)), 1), closing)
        end = closing
    else:
        seen = F.col("last_final").isNotNull()
        start = F.when(seen, F.coalesce("first_unfinished", F.date_add("last_final", 1))).otherwise(opening)
        end = F.when(seen & F.col("is_current"), as_of).otherwise(closing)
    return both.select(*keys, start.alias("pull_from"), end.alias("pull_to")).where("pull_from < pull_to")


def date_spine(ranges: DataFrame) -> DataFrame:
    """One row per day of every range, both ends included, with its yyyyMMdd key."""
    days = F.explode(F.sequence("pull_from", "pull_to", F.expr("interval 1 day")))
    return ranges.withColumn("game_date", days).withColumn("node_key", fn.date_key("game_date"))


def done_keys(run_log: DataFrame, node: str, group_done: bool = False) -> DataFrame:
    """Distinct keys of a node that ever completed; with ``group_done`` its group must have, too."""
    done = (F.col("node") == node) & (F.col("node_status") == COMPLETED)
    if group_done:
        done = done & (F.col("group_status") == COMPLETED)
    return run_log.where(done).select("node_key").distinct()


def pending_games(header: DataFrame, run_log: DataFrame, season: str | None = None, season_type: str | None = None) -> DataFrame:
    """Finished, non-exhibition games whose game, teams and players were not all loaded yet."""
    games = header.where(F.col("game_status_text") == FINAL)
    if season is not None:
        games = games.where(F.col("_season") == season)
    if season_type is not None:
        games = games.where(F.col("_season_type") == season_type)
    for code in EXHIBITION_CODES:
        games = games.where(~F.col("gamecode").contains(code))
    done = done_keys(run_log, "game", group_done=True)
    return games.join(done, F.col("game_id") == F.col("node_key"), "left_anti").orderBy("game_date", "game_id")


def not_done(
    candidates: DataFrame,
    run_log: DataFrame,
    node: str,
    run_id: int,
    as_of: Column,
    keys: Sequence[str] = ("node_key",),
    season: str | None = None,
    season_type: str | None = None,
) -> DataFrame:
    """Candidates not completed in this run or today.

    Pass ("node_key", "parent_key") as ``keys`` for players, who are tracked per team.
    The log is filtered and made distinct first, so the anti join has one row per key.
    """
    fresh = (F.col("run_id") == run_id) | (F.col("end_dtm").cast("date") == as_of)
    done = run_log.where((F.col("node") == node) & (F.col("node_status") == COMPLETED) & fresh)
    if season is not None:
        done = done.where(F.col("season") == season)
    if season_type is not None:
        done = done.where(F.col("season_type") == season_type)
    return candidates.join(done.select(*keys).distinct(), list(keys), "left_anti")


def log_status(events: DataFrame) -> DataFrame:
    """Current status per (run, node, key, parent key) from append-only log events, such as ``load.run_games`` leaves.

    An event without a node status moves the group status only. Start is the first event;
    end and measure count come from the last one.
    """
    at = F.struct("at", "seq")
    return events.groupBy("run_id", "node", "node_key", "parent_key").agg(
        F.max_by("node_status", F.when(F.col("node_status").isNotNull(), at)).alias("node_status"),
        F.max_by("group_status", at).alias("group_status"),
        F.min("at").alias("started_dtm"),
        F.max("at").alias("end_dtm"),
        F.max_by("measure_count", at).alias("measure_count"),
    )


def latest_team(history: DataFrame) -> DataFrame:
    """Team a player belongs to in each season: the stint that started last."""
    order = [*latest_first("rec_start_date"), *earliest_first("team_id")]
    return latest_by(history, ["player_id", "season"], order).select("player_id", "season", "team_id")


def game_players(stats: DataFrame) -> DataFrame:
    """Players of each game and team, each once, by name."""
    return (
        stats.select("game_id", "team_id", "team_abbreviation", "player_id", "player_name")
        .distinct()
        .orderBy("game_id", "team_id", "player_name", "player_id")
    )


def season_players(stats: DataFrame, history: DataFrame) -> DataFrame:
    """Every player of a season with the team to load a single measure for."""
    players = stats.select("player_id", F.col("_season").alias("season")).distinct()
    return players.join(latest_team(history), ["player_id", "season"], "left")


def find_player(players: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Rows whose 'Last, First' (or single name) matches, ignoring case."""
    name = first if last is None else f"{last}, {first}"
    return players.where(F.lower("display_last_comma_first") == F.lower(F.lit(name)))


def with_names(df: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Player name and team abbreviation per row, instead of one lookup per task.

    Of several names of a player the smallest is taken; unknown players get a stand-in.
    """
    names = players.groupBy("player_id").agg(F.min("player_name").alias("player_name"))
    short = teams.groupBy("team_id").agg(F.min("team_abbrv").alias("team_abbrv"))
    return (
        df.join(names, "player_id", "left")
        .join(short, "team_id", "left")
        .withColumn("player_name", F.coalesce("player_name", F.lit(fn.UNKNOWN_PLAYER)))
    )
