"""Reporting tables: stints, schedules, defence, playing time, features, injury benefit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.functions import scalars as fn
from courtside.functions.ordering import earliest_first, latest_first
from courtside.operators.windows import by_month, global_previous, in_ranges, latest_by, previous, rolling, with_group_stats
from courtside.plans.control import EXHIBITION_TEAMS, FINAL
from courtside.session import passing, settle
from courtside.sources.schemas import HUSTLE_STATS, OPPONENT_STATS

# Defence categories and the columns that average them.
DEFENCE_CATEGORIES = {
    "Less Than 6 Ft": "less_than_6ft",
    "Less Than 10 Ft": "less_than_10ft",
    "Greater Than 15 Ft": "greater_than_15ft",
    "3 Pointers": "three_pointers",
    "2 Pointers": "two_pointers",
    "Overall": "overall",
}

# Share of an injured player's time that falls to a position,
# as (injured position, benefiting position, factor). Pairs not listed get nothing.
POSITION_FACTORS = (
    ("C", "C", 0.75), ("C", "PF", 0.25),
    ("PF", "PF", 0.75), ("PF", "C", 0.15), ("PF", "SF", 0.10),
    ("SF", "SF", 0.75), ("SF", "SG", 0.10), ("SF", "PG", 0.10), ("SF", "PF", 0.05),
    ("PG", "PG", 0.65), ("PG", "SG", 0.25), ("PG", "SF", 0.10),
)

# Injury details taken from the news.
INJURY_DETAILS = ("injured_status", "injury_detail", "injury_location", "injury_side", "injury_type")


# -- stints ---------------------------------------------------------------------------

def appearances(stats: DataFrame, header: DataFrame) -> DataFrame:
    """First and last game day per player, team and season; exhibition teams left out."""
    return (
        stats.where(~F.col("team_abbreviation").isin(*EXHIBITION_TEAMS))
        .join(header.select("game_id", "game_date", F.col("_season").alias("season")), "game_id")
        .groupBy("player_id", "player_name", "team_id", "team_abbreviation", "season")
        .agg(F.min("game_date").alias("start_date"), F.max("game_date").alias("end_date"))
    )


def stints(stats: DataFrame, header: DataFrame, seasons: DataFrame) -> DataFrame:
    """Appearances with an active flag; stints of the running season have no end yet."""
    running = seasons.where(F.col("season_type") == "Regular Season").select("season", "is_current")
    return (
        appearances(stats, header)
        .join(running, "season")
        .select(
            "player_id", "player_name", "team_id", "team_abbreviation", "season", "start_date",
            fn.yes_no("is_current").alias("is_active"),
            fn.open_end("is_current", "end_date").alias("end_date"),
        )
        .orderBy("player_name", "season", "start_date", "player_id", "team_id")
    )


def stints_with_attributes(
    stats: DataFrame, header: DataFrame, common: DataFrame, teams: DataFrame, as_of: Column
) -> DataFrame:
    """Appearances with the player's attributes. A player with several rows in ``common``
    appears once per row and stint, since the match is on the player alone."""
    person = player_attributes(common).select(
        F.col("id"), *PERSON_COLUMNS
    )
    team = teams.select("team_id", "team_name", "team_abbrv")
    key = fn.version_text(["player_id"], as_of.cast("string"))
    return (
        appearances(stats, header)
        .join(person, F.col("player_id") == F.col("id"), "left")
        .join(team, "team_id", "left")
        .select(
            fn.text_key(key).alias("dim_player_guid"), key.alias("crc_str"), F.col("player_id").alias("id"),
            *PERSON_COLUMNS, "team_id", "team_name", "team_abbrv", "season", "start_date", "end_date",
        )
        .orderBy("id", "start_date")
    )


PERSON_COLUMNS = (
    "first_name", "last_name", "display_first_last", "display_last_comma_first", "birthdate", "school",
    "country", "last_affiliation", "height", "weight", "jersey", "nba_pos", "rosterstatus",
    "is_dleague", "is_games_played",
)


# -- player dimension -----------------------------------------------------------------

def player_attributes(common: DataFrame) -> DataFrame:
    """Landed player rows with typed attributes, named as in the dimension."""
    return common.withColumns(
        {
            "birthdate": fn.birth_date("birthdate"),
            "height": fn.height_inches("height"),
            "weight": fn.text_to_int("weight"),
            "jersey": fn.text_to_int("jersey"),
            "is_dleague": fn.yes_flag("dleague_flag"),
            "is_games_played": fn.yes_flag("games_played_flag"),
        }
    ).withColumnsRenamed({"person_id": "id", "position": "nba_pos", "_season": "season", "_team_id": "team_id"}).drop(
        "dleague_flag", "games_played_flag"
    )


def player_versions(common: DataFrame, teams: DataFrame, as_of: Column) -> DataFrame:
    """Source rows for the player dimension."""
    key = fn.version_text(["id"], fn.clock_text(as_of))
    return (
        player_attributes(common)
        .join(teams.select("team_id", "team_name", "team_abbrv"), "team_id", "left")
        .withColumns({"crc_str": key, "dim_player_guid": fn.text_key(key)})
    )


def team_history(
    common: DataFrame,
    teams: DataFrame,
    stats: DataFrame,
    header: DataFrame,
    as_of: Column,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Source rows for the team-history form: one per player, season and team, with the first
    and last day played. The stint that ends on the player's last day is still open.

    Repeated landed rows of one stint share its dates; the newest landed one is taken.
    """
    played = (
        stats.where(~F.col("team_abbreviation").isin(*EXHIBITION_TEAMS))
        .join(header.select("game_id", "game_date"), "game_id")
        .groupBy(F.col("player_id").alias("id"), "team_id", F.col("_season").alias("season"))
        .agg(F.min("game_date").alias("start_date"), F.max("game_date").alias("end_date"))
    )
    stint = ["id", "season", "team_id"]
    newest = latest_by(player_attributes(common), stint, latest_first("_create_date", *tie))
    dated = newest.join(played, stint, "left")
    # one row per stint by now: a player's group is bounded by seasons x teams
    last = dated.withColumn("last_played_date", F.max("end_date").over(Window.partitionBy("id")))
    still = F.coalesce(F.col("end_date") == F.col("last_played_date"), F.lit(False))
    key = fn.version_text(["id", "team_id", "season"], as_of.cast("string"))
    # the landed team id drives the stint; the dimension shows the id the team table knows
    named = last.join(
        teams.select("team_id", F.col("team_id").alias("_known"), "team_name", "team_abbrv"), "team_id", "left"
    )
    return named.withColumns(
        {
            "team_id": F.col("_known"),
            "rec_start_date": F.col("start_date"),
            "rec_end_date": F.when(~still, F.col("end_date")),
            "is_rec_active": still,
        }
    ).withColumns({"crc_str": key, "dim_player_guid": fn.text_key(key)}).drop("_known", "start_date", "end_date")


# -- schedule -------------------------------------------------------------------------

def schedule_from_facts(
    games: DataFrame, teams: DataFrame, facts: DataFrame, players: DataFrame, both_legs: bool = False
) -> DataFrame:
    """Home and road leg of every game with the players who appeared.

    A player is listed on the leg of the own team. ``both_legs`` lists all players of a
    game on both legs instead.
    """
    team = teams.select(F.col("id").alias("team_id"), "team_abbreviation")
    rival = teams.select(F.col("id").alias("opp_team_id"), F.col("team_abbreviation").alias("opp_team_abbreviation"))
    # one scan of the games gives both legs
    legs = games.select(
        F.col("id").alias("game_id"), "season", "game_date",
        F.explode(F.array(
            F.struct(F.lit("Home").alias("loc"), F.lit("Road").alias("opp_loc"),
                     F.col("home_team_id").alias("team_id"), F.col("visitor_team_id").alias("opp_team_id")),
            F.struct(F.lit("Road").alias("loc"), F.lit("Home").alias("opp_loc"),
                     F.col("visitor_team_id").alias("team_id"), F.col("home_team_id").alias("opp_team_id")),
        )).alias("leg"),
    ).select("game_id", "season", "game_date", "leg.*")
    keys = ["game_id"] if both_legs else ["game_id", "team_id"]
    seen = facts.select(*keys, "player_id").distinct()
    person = players.select("id", "display_first_last", "birthdate")
    return (
        legs.join(team, "team_id").join(rival, "opp_team_id")
        .join(seen, keys, "left")
        .join(person, F.col("player_id") == F.col("id"), "left")
        .select(
            "display_first_last", F.col("id").alias("player_id"), "game_id",
            fn.age_days("game_date", "birthdate").alias("age_days"),
            "loc", "team_id", "team_abbreviation", "opp_team_id", "opp_team_abbreviation", "opp_loc",
            "season", "game_date",
        )
        .distinct()
    )


def schedule(
    games: DataFrame, teams: DataFrame, facts: DataFrame, history: DataFrame, players: DataFrame, players_only: bool = False
) -> DataFrame:
    """Finished games from the facts; open games from each player's latest team of the season.

    A game of which nobody is known has a row without a player; ``players_only`` leaves it out.
    """
    played = (
        games.where(F.col("game_status") == FINAL)
        .select(F.col("id").alias("game_id"), "game_code", "game_date", "game_status")
        .join(
            facts.select("game_id", "player_id", "team_id", "opp_team_id", "team_loc", "opp_team_loc", "season"),
            "game_id", "left",
        )
    )
    order = [*latest_first("rec_start_date"), *earliest_first("team_id")]
    roster = latest_by(history, ["player_id", "season"], order).select("player_id", "season", "team_id")
    waiting = games.where(F.col("game_status") != FINAL).select(
        F.col("id").alias("game_id"), "game_code", "game_date", "game_status", "season",
        F.explode(F.array(
            F.struct(F.lit("H").alias("team_loc"), F.lit("V").alias("opp_team_loc"),
                     F.col("home_team_id").alias("team_id"), F.col("visitor_team_id").alias("opp_team_id")),
            F.struct(F.lit("V").alias("team_loc"), F.lit("H").alias("opp_team_loc"),
                     F.col("visitor_team_id").alias("team_id"), F.col("home_team_id").alias("opp_team_id")),
        )).alias("leg"),
    ).select("*", "leg.*").drop("leg").join(roster, ["season", "team_id"], "left")

    team = teams.select(F.col("id").alias("team_id"), "team_name", "team_abbreviation")
    rival = teams.select(
        F.col("id").alias("opp_team_id"), F.col("team_name").alias("opp_team_name"),
        F.col("team_abbreviation").alias("opp_team_abbreviation"),
    )
    person = players.where("is_rec_active").select(
        F.col("id").alias("player_id"), "first_name", "last_name", "birthdate"
    )
    found = played.unionByName(waiting)
    if players_only:
        found = found.where(F.col("player_id").isNotNull())
    return (
        # the shuffles that find the players leave the disk before those of the names come
        settle(found, "legs")
        .join(team.withColumn("_known", F.col("team_id")), "team_id", "left")
        .join(rival.withColumn("_opp_known", F.col("opp_team_id")), "opp_team_id", "left")
        .join(person, "player_id", "left")
        .select(
            "player_id", "first_name", "last_name", "game_id", "game_code", "game_date", "game_status",
            F.col("_known").alias("team_id"), "team_name", "team_abbreviation", "team_loc",
            F.col("_opp_known").alias("opp_team_id"), "opp_team_name", "opp_team_abbreviation", "opp_team_loc",
            "season", fn.age_days("game_date", "birthdate").alias("age"),
        )
        .distinct()
    )


# -- defence, playing time ------------------------------------------------------------

def team_position_defence(shots: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Average plus-minus a team allows per position and category.

    A row of another category counts as 0 in the average, so each column averages over all rows.
    """
    person = players.where(
        F.col("is_rec_active") & (F.col("rosterstatus") == "Active") & fn.not_blank("pos")
    ).select(F.col("id").alias("_player_id"), "pos")
    category, value = F.col("defense_category"), F.col("pct_plusminus")
    return (
        shots.join(person, "_player_id")
        .join(teams.select(F.col("id").alias("_team_id")), "_team_id", "left_semi")
        .groupBy(F.col("_team_id").alias("team_id"), "pos", F.col("_season").alias("season"))
        .agg(*[
            fn.mean4(F.when(category == name, value).otherwise(0)).alias(column)
            for name, column in DEFENCE_CATEGORIES.items()
        ])
    )


def position_time(appearances_with_pos: DataFrame) -> DataFrame:
    """Seconds per position and game day of a team, with the sums of the 5 and 10 days before.

    After the aggregation a (season, team, position) group holds one row per game day, so the
    calendar bounds it and a plain window is enough.
    """
    daily = (
        appearances_with_pos.where(fn.not_blank("pos"))
        .groupBy("season", "team_id", "team_abbreviation", "pos", "game_date")
        .agg(F.coalesce(F.sum("seconds"), F.lit(0)).alias("pos_time_per_game"))
    )
    return rolling(
        daily, ["season", "team_id", "pos"], ["game_date", "team_abbreviation"],
        {
            "pos_time_last_5_games": ("sum", "pos_time_per_game", 5),
            "pos_time_last_10_games": ("sum", "pos_time_per_game", 10),
        },
    )


def parsed_news(news: DataFrame) -> DataFrame:
    return news.withColumns(
        {"player_id": fn.player_or_sentinel("playerid"), "tm": fn.epoch_instant("date"), "dt": fn.epoch_day("date"),
         "display_first_last": fn.full_name("firstname", "lastname")}
    )


def latest_news(news: DataFrame, tie: Sequence[str] = ("headline",)) -> DataFrame:
    """Newest item per player; of items at one instant the first by priority."""
    order = [*latest_first("tm"), *earliest_first("priority", *tie)]
    return latest_by(parsed_news(news), ["playerid"], order)


def news_of_the_day(news: DataFrame, tie: Sequence[str] = ("headline",)) -> DataFrame:
    """First item by priority per player and day."""
    return latest_by(parsed_news(news), ["playerid", "dt"], earliest_first("priority", *tie))


# Columns of the schedule that playing time is worked out from.
SCHEDULED = (
    "player_id", "game_id", "game_date", "season", "team_id", "team_abbreviation", "opp_team_id", "opp_team_abbreviation", "created_at",
)


def _appeared(schedule_rows: DataFrame, facts: DataFrame, players: DataFrame) -> DataFrame:
    """Schedule rows of active players with their box-score line, when there is one."""
    person = players.where("is_rec_active").select(F.col("id").alias("player_id"), "display_first_last", "pos")
    line = facts.select("player_id", "game_id", "start_position", "seconds", "comment")
    return schedule_rows.select(*SCHEDULED).join(person, "player_id").join(line, ["player_id", "game_id"], "left")


def _player_windows(rows: DataFrame, averages: bool) -> DataFrame:
    """Playing time over the 5 and 10 rows before, per player. Repeated schedule rows count,
    since they leave only afterwards."""
    frames = {f"player_time_last_{n}_games": ("sum", "seconds", n) for n in (5, 10)}
    if averages:
        frames |= {f"avg_player_time_last_{n}_games": ("avg", "seconds", n) for n in (5, 10)}
    return rolling(
        rows, ["season", "team_id", "pos", "player_id"], ["game_date", "created_at", "game_id"],
        frames, block=by_month("game_date"),
    )


def _one_per_day(rows: DataFrame) -> DataFrame:
    order = [*latest_first("created_at"), *earliest_first("game_id")]
    return latest_by(rows, ["player_id", "game_date"], order)


def player_time(schedule_rows: DataFrame, facts: DataFrame, players: DataFrame, news: DataFrame) -> DataFrame:
    """Rolling playing time of every player and game day, the share of the position's time, and
    the injury flag from the player's latest news."""
    with passing(schedule_rows.sparkSession):
        # three steps read these rows: position totals, and both passes of the player windows
        rows = settle(_appeared(schedule_rows, facts, players), "appeared")
        # the shuffles of a step leave the disk before those of the next come
        totals = settle(position_time(rows), "position-time", stays=True)
        timed = settle(_one_per_day(settle(_player_windows(rows, averages=True), "rolled")), "timed", stays=True)
    # ids that differ in padding only are one player here
    item = latest_by(
        latest_news(news), ["player_id"], [*latest_first("tm"), *earliest_first("priority", "headline")]
    ).select("player_id", "injured", *INJURY_DETAILS, F.col("listitemcaption").alias("caption"))
    day = ["season", "team_id", "game_date", "pos"]
    return (
        timed.join(_per_day(totals, day), day, "left")
        .join(item, "player_id", "left")
        .select(
            "player_id", "display_first_last", "pos", "game_date", "team_abbreviation", "opp_team_abbreviation",
            "opp_team_id", "season", "start_position", F.col("seconds").alias("player_time"),
            "player_time_last_5_games", "player_time_last_10_games",
            "avg_player_time_last_5_games", "avg_player_time_last_10_games",
            F.col("pos_time_per_game").alias("pos_time"), "pos_time_last_5_games", "pos_time_last_10_games",
            *[
                fn.guarded_share(F.col(f"player_time_last_{n}_games"), F.col(f"pos_time_last_{n}_games"))
                .alias(f"pct_player_time_{n}_games")
                for n in (5, 10)
            ],
            "comment", fn.injury_flag("injured", "comment").alias("injured"), *INJURY_DETAILS, "caption",
        )
    )


def _per_day(totals: DataFrame, day: Sequence[str]) -> DataFrame:
    return totals.select(*day, "pos_time_per_game", "pos_time_last_5_games", "pos_time_last_10_games")


def daily_schedule(
    schedule_rows: DataFrame,
    facts: DataFrame,
    players: DataFrame,
    versions: DataFrame,
    news: DataFrame,
    hustle: DataFrame,
    defence: DataFrame,
    season: str | None = None,
) -> DataFrame:
    """Like ``player_time``, with news of the game day, the opponent's defence per position and
    hustle numbers. Position time goes through the player version each fact row points to
    (``versions`` has dim_player_guid and pos). Shares are not guarded: a zero base is an error.
    """
    if season is not None:
        schedule_rows = schedule_rows.where(F.col("season") == season)
    versioned = facts.select("season", "team_id", "team_abbreviation", "game_date", "seconds", "dim_player_guid").join(
        versions.select("dim_player_guid", "pos"), "dim_player_guid"
    )
    totals = position_time(versioned)
    item = latest_by(
        news_of_the_day(news), ["player_id", "dt"], earliest_first("priority", "headline")
    ).select(
        "player_id", F.col("dt").alias("game_date"), "injured", *INJURY_DETAILS, F.col("listitemcaption").alias("caption")
    )
    allowed = defence.select(
        F.col("team_id").alias("opp_team_id"), "pos", "season",
        *[F.col(c).alias(f"opp_def_{c}") for c in DEFENCE_CATEGORIES.values()],
    )
    effort = hustle.select(
        F.col("team_id").alias("opp_team_id"), F.col("_season").alias("season"),
        *[F.col(c).alias(f"opp_hust_{c}") for c in HUSTLE_STATS],
    )
    day = ["season", "team_id", "game_date", "pos"]
    # the inner join to hustle comes before the windows: it decides which rows count
    rows = settle(_appeared(schedule_rows, facts, players).join(effort, ["opp_team_id", "season"]), "appeared")
    return (
        _one_per_day(_player_windows(rows, averages=False))
        .join(_per_day(totals, day), day, "left")
        .join(allowed, ["opp_team_id", "pos", "season"], "left")
        .join(item, ["player_id", "game_date"], "left")
        .select(
            "player_id", "display_first_last", "pos", "game_date", "team_abbreviation", "opp_team_abbreviation",
            "opp_team_id", "season", "start_position", F.col("seconds").alias("player_time"),
            "player_time_last_5_games", "player_time_last_10_games",
            "pos_time_per_game", "pos_time_last_5_games", "pos_time_last_10_games",
            *[
                fn.strict_share(F.col(f"player_time_last_{n}_games"), F.col(f"pos_time_last_{n}_games"))
                .alias(f"pct_player_time_{n}_games")
                for n in (5, 10)
            ],
            "comment", fn.injury_flag("injured", "comment").alias("injured"), *INJURY_DETAILS, "caption",
            *[f"opp_def_{c}" for c in DEFENCE_CATEGORIES.values()],
            *[f"opp_hust_{c}" for c in HUSTLE_STATS],
        )
    )


# -- features -------------------------------------------------------------------------

def game_features(
    schedule_rows: DataFrame,
    players: DataFrame,
    facts: DataFrame,
    team_facts: DataFrame,
    opponent_stats: Sequence[str] = tuple(OPPONENT_STATS),
) -> DataFrame:
    """Per scheduled game of a player: calendar labels, fantasy points, the season average of
    these points (all games of the season, later ones included) and the opponent's team numbers."""
    person = players.where("is_rec_active").select(
        F.col("id").alias("player_id"), F.col("display_first_last").alias("player"), "nba_pos"
    )
    line = facts.select("game_id", "player_id", "seconds", *fn.FANTASY_WEIGHTS)
    # read for the season's average and for the rows
    scored = settle(schedule_rows.join(line, ["game_id", "player_id"], "left").withColumn("fan_pts", fn.fantasy_points()), "scored")
    averaged = with_group_stats(scored, ["player_id", "season"], avg_fan_pts=F.avg("fan_pts"))
    rival = team_facts.select(
        "game_id", F.col("team_id").alias("opp_team_id"), *[F.col(c).alias(f"_opp_{c}") for c in opponent_stats]
    )
    return (
        averaged.join(person, "player_id", "left")
        .join(rival, ["game_id", "opp_team_id"], "left")
        .select(
            "player", "game_date", "season", "player_previous_game_date", "days_rest",
            F.col("team_abbreviation").alias("team"), F.col("team_loc").alias("loc"),
            F.col("opp_team_abbreviation").alias("opp_team"), F.col("opp_team_loc").alias("opp_loc"),
            "age", "nba_pos", fn.month_label("game_date").alias("mnth"), fn.weekday_label("game_date").alias("dow"),
            F.col("seconds").alias("seconds_played"), "fan_pts", "avg_fan_pts",
            *[F.col(f"_opp_{c}").alias(c) for c in opponent_stats],
        )
    )


def played_game_features(
    schedule_rows: DataFrame,
    players: DataFrame,
    facts: DataFrame,
    team_facts: DataFrame,
    defence: DataFrame,
    fantasy_positions: DataFrame,
    as_of: Column,
    across_players: bool = False,
    opponent_stats: Sequence[str] = tuple(OPPONENT_STATS),
) -> DataFrame:
    """Features of games with playing time up to a day. Both filters come before the averages
    and the days of rest.

    Days of rest look at the player's own game before. ``across_players`` takes the row before
    in (season, team, player, day) order, even if it belongs to another player.
    """
    line = facts.where(F.col("seconds") > 0).select("game_id", "player_id", "seconds", *fn.FANTASY_WEIGHTS)
    scored = (
        schedule_rows.where(F.col("game_date") <= as_of)
        .join(line, ["game_id", "player_id"])
        .withColumn("fdpts", fn.fantasy_points())
        .drop(*fn.FANTASY_WEIGHTS)
    )
    order = ["game_date", "game_id"]
    person = players.where("is_rec_active").select(
        F.col("id").alias("player_id"), F.col("display_first_last").alias("player"), "birthdate", "nba_pos",
        F.col("fd_pos").alias("_own_fd_pos"),
    )
    rival = team_facts.select(
        "game_id", F.col("team_id").alias("opp_team_id"), *[F.col(c).alias(f"_opp_{c}") for c in opponent_stats]
    )
    allowed = defence.select(
        "season", F.col("team").alias("opp_team_abbreviation"), F.col("fd_pos").alias("_own_fd_pos"),
        F.col("avg_norm_plusminus").alias("opp_pos_plusminus"),
    )
    # each step is written, so that its shuffles leave the disk before those of the next come; the team numbers, the widest, come last
    with passing(schedule_rows.sparkSession):
        allowed = settle(allowed, "allowed")
        # the lag reads the rows twice: for the block tails and for the rows themselves
        averaged = settle(with_group_stats(scored, ["player_id", "season"], avg_fdpts=F.avg("fdpts")), "scored")
        if across_players:
            team = ["season", "team_id"]
            band = [*team, "_players"]
            rested = global_previous(
                averaged.withColumn("_players", in_ranges("player_id", 4096)), [team, band, [*band, "player_id"]], order, "game_date",
                "_prev", block=by_month("game_date"),
            ).drop("_players")
        else:
            rested = previous(averaged, ["player_id"], order, "game_date", "_prev", block=by_month("game_date"))
        named = settle(
            rested.join(person, "player_id", "left")
            .join(fantasy_positions.select("player_id", "fd_pos"), "player_id", "left")
            .join(allowed, ["season", "opp_team_abbreviation", "_own_fd_pos"], "left")
            .select(
                "game_id", "opp_team_id", "player", F.col("team_loc").alias("loc"), F.col("team_abbreviation").alias("team"),
                F.col("opp_team_abbreviation").alias("opponent"), F.col("opp_team_loc").alias("opp_loc"), "game_date",
                fn.age_days("game_date", "birthdate").alias("age_in_days"), "nba_pos", "fd_pos", F.col("season").alias("season_str"),
                fn.zero_to_null("seconds").alias("seconds"), "fdpts", "avg_fdpts",
                fn.days_rest("game_date", "_prev").alias("player_days_rest"), "opp_pos_plusminus",
            ),
            "named", stays=True,
        )
    return named.join(rival, ["game_id", "opp_team_id"], "left").select(
        "player", "loc", "team", "opponent", "opp_loc", "game_date", "age_in_days", "nba_pos", "fd_pos",
        fn.month_label("game_date").alias("mnth"), fn.weekday_label("game_date").alias("dow"), "season_str", "seconds",
        "fdpts", "avg_fdpts", "player_days_rest", "opp_pos_plusminus", *[F.col(f"_opp_{c}").alias(c) for c in opponent_stats],
    )


# -- injury benefit -------------------------------------------------------------------

def injury_benefit(
    times: DataFrame, factors: DataFrame | Sequence[tuple[str, str, float]] = POSITION_FACTORS
) -> DataFrame:
    """Seconds a healthy player gains from injured team mates of the same day: the sum over them
    of average time x own share x position factor; NULL when that is 0.

    The share does not depend on the team mate, so the injured side is summed per team, day and
    position first and no player pairs are formed. ``times`` has one row per player and day, so
    nobody is their own team mate. ``factors`` is a table of inj_pos, pos and dist_factor, or a
    list of such triples.
    """
    team_day = ["season", "team_abbreviation", "game_date"]
    lost = (
        times.where(F.col("injured") == "YES")
        .groupBy(*team_day, F.col("pos").alias("inj_pos"))
        .agg(F.sum("avg_player_time_last_5_games").alias("lost"))
    )
    if isinstance(factors, DataFrame):
        shared = lost.join(factors.select("inj_pos", "pos", "dist_factor"), "inj_pos")
    else:
        shared = lost.select(*team_day, "lost", F.explode(_gains(factors)[F.col("inj_pos")]).alias("gain")).select(
            *team_day, "lost", "gain.*"
        )
    gained = shared.groupBy(*team_day, "pos").agg(F.sum(F.col("lost") * F.col("dist_factor")).alias("gained"))
    benefit = F.col("gained") * F.col("pct_player_time_5_games")
    return (
        times.where(F.col("injured") == "NO")
        .join(gained, [*team_day, "pos"], "left")
        .select(*team_day[:2], "player_id", "game_date", "pos", fn.zero_to_null(benefit).alias("benefit_seconds"))
    )


def _gains(factors: Sequence[tuple[str, str, float]]) -> Column:
    """Injured position to its (pos, dist_factor) list, as a literal map."""
    by_injured: dict[str, list[Column]] = {}
    for hurt, pos, factor in factors:
        gain = F.struct(F.lit(pos).alias("pos"), F.lit(float(factor)).alias("dist_factor"))
        by_injured.setdefault(hurt, []).append(gain)
    return F.create_map(*[c for hurt, pairs in by_injured.items() for c in (F.lit(hurt), F.array(*pairs))])


def injury_time(
    times: DataFrame, season: str, team_abbreviation: str, player_id: int, day, factors=POSITION_FACTORS
) -> DataFrame:
    """The benefit of one player on one day; only that team's rows of that day are read."""
    that_day = times.where(
        (F.col("season") == season) & (F.col("team_abbreviation") == team_abbreviation) & (F.col("game_date") == F.lit(day))
    )
    return injury_benefit(that_day, factors).where(F.col("player_id") == player_id)
