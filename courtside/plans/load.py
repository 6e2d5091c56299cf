"""Landing runs: every active measure of a node from its documents into its table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, functions as F, types as T

from courtside.plans.control import (
    COMPLETED, FAILED, active_measures, done_keys, not_done, pending_games, per_entity, single_measure,
)
from courtside.session import fresh_path, settle
from courtside.sources.catalogue import result_index
from courtside.sources.documents import with_more_fields
from courtside.sources.fan_out import found_sets, infer_schemas, parse_sets, set_rows
from courtside.sources.landing import land

# Key columns a document frame carries per node, named like the lineage they become.
DOCUMENT_KEYS = {"game": ("_game_id",), "team": ("_team_id",), "player": ("_player_id", "_team_id")}


def load_measures(
    measures: list[Row], documents: DataFrame, root: str, season: str, season_type: str, run_id: int, as_of: dt.datetime,
    schema: str | None = None,
) -> tuple[list[DataFrame], DataFrame]:
    """Land measures of one endpoint: parse its documents once, then per measure watch for new columns, stamp, append.

    ``documents`` has one document per row in ``body`` plus the key columns of the node. Without a ``schema`` the types of
    all measures are inferred from what was parsed. Returns the landed rows of each measure, and the key columns with
    ``landed``, the number of the measures' result sets that the documents of a key hold.
    """
    keys = DOCUMENT_KEYS[measures[0].node]
    indexes = [result_index(m.node, m.endpoint, m.measure) for m in measures]
    sets = parse_sets(documents, sorted(set(indexes)), keys)
    types = {} if schema else infer_schemas(sets)
    lineage = {key.removeprefix("_"): F.col(key) for key in keys}
    landed = [
        land(
            set_rows(sets, index, schema or types.get(index, T.StructType()), keys), measure.node, f"{root}/{measure.table_name}",
            **lineage, season=season, season_type=season_type, create_date=F.lit(as_of), run_id=run_id,
        )
        for measure, index in zip(measures, indexes)
    ]
    return landed, found_sets(sets, keys, indexes)


def load_measure(
    measure: Row, documents: DataFrame, root: str, season: str, season_type: str, run_id: int, as_of: dt.datetime,
    schema: str | None = None,
) -> DataFrame:
    """``load_measures`` for one measure: its landed rows."""
    return load_measures([measure], documents, root, season, season_type, run_id, as_of, schema)[0][0]


def load_single(
    nodes: DataFrame, table_name: str, documents: Callable[[str], DataFrame], root: str, season: str,
    entities: DataFrame | None = None, **run
) -> DataFrame:
    """Land one named measure for the entities of a season (their key columns), or for every document given."""
    measure = single_measure(nodes, season, table_name)
    docs = documents(measure.endpoint)
    if entities is not None:
        keys = list(DOCUMENT_KEYS[measure.node])
        docs = docs.join(entities.select(*keys).distinct(), keys, "left_semi")
    return load_measure(measure, docs, root, season, **run)


def load_news(
    items: DataFrame, root: str, season: str, season_type: str, as_of: dt.datetime, table: str = "player_news"
) -> DataFrame:
    """Land a poll of the news with every field the feed has, stamped like a league table."""
    return land(
        with_more_fields(items), "league", f"{root}/{table}", season=season, season_type=season_type, create_date=F.lit(as_of)
    )


def load_entities(
    nodes: DataFrame,
    node: str,
    todo: DataFrame,
    documents: Callable[[str], DataFrame],
    root: str,
    season: str,
    season_type: str,
    run_id: int,
    as_of: dt.datetime,
) -> DataFrame:
    """Land all active measures of a node for the entities in ``todo`` (its key columns); returns
    one log event per entity.

    The entities meet the documents of an endpoint in one semi join for all its measures. An
    entity is COMPLETED if every endpoint has a document of it that can be read and holds all the
    result sets asked for; otherwise it is FAILED, with the measures that did land counted, and
    stays to be loaded. The events are written by the caller after the last measure has landed.
    """
    keys = list(DOCUMENT_KEYS[node])
    todo = settle(todo.select(*keys).distinct(), f"{node}-todo")
    measures = per_entity(active_measures(nodes, season, node)).collect()
    met = todo.select(*keys, F.lit(0).alias("landed"))
    for endpoint in dict.fromkeys(m.endpoint for m in measures):
        # parsed from the join, once, so the documents themselves are not written again
        wanted = documents(endpoint).join(todo, keys, "left_semi")
        own = [m for m in measures if m.endpoint == endpoint]
        met = met.unionByName(load_measures(own, wanted, root, season, season_type, run_id, as_of)[1])
    status = met.groupBy(*keys).agg(F.sum("landed").alias("landed"))
    own, *parent = keys
    return status.select(
        F.lit(run_id).alias("run_id"), F.lit(node).alias("node"), F.col(own).cast("string").alias("node_key"),
        (F.col(parent[0]) if parent else F.lit(None)).cast("string").alias("parent_key"),
        F.when(F.col("landed") >= len(measures), COMPLETED).otherwise(FAILED).alias("node_status"),
        # a game's group is complete once its teams and players are, see run_games
        F.lit("IN PROGRESS" if node == "game" else "N/A").alias("group_status"),
        F.col("landed").cast("int").alias("measure_count"), F.lit(season).alias("season"), F.lit(season_type).alias("season_type"),
        F.lit(as_of).alias("end_dtm"), F.lit(as_of).alias("at"), F.lit(STEPS.index(node)).alias("seq"),
    )


# Result sets of a day's scoreboard, in order.
SCOREBOARD = (
    "game_header", "line_score", "series_standings", "last_meeting", "east_conf_standings_by_day",
    "west_conf_standings_by_day", "available",
)

# Tables of the roster load, and where their rows come from.
ROSTER = {
    "team_summary": ("TeamSummary", "info"), "team_season_ranks": ("TeamSummary", "season_ranks"),
    "team_common_roster": ("TeamCommonRoster", "roster"), "team_coaches": ("TeamCommonRoster", "coaches"),
}


def load_schedule(
    nodes: DataFrame, days: DataFrame, documents: DataFrame, root: str, season: str, season_type: str, run_id: int, as_of: dt.datetime
) -> DataFrame:
    """Land the scoreboards of the days still to pull (``control.date_spine``); returns one log event per day.

    ``documents`` has one scoreboard per day in ``body``, found by ``node_key``. Days meet them in one join for all
    active measures; a day without a readable scoreboard is FAILED and stays to be pulled.
    """
    days = settle(days.select("node_key").distinct(), "schedule-days")
    measures = active_measures(nodes, season, "schedule").collect()
    indexes = [SCOREBOARD.index(m.measure) for m in measures]
    sets = parse_sets(documents.join(days, "node_key", "left_semi"), sorted(set(indexes)), ["node_key"])
    types = infer_schemas(sets)
    for measure, index in zip(measures, indexes):
        land(
            set_rows(sets, index, types.get(index, T.StructType())), "schedule", f"{root}/{measure.table_name}", season=season,
            season_type=season_type, create_date=F.lit(as_of), run_id=run_id,
        )
    met = days.withColumn("landed", F.lit(0)).unionByName(found_sets(sets, ["node_key"], indexes))
    return met.groupBy("node_key").agg(F.max("landed").alias("landed")).select(
        F.lit(run_id).alias("run_id"), F.lit("schedule").alias("node"), "node_key", F.lit(None).cast("string").alias("parent_key"),
        F.when(F.col("landed") >= len(measures), COMPLETED).otherwise(FAILED).alias("node_status"), F.lit("N/A").alias("group_status"),
        F.col("landed").cast("int").alias("measure_count"), F.lit(season).alias("season"), F.lit(season_type).alias("season_type"),
        F.lit(as_of).alias("end_dtm"), F.lit(as_of).alias("at"), F.lit(0).alias("seq"),
    )


def load_roster(entities: DataFrame, documents: Callable[[str], DataFrame], root: str, run_id: int, as_of: dt.datetime) -> None:
    """Land all four team tables for teams and seasons (_team_id, _season), all seasons in one load."""
    keys = ["_team_id", "_season"]
    for document in dict.fromkeys(d for d, _ in ROSTER.values()):
        wanted = documents(document).join(entities.select(*keys).distinct(), keys, "left_semi")
        places = {table: result_index("team", name, measure) for table, (name, measure) in ROSTER.items() if name == document}
        sets = parse_sets(wanted, sorted(set(places.values())), keys)
        types = infer_schemas(sets)
        for table, (name, measure) in ROSTER.items():
            if name == document:
                index = places[table]
                rows = set_rows(sets, index, types.get(index, T.StructType()), keys).withColumnsRenamed({"_team_id": "of_team", "_season": "of_season"})
                land(
                    rows, "roster", f"{root}/{table}", team_id=F.col("of_team"), season=F.col("of_season"), create_date=F.lit(as_of),
                    run_id=run_id,
                )


def load_hustle(players: DataFrame, teams: DataFrame, root: str, season: str, season_type: str, as_of: dt.datetime) -> None:
    """Land the season's hustle tables of players and teams from their documents."""
    for grain, name, table, docs in (
        ("player", "PlayerHustleStats", "player_hustle_stats", players), ("team", "HustleStatsTeam", "team_hustle_stats", teams),
    ):
        index = result_index(grain, name, "overall")
        sets = parse_sets(docs, [index])
        land(
            set_rows(sets, index, infer_schemas(sets).get(index, T.StructType())), "league", f"{root}/{table}", season=season, season_type=season_type,
            create_date=F.lit(as_of),
        )


# order of a run's steps, which orders events of one instant
STEPS = ("game", "team", "player", "group")


def run_games(
    nodes: DataFrame,
    header: DataFrame,
    run_log: DataFrame,
    box: Callable[[], DataFrame],
    documents: Callable[[str], DataFrame],
    root: str,
    season: str,
    season_type: str,
    run_id: int,
    as_of: dt.datetime,
) -> DataFrame:
    """Load every pending game, then its teams, then the players who appeared; returns the log.

    Games whose own box score completed in an earlier run are not landed again, teams and players
    not twice in a run or day. A game's group is COMPLETED if neither the game nor one of its teams
    and players failed in this run, else FAILED, so that the game stays pending. ``box`` reads the
    landed player box scores after the games landed (game_id, team_id, player_id). Game, team and
    player ids are text, as in the log.
    """
    run = dict(season=season, season_type=season_type, run_id=run_id, as_of=as_of)
    today = F.lit(as_of.date())
    spark = header.sparkSession
    place = fresh_path(spark, "run-log")

    def write(events: DataFrame) -> None:
        events.write.mode("append").parquet(place)

    pending = settle(pending_games(header, run_log, season, season_type), "pending-games")
    games = pending.select(F.col("game_id").alias("node_key"))
    new = games.join(done_keys(run_log, "game"), "node_key", "left_anti").select(F.col("node_key").alias("_game_id"))
    write(load_entities(nodes, "game", new, documents, root, **run))

    sides = F.array(F.col("home_team_id").cast("string"), F.col("visitor_team_id").cast("string"))
    playing = pending.select("game_id", F.explode(sides).alias("node_key")).distinct()
    teams = not_done(playing.select("node_key").distinct(), run_log, "team", run_id, today, season=season, season_type=season_type)
    write(load_entities(nodes, "team", teams.select(F.col("node_key").alias("_team_id")), documents, root, **run))

    appeared = settle(
        box().join(games, F.col("game_id") == F.col("node_key"), "left_semi").select(
            "game_id", F.col("player_id").cast("string").alias("node_key"), F.col("team_id").cast("string").alias("parent_key")
        ).distinct(),
        "appeared",
    )
    players = appeared.select("node_key", "parent_key").distinct()
    players = not_done(players, run_log, "player", run_id, today, ("node_key", "parent_key"), season, season_type)
    todo = players.select(F.col("node_key").alias("_player_id"), F.col("parent_key").alias("_team_id"))
    write(load_entities(nodes, "player", todo, documents, root, **run))

    failed = spark.read.parquet(place).where(F.col("node_status") == FAILED)

    def of(node: str, *keys: str) -> DataFrame:
        return failed.where(F.col("node") == node).select(*keys)

    open_games = (
        of("game", F.col("node_key").alias("game_id"))
        .unionByName(playing.join(of("team", "node_key"), "node_key", "left_semi").select("game_id"))
        .unionByName(appeared.join(of("player", "node_key", "parent_key"), ["node_key", "parent_key"], "left_semi").select("game_id"))
        .distinct()
    )
    open_games = settle(open_games.select(F.col("game_id").alias("node_key"), F.lit(True).alias("open")), "open-games")
    write(games.join(open_games, "node_key", "left").select(
        F.lit(run_id).alias("run_id"), F.lit("game").alias("node"), "node_key", F.lit(None).cast("string").alias("parent_key"),
        F.when(F.col("open").isNull(), COMPLETED).alias("node_status"), F.when(F.col("open"), FAILED).otherwise(COMPLETED).alias("group_status"),
        F.lit(0).alias("measure_count"), F.lit(season).alias("season"), F.lit(season_type).alias("season_type"),
        F.lit(as_of).alias("end_dtm"), F.lit(as_of).alias("at"), F.lit(STEPS.index("group")).alias("seq"),
    ))
    return spark.read.parquet(place)
