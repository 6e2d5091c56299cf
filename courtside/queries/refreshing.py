"""The whole reporting refresh over the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from courtside.plans import load
from courtside.plans.night import Landed, run_night
from courtside.plans.refresh import ORDER, refresh_all
from courtside.queries.league import League, with_tables
from courtside.queries.registry import ORACLE, query
from courtside.queries.rosters import AFTER, _landed_sql, landed_players
from courtside.session import fresh_path, settle
from courtside.sources import documents, landing
from courtside.sources.published import read_parts

LAST_DAY = dt.date(2001, 12, 31)


def landed_tables(lg: League) -> dict:
    # a team's roster of a season is one customer here, so open games list few players
    # landed tables lie in the store: what a refresh reads several times is worked out once
    lg = lg.settled("games", "box")
    visitor = F.floor(F.col("o_totalprice") / 500).cast("int")
    games = lg.games.withColumns({"home_team_id": F.col("player_id"), "visitor_team_id": visitor})
    box = lg.box.select(
        F.col("id").alias("game_id"), "player_id", F.col("player_id").cast("int").alias("team_id"), F.col("season").alias("_season"),
        F.concat(F.lit("T"), F.col("player_id").cast("string")).alias("team_abbreviation"),
        F.substring("o_orderpriority", 1, 1).alias("start_position"), F.lit(None).cast("string").alias("comment"),
        F.col("game_date").alias("_create_date"), "seconds", "pts", "ast", "reb", "stl", "blk", "tov",
    )
    common = settle(landed_players(lg, LAST_DAY).withColumn("_team_id", F.col("person_id")), "player-common")
    return {
        "player_common": common,
        "player_common_all": common.withColumn("_create_date", F.lit(AFTER)),
        "team": lg.table("customer").select(
            F.col("c_custkey").cast("int").alias("team_id"), F.col("c_name").alias("team_name"),
            F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("team_abbrv"),
        ),
        "header": games.select(
            F.col("id").alias("game_id"), F.col("game_code").alias("gamecode"), "game_date",
            F.col("game_status").alias("game_status_text"), "home_team_id", "visitor_team_id",
            F.col("season").alias("_season"), F.col("season_type").alias("_season_type"),
        ),
        "player_box": box,
        "team_box": box.select("game_id", "team_id", "_create_date", "pts", "seconds"),
        "news": lg.news,
    }


@query(
    "reporting_refresh",
    with_tables(
        "game line item",
        """with who as (select distinct player_id from game), last_season as (select player_id, max(season) as season from game group by all),
        boxed as (select g.id, g.player_id, g.season, game_status from game g join line l on l.game_id = g.id),
        roster as (select * from last_season),
        vis as (select o_orderkey as id, cast(floor(o_totalprice / 500) as bigint) as visitor from orders),
        wait as (select g.id, g.player_id as team, g.season, 'H' as loc, game_date from game g where game_status <> 'Final'
                 union all select g.id, visitor, g.season, 'V', game_date from game g join vis using (id) where game_status <> 'Final'),
        sched as (
          select distinct b.id, b.player_id, game_date, 'H' as loc from boxed b join game g using (id) where g.game_status = 'Final'
          union select w.id, r.player_id, game_date, loc from wait w join roster r on r.player_id = w.team and r.season = w.season)
        select 'dim_player' as table_name, count(*) as rows from who
        union all select 'dim_game', count(*) from game
        union all select 'dim_player_team_history', count(*) from who
        union all select 'fct_game_team', count(*) from boxed
        union all select 'fct_game_player', count(*) from boxed
        union all select 'dim_player_schedule', count(*) from sched
        union all select 'player_time', count(*) from (select distinct player_id, game_date from sched)
        union all select 'player_latest_news', count(distinct playerid) from item""",
    ),
)
def reporting_refresh(lg: League):
    """Rows per table after a first refresh."""
    root = fresh_path(lg.spark, "reporting")
    counts = refresh_all(lg.spark, landed_tables(lg), root, "v1", dt.datetime(2002, 1, 1))
    return lg.spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")


@query(
    "refreshed_games",
    with_tables(
        "game",
        """select g.id, game_code, game_date, game_status, player_id as home_team_id, cast(floor(g.o_totalprice / 500) as integer) as visitor_team_id,
          season, season_type from game g""",
    ),
)
def refreshed_games(lg: League):
    """The game dimension that a refresh leaves."""
    root = fresh_path(lg.spark, "reporting")
    refresh_all(lg.spark, landed_tables(lg), root, "v1", dt.datetime(2002, 1, 1))
    return read_parts(lg.spark, root, "dim_game")


@query(
    "refreshed_player_facts",
    with_tables(
        "game line",
        """select g.id as game_id, player_id, season, cast(player_id as integer) as team_id, 'T' || player_id as team_abbreviation, 'H' as team_loc,
          cast(floor(g.o_totalprice / 500) as integer) as opp_team_id, 'V' as opp_team_loc, game_date, seconds,
          substr(g.o_orderpriority, 1, 1) as start_position, cast(null as varchar) as comment, ast, reb, pts, stl, blk, tov
        from game g join line l on l.game_id = g.id""",
    ),
)
def refreshed_player_facts(lg: League):
    """The player facts that a refresh leaves; their version keys differ from run to run."""
    root = fresh_path(lg.spark, "reporting")
    refresh_all(lg.spark, landed_tables(lg), root, "v1", dt.datetime(2002, 1, 1))
    return read_parts(lg.spark, root, "fct_game_player").drop("dim_player_guid")


@query(
    "refreshed_team_facts",
    with_tables(
        "game line",
        """select g.id as game_id, cast(player_id as integer) as team_id, game_date as _create_date, pts, seconds, season, game_date
        from game g join line l on l.game_id = g.id""",
    ),
)
def refreshed_team_facts(lg: League):
    """The team facts that a refresh leaves."""
    root = fresh_path(lg.spark, "reporting")
    refresh_all(lg.spark, landed_tables(lg), root, "v1", dt.datetime(2002, 1, 1))
    return read_parts(lg.spark, root, "fct_game_team")


@query("refreshed_latest_news", ORACLE["latest_news"])
def refreshed_latest_news(lg: League):
    """The newest item per player that a refresh leaves."""
    root = fresh_path(lg.spark, "reporting")
    refresh_all(lg.spark, landed_tables(lg), root, "v1", dt.datetime(2002, 1, 1))
    return read_parts(lg.spark, root, "player_latest_news").select(
        "playerid", "player_id", "tm", "dt", "priority", "headline", "injured", "injured_status"
    )


@query(
    "refreshed_players",
    f"""with {_landed_sql(LAST_DAY, "n")}
    select id, display_first_last, nba_pos, rosterstatus, birthdate, season_exp, from_year, to_year, height, weight, jersey, is_dleague, season,
      id as team_id, display_first_last as team_name, 'T' || id as team_abbrv, date '2002-01-01' as rec_start_date, date '2002-01-01' as rec_end_date,
      true as is_rec_active from n""",
)
def refreshed_players(lg: League):
    """The player dimension after a refresh and a second one that finds nothing new; its keys hold the time of the run."""
    root = fresh_path(lg.spark, "reporting")
    landed = landed_tables(lg)
    refresh_all(lg.spark, landed, root, "v1", dt.datetime(2002, 1, 1))
    refresh_all(lg.spark, landed, root, "v2", dt.datetime(2002, 1, 2), before="v1", seasons=[])
    return read_parts(lg.spark, root, "dim_player").select(
        "id", "display_first_last", "nba_pos", "rosterstatus", "birthdate", "season_exp", "from_year", "to_year", "height", "weight", "jersey",
        "is_dleague", "season", "team_id", "team_name", "team_abbrv", "rec_start_date", "rec_end_date", "is_rec_active",
    )


@query(
    "refreshed_schedule",
    with_tables(
        "game line",
        """with last_season as (select player_id, max(season) as season from game group by all),
        boxed as (select g.id, g.player_id, g.season, game_status, game_date from game g join line l on l.game_id = g.id),
        vis as (select o_orderkey as id, cast(floor(o_totalprice / 500) as bigint) as visitor from orders),
        wait as (select g.id, g.player_id as team, g.season, 'H' as loc, game_date, game_status from game g where game_status <> 'Final'
                 union all select g.id, visitor, g.season, 'V', game_date, game_status from game g join vis using (id) where game_status <> 'Final'),
        sched as (
          select distinct id, player_id, game_date, 'H' as loc, season, game_status from boxed where game_status = 'Final'
          union select w.id, r.player_id, game_date, loc, w.season, game_status from wait w join last_season r on r.player_id = w.team and r.season = w.season)
        select id as game_id, player_id, game_date, loc as team_loc, season, game_status,
          lag(game_date) over (partition by player_id order by game_date, id, loc) as player_previous_game_date,
          game_date - lag(game_date) over (partition by player_id order by game_date, id, loc) as days_rest
        from sched""",
    ),
)
def refreshed_schedule(lg: League):
    """The players' schedule after a refresh and a second one of the last season alone."""
    root = fresh_path(lg.spark, "reporting")
    landed = landed_tables(lg)
    refresh_all(lg.spark, landed, root, "v1", dt.datetime(2002, 1, 1))
    newest = lg.games.agg(F.max("season").alias("season")).first().season
    refresh_all(lg.spark, landed, root, "v2", dt.datetime(2002, 1, 2), before="v1", seasons=[newest])
    return read_parts(lg.spark, root, "dim_player_schedule").select(
        "game_id", "player_id", "game_date", "team_loc", "season", "game_status", "player_previous_game_date", "days_rest"
    )


def night_tables(lg: League) -> dict[str, Landed]:
    """The landed tables with the keys of their snapshots."""
    keys = {"player_box": ("game_id", "player_id"), "team_box": ("game_id", "team_id")}
    return {name: Landed(lambda rows=rows: rows, keys.get(name, ())) for name, rows in landed_tables(lg).items()}


@query(
    "nightly_run",
    f"""select * from ({ORACLE["reporting_refresh"]})
        union all select 'landed news', count(*) from events""",
)
def nightly_run(lg: League):
    """A night that lands the news, takes snapshots, breaks, and goes on to the refreshed tables."""
    root, day = fresh_path(lg.spark, "night"), dt.datetime.combine(AFTER, dt.time())

    def land_news() -> None:
        item = F.struct(F.col("user_id").cast("string").alias("PlayerID"), F.col("event_type").alias("Headline"))
        docs = lg.table("events").select(F.to_json(F.struct(F.array(item).alias("ListItems"))).alias("body"))
        load.load_news(documents.news_items(docs), f"{root}/landed", "2000-01", "Regular Season", day)

    def breaks() -> DataFrame:
        raise ConnectionError("the store went away")

    tables = night_tables(lg)
    try:
        run_night(lg.spark, root, "n1", day, {"news": land_news}, {**tables, "news": Landed(breaks)})
    except ConnectionError:
        pass
    run_night(lg.spark, root, "n1", day, {"news": land_news}, tables)
    counts = [
        read_parts(lg.spark, f"{root}/reporting", table, "n1").agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for table in ORDER
    ]
    news = landing.read_landed(lg.spark, f"{root}/landed/player_news")
    counts.append(news.agg(F.lit("landed news").alias("table_name"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, counts)
