"""Documents, landing tables, calendar, pending work and run log."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from courtside.functions import scalars as fn
from courtside.plans import control, load
from courtside.queries.league import League, with_tables
from courtside.queries.registry import query
from courtside.queries.rosters import seasons
from courtside.session import fresh_path
from courtside.sources import documents, landing

AS_OF = dt.date(2001, 6, 1)


def result_document(*sets: tuple[str, dict[str, Column]]) -> Column:
    """A landed document with one row per result set, written by Spark from a table row."""
    return F.to_json(F.struct(F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.array(*[F.lit(h) for h in row]).alias("headers"),
            F.array(F.array(*[c.cast("string") for c in row.values()])).alias("rowSet"),
        )
        for name, row in sets
    ]).alias("resultSets")))


ORDER_ROW = "order_id bigint, tov int, status string, price double, not_there string"


def _order_documents(lg: League) -> DataFrame:
    body = result_document(
        ("Head", {"KEY": F.col("o_orderkey")}),
        ("Row", {"ORDER_ID": F.col("o_orderkey"), "TO": F.month("o_orderdate"), "STATUS": F.col("o_orderstatus"), "PRICE": F.col("o_totalprice")}),
    )
    return lg.table("orders").select(fn.season_text("o_orderdate").alias("_season"), body.alias("body"))


@query(
    "resultset_scrape",
    """select cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2) as _season, o_orderkey as order_id,
         cast(month(o_orderdate) as integer) as tov, o_orderstatus as status, o_totalprice as price, cast(null as varchar) as not_there from orders""",
)
def resultset_scrape(lg: League):
    return documents.scrape(_order_documents(lg), 1, ORDER_ROW, keep=["_season"])


@query(
    "resultset_types",
    """select * from (values ('event_id', 'bigint'), ('kind', 'string'), ('value', 'double')) t(name, kind)""",
)
def resultset_types(lg: League):
    """Inferred column types of a result set that holds every event, one document per event."""
    events = lg.table("events")
    cells = F.to_json(F.struct(F.col("event_id").alias("a"), F.col("event_type").alias("b"), F.col("value").alias("c")))
    row = F.regexp_replace(cells, r'"[abc]":', "")
    body = F.concat(
        F.lit('{"resultSets":[{"name":"x","headers":["EVENT_ID","KIND","VALUE"],"rowSet":[['),
        F.substring(row, F.lit(2), F.length(row) - 2), F.lit("]]}]}"),
    )
    found = documents.infer_schema(events.select(body.alias("body")), 0)
    return lg.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "name string, kind string")


@query(
    "news_documents",
    """select cast(user_id as varchar) as playerid, event_type as headline, cast(props ->> '$.k' as varchar) as priority,
         cast(null as varchar) as injury_side from events""",
)
def news_documents(lg: League):
    item = F.struct(
        F.col("user_id").cast("string").alias("PlayerID"), F.col("event_type").alias("Headline"),
        F.get_json_object("props", "$.k").cast("int").alias("Priority"),
    )
    docs = lg.table("events").select(F.to_json(F.struct(F.array(item).alias("ListItems"))).alias("body"))
    return documents.news_items(docs).select("playerid", "headline", "priority", "injury_side")


@query(
    "player_lists",
    """select distinct cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2) as _season,
         c_custkey as person_id, c_name as display_first_last from orders join customer on c_custkey = o_custkey""",
)
def player_lists(lg: League):
    """Player lists landed per season, one document per player, read back over all seasons."""
    path = fresh_path(lg.spark, "player-lists")
    body = result_document(("CommonAllPlayers", {"PERSON_ID": F.col("id"), "DISPLAY_FIRST_LAST": F.col("display_first_last")}))
    listed = lg.games.select("player_id", F.col("season").alias("_season")).distinct().join(
        lg.players, F.col("player_id") == F.col("id")
    )
    listed.select(body.alias("value"), "_season").hint("rebalance", "_season").write.partitionBy("_season").text(path)
    return documents.read_player_lists(lg.spark, path, "person_id bigint, display_first_last string")


@query(
    "landed_measure",
    """select l_orderkey as _game_id, l_linenumber as line, l_quantity as tov, l_returnflag as flag,
         cast(year(l_shipdate) as varchar) || '-' || substr(cast(year(l_shipdate) + 1 as varchar), 3, 2) as _season,
         'Regular Season' as _season_type, 1 as _run_id from lineitem""",
)
def landed_measure(lg: League):
    """One measure end to end: document, scrape, names, stamps, append, read back."""
    path = fresh_path(lg.spark, "player-track")
    body = result_document(
        ("PlayerTrack", {"LINE": F.col("l_linenumber"), "TO": F.col("l_quantity"), "FLAG": F.col("l_returnflag")}),
        ("TeamTrack", {"LINE": F.col("l_linenumber")}),
    )
    docs = lg.table("lineitem").select(
        body.alias("body"), F.col("l_orderkey").alias("key"), fn.season_text("l_shipdate").alias("season")
    )
    schema = "line int, tov double, flag string"
    rows = documents.scrape_measure(docs, "game", "BoxScorePlayerTrack", "player_track", schema, keep=["key", "season"])
    landing.land(
        rows, "game", path, game_id=F.col("key"), season=F.col("season"), season_type="Regular Season",
        create_date=F.lit("2001-06-01 00:00:00").cast("timestamp"), run_id=1,
    )
    return landing.read_landed(lg.spark, path).drop("key", "season", "_create_date")


@query(
    "landed_drift",
    """select s_suppkey as key, s_name as name, s_acctbal as acctbal, null as segment, null as rating, s_nationkey as _team_id, 1 as _run_id from supplier
       union all select c_custkey, c_name, c_acctbal, c_mktsegment, cast(c_nationkey as bigint), c_nationkey, 2 from customer""",
)
def landed_drift(lg: League):
    """Two loads of one table; the second brings two columns the first did not have."""
    path = fresh_path(lg.spark, "drift")
    first = lg.table("supplier").select(
        F.col("s_suppkey").alias("KEY"), F.col("s_name").alias("NAME"), F.col("s_acctbal").alias("ACCTBAL"), F.col("s_nationkey").alias("team")
    )
    second = lg.table("customer").select(
        F.col("c_custkey").alias("KEY"), F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("ACCTBAL"),
        F.col("c_nationkey").alias("team"), F.col("c_mktsegment").alias("SEGMENT"), F.col("c_nationkey").alias("RATING"),
    )
    for run, rows in enumerate((first, second), start=1):
        landing.land(
            rows, "team", path, team_id=F.col("team"), season="2001-02",
            season_type="Playoffs", create_date=F.lit("2001-06-01 00:00:00").cast("timestamp"), run_id=run,
        )
    return landing.read_landed(lg.spark, path).select("key", "name", "acctbal", "segment", "rating", "_team_id", "_run_id")


@query(
    "league_hustle_refresh",
    with_tables(
        "game",
        """select home_team_id as team_id, season as _season, count(*) as contested_shots, count(*) filter (game_status = 'Final') as charges_drawn
        from game group by all""",
    ),
)
def league_hustle_refresh(lg: League):
    """League-wide table landed twice (each run appends all of it); the refreshed view shows each row once."""
    path = fresh_path(lg.spark, "team-hustle")
    for day in ("2001-05-31", "2001-06-01"):
        landing.land(
            lg.team_hustle.withColumnRenamed("_season", "for_season"), "league", path, season=F.col("for_season"),
            season_type="Regular Season", create_date=F.lit(day).cast("timestamp"),
        )
    view = landing.snapshot(landing.read_landed(lg.spark, path), ["team_id", "_season"])
    published, _ = landing.publish(view, f"{path}-views", "team_hustle", "v1")
    return lg.spark.read.parquet(published).select("team_id", "_season", "contested_shots", "charges_drawn")


@query(
    "season_summary_backfill",
    with_tables(
        "game",
        "select home_team_id as _team_id, season as _season, count(*) as games, cast(count(*) filter (game_status = 'Final') as bigint) as finals from game group by all",
    ),
)
def season_summary_backfill(lg: League):
    """Team summaries of all seasons and teams, landed at roster grain."""
    path = fresh_path(lg.spark, "team-summary")
    counts = lg.games.groupBy("home_team_id", "season").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("game_status") == "Final").alias("f")
    )
    body = result_document(("Info", {"GAMES": F.col("n"), "FINALS": F.col("f")}), ("Ranks", {"GAMES": F.col("n")}))
    docs = counts.select(body.alias("body"), "home_team_id", "season")
    rows = documents.scrape_measure(
        docs, "team", "TeamSummary", "info", "games bigint, finals bigint", keep=["home_team_id", "season"]
    )
    landing.land(
        rows, "roster", path, team_id=F.col("home_team_id"), season=F.col("season"),
        create_date=F.lit("2001-06-01").cast("timestamp"), run_id=1,
    )
    return landing.read_landed(lg.spark, path).select("_team_id", "_season", "games", "finals")


@query(
    "latest_snapshot",
    """select o_custkey, o_orderkey, cast(o_orderdate as date) as _create_date, o_orderpriority from orders
       qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def latest_snapshot(lg: League):
    """Each order is a pull of its customer; the refreshed view keeps the newest pull."""
    pulls = lg.table("orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("_create_date"), "o_orderpriority"
    )
    path, _ = landing.publish(
        landing.snapshot(pulls, ["o_custkey"], "o_orderkey"), fresh_path(lg.spark, "views"), "customer", "v1"
    )
    return lg.spark.read.parquet(path)


def nodes(lg: League) -> DataFrame:
    """The part table as measure catalogue."""
    return lg.table("part").select(
        F.lower("p_type").alias("node"), F.col("p_brand").alias("endpoint"), F.col("p_name").alias("measure"),
        F.concat(F.col("p_name"), F.lit("_"), F.col("p_partkey").cast("string")).alias("table_name"),
        (F.col("p_retailprice") > 950).alias("active"),
        F.when(F.col("p_size") > 40, "pass").otherwise("self").alias("measure_type"),
        (F.col("p_size") + 1970).alias("available_year"),
    )


@query(
    "measure_catalogue",
    """select lower(p_type) as node, p_brand as endpoint, p_name as measure, p_name || '_' || p_partkey as table_name, cast(p_size + 1970 as integer) as available_year
       from part where p_retailprice > 950 and p_size + 1970 <= 2016 and p_size <= 40""",
)
def measure_catalogue(lg: League):
    return control.per_entity(control.active_measures(nodes(lg), "2016-17")).select(
        "node", "endpoint", "measure", "table_name", "available_year"
    )


@query(
    "measures_of_node",
    """select p_brand as endpoint, p_name as measure, p_name || '_' || p_partkey as table_name from part
       where p_retailprice > 950 and p_size + 1970 <= 1998 and lower(p_type) = 'promo'""",
)
def measures_of_node(lg: League):
    return control.active_measures(nodes(lg), "1998-99", node="promo").select("endpoint", "measure", "table_name")


@query(
    "single_measure",
    """select lower(p_type) as node, p_brand as endpoint, p_name as measure, p_name || '_' || p_partkey as table_name from part
       where p_size + 1970 <= 2016 and p_name || '_' || p_partkey = (select min(p_name || '_' || p_partkey) from part where p_size + 1970 <= 2016)""",
)
def single_measure(lg: League):
    """The one measure of the first table in order of name, all measures being active."""
    catalogue = nodes(lg).withColumn("active", F.lit(True))
    first = control.active_measures(catalogue, "2016-17").agg(F.min("table_name")).first()[0]
    found = control.single_measure(catalogue, "2016-17", first)
    return lg.spark.createDataFrame([found]).select("node", "endpoint", "measure", "table_name")


@query(
    "cleared_tables",
    """select 'before' as version, c_custkey, c_name from customer""",
)
def cleared_tables(lg: League):
    """A published table, and its next version after it was cleared: empty, while the version before stays."""
    root = fresh_path(lg.spark, "cleared")
    rows = lg.table("customer").select("c_custkey", "c_name")
    landing.publish(rows, root, "customer", "v1")
    landing.clear(lg.spark, rows.schema, root, ["customer"], "v2")
    return lg.spark.read.parquet(f"{root}/customer/v1").select(F.lit("before").alias("version"), "*").unionByName(
        lg.spark.read.parquet(f"{root}/customer/v2").select(F.lit("after").alias("version"), "*")
    )


_CAL_SQL = """cal as (select season, season_type, min(game_date) as start_date, max(game_date) as end_date,
    max(game_date) >= date '2001-01-01' as is_current from game group by all),
  marks as (select season, season_type, max(game_date) filter (game_status = 'Final') as last_final,
    min(game_date) filter (game_status not in ('Final', 'PPD') and game_date < date '2001-06-01') as first_unfinished,
    max(game_date) as last_game from game group by all)"""


def _marks(lg: League) -> DataFrame:
    return control.watermarks(lg.header, F.lit(AS_OF))


@query("schedule_watermarks", with_tables("game", f"with {_CAL_SQL} select * from marks"))
def schedule_watermarks(lg: League):
    return _marks(lg)


_RANGE_SQL = """rng as (select season, season_type,
    case when last_final is not null then coalesce(first_unfinished, last_final + 1) else start_date end as pull_from,
    case when last_final is not null and is_current then date '2001-06-01' else end_date end as pull_to
  from cal left join marks using (season, season_type))"""


@query("schedule_ranges", with_tables("game", f"with {_CAL_SQL}, {_RANGE_SQL} select * from rng where pull_from < pull_to"))
def schedule_ranges(lg: League):
    return control.schedule_range(_marks(lg), seasons(lg), F.lit(AS_OF))


@query(
    "schedule_ranges_full",
    with_tables(
        "game",
        f"""with {_CAL_SQL}, longer as (select season, season_type, start_date, end_date + 30 as end_date from cal)
        select season, season_type, least(coalesce(last_game, start_date - 1) + 1, end_date) as pull_from, end_date as pull_to
        from longer left join marks using (season, season_type)
        where least(coalesce(last_game, start_date - 1) + 1, end_date) < end_date""",
    ),
)
def schedule_ranges_full(lg: League):
    longer = seasons(lg).withColumn("end_date", F.date_add("end_date", 30))
    return control.schedule_range(_marks(lg), longer, F.lit(AS_OF), full=True)


@query(
    "schedule_days",
    with_tables(
        "game",
        f"""with {_CAL_SQL}, {_RANGE_SQL}, days as (select season, season_type, unnest(generate_series(pull_from, pull_to, interval 1 day)) as d
          from rng where pull_from < pull_to)
        select season, season_type, cast(d as date) as game_date, strftime(d, '%Y%m%d') as node_key from days""",
    ),
)
def schedule_days(lg: League):
    ranges = control.schedule_range(_marks(lg), seasons(lg), F.lit(AS_OF))
    return control.date_spine(ranges).select("season", "season_type", "game_date", "node_key")


@query(
    "season_teams",
    with_tables(
        "game",
        """with s(season) as (values ('1999-00'), ('2000-01'), ('2001-02'))
        select distinct visitor_team_id as team_id, 'T' || visitor_team_id as team_abbrv, s.season from game cross join s""",
    ),
)
def season_teams(lg: League):
    teams = lg.games.select(
        F.col("visitor_team_id").alias("team_id"), F.concat(F.lit("T"), F.col("visitor_team_id").cast("string")).alias("team_abbrv")
    )
    return control.season_teams(teams, ["1999-00", "2000-01", "2001-02"])


def game_log(lg: League) -> DataFrame:
    """Lines as log rows of their game."""
    return lg.table("lineitem").select(
        F.lit("game").alias("node"), F.col("l_orderkey").alias("node_key"),
        F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("IN PROGRESS").alias("node_status"),
        F.when(F.col("l_returnflag") == "A", "COMPLETED").when(F.col("l_returnflag") == "R", "FAILED").otherwise("IN PROGRESS").alias("group_status"),
    )


@query(
    "pending_games",
    with_tables(
        "game",
        """select id as game_id, game_code as gamecode, game_date, home_team_id, visitor_team_id, season as _season from game
        where game_status = 'Final' and game_code not like '%WSTEST%' and game_code not like '%ESTWST%'
          and not exists (select 1 from lineitem where l_orderkey = id and l_linestatus = 'F' and l_returnflag = 'A')""",
    ),
)
def pending_games(lg: League):
    return control.pending_games(lg.header, game_log(lg)).select(
        "game_id", "gamecode", "game_date", "home_team_id", "visitor_team_id", "_season"
    )


@query(
    "games_with_box_score",
    with_tables("game", "select id as game_id from game where exists (select 1 from lineitem where l_orderkey = id and l_linestatus = 'F')"),
)
def games_with_box_score(lg: League):
    done = control.done_keys(game_log(lg), "game")
    return lg.games.select(F.col("id").alias("game_id")).join(done, F.col("game_id") == F.col("node_key"), "left_semi")


@query(
    "players_not_done",
    """with cand as (select distinct l_suppkey as node_key, l_partkey as parent_key from lineitem)
       select * from cand where not exists (select 1 from lineitem l where l.l_suppkey = node_key and l.l_partkey = parent_key
         and l_linestatus = 'F' and (l_linenumber = 3 or cast(l_shipdate as date) = date '1999-06-01'))""",
)
def players_not_done(lg: League):
    lines = lg.table("lineitem")
    keys = [F.col("l_suppkey").alias("node_key"), F.col("l_partkey").alias("parent_key")]
    log = lines.select(
        F.lit("player").alias("node"), *keys, F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("FAILED").alias("node_status"),
        F.col("l_linenumber").alias("run_id"), F.col("l_shipdate").alias("end_dtm"),
    )
    return control.not_done(
        lines.select(*keys).distinct(), log, "player", run_id=3, as_of=F.lit(dt.date(1999, 6, 1)), keys=("node_key", "parent_key")
    )


@query(
    "run_log_status",
    """with e as (select cast(ts as date) as run_id, event_type as node, user_id as node_key, props ->> '$.k' as parent_key, ts as tm, event_id as seq,
           case when event_type in ('click', 'view') then null when value > 50 then 'COMPLETED' else 'IN PROGRESS' end as node_status,
           case when value > 80 then 'FAILED' else 'N/A' end as group_status, cast(props ->> '$.k' as integer) as n from events)
       select run_id, node, node_key, parent_key, arg_max(node_status, (tm, seq)) filter (node_status is not null) as node_status,
         arg_max(group_status, (tm, seq)) as group_status, min(tm) as started_dtm, max(tm) as end_dtm, arg_max(n, (tm, seq)) as measure_count
       from e group by all""",
)
def run_log_status(lg: League):
    events = lg.table("events").select(
        F.col("ts").cast("date").alias("run_id"), F.col("event_type").alias("node"), F.col("user_id").alias("node_key"),
        F.get_json_object("props", "$.k").alias("parent_key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type").isin("click", "view"), F.lit(None)).when(F.col("value") > 50, "COMPLETED").otherwise("IN PROGRESS").alias("node_status"),
        F.when(F.col("value") > 80, "FAILED").otherwise("N/A").alias("group_status"),
        F.get_json_object("props", "$.k").cast("int").alias("measure_count"),
    )
    return control.log_status(events)


@query(
    "game_players",
    with_tables("game sched stat", "select distinct game_id, team_id, team_abbreviation, player_id, player_name from stat"),
)
def game_players(lg: League):
    return control.game_players(lg.player_stats)


@query(
    "season_players",
    with_tables(
        "game sched stat hist",
        """with t as (select player_id, season, team_id from hist
          qualify row_number() over (partition by player_id, season order by rec_start_date desc, team_id) = 1)
        select distinct player_id, season, t.team_id from stat left join t using (player_id, season)""",
    ),
)
def season_players(lg: League):
    return control.season_players(lg.player_stats, lg.team_history)


@query(
    "find_player",
    "select c_custkey as id, c_name as display_first_last from customer where lower(split_part(c_name, '#', 2) || ', ' || split_part(c_name, '#', 1)) = '000000042, customer'",
)
def find_player(lg: League):
    named = lg.players.withColumn("display_last_comma_first", F.concat("last_name", F.lit(", "), "first_name"))
    return control.find_player(named, "CUSTOMER", "000000042").select("id", "display_first_last")


@query(
    "named_events",
    """select event_id, user_id as player_id, coalesce(c_name, 'Unknown Player (for now)') as player_name, n_name as team_abbrv
       from events left join (select * from customer where c_acctbal >= 0) c on c_custkey = user_id
       left join nation on n_nationkey = cast(props ->> '$.k' as integer)""",
)
def named_events(lg: League):
    events = lg.table("events").select(
        "event_id", F.col("user_id").alias("player_id"), F.get_json_object("props", "$.k").cast("int").alias("team_id")
    )
    known = lg.table("customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name")
    )
    teams = lg.teams.select(F.col("id").alias("team_id"), F.col("team_name").alias("team_abbrv"))
    return control.with_names(events, known, teams).select("event_id", "player_id", "player_name", "team_abbrv")


@query(
    "season_calendar",
    with_tables(
        "game",
        """select season, min(game_date) as start_date, max(game_date) as end_date, max(game_date) >= date '2001-01-01' as is_current
        from game where season = '1998-99' and season_type = 'Playoffs' group by season""",
    ),
)
def season_calendar(lg: League):
    return control.season_dates(seasons(lg), "1998-99", "Playoffs").select(F.lit("1998-99").alias("season"), "*")


def _stamped(lg: League, grain: str, rows: DataFrame, **lineage) -> DataFrame:
    path = fresh_path(lg.spark, f"{grain}-grain")
    landing.land(rows, grain, path, **lineage)
    return landing.read_landed(lg.spark, path)


@query(
    "landed_player_grain",
    """select o_custkey as _player_id, c_nationkey as _team_id, o_totalprice as _stats_value, cast(month(o_orderdate) as integer) as tov,
         '1998-99' as _season, 'Regular Season' as _season_type, date '2001-06-01' as _create_date, 7 as _run_id
       from orders join customer on c_custkey = o_custkey""",
)
def landed_player_grain(lg: League):
    team = lg.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("team"))
    rows = lg.table("orders").join(team, "o_custkey").select(
        F.col("o_totalprice").alias("STATS_VALUE"), F.month("o_orderdate").alias("TO"), F.col("o_custkey").alias("who"), "team"
    )
    return _stamped(
        lg, "player", rows, player_id=F.col("who"), team_id=F.col("team"), season="1998-99", season_type="Regular Season",
        create_date=F.lit(AS_OF), run_id=7,
    ).drop("who", "team")


@query(
    "landed_schedule_grain",
    """select o_orderkey as game_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as game_date_est, '1998-99' as _season, 'Playoffs' as _season_type,
         date '2001-06-01' as _create_date, 7 as _run_id from orders""",
)
def landed_schedule_grain(lg: League):
    rows = lg.table("orders").select(
        F.col("o_orderkey").alias("GAME_ID"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("GAME_DATE_EST")
    )
    return _stamped(lg, "schedule", rows, season="1998-99", season_type="Playoffs", create_date=F.lit(AS_OF), run_id=7)


@query(
    "landed_player_list",
    "select c_custkey as person_id, c_name as display_first_last, '1998-99' as _season, date '2001-06-01' as _create_date from customer",
)
def landed_player_list(lg: League):
    rows = lg.players.select(F.col("id").alias("PERSON_ID"), F.col("display_first_last").alias("DISPLAY_FIRST_LAST"))
    return _stamped(lg, "player_list", rows, season="1998-99", create_date=F.lit(AS_OF))


@query(
    "landed_widening",
    """select 'whole' as step, l_orderkey as _game_id, cast(l_linenumber as varchar) as value from lineitem
       union all select 'fraction', l_orderkey, cast(l_discount as varchar) from lineitem
       union all select 'text', l_orderkey, l_returnflag from lineitem""",
)
def landed_widening(lg: League):
    """One measure landed three times: whole numbers, then fractions, then text. No value is cut."""
    path = fresh_path(lg.spark, "widening")
    row = {"VALUE": F.col("value")}
    measure = Row(node="game", endpoint="BoxScorePlayerTrack", measure="player_track", table_name="track")
    for run, (step, column) in enumerate((("whole", "l_linenumber"), ("fraction", "l_discount"), ("text", "l_returnflag"))):
        set_ = F.struct(
            F.lit("PlayerTrack").alias("name"), F.array(F.lit("VALUE")).alias("headers"), F.array(F.array(F.col(column))).alias("rowSet")
        )
        body = F.to_json(F.struct(F.array(set_).alias("resultSets")))
        docs = lg.table("lineitem").select(F.col("l_orderkey").alias("_game_id"), body.alias("body"))
        load.load_measure(measure, docs, path, "2001-02", "Playoffs", run, dt.datetime(2001, 6, 1))
    steps = F.element_at(F.array(*map(F.lit, ("whole", "fraction", "text"))), F.col("_run_id") + 1)
    return landing.read_landed(lg.spark, f"{path}/track").select(steps.alias("step"), "_game_id", "value")


@query(
    "landed_news",
    """select cast(user_id as varchar) as playerid, event_type as headline, null as teamcode, date '2001-05-31' as _create_date, '2000-01' as _season from events
       union all select cast(user_id as varchar), event_type, 'T' || event_id, date '2001-06-01', '2000-01' from events""",
)
def landed_news(lg: League):
    """Two polls of the news; the second feed has a field that the first did not have."""
    path = fresh_path(lg.spark, "news")
    fields = [F.col("user_id").cast("string").alias("PlayerID"), F.col("event_type").alias("Headline")]
    for day, more in ((dt.datetime(2001, 5, 31), []), (dt.datetime(2001, 6, 1), [F.concat(F.lit("T"), F.col("event_id")).alias("TeamCode")])):
        body = F.to_json(F.struct(F.array(F.struct(*fields, *more)).alias("ListItems")))
        items = documents.news_items(lg.table("events").select(body.alias("body")))
        load.load_news(items, path, "2000-01", "Regular Season", day)
    return landing.read_landed(lg.spark, f"{path}/player_news").select(
        "playerid", "headline", "teamcode", F.col("_create_date").cast("date").alias("_create_date"), "_season"
    )


# Measures of the career endpoint, in order of their result sets.
CAREER = (
    "regular_season_totals", "regular_season_career_totals", "post_season_totals", "post_season_career_totals", "all_star_season_totals",
    "career_all_star_season_totals", "college_season_totals", "college_season_career_totals", "regular_season_rankings", "post_season_rankings",
)


@query(
    "career_measures",
    """with m(measure, place) as (values """ + ", ".join(f"('{m}', {i})" for i, m in enumerate(CAREER)) + """),
      o as (select o_orderkey, o_custkey, o_totalprice, o_orderstatus, cast(year(o_orderdate) as varchar) as season_id, date_part('month', o_orderdate) % 10 as place from orders),
      b as (select o_custkey as _player_id, place, season_id, count(*) as gp, sum(o_totalprice) as tov, max(o_orderstatus) as flag from o group by all)
    select measure, _player_id, season_id, gp, round(tov, 2) as tov, flag from b join m using (place)""",
)
def career_measures(lg: League):
    """All ten measures of the career endpoint landed from one document per player, which is parsed once."""
    path = fresh_path(lg.spark, "careers")
    yearly = lg.table("orders").groupBy(
        F.col("o_custkey").alias("_player_id"), (F.month("o_orderdate") % 10).alias("place"), F.year("o_orderdate").cast("string").alias("season")
    ).agg(F.count(F.lit(1)).alias("gp"), F.sum("o_totalprice").alias("tov"), F.max("o_orderstatus").alias("flag"))
    quoted = [F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in ("season", "flag")]
    row = F.concat(F.lit("["), quoted[0], F.lit(","), F.col("gp").cast("string"), F.lit(","), F.col("tov").cast("string"), F.lit(","), quoted[1], F.lit("]"))
    rows = yearly.select("_player_id", *[F.when(F.col("place") == i, row).alias(f"r{i}") for i in range(len(CAREER))])
    # a player's seasons are few
    people = rows.groupBy("_player_id").agg(*[F.array_join(F.collect_list(f"r{i}"), ",").alias(f"r{i}") for i in range(len(CAREER))])
    sets = [
        F.concat(F.lit(f'{{"name":"{name}","headers":["SEASON_ID","GP","TO","FLAG"],"rowSet":['), F.col(f"r{i}"), F.lit("]}"))
        for i, name in enumerate(CAREER)
    ]
    docs = people.select("_player_id", F.lit(None).cast("string").alias("_team_id"), F.concat(F.lit('{"resultSets":['), F.concat_ws(",", *sets), F.lit("]}")).alias("body"))
    measures = [Row(node="player", endpoint="PlayerCareer", measure=m, table_name=f"career_{m}") for m in CAREER]
    load.load_measures(measures, docs, path, "2001-02", "Regular Season", 1, dt.datetime(2001, 6, 1))
    parts = [
        landing.read_landed(lg.spark, f"{path}/career_{m}").select(
            F.lit(m).alias("measure"), "_player_id", "season_id", "gp", F.round("tov", 2).alias("tov"), "flag"
        )
        for m in CAREER
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "season_measure",
    """select o_custkey as _team_id, count(*) as games from orders
       where year(o_orderdate) = 1998 and o_custkey in (select c_custkey from customer where c_acctbal > 0) group by all""",
)
def season_measure(lg: League):
    """A single measure for the teams of a season; documents of others are at hand and stay out."""
    path = fresh_path(lg.spark, "season-measure")
    counts = lg.table("orders").where(F.year("o_orderdate") == 1998).groupBy(F.col("o_custkey").alias("_team_id")).agg(F.count(F.lit(1)).alias("n"))
    docs = counts.select("_team_id", result_document(("Info", {"GAMES": F.col("n")})).alias("body"))
    teams = lg.table("customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("_team_id"))
    catalogue = lg.spark.createDataFrame(
        [("team", "TeamSummary", "info", "team_info", True, "self", 1990)],
        "node string, endpoint string, measure string, table_name string, active boolean, measure_type string, available_year int",
    )
    load.load_single(
        catalogue, "team_info", lambda endpoint: docs, path, "1998-99", entities=teams, season_type="Regular Season", run_id=1,
        as_of=dt.datetime(2001, 6, 1), schema="games bigint",
    )
    return landing.read_landed(lg.spark, f"{path}/team_info").select("_team_id", "games")


@query(
    "schedule_load",
    """with d as (select distinct strftime(o_orderdate, '%Y%m%d') as node_key from orders where year(o_orderdate) = 1998)
       select 'game' as kind, cast(o_orderkey as varchar) as key, o_orderstatus as value, '1998-99' as _season from orders
         where year(o_orderdate) = 1998 and day(o_orderdate) <> 13
       union all select 'log', node_key, case when node_key like '%13' then 'FAILED' else 'COMPLETED' end, '1998-99' from d""",
)
def schedule_load(lg: League):
    """The scoreboards of a year's days landed, and the log; scoreboards of each 13th are missing, those of other years stay out."""
    path = fresh_path(lg.spark, "schedule-load")
    orders = lg.table("orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("node_key"), "o_orderkey", "o_orderstatus")
    row = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"))
    headers = F.array(F.lit("GAME_ID"), F.lit("GAME_STATUS"))
    board = F.struct(F.lit("GameHeader").alias("name"), headers.alias("headers"), F.sort_array(F.collect_list(row)).alias("rowSet"))
    docs = orders.where(~F.col("node_key").endswith("13")).groupBy("node_key").agg(F.to_json(F.struct(F.array(board).alias("resultSets"))).alias("body"))
    days = orders.where(F.col("node_key").startswith("1998")).select("node_key").distinct()
    catalogue = lg.spark.createDataFrame(
        [("schedule", "Scoreboard", "game_header", "schedule_game_header", True, "self", 1990)],
        "node string, endpoint string, measure string, table_name string, active boolean, measure_type string, available_year int",
    )
    log = load.load_schedule(catalogue, days, docs, path, "1998-99", "Regular Season", 1, dt.datetime(2001, 6, 1))
    games = landing.read_landed(lg.spark, f"{path}/schedule_game_header")
    return games.select(F.lit("game").alias("kind"), F.col("game_id").alias("key"), F.col("game_status").alias("value"), "_season").unionByName(
        log.select(F.lit("log").alias("kind"), F.col("node_key").alias("key"), F.col("node_status").alias("value"), F.col("season").alias("_season"))
    )


@query(
    "roster_load_all",
    with_tables(
        "game",
        """with t as (select home_team_id as _team_id, season as _season, count(*) as n, count(*) filter (game_status = 'Final') as f from game group by all)
        select 'team_summary' as table_name, _team_id, _season, n as a, cast(null as bigint) as b from t
        union all select 'team_season_ranks', _team_id, _season, f, null from t
        union all select 'team_common_roster', _team_id, _season, n, f from t
        union all select 'team_coaches', _team_id, _season, f, n from t""",
    ),
)
def roster_load_all(lg: League):
    """All four roster tables of all seasons and teams, in one load."""
    path = fresh_path(lg.spark, "roster-load")
    counts = lg.games.groupBy(F.col("home_team_id").alias("_team_id"), F.col("season").alias("_season")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("game_status") == "Final").alias("f")
    )

    def numbers(*sets: tuple[str, tuple[Column, ...]]) -> Column:
        return F.to_json(F.struct(F.array(*[
            F.struct(
                F.lit(name).alias("name"), F.array(*[F.lit("AB"[i]) for i in range(len(row))]).alias("headers"), F.array(F.array(*row)).alias("rowSet")
            )
            for name, row in sets
        ]).alias("resultSets")))

    n, f = F.col("n"), F.col("f")
    bodies = {
        "TeamSummary": numbers(("TeamInfoCommon", (n,)), ("TeamSeasonRanks", (f,))),
        "TeamCommonRoster": numbers(("CommonTeamRoster", (n, f)), ("Coaches", (f, n))),
    }
    load.load_roster(
        counts, lambda name: counts.select("_team_id", "_season", bodies[name].alias("body")), path, 1, dt.datetime(2001, 6, 1)
    )
    parts = []
    for name in load.ROSTER:
        rows = landing.read_landed(lg.spark, f"{path}/{name}")
        b = F.col("b") if "b" in rows.columns else F.lit(None).cast("bigint")
        parts.append(rows.select(F.lit(name).alias("table_name"), "_team_id", "_season", "a", b.alias("b")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "hustle_load",
    """select 'player' as side, c_custkey as id, count(*) as deflections, '2000-01' as _season from customer join orders on o_custkey = c_custkey group by all
       union all select 'team', c_nationkey, count(*), '2000-01' from customer group by all""",
)
def hustle_load(lg: League):
    """The hustle tables of players and teams, one document per row."""
    path = fresh_path(lg.spark, "hustle-load")

    def docs(rows: DataFrame) -> DataFrame:
        set_ = F.struct(
            F.lit("Hustle").alias("name"), F.array(F.lit("ID"), F.lit("DEFLECTIONS")).alias("headers"),
            F.array(F.array(F.col("id").cast("bigint"), F.col("n"))).alias("rowSet"),
        )
        return rows.select(F.to_json(F.struct(F.array(set_).alias("resultSets"))).alias("body"))

    players = lg.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    teams = lg.table("customer").groupBy(F.col("c_nationkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    load.load_hustle(docs(players), docs(teams), path, "2000-01", "Regular Season", dt.datetime(2001, 6, 1))
    return reduce(DataFrame.unionByName, [
        landing.read_landed(lg.spark, f"{path}/{side}_hustle_stats").select(F.lit(side).alias("side"), "id", "deflections", "_season")
        for side in ("player", "team")
    ])


@query(
    "game_run_log",
    """with log as (select l_orderkey, max(l_linestatus = 'F') as boxed, max(l_linestatus = 'F' and l_returnflag = 'A') as done from lineitem group by all),
       pend as (select o_orderkey, o_custkey, coalesce(boxed, false) as boxed from orders left join log on l_orderkey = o_orderkey
         where o_orderstatus = 'F' and month(o_orderdate) <= 9 and year(o_orderdate) = 1998 and not coalesce(done, false)),
       game as (select o_orderkey, o_custkey, not boxed and o_orderkey % 7 = 0 as bad from pend),
       player as (select distinct o_orderkey, o_custkey, l_suppkey, l_suppkey % 5 = 0 as bad from pend join lineitem on l_orderkey = o_orderkey),
       e as (
         select 'game' as node, o_orderkey as k, null as p, case when o_orderkey % 7 = 0 then 'FAILED' else 'COMPLETED' end as s, 'IN PROGRESS' as g,
           case when o_orderkey % 7 = 0 then 0 else 1 end as n, 0 as seq from pend where not boxed
         union all select distinct 'team', o_custkey, null, case when o_custkey % 11 = 0 then 'FAILED' else 'COMPLETED' end, 'N/A',
           case when o_custkey % 11 = 0 then 0 else 1 end, 1 from pend
         union all select distinct 'player', l_suppkey, o_custkey, case when bad then 'FAILED' else 'COMPLETED' end, 'N/A', case when bad then 0 else 1 end, 2 from player
         union all select 'game', o_orderkey, null, case when open then null else 'COMPLETED' end, case when open then 'FAILED' else 'COMPLETED' end, 0, 3
           from (select o_orderkey, bad or o_custkey % 11 = 0 or exists (select 1 from player p where p.o_orderkey = game.o_orderkey and p.bad) as open from game))
       select node, cast(k as varchar) as node_key, cast(p as varchar) as parent_key, arg_max(s, seq) filter (s is not null) as node_status,
         arg_max(g, seq) as group_status, cast(arg_max(n, seq) as integer) as measure_count from e group by node, k, p""",
)
def game_run_log(lg: League):
    """A whole run over the pending games of a season: box scores, teams, players, and the log it leaves, as status rows.

    A customer is the team here (it plays itself) and a supplier the player. Documents of some games are broken text, of some
    teams missing, and of some players without the result set asked for.
    """
    orders = lg.table("orders")
    day = F.col("o_orderdate").cast("date")
    text = F.col("o_custkey").cast("string")
    header = orders.select(
        F.col("o_orderkey").cast("string").alias("game_id"), fn.date_key(day).alias("gamecode"), day.alias("game_date"),
        F.when(F.col("o_orderstatus") == "F", "Final").otherwise("Scheduled").alias("game_status_text"),
        text.alias("home_team_id"), text.alias("visitor_team_id"), fn.season_text(day).alias("_season"),
        F.when(F.month(day) <= 9, "Regular Season").otherwise("Playoffs").alias("_season_type"),
    )
    log = game_log(lg).select(
        F.lit(1).alias("run_id"), "node", F.col("node_key").cast("string").alias("node_key"), F.lit(None).cast("string").alias("parent_key"),
        "node_status", "group_status", F.lit("1998-99").alias("season"), F.lit("Regular Season").alias("season_type"),
        F.lit(dt.datetime(2001, 1, 1)).alias("end_dtm"),
    )
    played = lg.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").cast("string").alias("player_id")).join(
        orders.select("o_orderkey", text.alias("team_id")), "o_orderkey"
    ).select(F.col("o_orderkey").cast("string").alias("game_id"), "team_id", "player_id")
    first = {"VALUE": F.col("key")}
    documents_of = {
        "BoxscoreTraditional": orders.select(F.col("o_orderkey").cast("string").alias("key")).select(
            F.col("key").alias("_game_id"),
            F.when(F.col("key").cast("bigint") % 7 == 0, '{"resultSets": [{"na').otherwise(result_document(("PlayerStats", first))).alias("body")),
        "TeamGeneralSplits": orders.where("o_custkey % 11 <> 0").select(text.alias("key")).distinct().select(
            F.col("key").alias("_team_id"), result_document(("Overall", first), ("Location", first)).alias("body")),
        "PlayerGeneralSplits": played.select(F.col("player_id").alias("key"), "team_id").distinct().select(
            F.col("key").alias("_player_id"), F.col("team_id").alias("_team_id"),
            F.when(F.col("key").cast("bigint") % 5 == 0, result_document(("Overall", first)))
            .otherwise(result_document(("Overall", first), ("Location", first))).alias("body")),
    }
    rows = [
        ("game", "BoxscoreTraditional", "player_stats", "game_player_stats", True, "self", 1990),
        ("team", "TeamGeneralSplits", "location", "team_location", True, "Base", 1990),
        ("player", "PlayerGeneralSplits", "location", "player_location", True, "Base", 1990),
        ("player", "PlayerGeneralSplits", "overall", "player_news", True, "pass", 1990),
    ]
    catalogue = lg.spark.createDataFrame(
        rows, "node string, endpoint string, measure string, table_name string, active boolean, measure_type string, available_year int"
    )
    events = load.run_games(
        catalogue, header, log, lambda: played, documents_of.__getitem__, fresh_path(lg.spark, "game-run"),
        season="1998-99", season_type="Regular Season", run_id=2, as_of=dt.datetime(2001, 6, 1),
    )
    return control.log_status(events).select("node", "node_key", "parent_key", "node_status", "group_status", "measure_count")
