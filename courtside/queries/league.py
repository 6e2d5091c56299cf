"""The given star schema read as a league.

customer is the player, market segment the position, nation the team, region the conference;
an order is a game of its customer, the year its season, its lines the box score; events are
news. ``SQL`` holds the same tables as common table expressions for the checking SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.session import settle
from courtside.sources.schemas import OPPONENT_STATS
from courtside.functions import scalars as fn

NEWS_SHIFT = 9131 * 86400  # seconds from January 2024 back to January 1999, into the order calendar


# Columns of the given tables, so that no job is spent on finding them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class League:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def settled(self, *names: str) -> League:
        """This league with the named tables written once, for queries whose steps read them several times."""
        for name in names:
            setattr(self, name, settle(getattr(self, name), name))
        return self

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def teams(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("id"), F.col("n_name").alias("team_name"),
                F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("team_abbreviation"),
                F.col("r_name").alias("conference"),
            )
        )

    @cached_property
    def landed_teams(self) -> DataFrame:
        return self.teams.select(
            F.col("id").alias("team_id"), "team_name", F.col("team_abbreviation").alias("team_abbrv")
        )

    @cached_property
    def players(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("display_first_last"),
            fn.part("c_name", "#", 1).alias("first_name"), fn.part("c_name", "#", 2).alias("last_name"),
            F.col("c_mktsegment").alias("pos"), F.col("c_mktsegment").alias("nba_pos"),
            F.col("c_mktsegment").alias("fd_pos"), F.col("c_nationkey").alias("team_id"),
            F.date_add(F.to_date(F.lit("1970-01-01")), F.floor("c_acctbal").cast("int")).alias("birthdate"),
            F.when(F.col("c_acctbal") >= 0, "Active").otherwise("Inactive").alias("rosterstatus"),
            F.lit(True).alias("is_rec_active"),
        )

    @cached_property
    def games(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        home = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("home_team_id"))
        return self.table("orders").join(home, "o_custkey").select(
            F.col("o_orderkey").alias("id"),
            F.concat(fn.date_key(day), F.lit("/"), F.col("o_orderkey").cast("string")).alias("game_code"),
            day.alias("game_date"),
            F.when(F.col("o_orderstatus") == "F", "Final").when(F.col("o_orderstatus") == "P", "PPD")
            .otherwise("Scheduled").alias("game_status"),
            "home_team_id", (F.floor("o_totalprice") % 25).cast("int").alias("visitor_team_id"),
            F.col("o_custkey").alias("player_id"), fn.season_text(day).alias("season"),
            F.when(F.month(day) <= 9, "Regular Season").otherwise("Playoffs").alias("season_type"),
            "o_orderpriority", "o_totalprice",
        )

    @cached_property
    def box_lines(self) -> DataFrame:
        """Box-score numbers per game, rolled up from its lines."""
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("game_id")).agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("seconds"),
            F.sum(F.col("l_linenumber").cast("bigint")).alias("pts"),
            F.count_if(F.col("l_returnflag") == "A").alias("ast"),
            F.count_if(F.col("l_returnflag") == "R").alias("reb"),
            F.count_if(F.col("l_returnflag") == "N").alias("stl"),
            F.count_if(F.col("l_linestatus") == "O").alias("blk"),
            F.count_if(F.col("l_linestatus") == "F").alias("tov"),
        )

    @cached_property
    def box(self) -> DataFrame:
        """The games that have lines, with their box score."""
        return self.games.drop("game_code").join(self.box_lines.withColumnRenamed("game_id", "id"), "id")

    @cached_property
    def facts(self) -> DataFrame:
        """Player-game rows of the games that have lines."""
        return self.box.select(
            F.col("id").alias("game_id"), "player_id", "season", "season_type", "game_date", "game_status",
            F.col("home_team_id").alias("team_id"), F.col("visitor_team_id").alias("opp_team_id"),
            F.concat(F.lit("T"), F.col("home_team_id").cast("string")).alias("team_abbreviation"),
            F.lit("H").alias("team_loc"), F.lit("V").alias("opp_team_loc"),
            F.substring("o_orderpriority", 1, 1).alias("start_position"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "DND - Injury/Illness")
            .when(F.col("o_orderpriority") == "2-HIGH", "DNP - Coach's Decision")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "DND - League Suspension")
            .when(F.col("o_orderpriority") == "5-LOW", "").alias("comment"),
            F.col("player_id").alias("dim_player_guid"), "seconds", "pts", "ast", "reb", "stl", "blk", "tov",
        )

    @cached_property
    def schedule(self) -> DataFrame:
        return self.games.select(
            "player_id", F.col("id").alias("game_id"), "game_date", "season",
            F.col("home_team_id").alias("team_id"),
            F.concat(F.lit("T"), F.col("home_team_id").cast("string")).alias("team_abbreviation"),
            F.lit("H").alias("team_loc"), F.col("visitor_team_id").alias("opp_team_id"),
            F.concat(F.lit("T"), F.col("visitor_team_id").cast("string")).alias("opp_team_abbreviation"),
            F.lit("V").alias("opp_team_loc"), F.col("id").alias("created_at"),
        )

    @cached_property
    def header(self) -> DataFrame:
        """Landed schedule headers."""
        return self.games.select(
            F.col("id").alias("game_id"), F.col("game_code").alias("gamecode"), "game_date",
            F.col("game_status").alias("game_status_text"), "home_team_id", "visitor_team_id",
            F.col("season").alias("_season"), F.col("season_type").alias("_season_type"),
        )

    @cached_property
    def player_stats(self) -> DataFrame:
        """Landed box-score rows: one per line, so players repeat within a game."""
        name = self.players.select(F.col("id").alias("player_id"), F.col("display_first_last").alias("player_name"))
        return (
            self.table("lineitem").select(F.col("l_orderkey").alias("game_id"))
            .join(self.schedule.select("game_id", "player_id", "team_id", "team_abbreviation", F.col("season").alias("_season")), "game_id")
            .join(name, "player_id")
        )

    @cached_property
    def news(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.when(kind == "error", " ").otherwise(F.col("user_id").cast("string")).alias("playerid"),
            F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("firstname"),
            F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("lastname"),
            (F.unix_seconds(F.col("ts").cast("timestamp")) - NEWS_SHIFT).cast("string").alias("date"),
            F.get_json_object("props", "$.k").cast("int").alias("priority"),
            F.concat(F.lit("E"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("headline"),
            F.when(kind == "purchase", "YES").when(kind == "signup", "NO").alias("injured"),
            kind.alias("injured_status"), F.col("props").alias("injury_detail"),
            F.lit(None).cast("string").alias("injury_location"), F.lit("Left").alias("injury_side"),
            kind.alias("injury_type"), F.col("event_id").cast("string").alias("listitemcaption"),
        )

    @cached_property
    def defending_shots(self) -> DataFrame:
        number = F.col("l_linenumber")
        names = ["Less Than 6 Ft", "Less Than 10 Ft", "Greater Than 15 Ft", "3 Pointers", "2 Pointers", "Overall"]
        category = F.lit("Other")
        for i, label in enumerate(names, start=1):
            category = F.when(number == i, label).otherwise(category)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("game_id"), category.alias("defense_category"),
            (F.col("l_discount") - F.col("l_tax")).alias("pct_plusminus"),
        ).join(
            self.schedule.select("game_id", F.col("player_id").alias("_player_id"), F.col("team_id").alias("_team_id"),
                                 F.col("season").alias("_season")), "game_id",
        )

    @cached_property
    def team_hustle(self) -> DataFrame:
        def having(column: str, value: str):
            return F.count_if(F.col(column) == value)

        return self.games.groupBy(F.col("home_team_id").alias("team_id"), F.col("season").alias("_season")).agg(
            having("game_status", "Final").alias("charges_drawn"), F.count(F.lit(1)).alias("contested_shots"),
            having("game_status", "PPD").alias("contested_shots_2pt"),
            having("game_status", "Scheduled").alias("contested_shots_3pt"),
            having("o_orderpriority", "1-URGENT").alias("deflections"),
            having("o_orderpriority", "2-HIGH").alias("loose_balls_recovered"),
            having("o_orderpriority", "3-MEDIUM").alias("screen_assists"),
        )

    @cached_property
    def team_facts(self) -> DataFrame:
        """Team numbers of the visiting side of each game that has lines: points, pace and plus-minus from
        the order and its lines, every other number by its place in the list from the points."""
        others = [(F.col("o_totalprice") + i).alias(c) for i, c in enumerate(OPPONENT_STATS) if c not in ("pts", "pace", "plus_minus")]
        return self.box.select(
            F.col("id").alias("game_id"), F.col("visitor_team_id").alias("team_id"), F.col("o_totalprice").alias("pts"), *others,
            F.col("seconds").alias("pace"), self.box["pts"].alias("plus_minus"),
        )

    @cached_property
    def team_history(self) -> DataFrame:
        """Stints from the games played: first and last day per player, season and opponent, so a
        player changes teams within a season."""
        return self.games.groupBy("player_id", "season", F.col("visitor_team_id").alias("team_id")).agg(
            F.min("game_date").alias("rec_start_date"), F.max("game_date").alias("rec_end_date")
        )


_SEASON = "cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2)"

SQL = {
    "team": """
        select n_nationkey as id, n_name as team_name, 'T' || n_nationkey as team_abbreviation, r_name as conference
        from nation join region on n_regionkey = r_regionkey""",
    "player": """
        select c_custkey as id, c_name as display_first_last, split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) as last_name, c_mktsegment as pos, c_nationkey as team_id,
               date '1970-01-01' + cast(floor(c_acctbal) as integer) as birthdate,
               case when c_acctbal >= 0 then 'Active' else 'Inactive' end as rosterstatus
        from customer""",
    "game": f"""
        select o_orderkey as id, strftime(o_orderdate, '%Y%m%d') || '/' || o_orderkey as game_code,
               cast(o_orderdate as date) as game_date,
               case o_orderstatus when 'F' then 'Final' when 'P' then 'PPD' else 'Scheduled' end as game_status,
               c_nationkey as home_team_id, cast(cast(floor(o_totalprice) as bigint) % 25 as integer) as visitor_team_id,
               o_custkey as player_id, {_SEASON} as season,
               case when month(o_orderdate) <= 9 then 'Regular Season' else 'Playoffs' end as season_type,
               o_orderpriority, o_totalprice
        from orders join customer on o_custkey = c_custkey""",
    "line": """
        select l_orderkey as game_id, cast(sum(l_quantity) as bigint) as seconds, cast(sum(l_linenumber) as bigint) as pts,
               count(*) filter (l_returnflag = 'A') as ast, count(*) filter (l_returnflag = 'R') as reb,
               count(*) filter (l_returnflag = 'N') as stl, count(*) filter (l_linestatus = 'O') as blk,
               count(*) filter (l_linestatus = 'F') as tov
        from lineitem group by l_orderkey""",
    "fact": """
        select game.id as game_id, player_id, season, season_type, game_date, game_status, home_team_id as team_id,
               visitor_team_id as opp_team_id, 'T' || home_team_id as team_abbreviation, 'H' as team_loc,
               'V' as opp_team_loc, substr(o_orderpriority, 1, 1) as start_position,
               case o_orderpriority when '1-URGENT' then 'DND - Injury/Illness' when '2-HIGH' then 'DNP - Coach''s Decision'
                    when '3-MEDIUM' then 'DND - League Suspension' when '5-LOW' then '' end as comment,
               seconds, pts, ast, reb, stl, blk, tov
        from game join line on game.id = line.game_id""",
    "sched": """
        select player_id, id as game_id, game_date, season, home_team_id as team_id,
               'T' || home_team_id as team_abbreviation, 'H' as team_loc, visitor_team_id as opp_team_id,
               'T' || visitor_team_id as opp_team_abbreviation, 'V' as opp_team_loc, id as created_at
        from game""",
    "stat": """
        select l_orderkey as game_id, player_id, c_name as player_name, team_id, team_abbreviation, season
        from lineitem join sched on l_orderkey = game_id join customer on c_custkey = player_id""",
    "item": f"""
        select case when event_type = 'error' then ' ' else cast(user_id as varchar) end as playerid,
               cast(floor(epoch(ts)) as bigint) - {NEWS_SHIFT} as secs,
               timestamp '1970-01-01' + to_seconds(cast(floor(epoch(ts)) as bigint) - {NEWS_SHIFT}) as tm,
               cast(timestamp '1970-01-01' + to_seconds(cast(floor(epoch(ts)) as bigint) - {NEWS_SHIFT}) as date) as dt,
               cast(props ->> '$.k' as integer) as priority,
               'E' || lpad(cast(event_id as varchar), 12, '0') as headline,
               case event_type when 'purchase' then 'YES' when 'signup' then 'NO' end as injured,
               event_type as injured_status, props as injury_detail, null as injury_location, 'Left' as injury_side,
               event_type as injury_type, cast(event_id as varchar) as caption,
               case when event_type = 'error' then -2 else cast(user_id as integer) end as player_id
        from events""",
    "shot": """
        select l_orderkey as game_id, player_id, team_id, season,
               case l_linenumber when 1 then 'Less Than 6 Ft' when 2 then 'Less Than 10 Ft' when 3 then 'Greater Than 15 Ft'
                    when 4 then '3 Pointers' when 5 then '2 Pointers' when 6 then 'Overall' else 'Other' end as category,
               cast(round(l_discount * 100) as bigint) - cast(round(l_tax * 100) as bigint) as cents
        from lineitem join sched on l_orderkey = game_id""",
    "hist": """
        select player_id, season, visitor_team_id as team_id, min(game_date) as rec_start_date, max(game_date) as rec_end_date
        from game group by player_id, season, visitor_team_id""",
}

_NEEDS = {
    "fact": ("game", "line"), "sched": ("game",), "stat": ("game", "sched"), "shot": ("game", "sched"), "hist": ("game",),
}


def with_tables(names: str, body: str) -> str:
    """``body`` preceded by the named tables (space separated) and what they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in order) + (
        ",\n" + body.strip()[len("with "):] if body.strip().startswith("with ") else "\n" + body.strip()
    )
