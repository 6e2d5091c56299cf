"""Scalar functions and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.functions import scalars as fn
from courtside.functions.ordering import earliest_first
from courtside.operators.windows import latest_by
from courtside.plans import marts
from courtside.plans.control import EXHIBITION_TEAMS
from courtside.queries.league import League, with_tables
from courtside.queries.registry import query


@query(
    "order_labels",
    """select o_orderkey, strftime(o_orderdate, '%Y%m%d') as date_key, upper(strftime(o_orderdate, '%b')) as mnth,
         lower(strftime(o_orderdate, '%a')) as dow, cast(cast(o_orderdate as date) - date '1995-01-01' as integer) as age,
         cast(split_part(cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2), '-', 1) as integer) as first_year,
         cast(o_orderdate as date) as landed, substr(strftime(o_orderdate, '%Y%m%d') || '/' || o_orderkey, 1, 8) as schedule_key,
         split_part(o_orderpriority, '-', 2) as label, split_part(o_orderpriority, '-', 3) as past_end,
         strftime(o_orderdate + interval 13 hour, '%Y-%m-%d') || ' 01:00:00' as clock
       from orders""",
)
def order_labels(lg: League):
    day = F.col("o_orderdate").cast("date")
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return lg.table("orders").select(
        "o_orderkey", fn.date_key(day).alias("date_key"), fn.month_label(day).alias("mnth"), fn.weekday_label(day).alias("dow"),
        fn.age_days(day, F.to_date(F.lit("1995-01-01"))).alias("age"), fn.first_year(fn.season_text(day)).alias("first_year"),
        fn.landed_date(text).alias("landed"),
        fn.schedule_key(F.concat(fn.date_key(day), F.lit("/"), F.col("o_orderkey").cast("string"))).alias("schedule_key"),
        fn.part("o_orderpriority", "-", 2).alias("label"), fn.part("o_orderpriority", "-", 3).alias("past_end"),
        fn.clock_text(F.col("o_orderdate") + F.expr("interval 13 hours")).alias("clock"),
    )


@query(
    "height_text",
    """select p_partkey, case when p_size > 40 then null else p_size end as height, case when p_size <= 10 then null else p_size end as weight from part""",
)
def height_text(lg: League):
    """Sizes written as feet-inches text (blank when large) and read back."""
    inches = F.col("p_size")
    text = F.when(inches > 40, "").otherwise(
        F.concat(F.floor(inches / 12).cast("string"), F.lit("-"), (inches % 12).cast("string"))
    )
    weight = F.when(inches > 10, inches.cast("string")).otherwise("")
    return lg.table("part").select("p_partkey", fn.height_inches(text).alias("height"), fn.text_to_int(weight).alias("weight"))


@query(
    "version_keys",
    """select o_orderkey, cast('0x' || substr(md5(o_custkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || ' 12:00:00'), 1, 15) as bigint) as guid,
         case when o_orderstatus <> 'P' then o_orderstatus || '|' || o_custkey || '|x' end as crc_str from orders""",
)
def version_keys(lg: League):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return lg.table("orders").select(
        "o_orderkey", fn.text_key(fn.version_text(["o_custkey"], fn.clock_text("o_orderdate"))).alias("guid"),
        fn.version_text([status, "o_custkey"], F.lit("x")).alias("crc_str"),
    )


@query(
    "news_instants",
    with_tables("item", "select headline, tm, dt, player_id, injured is null as silent from item"),
)
def news_instants(lg: League):
    return lg.news.select(
        "headline", fn.epoch_instant("date").alias("tm"), fn.epoch_day("date").alias("dt"),
        fn.player_or_sentinel("playerid").alias("player_id"), F.col("injured").isNull().alias("silent"),
    )


@query(
    "flag_texts",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_returnflag = 'A' as is_flag, case when l_linestatus = 'O' then 'Y' else 'N' end as yes_no,
         case when l_linestatus = 'O' then null else cast(l_shipdate as date) end as open_end, case when l_tax <> 0 then l_tax end as tax
       from lineitem""",
)
def flag_texts(lg: League):
    is_open = F.col("l_linestatus") == "O"
    yes = F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "R", "N")
    return lg.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        fn.yes_flag(yes).alias("is_flag"), fn.yes_no(is_open).alias("yes_no"),
        fn.open_end(is_open, F.col("l_shipdate").cast("date")).alias("open_end"), fn.zero_to_null("l_tax").alias("tax"),
    )


@query(
    "injury_flags",
    with_tables(
        "game line fact item",
        """with i as (select * from item
          qualify row_number() over (partition by player_id, dt order by priority, headline) = 1)
        select f.game_id, i.headline, case when i.injured is not null then i.injured
             when upper(comment) like '%DECISION%' or upper(comment) like '%DRESS%' or upper(comment) like '%SUSPEN%'
               or upper(comment) like '%PERSONAL%' or upper(comment) like '%SERVING%' then 'NO'
             when comment like '%DND%' then 'YES' else 'NO' end as injured
        from fact f left join i on i.player_id = f.player_id and i.dt = f.game_date""",
    ),
)
def injury_flags(lg: League):
    """Flag of every played game, from the first news item of the player's day or the comment."""
    items = latest_by(marts.news_of_the_day(lg.news), ["player_id", "dt"], earliest_first("priority", "headline")).select(
        "player_id", F.col("dt").alias("game_date"), "headline", F.col("injured").alias("said")
    )
    return lg.facts.join(items, ["player_id", "game_date"], "left").select(
        "game_id", "headline", fn.injury_flag("said", "comment").alias("injured")
    )


@query(
    "text_marks",
    """select doc_id, upper(text) like '%PERSONAL%' or upper(text) like '%THE%' as shouted, text like '%The%' as cased,
         text not like '%ing%' and text not like '%ion%' as plain, trim(source) <> '' as has_source from documents""",
)
def text_marks(lg: League):
    """LIKE predicates over whole document texts."""
    shouted = F.upper("text")
    return lg.table("documents").select(
        "doc_id", (shouted.contains("PERSONAL") | shouted.contains("THE")).alias("shouted"), F.col("text").contains("The").alias("cased"),
        (~F.col("text").contains("ing") & ~F.col("text").contains("ion")).alias("plain"), fn.not_blank("source").alias("has_source"),
    )


@query(
    "null_logic",
    """with b as (select o_orderkey, nullif(o_orderstatus, 'P') as a, nullif(o_orderpriority, '5-LOW') as b, nullif(c_mktsegment, 'BUILDING') as c
         from orders join customer on c_custkey = o_custkey)
       select o_orderkey, coalesce(a <> 'F', false) as changed from b where b not like '%HIGH%' and c not in ('EST', 'WST') and trim(c) <> ''""",
)
def null_logic(lg: League):
    """NULL is no change, and drops out of NOT LIKE, NOT IN and the not-blank test."""
    segment = lg.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c"))
    rows = lg.table("orders").join(segment, "o_custkey").withColumns(
        {"a": F.nullif("o_orderstatus", F.lit("P")), "b": F.nullif("o_orderpriority", F.lit("5-LOW"))}
    )
    kept = rows.where(~F.col("b").contains("HIGH")).where(~F.col("c").isin(*EXHIBITION_TEAMS)).where(fn.not_blank("c"))
    return kept.select("o_orderkey", fn.differs([F.col("a")], [F.lit("F")]).alias("changed"))


@query(
    "fantasy_points",
    with_tables(
        "game line fact",
        "select game_id, round(ast * 1.5::double + reb * 1.2::double + pts + stl * 2::double + blk * 2::double - tov, 6) as points from fact",
    ),
)
def fantasy_points(lg: League):
    return lg.facts.select("game_id", F.round(fn.fantasy_points(), 6).alias("points"))


@query(
    "names_and_teams",
    """select l_orderkey, c.n_name as own_team, s.n_name as opp_team, cast(count(*) as bigint) as lines
       from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join nation c on c.n_nationkey = c_nationkey
       join supplier on s_suppkey = l_suppkey join nation s on s.n_nationkey = s_nationkey group by all""",
)
def names_and_teams(lg: League):
    """The team dimension in two roles: the customer's own and the supplier's as opponent."""
    own = lg.teams.select(F.col("id").alias("home_team_id"), F.col("team_name").alias("own_team"))
    rival = lg.teams.select(F.col("id").alias("s_nationkey"), F.col("team_name").alias("opp_team"))
    supplier = lg.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    # lines collapse per game and supplier before they meet the dimensions
    lines = lg.table("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    home = lg.games.select(F.col("id").alias("l_orderkey"), "home_team_id")
    return (
        lines.join(supplier, "l_suppkey").join(rival, "s_nationkey").join(home, "l_orderkey").join(own, "home_team_id")
        .groupBy("l_orderkey", "own_team", "opp_team").agg(F.sum("n").alias("lines"))
    )
