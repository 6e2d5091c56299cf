"""Rolling windows, latest rows, shares, lags, injury benefit."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.functions import scalars as fn
from courtside.functions.ordering import earliest_first, latest_first
from courtside.operators.windows import (
    by_month, global_previous, in_ranges, latest_by, numbered, previous, ranked, rolling, with_group_stats,
)
from courtside.plans import marts
from courtside.queries.league import League, with_tables
from courtside.queries.registry import query
from courtside.session import settle

TIME_SQL = """
with shown as (
  select s.*, p.pos, p.display_first_last, f.seconds, f.start_position, f.comment
  from sched s join player p on s.player_id = p.id left join fact f on s.game_id = f.game_id
), day_total as (
  select season, team_id, team_abbreviation, pos, game_date, coalesce(sum(seconds), 0) as pos_time
  from shown where trim(pos) <> '' group by all
), base as (
  select *,
    sum(pos_time) over (w rows between 5 preceding and 1 preceding) as pos_time_5,
    sum(pos_time) over (w rows between 10 preceding and 1 preceding) as pos_time_10
  from day_total window w as (partition by season, team_id, pos order by game_date, team_abbreviation)
), own as (
  select *,
    sum(seconds) over (w rows between 5 preceding and 1 preceding) as t5,
    sum(seconds) over (w rows between 10 preceding and 1 preceding) as t10,
    avg(seconds) over (w rows between 5 preceding and 1 preceding) as a5,
    avg(seconds) over (w rows between 10 preceding and 1 preceding) as a10,
    row_number() over (partition by player_id, game_date order by created_at desc, game_id) as rn
  from shown window w as (partition by season, team_id, pos, player_id order by game_date, created_at, game_id)
), newest as (
  select * from item
  qualify row_number() over (partition by playerid order by tm desc, priority, headline) = 1
), ptime as (
  select o.player_id, o.display_first_last, o.pos, o.game_date, o.team_abbreviation, o.opp_team_abbreviation,
    o.opp_team_id, o.season, o.start_position, o.seconds as player_time,
    cast(t5 as bigint) as player_time_last_5_games, cast(t10 as bigint) as player_time_last_10_games,
    a5 as avg_player_time_last_5_games, a10 as avg_player_time_last_10_games,
    cast(b.pos_time as bigint) as pos_time, cast(pos_time_5 as bigint) as pos_time_last_5_games,
    cast(pos_time_10 as bigint) as pos_time_last_10_games,
    case when coalesce(pos_time_5, 0) = 0 then 0 else cast(t5 as double) / cast(pos_time_5 as double) end as pct_player_time_5_games,
    case when coalesce(pos_time_10, 0) = 0 then 0 else cast(t10 as double) / cast(pos_time_10 as double) end as pct_player_time_10_games,
    o.comment,
    case when n.injured is not null then n.injured
         when upper(o.comment) like '%DECISION%' or upper(o.comment) like '%DRESS%' or upper(o.comment) like '%SUSPEN%'
           or upper(o.comment) like '%PERSONAL%' or upper(o.comment) like '%SERVING%' then 'NO'
         when o.comment like '%DND%' then 'YES' else 'NO' end as injured,
    n.injured_status, n.injury_detail, n.injury_location, n.injury_side, n.injury_type, n.caption
  from own o
  left join newest n on n.player_id = o.player_id
  left join base b on b.season = o.season and b.team_id = o.team_id and b.game_date = o.game_date and b.pos = o.pos
  where o.rn = 1
)
"""


def _player_time(lg: League):
    return marts.player_time(lg.schedule, lg.facts, lg.players, lg.news)


@query("player_rolling_time", with_tables("game line fact sched player item", TIME_SQL + "select * from ptime"))
def player_rolling_time(lg: League):
    return _player_time(lg)


@query(
    "injury_benefit",
    with_tables(
        "game line fact sched player item",
        TIME_SQL + """, factor(hurt, pos, factor) as (values
          ('AUTOMOBILE', 'AUTOMOBILE', 0.75), ('AUTOMOBILE', 'BUILDING', 0.25), ('BUILDING', 'BUILDING', 0.75),
          ('BUILDING', 'AUTOMOBILE', 0.15), ('BUILDING', 'FURNITURE', 0.10), ('FURNITURE', 'FURNITURE', 0.75),
          ('FURNITURE', 'HOUSEHOLD', 0.10), ('FURNITURE', 'MACHINERY', 0.10), ('FURNITURE', 'BUILDING', 0.05),
          ('MACHINERY', 'MACHINERY', 0.65), ('MACHINERY', 'HOUSEHOLD', 0.25), ('MACHINERY', 'FURNITURE', 0.10))
        select well.season, well.team_abbreviation, well.player_id, well.game_date, well.pos,
          floor(nullif(sum(hurt.avg_player_time_last_5_games * f.factor::double) * well.pct_player_time_5_games, 0) * 1e6::double
            + 0.5::double) / 1e6::double as benefit_seconds
        from ptime well
        left join ptime hurt on hurt.season = well.season and hurt.team_abbreviation = well.team_abbreviation
          and hurt.game_date = well.game_date and hurt.injured = 'YES' and hurt.player_id <> well.player_id
        left join factor f on f.hurt = hurt.pos and f.pos = well.pos
        where well.injured = 'NO'
        group by well.season, well.team_abbreviation, well.player_id, well.game_date, well.pos, well.pct_player_time_5_games""",
    ),
)
def injury_benefit(lg: League):
    names = {"C": "AUTOMOBILE", "PF": "BUILDING", "SF": "FURNITURE", "SG": "HOUSEHOLD", "PG": "MACHINERY"}
    factors = [(names[a], names[b], f) for a, b, f in marts.POSITION_FACTORS]
    # both sides read the playing-time table
    # half up to six places, in the same steps as the SQL
    return marts.injury_benefit(settle(_player_time(lg), "player-time"), factors).withColumn(
        "benefit_seconds", F.floor(F.col("benefit_seconds") * 1e6 + 0.5) / 1e6
    )


@query(
    "injury_time",
    with_tables(
        "game line fact sched player item",
        TIME_SQL + """, factor(hurt, pos, factor) as (values
          ('AUTOMOBILE', 'AUTOMOBILE', 0.75), ('AUTOMOBILE', 'BUILDING', 0.25), ('BUILDING', 'BUILDING', 0.75),
          ('BUILDING', 'AUTOMOBILE', 0.15), ('BUILDING', 'FURNITURE', 0.10), ('FURNITURE', 'FURNITURE', 0.75),
          ('FURNITURE', 'HOUSEHOLD', 0.10), ('FURNITURE', 'MACHINERY', 0.10), ('FURNITURE', 'BUILDING', 0.05),
          ('MACHINERY', 'MACHINERY', 0.65), ('MACHINERY', 'HOUSEHOLD', 0.25), ('MACHINERY', 'FURNITURE', 0.10))
        select well.season, well.team_abbreviation, well.player_id, well.game_date, well.pos,
          floor(nullif(sum(hurt.avg_player_time_last_5_games * f.factor::double) * well.pct_player_time_5_games, 0) * 1e6::double
            + 0.5::double) / 1e6::double as benefit_seconds
        from ptime well
        left join ptime hurt on hurt.season = well.season and hurt.team_abbreviation = well.team_abbreviation
          and hurt.game_date = well.game_date and hurt.injured = 'YES' and hurt.player_id <> well.player_id
        left join factor f on f.hurt = hurt.pos and f.pos = well.pos
        where well.injured = 'NO' and well.player_id = (select min(player_id) from ptime) and well.season = (select max(season) from ptime
            where player_id = (select min(player_id) from ptime)) and well.game_date = (select max(game_date) from ptime
            where player_id = (select min(player_id) from ptime))
        group by well.season, well.team_abbreviation, well.player_id, well.game_date, well.pos, well.pct_player_time_5_games""",
    ),
)
def injury_time(lg: League):
    """The benefit of one player on the last of their days."""
    names = {"C": "AUTOMOBILE", "PF": "BUILDING", "SF": "FURNITURE", "SG": "HOUSEHOLD", "PG": "MACHINERY"}
    factors = [(names[a], names[b], f) for a, b, f in marts.POSITION_FACTORS]
    times = settle(_player_time(lg), "player-time")
    last = times.groupBy("player_id").agg(F.max_by(F.struct("season", "team_abbreviation", "game_date"), "game_date").alias("day"))
    who = last.orderBy("player_id").first()
    return marts.injury_time(times, who.day.season, who.day.team_abbreviation, who.player_id, who.day.game_date, factors).withColumn(
        "benefit_seconds", F.floor(F.col("benefit_seconds") * 1e6 + 0.5) / 1e6
    )


@query(
    "position_rolling_time",
    with_tables(
        "game line fact sched player item",
        TIME_SQL + """select season, team_id, team_abbreviation, pos, game_date, cast(pos_time as bigint) as pos_time_per_game,
          cast(pos_time_5 as bigint) as pos_time_last_5_games, cast(pos_time_10 as bigint) as pos_time_last_10_games from base""",
    ),
)
def position_rolling_time(lg: League):
    person = lg.players.select(F.col("id").alias("player_id"), "pos")
    line = lg.facts.select("game_id", "seconds")
    return marts.position_time(lg.schedule.join(person, "player_id").join(line, "game_id", "left"))


@query(
    "rolling_share",
    """with daily as (
         select cast(year(o_orderdate) as integer) as season, c_nationkey as team, c_mktsegment as pos, o_custkey, o_orderkey,
                cast(o_orderdate as date) as d, cast(round(o_totalprice * 100) as bigint) as cents
         from orders join customer on o_custkey = c_custkey),
       team_day as (select season, team, pos, d, sum(cents) as cents from daily group by all),
       base as (select *, sum(cents) over (partition by season, team, pos order by d rows between 5 preceding and 1 preceding) as b5
                from team_day),
       own as (select *, sum(cents) over (partition by season, team, pos, o_custkey order by d, o_orderkey
                                          rows between 5 preceding and 1 preceding) as p5 from daily)
       select own.o_orderkey, own.season, own.team, own.pos, cast(p5 as bigint) as own_last_5, cast(b5 as bigint) as base_last_5,
              case when coalesce(b5, 0) = 0 then 0 else cast(p5 as double) / cast(b5 as double) end as share_last_5
       from own join base using (season, team, pos, d)""",
)
def rolling_share(lg: League):
    """Spending of a customer over the five orders before, as a share of the segment's five days before."""
    customer = lg.table("customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("team"), F.col("c_mktsegment").alias("pos")
    )
    daily = lg.table("orders").join(customer, "o_custkey").select(
        F.year("o_orderdate").alias("season"), "team", "pos", "o_custkey", "o_orderkey",
        F.col("o_orderdate").cast("date").alias("d"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    group = ["season", "team", "pos"]
    team_day = daily.groupBy(*group, "d").agg(F.sum("cents").alias("cents"))
    base = rolling(team_day, group, ["d"], {"base_last_5": ("sum", "cents", 5)}).drop("cents")
    own = rolling(
        daily, [*group, "o_custkey"], ["d", "o_orderkey"], {"own_last_5": ("sum", "cents", 5)}, by_month("d")
    )
    return own.join(base, [*group, "d"]).select(
        "o_orderkey", *group, "own_last_5", "base_last_5",
        fn.guarded_share(F.col("own_last_5"), F.col("base_last_5")).alias("share_last_5"),
    )


@query(
    "rolling_mean",
    """select event_id, avg(v) over (w rows between 5 preceding and 1 preceding) as mean_5,
              avg(v) over (w rows between 10 preceding and 1 preceding) as mean_10
       from (select *, cast(round(value * 100) as bigint) as v from events)
       window w as (partition by user_id order by ts, event_id)""",
)
def rolling_mean(lg: League):
    cents = lg.table("events").select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("v")
    )
    frames = {"mean_5": ("avg", "v", 5), "mean_10": ("avg", "v", 10)}
    return rolling(cents, ["user_id"], ["ts", "event_id"], frames, by_month("ts")).select("event_id", *frames)


@query(
    "latest_event",
    """select user_id, event_id, ts, event_type from events
       qualify row_number() over (partition by user_id order by ts desc nulls first, event_id) = 1""",
)
def latest_event(lg: League):
    order = [*latest_first("ts"), *earliest_first("event_id")]
    return latest_by(lg.table("events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], order)


@query(
    "first_event_of_day",
    """select user_id, cast(ts as date) as d, event_id, event_type from events
       qualify row_number() over (partition by user_id, cast(ts as date) order by event_type, ts, event_id) = 1""",
)
def first_event_of_day(lg: League):
    events = lg.table("events").withColumn("d", F.col("ts").cast("date"))
    return latest_by(events, ["user_id", "d"], earliest_first("event_type", "ts", "event_id")).select(
        "user_id", "d", "event_id", "event_type"
    )


@query(
    "latest_news",
    with_tables("item", """select playerid, player_id, tm, dt, priority, headline, injured, injured_status from item
       qualify row_number() over (partition by playerid order by tm desc nulls first, priority nulls last, headline) = 1"""),
)
def latest_news(lg: League):
    return marts.latest_news(lg.news).select(
        "playerid", "player_id", "tm", "dt", "priority", "headline", "injured", "injured_status"
    )


@query(
    "news_of_the_day",
    with_tables("item", """select playerid, player_id, dt, priority, headline, injured from item
       qualify row_number() over (partition by playerid, dt order by priority nulls last, headline) = 1"""),
)
def news_of_the_day(lg: League):
    return marts.news_of_the_day(lg.news).select("playerid", "player_id", "dt", "priority", "headline", "injured")


@query(
    "season_mean",
    """select o_orderkey, cast(year(o_orderdate) as integer) as season,
         cast(sum(cast(round(o_totalprice * 100) as bigint)) over w as double) / count(*) over w as season_mean
       from orders window w as (partition by o_custkey, year(o_orderdate))""",
)
def season_mean(lg: League):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = lg.table("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), cents.alias("v"))
    return with_group_stats(
        orders, ["o_custkey", "season"], season_mean=F.sum("v").cast("double") / F.count("v")
    ).select("o_orderkey", "season", "season_mean")


@query(
    "newest_flag",
    """select o_orderkey, o_custkey, cast(o_orderdate as date) as d,
         case when o_orderdate = max(o_orderdate) over (partition by o_custkey) then true else false end as is_newest,
         case when o_orderdate = max(o_orderdate) over (partition by o_custkey) then null else cast(o_orderdate as date) end as closed_on
       from orders""",
)
def newest_flag(lg: League):
    orders = lg.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    marked = with_group_stats(orders, ["o_custkey"], last=F.max("d"))
    newest = F.col("d") == F.col("last")
    return marked.select("o_orderkey", "o_custkey", "d", newest.alias("is_newest"), F.when(~newest, F.col("d")).alias("closed_on"))


@query(
    "stints_per_player",
    with_tables("hist", "select *, cast(count(*) over (partition by player_id) as bigint) as stints from hist"),
)
def stints_per_player(lg: League):
    return with_group_stats(lg.team_history, ["player_id"], stints=F.count(F.lit(1)))


@query(
    "days_since_previous",
    """select o_orderkey, cast(o_orderdate as date) as d,
         cast(date_diff('day', lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), o_orderdate) as integer) as days_rest
       from orders""",
)
def days_since_previous(lg: League):
    orders = lg.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    return previous(orders, ["o_custkey"], ["d", "o_orderkey"], "d", "before", by_month("d")).select(
        "o_orderkey", "d", fn.days_rest("d", "before").alias("days_rest")
    )


@query(
    "global_previous",
    """select event_id, lag(ts) over (order by event_type, user_id, ts, event_id) as previous_ts from events""",
)
def previous_in_global_order(lg: League):
    events = lg.table("events").select("event_type", in_ranges("user_id", 32).alias("users"), "user_id", "ts", "event_id")
    levels = [["event_type"], ["event_type", "users"], ["event_type", "users", "user_id"]]
    return global_previous(
        events, levels, ["ts", "event_id"], "ts", "previous_ts", by_month("ts")
    ).select("event_id", "previous_ts")


@query(
    "game_number",
    """select o_orderkey, cast(row_number() over (partition by c_nationkey order by o_orderdate, o_orderkey) as bigint) as game_number
       from orders join customer on o_custkey = c_custkey""",
)
def game_number(lg: League):
    return numbered(
        lg.games.select("home_team_id", "game_date", "id"), ["home_team_id"], ["game_date", "id"], "game_number",
        by_month("game_date"),
    ).select(F.col("id").alias("o_orderkey"), F.col("game_number").cast("bigint").alias("game_number"))


@query(
    "season_rank",
    """with t as (select cast(year(o_orderdate) as integer) as season, o_custkey, sum(cast(round(o_totalprice * 100) as bigint)) as cents
                  from orders group by all)
       select season, o_custkey, cast(cents as bigint) as cents,
              cast(rank() over (partition by season order by cents desc) as bigint) as cents_rank from t""",
)
def season_rank(lg: League):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    spent = lg.table("orders").groupBy(F.year("o_orderdate").alias("season"), "o_custkey").agg(F.sum(cents).alias("cents"))
    return ranked(spent, ["season"], "cents", "cents_rank", F.floor(F.col("cents") / 1_000_000))
