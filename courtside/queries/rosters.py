"""Player dimension, team history, stints, schedules, defence and feature tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from courtside.functions import scalars as fn
from courtside.operators.scd2 import duplicate_keys, scd2
from courtside.operators.windows import by_month, previous
from courtside.plans import control, marts
from courtside.queries.league import League, with_tables
from courtside.queries.registry import query
from courtside.queries.timing import TIME_SQL
from courtside.session import settle
from courtside.sources.landing import conform, null_violations
from courtside.sources.schemas import HUSTLE_STATS, OPPONENT_STATS, compared_columns, dim_player

# Days the landed player rows are looked at: an old version, the current one, the refresh.
FIRST, BEFORE, AFTER = dt.date(1995, 12, 31), dt.date(1996, 6, 30), dt.date(1996, 12, 31)
AFTERNOON = " 13:05:00"


def landed_players(lg: League, until: dt.date) -> DataFrame:
    """Player rows as landed on a day: attributes as text, taken from the customer's orders so far."""
    # compared as a timestamp, the bound reaches the scan
    night = F.lit(dt.datetime.combine(until + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz")
    orders = lg.table("orders").where(F.col("o_orderdate") < night)
    newest = F.struct("o_orderdate", "o_orderkey")
    career = orders.groupBy(F.col("o_custkey").cast("int").alias("person_id")).agg(
        F.count(F.lit(1)).cast("int").alias("season_exp"),
        F.min(F.year("o_orderdate")).alias("from_year"), F.max(F.year("o_orderdate")).alias("to_year"),
        F.max_by(F.struct("o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"), newest).alias("last"),
    ).select("*", "last.*").drop("last")
    person = lg.players.select(
        F.col("id").cast("int").alias("person_id"), "first_name", "last_name", "display_first_last",
        F.concat("last_name", F.lit(", "), "first_name").alias("display_last_comma_first"),
        F.lit(None).cast("string").alias("display_fi_last"),
        F.concat(F.date_format("birthdate", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("birthdate"),
        F.lit("-").alias("school"), F.lit("-").alias("country"), F.lit("-").alias("last_affiliation"),
        F.col("pos").alias("position"), "rosterstatus", F.lower("display_first_last").alias("playercode"),
        F.col("team_id").alias("_team_id"),
    )
    low = F.col("o_orderpriority") == "5-LOW"
    return (
        career.join(person, "person_id")
        .select(
            *person.columns, "season_exp", "from_year", "to_year",
            F.when(F.col("o_orderstatus") == "P", "").otherwise(
                F.concat((4 + F.floor(F.col("o_totalprice") / 200000)).cast("string"), F.lit("-"), F.month("o_orderdate").cast("string"))
            ).alias("height"),
            F.floor(F.col("o_totalprice") / 50000).cast("string").alias("weight"),
            F.when(low, "").otherwise(F.substring("o_orderpriority", 1, 1)).alias("jersey"),
            F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N").alias("dleague_flag"),
            F.lit("Y").alias("games_played_flag"), F.lit(None).cast("string").alias("draft_year"),
            F.lit("").alias("draft_round"), F.lit("").alias("draft_number"),
            fn.season_text("o_orderdate").alias("_season"),
        )
    )


def _landed_sql(until: dt.date, name: str) -> str:
    """The same rows already typed, as a common table expression."""
    day = f"date '{until}'"
    return f"""{name} as (
      select cast(c_custkey as integer) as id, c_name as display_first_last, c_mktsegment as nba_pos,
        case when c_acctbal >= 0 then 'Active' else 'Inactive' end as rosterstatus,
        date '1970-01-01' + cast(floor(c_acctbal) as integer) as birthdate,
        cast(n as integer) as season_exp, cast(lo as integer) as from_year, cast(hi as integer) as to_year,
        case when o_orderstatus <> 'P' then cast((4 + floor(o_totalprice / 200000)) * 12 + month(o_orderdate) as integer) end as height,
        cast(floor(o_totalprice / 50000) as integer) as weight,
        case when o_orderpriority <> '5-LOW' then cast(substr(o_orderpriority, 1, 1) as integer) end as jersey,
        o_orderstatus = 'F' as is_dleague,
        cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2) as season,
        c_nationkey as team_id, n_name as team_name,
        substr(md5(c_custkey || '|{until} 01:05:00'), 1, 15) as hex, c_custkey || '|{until} 01:05:00' as crc_str
      from (select *, count(*) over (partition by o_custkey) as n, min(year(o_orderdate)) over (partition by o_custkey) as lo,
                   max(year(o_orderdate)) over (partition by o_custkey) as hi,
                   row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
            from orders where cast(o_orderdate as date) <= {day}) o
      join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
      where rn = 1)"""


def _at(day: dt.date):
    return F.lit(f"{day}{AFTERNOON}").cast("timestamp")


def _versions(lg: League, day: dt.date) -> DataFrame:
    return marts.player_versions(landed_players(lg, day), lg.landed_teams, _at(day))


def _dimension(lg: League) -> DataFrame:
    """Closed versions of the first day, and versions of the second day that are open for active players only."""
    closed = _versions(lg, FIRST).withColumns(
        {"rec_start_date": F.lit(FIRST), "rec_end_date": F.lit(BEFORE), "is_rec_active": F.lit(False),
         "created_at": _at(FIRST), "updated_at": _at(BEFORE)}
    )
    current = _versions(lg, BEFORE).withColumns(
        {"rec_start_date": F.lit(BEFORE), "rec_end_date": F.lit(BEFORE),
         "is_rec_active": F.col("rosterstatus") == "Active", "created_at": _at(BEFORE), "updated_at": F.lit(None).cast("timestamp")}
    )
    return settle(conform(closed, dim_player()).unionByName(conform(current, dim_player())), "dim-player")


def _source(lg: League) -> DataFrame:
    return settle(_versions(lg, AFTER), "player-versions")


SHOWN = (
    "dim_player_guid", "crc_str", "id", "display_first_last", "nba_pos", "rosterstatus", "birthdate", "season_exp", "from_year",
    "to_year", "height", "weight", "jersey", "is_dleague", "season", "team_id", "team_name",
)

_SHOWN_SQL = """cast('0x' || {a}.hex as bigint) as dim_player_guid, {a}.crc_str, {a}.id, {a}.display_first_last, {a}.nba_pos,
  {a}.rosterstatus, {a}.birthdate, {a}.season_exp, {a}.from_year, {a}.to_year, {a}.height, {a}.weight, {a}.jersey,
  {a}.is_dleague, {a}.season, {a}.team_id, {a}.team_name"""

_COMPARED_SQL = " or ".join(
    f"d.{c} <> s.{c}"
    for c in "display_first_last nba_pos rosterstatus birthdate season_exp from_year to_year height weight jersey is_dleague season team_id team_name".split()
)

DIM_SQL = f"""with {_landed_sql(FIRST, 'v0')}, {_landed_sql(BEFORE, 'v1')}, {_landed_sql(AFTER, 's')},
dim as (
  select *, date '{FIRST}' as rec_start_date, date '{BEFORE}' as rec_end_date, false as is_rec_active, date '{BEFORE}' as updated_on from v0
  union all
  select *, date '{BEFORE}', date '{BEFORE}', rosterstatus = 'Active', null from v1
), closing as (
  select d.id, d.crc_str from dim d where is_rec_active and exists (select 1 from s where s.id = d.id and ({_COMPARED_SQL}))
), fresh as (
  select * from s where not exists (select 1 from dim where dim.id = s.id)
  union
  select * from s where exists (select 1 from closing where closing.id = s.id)
)"""


def _dim_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *SHOWN, "rec_start_date", "rec_end_date", "is_rec_active", F.col("updated_at").cast("date").alias("updated_on")
    )


@query(
    "player_dimension_refresh",
    f"""{DIM_SQL}
    select {_SHOWN_SQL.format(a='d')}, d.rec_start_date,
      case when c.id is null then d.rec_end_date else date '{AFTER}' end as rec_end_date,
      d.is_rec_active and c.id is null as is_rec_active,
      case when c.id is null then d.updated_on else date '{AFTER}' end as updated_on
    from dim d left join closing c on c.id = d.id and c.crc_str = d.crc_str
    union all
    select {_SHOWN_SQL.format(a='f')}, date '{AFTER}', date '{AFTER}', true, null from fresh f""",
)
def player_dimension_refresh(lg: League):
    after, _ = scd2(_dimension(lg), _source(lg), "id", compared_columns(), _at(AFTER))
    return _dim_columns(after)


@query(
    "player_dimension_inserts",
    f"""{DIM_SQL} select {_SHOWN_SQL.format(a='f')}, date '{AFTER}' as rec_start_date, date '{AFTER}' as rec_end_date,
        true as is_rec_active, cast(null as date) as updated_on from fresh f""",
)
def player_dimension_inserts(lg: League):
    _, inserted = scd2(_dimension(lg), _source(lg), "id", compared_columns(), _at(AFTER))
    return _dim_columns(inserted)


@query(
    "player_dimension_closed",
    f"{DIM_SQL} select d.id, d.crc_str, d.season from dim d where exists (select 1 from closing c where c.id = d.id and c.crc_str = d.crc_str)",
)
def player_dimension_closed(lg: League):
    after, _ = scd2(_dimension(lg), _source(lg), "id", compared_columns(), _at(AFTER))
    return after.where((F.col("updated_at") == _at(AFTER)) & ~F.col("is_rec_active")).select("id", "crc_str", "season")


@query("dimension_null_check", "select count(*) filter (o_orderkey is null) as dim_player_guid, count(*) filter (o_orderdate is null) as rec_start_date, count(*) filter (o_orderstatus is null) as is_rec_active, count(*) filter (o_orderdate is null) as created_at from orders")
def dimension_null_check(lg: League):
    """NOT NULL columns of the declared dimension, over versions derived from every order."""
    versions = lg.table("orders").select(
        F.col("o_orderkey").alias("dim_player_guid"), F.col("o_orderdate").cast("date").alias("rec_start_date"),
        (F.col("o_orderstatus") == "F").alias("is_rec_active"), F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    return null_violations(conform(versions, dim_player()), dim_player())


@query("repeated_line_keys", "select l_orderkey, l_linenumber, count(*) as count from lineitem group by all having count(*) > 1")
def repeated_line_keys(lg: League):
    return duplicate_keys(lg.table("lineitem"), "l_orderkey", "l_linenumber")


HISTORY_CUT = dt.date(2000, 1, 1)

_STINT_SQL = """
  select player_id as id, season, visitor_team_id as team_id, min(game_date) as start_date, max(game_date) as end_date,
         cast(arg_max(floor(o_totalprice / 50000), (game_date, g.id)) as integer) as weight,
         max(max(game_date)) over (partition by player_id) as last_played_date
  from game g where {cond} group by player_id, season, visitor_team_id"""


def _history_source(lg: League, games: DataFrame, day: dt.date) -> DataFrame:
    """Team-history rows of some games: a landed player row per game, so stints repeat in the landing."""
    side = games.select(
        F.col("id").alias("game_id"), F.col("player_id").cast("int").alias("player_id"),
        F.col("visitor_team_id").alias("team_id"), "game_date", F.col("season").alias("_season"), "o_totalprice",
    )
    stats = side.select(
        "game_id", "player_id", "team_id", "_season",
        F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("team_abbreviation"),
    )
    landed = side.select(
        F.col("player_id").alias("person_id"), F.col("team_id").alias("_team_id"), "_season",
        F.col("game_date").alias("_create_date"), F.col("game_id").alias("_row"),
        F.floor(F.col("o_totalprice") / 50000).cast("string").alias("weight"),
        *[F.lit("").alias(c) for c in ("height", "jersey")],
        *[F.lit(None).cast("string").alias(c) for c in ("birthdate", "dleague_flag", "games_played_flag", "position")],
    )
    rows = marts.team_history(landed, lg.landed_teams, stats, side.select("game_id", "game_date"), _at(day), tie=("_row",))
    rows = rows.withColumns({"created_at": _at(day), "updated_at": F.lit(None).cast("timestamp")})
    return settle(conform(rows, dim_player(history=True)), "team-history")


@query(
    "team_history_rows",
    with_tables(
        "game",
        f"""with st as ({_STINT_SQL.format(cond='true')})
        select id, season, team_id, n_name as team_name, weight, last_played_date, start_date as rec_start_date,
          case when end_date <> last_played_date then end_date end as rec_end_date,
          end_date = last_played_date as is_rec_active
        from (select cast(id as integer) as id, st.* exclude (id) from st) join nation on n_nationkey = team_id""",
    ),
)
def team_history_rows(lg: League):
    return _history_source(lg, lg.games, AFTER).select(
        "id", "season", "team_id", "team_name", "weight", "last_played_date", "rec_start_date", "rec_end_date", "is_rec_active"
    )


@query(
    "team_history_refresh",
    with_tables(
        "game",
        f"""with old as ({_STINT_SQL.format(cond=f"game_date < date '{HISTORY_CUT}'")}),
        s as ({_STINT_SQL.format(cond='true')}),
        dim as (select *, case when end_date <> last_played_date then end_date end as rec_end_date,
                  end_date = last_played_date as active from old),
        closing as (select distinct d.id, d.season, d.team_id from dim d join s on s.id = d.id
          where d.active and (d.season <> s.season or d.team_id <> s.team_id or d.weight <> s.weight
             or d.last_played_date <> s.last_played_date))
        select cast(d.id as integer) as id, d.season, d.team_id, d.weight, d.last_played_date, start_date as rec_start_date,
          case when c.id is null then rec_end_date else date '{HISTORY_CUT}' end as rec_end_date, active and c.id is null as is_rec_active
        from dim d left join closing c on c.id = d.id and c.season = d.season and c.team_id = d.team_id
        union all
        select cast(id as integer), season, team_id, weight, last_played_date, start_date,
          case when end_date <> last_played_date then end_date end, true
        from s where not exists (select 1 from dim where dim.id = s.id)
        union all
        select cast(id as integer), season, team_id, weight, last_played_date, date '{HISTORY_CUT}', date '{HISTORY_CUT}', true
        from s where exists (select 1 from closing c where c.id = s.id)""",
    ),
)
def team_history_refresh(lg: League):
    before = _history_source(lg, lg.games.where(F.col("game_date") < F.lit(HISTORY_CUT)), BEFORE)
    after, _ = scd2(
        before, _history_source(lg, lg.games, HISTORY_CUT), "id", compared_columns(history=True), _at(HISTORY_CUT), keep_dates=True
    )
    return after.select(
        "id", "season", "team_id", "weight", "last_played_date", "rec_start_date", "rec_end_date", "is_rec_active"
    )


def seasons(lg: League) -> DataFrame:
    return lg.games.groupBy("season", "season_type").agg(
        F.min("game_date").alias("start_date"), F.max("game_date").alias("end_date")
    ).withColumn("is_current", F.col("end_date") >= F.lit(dt.date(2001, 1, 1)))


@query(
    "player_stints",
    with_tables(
        "game sched stat",
        """select player_id, player_name, team_id, team_abbreviation, season, min(game_date) as start_date,
          case when season >= '2001' then 'Y' else 'N' end as is_active,
          case when season >= '2001' then null else max(game_date) end as end_date
        from stat join (select id as game_id, game_date from game) using (game_id)
        group by player_id, player_name, team_id, team_abbreviation, season""",
    ),
)
def player_stints(lg: League):
    return marts.stints(lg.player_stats, lg.header, seasons(lg))


@query(
    "stints_with_attributes",
    with_tables(
        "game sched stat",
        f"""with {_landed_sql(BEFORE, 'v1')}, {_landed_sql(AFTER, 'v2')}, common as (select * from v1 union all select * from v2),
        a as (select player_id, team_id, season, min(game_date) as start_date, max(game_date) as end_date
              from stat join (select id as game_id, game_date from game) using (game_id) group by all)
        select a.player_id as id, c.height, c.weight, c.jersey, c.is_dleague, a.team_id, n_name as team_name,
               a.season, a.start_date, a.end_date
        from a left join common c on c.id = a.player_id left join nation on n_nationkey = a.team_id""",
    ),
)
def stints_with_attributes(lg: League):
    common = landed_players(lg, BEFORE).unionByName(landed_players(lg, AFTER))
    return marts.stints_with_attributes(lg.player_stats, lg.header, common, lg.landed_teams, _at(AFTER)).select(
        "id", "height", "weight", "jersey", "is_dleague", "team_id", "team_name", "season", "start_date", "end_date"
    )


_LEG = """select p.display_first_last, p.id as player_id, g.id as game_id, cast(g.game_date - p.birthdate as integer) as age_days,
   '{loc}' as loc, t.id as team_id, t.team_abbreviation, o.id as opp_team_id, o.team_abbreviation as opp_team_abbreviation,
   '{opp}' as opp_loc, g.season, g.game_date
 from game g join team t on t.id = g.{own}_team_id join team o on o.id = g.{other}_team_id
 left join fact f on f.game_id = g.id {extra} left join player p on p.id = f.player_id"""


def _legs_sql(extra: str) -> str:
    home = _LEG.format(loc="Home", opp="Road", own="home", other="visitor", extra=extra)
    road = _LEG.format(loc="Road", opp="Home", own="visitor", other="home", extra=extra)
    return with_tables("team player game line fact", f"{home} union {road}")


@query("schedule_own_leg", _legs_sql("and f.team_id = t.id"))
def schedule_own_leg(lg: League):
    return marts.schedule_from_facts(lg.games, lg.teams, lg.facts, lg.players)


@query("schedule_both_legs", _legs_sql(""))
def schedule_both_legs(lg: League):
    return marts.schedule_from_facts(lg.games, lg.teams, lg.facts, lg.players, both_legs=True)


# For the full schedule a customer is the team and a supplier the player: rosters stay small
# at any scale, as they are in a league.
_CLUB_SQL = """with g as (
  select o_orderkey as id, strftime(o_orderdate, '%Y%m%d') || '/' || o_orderkey as game_code, cast(o_orderdate as date) as game_date,
    case o_orderstatus when 'F' then 'Final' when 'P' then 'PPD' else 'Scheduled' end as game_status,
    o_custkey as home, cast(floor(o_totalprice / 500) as bigint) as visitor,
    cast(year(o_orderdate) as varchar) || '-' || substr(cast(year(o_orderdate) + 1 as varchar), 3, 2) as season from orders),
 f as (select l_orderkey as game_id, l_suppkey as player_id, home as team_id, visitor as opp_team_id, season, game_date
       from lineitem join g on g.id = l_orderkey),
 pth as (select player_id, season, team_id from
          (select player_id, season, team_id, min(game_date) as rec_start_date from f group by all)
          qualify row_number() over (partition by player_id, season order by rec_start_date desc nulls first, team_id) = 1),
 legs as (
  select f.player_id, g.id as game_id, game_code, g.game_date, game_status, f.team_id, 'H' as team_loc, f.opp_team_id, 'V' as opp_team_loc, f.season
    from g left join f on f.game_id = g.id where game_status = 'Final'
  union
  select pth.player_id, g.id, game_code, game_date, game_status, home, 'H', visitor, 'V', g.season
    from g left join pth on pth.team_id = home and pth.season = g.season where game_status <> 'Final'
  union
  select pth.player_id, g.id, game_code, game_date, game_status, visitor, 'V', home, 'H', g.season
    from g left join pth on pth.team_id = visitor and pth.season = g.season where game_status <> 'Final')
select l.player_id, split_part(s_name, '#', 1) as first_name, split_part(s_name, '#', 2) as last_name, game_id, game_code, game_date,
  game_status, t.c_custkey as team_id, t.c_name as team_name, t.c_mktsegment as team_abbreviation,
  case when l.player_id is null and game_status = 'Final' then null else team_loc end as team_loc,
  o.c_custkey as opp_team_id, o.c_name as opp_team_name, o.c_mktsegment as opp_team_abbreviation,
  case when l.player_id is null and game_status = 'Final' then null else opp_team_loc end as opp_team_loc, season,
  cast(game_date - (date '1970-01-01' + cast(floor(s_acctbal) as integer)) as integer) as age
from legs l left join customer t on t.c_custkey = l.team_id left join customer o on o.c_custkey = l.opp_team_id
left join supplier on s_suppkey = l.player_id"""


@query("player_schedule", _CLUB_SQL)
def player_schedule(lg: League):
    day = F.col("o_orderdate").cast("date")
    games = lg.table("orders").select(
        F.col("o_orderkey").alias("id"), F.concat(fn.date_key(day), F.lit("/"), F.col("o_orderkey").cast("string")).alias("game_code"),
        day.alias("game_date"),
        F.when(F.col("o_orderstatus") == "F", "Final").when(F.col("o_orderstatus") == "P", "PPD").otherwise("Scheduled").alias("game_status"),
        F.col("o_custkey").alias("home_team_id"), F.floor(F.col("o_totalprice") / 500).cast("bigint").alias("visitor_team_id"),
        fn.season_text(day).alias("season"),
    )
    facts = lg.table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("player_id")).join(games, "id").select(
        F.col("id").alias("game_id"), "player_id", F.col("home_team_id").alias("team_id"),
        F.col("visitor_team_id").alias("opp_team_id"), F.lit("H").alias("team_loc"), F.lit("V").alias("opp_team_loc"),
        "season", "game_date",
    )
    history = facts.groupBy("player_id", "season", "team_id").agg(F.min("game_date").alias("rec_start_date"))
    clubs = lg.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("team_name"), F.col("c_mktsegment").alias("team_abbreviation")
    )
    people = lg.table("supplier").select(
        F.col("s_suppkey").alias("id"), fn.part("s_name", "#", 1).alias("first_name"), fn.part("s_name", "#", 2).alias("last_name"),
        F.date_add(F.to_date(F.lit("1970-01-01")), F.floor("s_acctbal").cast("int")).alias("birthdate"),
        F.lit(True).alias("is_rec_active"),
    )
    return marts.schedule(games, clubs, facts, history, people)





def _mean4_sql(category: str) -> str:
    """Half-up rounding of an average of cents to four places, in whole numbers."""
    total = f"sum(case when category = '{category}' then cents else 0 end)"
    return (
        f"(case when {total} < 0 then -((-2 * {total} * 100 + count(*)) // (2 * count(*)))"
        f" else (2 * {total} * 100 + count(*)) // (2 * count(*)) end)::double / 10000.0"
    )


DEFENCE_SQL = "select s.team_id, pos, season, " + ", ".join(
    f"{_mean4_sql(name)} as {column}" for name, column in marts.DEFENCE_CATEGORIES.items()
) + " from shot s join player p on p.id = s.player_id and p.rosterstatus = 'Active' where trim(pos) <> '' group by s.team_id, pos, season"


def defence(lg: League) -> DataFrame:
    table = marts.team_position_defence(lg.defending_shots, lg.players, lg.teams)
    return table.select("team_id", "pos", "season", *[F.col(c).cast("double").alias(c) for c in marts.DEFENCE_CATEGORIES.values()])


@query("team_position_defence", with_tables("player game sched shot", DEFENCE_SQL))
def team_position_defence(lg: League):
    return defence(lg)


_DAILY_SQL = TIME_SQL.split("), newest as (")[0] + f"""), def as ({DEFENCE_SQL}),
hust as (select home_team_id as team_id, season, count(*) filter (game_status = 'Final') as charges_drawn, count(*) as contested_shots,
   count(*) filter (game_status = 'PPD') as contested_shots_2pt, count(*) filter (game_status = 'Scheduled') as contested_shots_3pt,
   count(*) filter (o_orderpriority = '1-URGENT') as deflections, count(*) filter (o_orderpriority = '2-HIGH') as loose_balls_recovered,
   count(*) filter (o_orderpriority = '3-MEDIUM') as screen_assists from game group by all),
vt as (select f.season, f.team_id, f.team_abbreviation, p.pos, f.game_date, coalesce(sum(seconds), 0) as pos_time
       from fact f join player p on p.id = f.player_id where trim(pos) <> '' group by all),
vb as (select *, sum(pos_time) over (w rows between 5 preceding and 1 preceding) as pos_time_5,
    sum(pos_time) over (w rows between 10 preceding and 1 preceding) as pos_time_10
  from vt window w as (partition by season, team_id, pos order by game_date, team_abbreviation)),
daynews as (select * from item qualify row_number() over (partition by playerid, dt order by priority, headline) = 1),
counted as (
  select s.*, h.* exclude (team_id, season) from shown s join hust h on h.team_id = s.opp_team_id and h.season = s.season),
own2 as (
  select *, sum(seconds) over (w rows between 5 preceding and 1 preceding) as t5,
    sum(seconds) over (w rows between 10 preceding and 1 preceding) as t10,
    row_number() over (partition by player_id, game_date order by created_at desc, game_id) as rn
  from counted window w as (partition by season, team_id, pos, player_id order by game_date, created_at, game_id))
select o.player_id, o.display_first_last, o.pos, o.game_date, o.team_abbreviation, o.opp_team_abbreviation, o.opp_team_id, o.season,
  o.start_position, o.seconds as player_time, cast(t5 as bigint) as player_time_last_5_games, cast(t10 as bigint) as player_time_last_10_games,
  cast(b.pos_time as bigint) as pos_time_per_game, cast(pos_time_5 as bigint) as pos_time_last_5_games,
  cast(pos_time_10 as bigint) as pos_time_last_10_games, o.comment,
  cast(t5 as double) / cast(pos_time_5 as double) as pct_player_time_5_games,
  cast(t10 as double) / cast(pos_time_10 as double) as pct_player_time_10_games,
  case when n.injured is not null then n.injured
       when upper(o.comment) like '%DECISION%' or upper(o.comment) like '%DRESS%' or upper(o.comment) like '%SUSPEN%'
         or upper(o.comment) like '%PERSONAL%' or upper(o.comment) like '%SERVING%' then 'NO'
       when o.comment like '%DND%' then 'YES' else 'NO' end as injured,
  n.injured_status, n.injury_detail, n.injury_location, n.injury_side, n.injury_type, n.caption,
  {", ".join(f"d.{c} as opp_def_{c}" for c in marts.DEFENCE_CATEGORIES.values())},
  {", ".join(f"o.{c} as opp_hust_{c}" for c in HUSTLE_STATS)}
from own2 o
left join daynews n on n.player_id = o.player_id and n.dt = o.game_date
left join vb b on b.season = o.season and b.team_id = o.team_id and b.game_date = o.game_date and b.pos = o.pos
left join def d on d.team_id = o.opp_team_id and d.pos = o.pos and d.season = o.season
where rn = 1"""


@query("daily_schedule", with_tables("game line fact sched player item shot", _DAILY_SQL))
def daily_schedule(lg: League):
    lg = lg.settled("games", "box")
    versions = lg.players.select(F.col("id").alias("dim_player_guid"), "pos")
    return marts.daily_schedule(lg.schedule, lg.facts, lg.players, versions, lg.news, lg.team_hustle, defence(lg))


# points, pace and plus-minus are named in the SQL below; the others follow from the points by their place
_OTHER_STATS = [(i, c) for i, c in enumerate(OPPONENT_STATS) if c not in ("pts", "pace", "plus_minus")]

_POINTS = "(ast * 1.5::double + reb * 1.2::double + pts + stl * 2::double + blk * 2::double - tov)"


def _rested_schedule(lg: League) -> DataFrame:
    birth = lg.players.select(F.col("id").alias("player_id"), "birthdate")
    rested = previous(
        lg.schedule, ["player_id"], ["game_date", "game_id"], "game_date", "player_previous_game_date", by_month("game_date")
    )
    return rested.join(birth, "player_id", "left").withColumns(
        {"days_rest": fn.days_rest("game_date", "player_previous_game_date"), "age": fn.age_days("game_date", "birthdate")}
    ).drop("birthdate")


@query(
    "game_features",
    with_tables(
        "game line fact sched player",
        f"""with r as (select *, lag(game_date) over (partition by player_id order by game_date, game_id) as prev from sched)
        select p.display_first_last as player, r.game_date, r.season, prev as player_previous_game_date,
          cast(r.game_date - prev as integer) as days_rest, r.team_abbreviation as team, r.team_loc as loc,
          r.opp_team_abbreviation as opp_team, r.opp_team_loc as opp_loc, cast(r.game_date - p.birthdate as integer) as age,
          p.pos as nba_pos, upper(strftime(r.game_date, '%b')) as mnth, lower(strftime(r.game_date, '%a')) as dow,
          f.seconds as seconds_played, round({_POINTS}, 6) as fan_pts,
          round(avg({_POINTS}) over (partition by r.player_id, r.season), 6) as avg_fan_pts,
          case when f.game_id is not null then g.o_totalprice end as pts, f.seconds as pace, f.pts as plus_minus,
          {", ".join(f"case when f.game_id is not null then g.o_totalprice + {i} end as {c}" for i, c in _OTHER_STATS)}
        from r left join player p on p.id = r.player_id left join fact f on f.game_id = r.game_id
        join game g on g.id = r.game_id""",
    ),
)
def game_features(lg: League):
    # schedule, facts and team facts are read several times
    lg = lg.settled("games", "box")
    table = marts.game_features(_rested_schedule(lg), lg.players, lg.facts, lg.team_facts)
    return table.withColumns({c: F.round(c, 6) for c in ("fan_pts", "avg_fan_pts")})


def _played_sql(order: str) -> str:
    return with_tables(
        "game line fact sched player shot",
        f"""with def as ({DEFENCE_SQL}),
        r as (select s.*, seconds, f.pts as line_pts, {_POINTS} as fdpts, lag(s.game_date) over ({order}) as prev,
                avg({_POINTS}) over (partition by s.player_id, s.season) as avg_fdpts
              from sched s join fact f on f.game_id = s.game_id where seconds > 0 and s.game_date <= date '2001-01-01')
        select p.display_first_last as player, r.game_date, r.season as season_str, r.team_abbreviation as team, r.team_loc as loc,
          r.opp_team_abbreviation as opponent, r.opp_team_loc as opp_loc, cast(r.game_date - p.birthdate as integer) as age_in_days,
          p.pos as nba_pos, p.pos as fd_pos, upper(strftime(r.game_date, '%b')) as mnth, lower(strftime(r.game_date, '%a')) as dow,
          r.seconds, round(fdpts, 6) as fdpts, round(avg_fdpts, 6) as avg_fdpts, cast(r.game_date - prev as integer) as player_days_rest,
          d.overall as opp_pos_plusminus, g.o_totalprice as pts, r.seconds as pace, r.line_pts as plus_minus,
          {", ".join(f"g.o_totalprice + {i} as {c}" for i, c in _OTHER_STATS)}
        from r left join player p on p.id = r.player_id join game g on g.id = r.game_id
        left join def d on d.team_id = r.opp_team_id and d.season = r.season and d.pos = p.pos""",
    )


def _played(lg: League, across: bool) -> DataFrame:
    lg = lg.settled("games", "box")
    allowed = defence(lg).select(
        "season", F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("team"), F.col("pos").alias("fd_pos"),
        F.col("overall").alias("avg_norm_plusminus"),
    )
    positions = lg.players.select(F.col("id").alias("player_id"), F.col("pos").alias("fd_pos"))
    table = marts.played_game_features(
        lg.schedule, lg.players, lg.facts, lg.team_facts, allowed, positions, F.lit(dt.date(2001, 1, 1)), across
    )
    return table.withColumns({c: F.round(c, 6) for c in ("fdpts", "avg_fdpts")})


@query("played_game_features", _played_sql("partition by s.player_id order by s.game_date, s.game_id"))
def played_game_features(lg: League):
    return _played(lg, across=False)


@query("played_game_features_across", _played_sql("order by s.season, s.team_id, s.player_id, s.game_date, s.game_id"))
def played_game_features_across(lg: League):
    return _played(lg, across=True)


@query(
    "latest_team",
    with_tables("hist", """select player_id, season, team_id from hist
        qualify row_number() over (partition by player_id, season order by rec_start_date desc nulls first, team_id) = 1"""),
)
def latest_team(lg: League):
    return control.latest_team(lg.team_history)
