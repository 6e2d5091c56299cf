"""Split tables by game, opponent, recency, period, clutch, shot, tracking and lineup keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from courtside.functions import scalars as fn

from courtside.operators import splits
from courtside.operators.windows import by_month, previous
from courtside.queries.league import League, with_tables
from courtside.queries.registry import query

STATS = ["pts", "ast", "seconds"]
CUT = dt.date(1998, 1, 1)

_BOX = """select f.*, case when pts >= 16 then 'W' else 'L' end as outcome,
   case when start_position < '3' then 'Home' else 'Road' end as location from fact f"""
_SUMS = "count(*) as gp, cast(sum(pts) as bigint) as pts, cast(sum(ast) as bigint) as ast, cast(sum(seconds) as bigint) as seconds"


def box(lg: League) -> DataFrame:
    """Player-game rows with outcome and location."""
    return lg.facts.withColumns(
        {
            "outcome": F.when(F.col("pts") >= 16, "W").otherwise("L"),
            "location": F.when(F.col("start_position") < "3", "Home").otherwise("Road"),
        }
    )


def _box_sql(keys: str, more: str = "", sums: str = _SUMS, tables: str = "game line fact") -> str:
    return with_tables(tables, f"with box as ({_BOX}) select {keys}, {sums} from box {more} group by all")


@query("split_by_location", _box_sql("player_id, location"))
def split_by_location(lg: League):
    return splits.totals(box(lg), ["player_id", "location"], STATS)


@query("split_by_outcome", _box_sql("team_id, outcome"))
def split_by_outcome(lg: League):
    return splits.totals(box(lg), ["team_id", "outcome"], STATS)


@query("split_by_month", _box_sql("player_id, cast(month(game_date) as integer) as month"))
def split_by_month(lg: League):
    return splits.totals(box(lg), ["player_id", F.month("game_date").alias("month")], STATS)


@query("split_by_season_half", _box_sql(f"player_id, case when game_date < date '{CUT}' then 'Pre All-Star' else 'Post All-Star' end as half"))
def split_by_season_half(lg: League):
    return splits.totals(box(lg), ["player_id", splits.season_half(CUT).alias("half")], STATS)


@query("split_by_start_position", _box_sql("team_id, start_position"))
def split_by_start_position(lg: League):
    return splits.totals(box(lg), ["team_id", "start_position"], STATS)


@query(
    "split_by_days_rest",
    with_tables(
        "game line fact",
        f"""with r as (select *, game_date - lag(game_date) over (partition by player_id order by game_date, game_id) - 1 as free from fact)
        select team_id, case when free is null then 'First Game' when free >= 6 then '6+ Days Rest'
          else cast(greatest(free, 0) as varchar) || ' Days Rest' end as rest, {_SUMS} from r group by all""",
    ),
)
def split_by_days_rest(lg: League):
    rested = previous(lg.facts, ["player_id"], ["game_date", "game_id"], "game_date", "prev", by_month("game_date"))
    rest = fn.days_rest("game_date", "prev")
    return splits.totals(rested, ["team_id", splits.rest_bucket(rest).alias("rest")], STATS)


@query("split_by_opponent_conference", _box_sql("player_id, conference as opp_conference", "join team t on t.id = opp_team_id", tables="team game line fact"))
def split_by_opponent_conference(lg: League):
    return splits.by_opponent(box(lg), lg.teams, "conference", "player_id", STATS)


@query("split_by_opponent_division", _box_sql("team_id, team_name as opp_team_name", "join team t on t.id = opp_team_id", tables="team game line fact"))
def split_by_opponent_division(lg: League):
    return splits.by_opponent(box(lg), lg.teams, "team_name", "team_id", STATS)


@query("split_by_opponent", _box_sql("player_id, opp_team_id"))
def split_by_opponent(lg: League):
    return splits.totals(box(lg), ["player_id", "opp_team_id"], STATS)


@query(
    "split_last_games",
    with_tables(
        "game line fact",
        f"""with r as (select *, row_number() over (partition by player_id order by game_date desc, game_id desc) as n from fact),
        size(last_n) as (values (5), (10), (15), (20))
        select player_id, last_n, {_SUMS} from r join size on n <= last_n group by all""",
    ),
)
def split_last_games(lg: League):
    return splits.by_last_games(lg.facts, "player_id", STATS)


@query(
    "split_by_game_number",
    with_tables(
        "game line fact",
        f"""with r as (select *, row_number() over (partition by team_id, season order by game_date, game_id) as n from fact)
        select team_id, season, cast((n - 1) // 10 * 10 + 1 as bigint) as first_game, {_SUMS} from r group by all""",
    ),
)
def split_by_game_number(lg: League):
    return splits.by_game_number(lg.facts, ["team_id", "season"], STATS, by_month("game_date"))


def moments(lg: League) -> DataFrame:
    """Event rows of a game day: half, six-hour period, seconds left in the day, margin and value in cents."""
    second = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return lg.table("events").select(
        "event_id", "user_id", "event_type", "ts", F.col("ts").cast("date").alias("d"),
        (F.floor(F.hour("ts") / 12) + 1).cast("int").alias("half"), (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"),
        (86400 - second).alias("seconds_left"),
        (F.get_json_object("props", "$.k").cast("int") - 50).alias("margin"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


_MOMENT = """with m as (select user_id, event_type, ts, cast(hour(ts) // 12 + 1 as integer) as half, cast(hour(ts) // 6 + 1 as integer) as period,
   86400 - (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) as seconds_left, cast(props ->> '$.k' as integer) - 50 as margin,
   cast(round(value * 100) as bigint) as cents, event_id, cast(ts as date) as d from events) """
_CENTS = "count(*) as gp, cast(sum(cents) as bigint) as cents"


@query("split_by_half", _MOMENT + f"select user_id, half, {_CENTS} from m group by all")
def split_by_half(lg: League):
    return splits.totals(moments(lg), ["user_id", "half"], ["cents"])


@query("split_by_period", _MOMENT + f"select user_id, period, {_CENTS} from m group by all")
def split_by_period(lg: League):
    return splits.totals(moments(lg), ["user_id", "period"], ["cents"])


_MARGIN_EDGES = [-10, 0, 1, 11]
_MARGIN_NAMES = ["Behind 11+", "Behind 1-10", "Tied", "Ahead 1-10", "Ahead 11+"]


@query(
    "split_by_score_margin",
    _MOMENT + f"""select user_id, case when margin < -10 then 'Behind 11+' when margin < 0 then 'Behind 1-10' when margin < 1 then 'Tied'
      when margin < 11 then 'Ahead 1-10' else 'Ahead 11+' end as score_margin, {_CENTS} from m group by all""",
)
def split_by_score_margin(lg: League):
    key = splits.labelled("margin", _MARGIN_EDGES, _MARGIN_NAMES).alias("score_margin")
    return splits.totals(moments(lg), ["user_id", key], ["cents"])


@query("split_by_actual_margin", _MOMENT + f"select user_id, margin, {_CENTS} from m group by all")
def split_by_actual_margin(lg: League):
    return splits.totals(moments(lg), ["user_id", "margin"], ["cents"])


# the given events are sparse late in a day, so an hour stands for a minute here
_SLOW_CLUTCH = {name: (left * 60, low * 5, high * 5) for name, (left, low, high) in splits.CLUTCH.items()}


@query(
    "split_by_clutch",
    _MOMENT + ", c(clutch, t, lo, hi) as (values "
    + ", ".join(f"('{n}', {t}, {lo}, {hi})" for n, (t, lo, hi) in _SLOW_CLUTCH.items())
    + f") select user_id, clutch, {_CENTS} from m join c on seconds_left <= t and margin between lo and hi group by all",
)
def split_by_clutch(lg: League):
    return splits.by_clutch(moments(lg), "user_id", ["cents"], _SLOW_CLUTCH)


@query(
    "line_score",
    _MOMENT + """select user_id, d, cast(sum(case when period = 1 then cents else 0 end) as bigint) as pts_1,
      cast(sum(case when period = 2 then cents else 0 end) as bigint) as pts_2, cast(sum(case when period = 3 then cents else 0 end) as bigint) as pts_3,
      cast(sum(case when period = 4 then cents else 0 end) as bigint) as pts_4, cast(sum(cents) as bigint) as pts from m group by all""",
)
def line_score(lg: League):
    return splits.line_score(moments(lg), ["user_id", "d"], "period", "cents", [1, 2, 3, 4])


def shots(lg: League) -> DataFrame:
    """Line rows as shots: distance, area, kind and maker from the part, tracking bands from the line."""
    part = lg.table("part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("distance"), F.col("p_type").alias("area"),
        F.col("p_brand").alias("kind"),
    )
    return lg.table("lineitem").select(
        "l_partkey", F.col("l_suppkey").alias("shooter"), F.col("l_quantity").cast("bigint").alias("made"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("int").alias("clock"), F.round(F.col("l_tax") * 100).cast("int").alias("dribbles"),
        (F.col("l_returnflag") == "A").alias("assisted"), F.col("l_linestatus").alias("contest"),
        F.col("l_linenumber").alias("touch"),
    ).join(part, "l_partkey")


_SHOT = """with s as (select l_suppkey as shooter, cast(l_quantity as bigint) as made, cast(round(l_extendedprice * 100) as bigint) as cents,
   cast(round(l_discount * 100) as integer) as clock, cast(round(l_tax * 100) as integer) as dribbles, l_returnflag = 'A' as assisted,
   l_linestatus as contest, l_linenumber as touch, l_partkey, p_size as distance, p_type as area, p_brand as kind
   from lineitem join part on p_partkey = l_partkey) """
_MADE = "count(*) as gp, cast(sum(made) as bigint) as made, cast(sum(cents) as bigint) as cents"
SHOT_STATS = ["made", "cents"]


def _shot_split(name: str, key_sql: str, key):
    @query(name, _SHOT + f"select shooter, {key_sql}, {_MADE} from s group by all")
    def build(lg: League):
        return splits.totals(shots(lg), ["shooter", key()], SHOT_STATS)

    return build


_shot_split("shots_by_5ft", "cast(distance // 5 * 5 as bigint) as band", lambda: splits.band("distance", 5).alias("band"))
_shot_split("shots_by_8ft", "cast(distance // 8 * 8 as bigint) as band", lambda: splits.band("distance", 8).alias("band"))
_shot_split("shots_by_area", "area", lambda: F.col("area"))
_shot_split("shots_assisted", "assisted", lambda: F.col("assisted"))
_shot_split("shots_by_type", "kind", lambda: F.col("kind"))
_shot_split("shots_assisted_by", "l_partkey as assisted_by", lambda: F.col("l_partkey").alias("assisted_by"))

_CLOCK = ([1, 4, 7, 9], ["24-22", "22-18", "18-15", "15-7", "7-0"])
_TOUCH = ([3, 6], ["Touch < 2 Seconds", "Touch 2-6 Seconds", "Touch 6+ Seconds"])


def _labels_sql(column: str, edges, names) -> str:
    return "case " + " ".join(f"when {column} < {e} then '{n}'" for e, n in zip(edges, names)) + f" else '{names[-1]}' end"


_shot_split("tracking_by_shot_clock", _labels_sql("clock", *_CLOCK) + " as shot_clock", lambda: splits.labelled("clock", *_CLOCK).alias("shot_clock"))
_shot_split("tracking_by_dribbles", "dribbles", lambda: F.col("dribbles"))
_shot_split("tracking_by_touch_time", _labels_sql("touch", *_TOUCH) + " as touch_time", lambda: splits.labelled("touch", *_TOUCH).alias("touch_time"))


@query(
    "tracking_by_defender_distance",
    _SHOT + f"select shooter, case when distance < 4 then 'Tight' when distance < 6 then 'Open' else 'Wide Open' end as defender, {_MADE} from s group by all",
)
def tracking_by_defender_distance(lg: League):
    key = splits.labelled("distance", [4, 6], ["Tight", "Open", "Wide Open"]).alias("defender")
    return splits.totals(shots(lg), ["shooter", key], SHOT_STATS)


@query(
    "tracking_by_defender_distance_long",
    _SHOT + f"""select shooter, case when distance < 4 then 'Tight' when distance < 6 then 'Open' else 'Wide Open' end as defender, {_MADE}
      from s where distance >= 10 group by all""",
)
def tracking_by_defender_distance_long(lg: League):
    key = splits.labelled("distance", [4, 6], ["Tight", "Open", "Wide Open"]).alias("defender")
    return splits.totals(shots(lg).where(F.col("distance") >= 10), ["shooter", key], SHOT_STATS)


@query("rebounds_by_contest", _SHOT + f"select shooter, contest, cast(distance // 10 * 10 as bigint) as band, {_MADE} from s group by all")
def rebounds_by_contest(lg: League):
    return splits.totals(shots(lg), ["shooter", "contest", splits.band("distance", 10).alias("band")], SHOT_STATS)


_GENERAL = "case when distance < 10 then 'Less than 10 ft' when dribbles = 0 then 'Catch and Shoot' else 'Pull Ups' end"
_shot_split(
    "tracking_general_shooting", _GENERAL + " as general",
    lambda: F.when(F.col("distance") < 10, "Less than 10 ft").when(F.col("dribbles") == 0, "Catch and Shoot").otherwise("Pull Ups").alias("general"),
)
_shot_split(
    "rebounds_by_shot_type", "case when distance < 24 then 'Miss 2FG' else 'Miss 3FG' end as shot_type",
    lambda: F.when(F.col("distance") < 24, "Miss 2FG").otherwise("Miss 3FG").alias("shot_type"),
)
_shot_split("rebounds_by_distance", "cast(distance // 6 * 6 as bigint) as band", lambda: splits.band("distance", 6).alias("band"))


@query(
    "defence_by_category",
    with_tables("game sched shot", "select player_id, category, count(*) as gp, cast(sum(cents) as bigint) as cents from shot group by all"),
)
def defence_by_category(lg: League):
    rows = lg.defending_shots.select(
        F.col("_player_id").alias("player_id"), F.col("defense_category").alias("category"),
        F.round(F.col("pct_plusminus") * 100).cast("bigint").alias("cents"),
    )
    return splits.totals(rows, ["player_id", "category"], ["cents"])


_SCORED = _labels_sql("pts", [6, 12, 18, 24], ["0-5", "6-11", "12-17", "18-23", "24+"])


@query("split_by_points_scored", _box_sql(f"team_id, {_SCORED} as points_scored"))
def split_by_points_scored(lg: League):
    key = splits.labelled("pts", [6, 12, 18, 24], ["0-5", "6-11", "12-17", "18-23", "24+"]).alias("points_scored")
    return splits.totals(box(lg), ["team_id", key], STATS)


@query("split_by_points_against", _box_sql(f"opp_team_id, {_SCORED} as points_against"))
def split_by_points_against(lg: League):
    key = splits.labelled("pts", [6, 12, 18, 24], ["0-5", "6-11", "12-17", "18-23", "24+"]).alias("points_against")
    return splits.totals(box(lg), ["opp_team_id", key], STATS)


@query("split_by_score_differential", _box_sql("team_id, cast(floor((pts - 16) / 5.0) * 5 as bigint) as differential"))
def split_by_score_differential(lg: League):
    return splits.totals(box(lg), ["team_id", splits.band(F.col("pts") - 16, 5).alias("differential")], STATS)


@query(
    "career_by_year",
    with_tables("game line fact", f"select player_id, season, {_SUMS} from fact group by grouping sets ((player_id, season), (player_id))"),
)
def career_by_year(lg: League):
    return splits.by_year_with_career(lg.facts, "player_id", STATS)


@query(
    "season_rankings",
    with_tables(
        "game line fact",
        f"""with t as (select player_id, season, {_SUMS} from fact group by all)
        select *, cast(rank() over (partition by season order by pts desc) as bigint) as pts_rank from t""",
    ),
)
def season_rankings(lg: League):
    return splits.rankings(splits.totals(lg.facts, ["player_id", "season"], STATS), "pts", 10)


def _highs_sql(keys: str) -> str:
    return with_tables(
        "game line fact",
        f"""select {keys}, max(pts) as pts_high, arg_max(game_date, (pts, -(game_date - date '1970-01-01'))) as pts_date,
          max(seconds) as seconds_high, arg_max(game_date, (seconds, -(game_date - date '1970-01-01'))) as seconds_date
        from fact group by all""",
    )


@query("season_highs", _highs_sql("player_id, season"))
def season_highs(lg: League):
    return splits.highs(lg.facts, ["player_id", "season"], ["pts", "seconds"])


@query("career_highs", _highs_sql("player_id"))
def career_highs(lg: League):
    return splits.highs(lg.facts, ["player_id"], ["pts", "seconds"])


@query(
    "next_game",
    with_tables("game sched", "select player_id, min(game_date) as next_game from sched where game_date > date '2000-06-30' group by all"),
)
def next_game(lg: League):
    return splits.next_game(lg.schedule, ["player_id"], F.lit(dt.date(2000, 6, 30)))


@query(
    "pass_pairs",
    """with p as (select event_type as received_by, lag(event_type) over (partition by user_id order by ts, event_id) as made_by from events)
       select made_by, received_by, count(*) as passes from p where made_by is not null group by all""",
)
def pass_pairs(lg: League):
    passes = previous(
        lg.table("events").select("event_id", "user_id", "ts", F.col("event_type").alias("received_by")),
        ["user_id"], ["ts", "event_id"], "received_by", "made_by", by_month("ts"),
    )
    return splits.pass_pairs(passes, "made_by", "received_by")


def _segments(lg: League) -> tuple[DataFrame, DataFrame]:
    """Games as segments of the home team, and the suppliers on their lines as the players present."""
    segments = lg.facts.select(F.col("game_id").alias("segment_id"), "team_id", "pts", "seconds")
    team = lg.schedule.select(F.col("game_id").alias("segment_id"), "team_id")
    presence = lg.table("lineitem").select(
        F.col("l_orderkey").alias("segment_id"), F.col("l_suppkey").alias("player")
    ).join(team, "segment_id")
    return segments, presence


@query(
    "on_off_court",
    with_tables(
        "game line fact",
        """with pres as (select distinct l_orderkey as game_id, l_suppkey as player from lineitem),
        w as (select team_id, count(*) as gp, sum(pts) as pts, sum(seconds) as seconds from fact group by all),
        o as (select team_id, player, count(*) as on_gp, sum(pts) as on_pts, sum(seconds) as on_seconds from fact join pres using (game_id) group by all)
        select team_id, player, on_gp, cast(on_pts as bigint) as on_pts, cast(on_seconds as bigint) as on_seconds, gp - on_gp as off_gp,
          cast(pts - on_pts as bigint) as off_pts, cast(seconds - on_seconds as bigint) as off_seconds from o join w using (team_id)""",
    ),
)
def on_off_court(lg: League):
    return splits.on_off(*_segments(lg), "team_id", "player", ["pts", "seconds"])


@query(
    "versus_player",
    with_tables(
        "game line fact",
        f"""with met as (select distinct l_orderkey as game_id from lineitem where l_suppkey = 7)
        select player_id, case when met.game_id is null then 'Off' else 'On' end as court_status, {_SUMS}
        from fact left join met using (game_id) group by all""",
    ),
)
def versus_player(lg: League):
    presence = lg.table("lineitem").select(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player"))
    return splits.versus(lg.facts, presence, "player_id", "player", 7, STATS)


@query(
    "versus_by_distance",
    """with met as (select distinct l_orderkey from lineitem where l_suppkey = 7)
       select p_type as area, cast(p_size // 10 * 10 as bigint) as band, l.l_suppkey as shooter,
         case when met.l_orderkey is null then 'Off' else 'On' end as court_status, count(*) as gp, cast(sum(l_quantity) as bigint) as made
       from lineitem l join part on p_partkey = l_partkey left join met on met.l_orderkey = l.l_orderkey group by all""",
)
def versus_by_distance(lg: League):
    part = lg.table("part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("area"), splits.band("p_size", 10).alias("band")
    )
    lines = lg.table("lineitem").select(
        F.col("l_orderkey").alias("game_id"), "l_partkey", F.col("l_suppkey").alias("shooter"), F.col("l_quantity").cast("bigint").alias("made")
    )
    presence = lines.select("game_id", F.col("shooter").alias("player"))
    return splits.versus(lines.join(part, "l_partkey"), presence, "shooter", "player", 7, ["made"], by=["area", "band"])


_LINEUP_SQL = """with pres as (select distinct l_orderkey, l_suppkey from lineitem),
  g as (select l_orderkey, list(l_suppkey order by l_suppkey) as members from pres group by all having count(*) = {size})
  select array_to_string(members, '-') as lineup, count(*) as segments from g group by all"""


def _lineups(lg: League, size: int) -> DataFrame:
    presence = lg.table("lineitem").select("l_orderkey", "l_suppkey")
    groups = splits.lineups(presence, ["l_orderkey"], "l_suppkey", size)
    return groups.select(F.array_join(F.col("lineup").cast("array<string>"), "-").alias("lineup"), "segments")


@query("lineups_of_five", _LINEUP_SQL.format(size=5))
def lineups_of_five(lg: League):
    return _lineups(lg, 5)


@query("lineups_of_two", _LINEUP_SQL.format(size=2))
def lineups_of_two(lg: League):
    return _lineups(lg, 2)


_FILTER_SQL = "where season = '1998-99' and season_type = 'Regular Season' and outcome = 'W' and game_date >= date '1998-02-01' and game_date <= date '1998-08-31'"


@query("league_table", _box_sql("player_id", _FILTER_SQL))
def league_table(lg: League):
    rows = splits.narrowed(
        box(lg), season="1998-99", season_type="Regular Season", outcome="W",
        date_from=dt.date(1998, 2, 1), date_to=dt.date(1998, 8, 31),
    )
    return splits.totals(rows, ["player_id"], STATS)


@query(
    "league_table_last_games",
    with_tables(
        "game line fact",
        f"""with box as ({_BOX}), r as (select *, row_number() over (partition by player_id order by game_date desc, game_id desc) as n
          from box where location = 'Home' and month(game_date) = 3)
        select player_id, {_SUMS} from r where n <= 3 group by all""",
    ),
)
def league_table_last_games(lg: League):
    rows = splits.narrowed(box(lg), location="Home", month=3, last_n_games=3)
    return splits.totals(rows, ["player_id"], STATS)


@query(
    "per_game_table",
    _box_sql("team_id, season", sums="count(*) as gp, cast(sum(pts) as double) / count(*) as pts, cast(sum(ast) as double) / count(*) as ast"),
)
def per_game_table(lg: League):
    return splits.totals(box(lg), ["team_id", "season"], ["pts", "ast"], "PerGame")


@query(
    "per_36_table",
    _box_sql("player_id, season", sums="""count(*) as gp, case when sum(seconds) <> 0 then cast(sum(pts) as double) * 2160 / cast(sum(seconds) as double) end as pts,
      case when sum(seconds) <> 0 then cast(sum(ast) as double) * 2160 / cast(sum(seconds) as double) end as ast"""),
)
def per_36_table(lg: League):
    return splits.totals(box(lg), ["player_id", "season"], ["pts", "ast"], "Per36")


@query("team_season_totals", _box_sql("team_id, season"))
def team_season_totals(lg: League):
    return splits.totals(box(lg), ["team_id", "season"], STATS)


@query(
    "career_by_season_type",
    with_tables("game line fact", f"select player_id, season_type, {_SUMS} from fact group by all"),
)
def career_by_season_type(lg: League):
    return splits.totals(lg.facts, ["player_id", "season_type"], STATS)


@query(
    "team_season_ranks",
    with_tables(
        "game line fact",
        f"""with t as (select team_id, season, {_SUMS} from fact group by all)
        select *, cast(rank() over (partition by season order by pts desc) as bigint) as pts_rank from t""",
    ),
)
def team_season_ranks(lg: League):
    return splits.rankings(splits.totals(lg.facts, ["team_id", "season"], STATS), "pts", 100)


@query(
    "passes_received",
    """with p as (select event_type as received_by, lag(event_type) over (partition by user_id order by ts, event_id) as made_by from events)
       select received_by, cast(count(*) as bigint) as passes from p where made_by is not null group by all""",
)
def passes_received(lg: League):
    return pass_pairs(lg).groupBy("received_by").agg(F.sum("passes").alias("passes"))


@query(
    "conference_table",
    _box_sql("player_id", "join team t on t.id = opp_team_id where conference = 'ASIA' and location = 'Home'", tables="team game line fact"),
)
def conference_table(lg: League):
    side = lg.teams.select(F.col("id").alias("opp_team_id"), F.col("conference").alias("opp_conference"))
    rows = splits.narrowed(box(lg).join(side, "opp_team_id"), opp_conference="ASIA", location="Home")
    return splits.totals(rows, ["player_id"], STATS)
