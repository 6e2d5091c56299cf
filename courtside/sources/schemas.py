"""Declared tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the player dimension, its change-detection list and the
# team columns the training view takes from the opponent.
_DIM_PLAYER = """
dim_player_guid bigint not null, crc_str string, id int, first_name string, last_name string,
display_first_last string, display_last_comma_first string, display_fi_last string, birthdate date,
school string, country string, last_affiliation string, height int, weight int, season_exp int, jersey int,
nba_pos string, rosterstatus string, playercode string, from_year int, to_year int, is_dleague boolean,
is_games_played boolean, draft_year string, draft_round string, draft_number string, season string,
team_id int, team_name string, team_abbrv string, last_played_date date,
rec_start_date date not null, rec_end_date date, is_rec_active boolean not null,
created_at timestamp not null, updated_at timestamp
"""

OPPONENT_STATS = """
opp_efg_pct opp_fta_rate opp_oreb_pct opp_pts_2nd_chance opp_pts_fb opp_pts_off_tov opp_pts_paint opp_tov_pct
plus_minus pie def_rating pts fga pace efg_pct blka pts_fb tm_tov_pct off_rating pf oreb_pct pts_2nd_chance
fta_rate reb_pct ft_pct dreb pts_off_tov fg3_pct blk pct_pts_2pt_mr pts_paint dreb_pct pct_pts_off_tov pfd fg3a
pct_pts_3pt pct_pts_fb ts_pct pct_pts_paint stl ast pct_pts_2pt fg_pct pct_pts_ft oreb
""".split()

HUSTLE_STATS = """
charges_drawn contested_shots contested_shots_2pt contested_shots_3pt deflections loose_balls_recovered
screen_assists
""".split()


def dim_player(history: bool = False) -> T.StructType:
    """The player dimension; the team-history form also has ``last_played_date``."""
    schema = T.StructType.fromDDL(" ".join(_DIM_PLAYER.split()))
    if history:
        return schema
    return T.StructType([f for f in schema.fields if f.name != "last_played_date"])


def compared_columns(history: bool = False) -> list[str]:
    """Columns whose change closes a version: every attribute, but no key, date or flag of the version."""
    names = [f.name for f in dim_player(history).fields]
    first, last = names.index("first_name"), names.index("rec_start_date")
    return names[first:last]
