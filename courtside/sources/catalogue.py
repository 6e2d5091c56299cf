"""Catalogue of landed documents: which result set holds which measure."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values. One document type per line:
# grain, name, parent (its measures are inherited) or -, endpoint or -, measure:index ...
DOCUMENTS = """
game Boxscore - boxscoresummaryv2 game_summary:0 other_stats:1 officials:2 inactive_players:3 game_info:4 line_score:5 last_meeting:6 season_series:7 available_video:8
game BoxscoreTraditional Boxscore boxscoretraditionalv2 player_stats:0 team_stats:1 team_starter_bench_stats:2
game BoxscoreAdvanced Boxscore boxscoreadvancedv2 player_stats_advanced:0 team_stats_advanced:1
game BoxscoreMisc Boxscore boxscoremiscv2 sql_players_misc:0 sql_teams_misc:1
game BoxscoreScoring Boxscore boxscorescoringv2 sql_players_scoring:0 sql_teams_scoring:1
game BoxscoreUsage Boxscore boxscoreusagev2 sql_players_usage:0 sql_teams_usage:1
game BoxscoreFourFactors Boxscore boxscorefourfactorsv2 sql_players_four_factors:0 sql_teams_four_factors:1
game BoxScorePlayerTrack Boxscore boxscoreplayertrackv2 player_track:0 team_track:1
game PlayByPlay - playbyplay PlayByPlay:0 available_video:1
team TeamList - commonteamyears info:0
team TeamSummary - teaminfocommon info:0 season_ranks:1
team TeamCommonRoster - commonteamroster roster:0 coaches:1
team _TeamDashboard - - overall:0
team TeamGeneralSplits _TeamDashboard teamdashboardbygeneralsplits location:1 wins_losses:2 monthly:3 pre_post_all_star:4 days_rest:5
team TeamOpponentSplits _TeamDashboard teamdashboardbyopponent by_conference:1 by_division:2 by_opponent:3
team TeamLastNGamesSplits _TeamDashboard teamdashboardbylastngames last5:1 last10:2 last15:3 last20:4 gamenumber:5
team TeamInGameSplits _TeamDashboard teamdashboardbygamesplits by_half:1 by_period:2 by_score_margin:3 by_actual_margin:4
team TeamClutchSplits _TeamDashboard teamdashboardbyclutch last5min_deficit_5point:1 last3min_deficit_5point:2 last1min_deficit_5point:3 last30sec_deficit_3point:4 last10sec_deficit_3point:5 last5min_plusminus_5point:6 last3min_plusminus_5point:7 last1min_plusminus_5point:8 last30sec_plusminus_5point:9
team TeamShootingSplits _TeamDashboard teamdashboardbyshootingsplits shot_5ft:1 shot_8ft:2 shot_areas:3 assisted_shots:4 shot_type_summary:5 assissted_by:6
team TeamPerformanceSplits _TeamDashboard teamdashboardbyteamperformance score_differential:1 points_scored:2 points_against:3
team TeamYearOverYearSplits _TeamDashboard teamdashboardbyyearoveryear by_year:1
team TeamLineups - teamdashlineups overall:0 lineups:1
team TeamPlayers _TeamDashboard teamplayerdashboard season_totals:1
team TeamPlayerOnOffDetail _TeamDashboard teamplayeronoffdetails on_court:1 off_court:2
team TeamPlayerOnOffSummary _TeamDashboard teamplayeronoffsummary on_court:1 off_court:2
team TeamGameLogs - teamgamelog team_game_log:0
team TeamSeasons - teamyearbyyearstats team_seasons:0
team TeamShotTracking _TeamDashboard teamdashptshots shot_clock_shooting:1 dribble_shooting:2 closest_defender_shooting:3 closest_defender_shooting_long:4 touch_time_shooting:5
team TeamReboundTracking _TeamDashboard teamdashptreb shot_type_rebounding:1 contested_rebounding:2 shot_distance_rebounding:3 rebound_distance_rebounding:4
team TeamPassTracking _TeamDashboard teamdashptpass passes_made:0 passes_recieved:1
team HustleStatsTeam - leaguehustlestatsteam overall:0
team TeamVsPlayer - teamvsplayer overall:0 vs_player_overall:1 on_off_court:2 shot_distance_overall:3 shot_distance_on_court:4 shot_distance_off_court:5 shot_area_overall:6 shot_area_on_court:7 shot_area_off_court:8
player PlayerList - commonallplayers info:0
player PlayerSummary - commonplayerinfo info:0 headline_stats:1
player _PlayerDashboard - - overall:0
player PlayerGeneralSplits _PlayerDashboard playerdashboardbygeneralsplits location:1 win_losses:2 month:3 pre_post_all_star:4 starting_position:5 days_rest:6
player PlayerOpponentSplits _PlayerDashboard playerdashboardbyopponent by_conference:1 by_division:2 by_opponent:3
player PlayerLastNGamesSplits _PlayerDashboard playerdashboardbylastngames last5:1 last10:2 last15:3 last20:4 gamenumber:5
player PlayerInGameSplits _PlayerDashboard playerdashboardbygamesplits by_half:1 by_period:2 by_score_margin:3 by_actual_margin:4
player PlayerClutchSplits _PlayerDashboard playerdashboardbyclutch last5min_deficit_5point:1 last3min_deficit_5point:2 last1min_deficit_5point:3 last30sec_deficit_3point:4 last10sec_deficit_3point:5 last5min_plusminus_5point:6 last3min_plusminus_5point:7 last1min_plusminus_5point:8 last30sec_plusminus_5point:9
player PlayerShootingSplits _PlayerDashboard playerdashboardbyshootingsplits shot_5ft:1 shot_8ft:2 shot_areas:3 assisted_shots:4 shot_types_summary:5 shot_types_detail:6 assissted_by:7
player PlayerPerformanceSplits _PlayerDashboard playerdashboardbyteamperformance score_differential:1 points_scored:2 points_against:3
player PlayerYearOverYearSplits _PlayerDashboard playerdashboardbyyearoveryear by_year:1
player PlayerCareer - playercareerstats regular_season_totals:0 regular_season_career_totals:1 post_season_totals:2 post_season_career_totals:3 all_star_season_totals:4 career_all_star_season_totals:5 college_season_totals:6 college_season_career_totals:7 regular_season_rankings:8 post_season_rankings:9
player PlayerProfile PlayerCareer playerprofilev2 season_highs:10 career_highs:11 next_game:12
player PlayerGameLogs - playergamelog info:0
player PlayerShotTracking _PlayerDashboard playerdashptshots general_shooting:1 shot_clock_shooting:2 dribble_shooting:3 closest_defender_shooting:4 closest_defender_shooting_long:5 touch_time_shooting:6
player PlayerReboundTracking _PlayerDashboard playerdashptreb shot_type_rebounding:1 num_contested_rebounding:2 shot_distance_rebounding:3 rebound_distance_rebounding:4
player PlayerPassTracking _PlayerDashboard playerdashptpass passes_made:0 passes_recieved:1
player PlayerDefenseTracking _PlayerDashboard playerdashptshotdefend defending_shots:0
player PlayerShotLogTracking _PlayerDashboard playerdashptshotlog
player PlayerReboundLogTracking _PlayerDashboard playerdashptreboundlogs
player PlayerHustleStats - leaguehustlestatsplayer overall:0
player PlayerVsPlayer - playervsplayer overall:0 on_off_court:1 shot_distance_overall:2 shot_distance_on_court:3 shot_distance_off_court:4 shot_area_overall:5 shot_area_on_court:6 shot_area_off_court:7 player_info:8 vs_player_info:9
player PlayerDefendingShots - playerdashptshotdefend overall:0
"""


@dataclass(frozen=True)
class DocumentType:
    grain: str
    name: str
    parent: str | None
    endpoint: str | None
    own: dict[str, int]


def _parse(line: str) -> DocumentType:
    grain, name, parent, endpoint, *measures = line.split()
    pairs = (m.split(":") for m in measures)
    return DocumentType(
        grain,
        name,
        None if parent == "-" else parent,
        None if endpoint == "-" else endpoint,
        {measure: int(index) for measure, index in pairs},
    )


CATALOGUE = {(d.grain, d.name): d for d in map(_parse, DOCUMENTS.strip().splitlines())}


def measures(grain: str, name: str) -> dict[str, int]:
    """Measure to result-set index, inherited ones included."""
    doc = CATALOGUE[grain, name]
    inherited = measures(grain, doc.parent) if doc.parent else {}
    return {**inherited, **doc.own}


def result_index(grain: str, name: str, measure: str) -> int:
    return measures(grain, name)[measure]
