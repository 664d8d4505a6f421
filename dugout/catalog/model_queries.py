"""The model graph over the stand-in frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import NULL_KEY_TEXT
from ..plans import dims, facts, intermediate, marts
from . import frames as fr
from .registry import query, rounded, table

_SWING = "('S', 'W', 'T', 'F', 'L', 'D', 'E', 'X')"
_IN = "plate_x between -0.83 and 0.83 and plate_z between sz_bot and sz_top"
_OUT = "(plate_x < -0.83 or plate_x > 0.83 or plate_z < sz_bot or plate_z > sz_top)"
_KNOWN = "(plate_x is not null and plate_z is not null and sz_top is not null and sz_bot is not null)"
_NOT_PA = "('wild_pitch', 'passed_ball', 'balk', 'other_advance', 'runner_double_play', 'defensive_indiff')"
_NOT_AB = "('walk', 'intent_walk', 'hit_by_pitch', 'sac_fly', 'sac_bunt', 'sac_fly_double_play', 'sac_bunt_double_play', 'catcher_interf')"


def _known(cond: str) -> str:
    return f"case when not {_KNOWN} then null when {cond} then 1 else 0 end"


def _flag(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


def _complete(final: str, result: str) -> str:
    return (
        f"case when {final} = 1 and {result} is not null and not starts_with({result}, 'caught_stealing') and not starts_with({result}, 'pickoff') "
        f"and not starts_with({result}, 'stolen_base') and {result} not in {_NOT_PA} then 1 else 0 end"
    )


def _bases(done: str, result: str) -> str:
    return f"case when {done} = 1 then case {result} when 'single' then 1 when 'double' then 2 when 'triple' then 3 when 'home_run' then 4 else 0 end else 0 end"


def isum(expr: str, name: str) -> str:
    return f"cast(sum({expr}) as bigint) as {name}"


def irate(num: str, den: str, name: str, digits: int = 3) -> str:
    return f"round(cast({num} as double) / nullif({den}, 0), {digits}) as {name}"


PITCHES_CTE = f"p0 as ({fr.PITCHES_SQL})"
ENRICHED_CTE = f"""{PITCHES_CTE},
p1 as (select * replace (coalesce(zone, 99) as zone), coalesce(zone, 99) between 1 and 9 as in_grid from p0),
p2 as (select *,
  {_flag(_KNOWN)} as has_location,
  case when in_grid then 1 else 0 end as is_in_zone,
  {_known(_IN)} as is_in_strike_zone,
  {_flag(f"pitch_result_code in {_SWING}")} as is_swing,
  {_flag("pitch_result_code in ('S', 'W', 'T')")} as is_whiff,
  {_flag("pitch_result_code = 'C'")} as is_called_strike,
  {_flag("pitch_result_code in ('F', 'L')")} as is_foul,
  {_known(f"pitch_result_code in {_SWING} and {_OUT}")} as is_chase,
  {_known(f"pitch_result_code in {_SWING} and {_IN}")} as is_zone_swing,
  {_known(f"pitch_result_code in ('S', 'W', 'T') and {_IN}")} as is_zone_whiff,
  {_known("abs(plate_x) between 0.65 and 1.0 or abs(plate_z - sz_top) < 0.25 or abs(plate_z - sz_bot) < 0.25")} as is_edge_pitch,
  {_known(f"pitch_result_code = 'C' and {_OUT}")} as is_called_strike_outside_zone,
  {_known(f"pitch_result_code in ('B', '*B') and {_IN}")} as is_ball_inside_zone,
  {_flag("strikes = 2")} as is_two_strike,
  {_flag("pitch_number = 1")} as is_first_pitch,
  case when strikes > balls then 'Ahead' when balls > strikes then 'Behind' else 'Even' end as count_leverage,
  {_complete("is_final_pitch", "result_event_type")} as pa_is_complete
 from p1),
enriched as (select *,
  {_flag("pa_is_complete = 1 and result_is_hit = 1")} as pa_is_hit,
  {_flag("pa_is_complete = 1 and result_event_type = 'home_run'")} as pa_is_home_run,
  {_flag("pa_is_complete = 1 and result_event_type in ('strikeout', 'strikeout_double_play', 'strikeout_triple_play')")} as pa_is_strikeout,
  {_flag("pa_is_complete = 1 and result_event_type in ('walk', 'intent_walk')")} as pa_is_walk,
  {_flag("pa_is_complete = 1 and result_event_type = 'hit_by_pitch'")} as pa_is_hit_by_pitch,
  {_flag(f"pa_is_complete = 1 and result_event_type not in {_NOT_AB}")} as pa_is_at_bat,
  {_bases("pa_is_complete", "result_event_type")} as pa_total_bases,
  case when pa_is_complete = 1 then coalesce(result_rbi, 0) else 0 end as pa_rbi
 from p2)"""
BATTED_CTE = """batted as (select *,
  case when exit_velocity >= 95 then 1 else 0 end as is_hard_hit,
  case when exit_velocity >= 98 and launch_angle between 26 and 30 then 1 else 0 end as is_barrel,
  case when launch_angle between 8 and 32 then 1 else 0 end as is_sweet_spot,
  case trajectory when 'ground_ball' then 'GB' when 'line_drive' then 'LD' when 'fly_ball' then 'FB' when 'popup' then 'PU' else 'UNK' end as trajectory_abbrev,
  case result_event_type when 'single' then 1 when 'double' then 2 when 'triple' then 3 when 'home_run' then 4 else 0 end as total_bases
 from p0 where is_in_play = 1 and exit_velocity is not null)"""


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_pitches_enriched(fr.pitches(spark, sf_dir), dims.dim_zone(spark))


def batted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_batted_balls(fr.pitches(spark, sf_dir))


_ENRICHED_OUT = [
    "event_id", "game_pk", "season", "zone", "zone_region", "has_location", "is_in_zone", "is_in_strike_zone", "is_swing", "is_whiff",
    "is_called_strike", "is_foul", "is_chase", "is_zone_swing", "is_zone_whiff", "is_edge_pitch", "is_called_strike_outside_zone",
    "is_ball_inside_zone", "is_two_strike", "is_first_pitch", "count_leverage", "pa_is_complete", "pa_is_hit", "pa_is_home_run",
    "pa_is_strikeout", "pa_is_walk", "pa_is_hit_by_pitch", "pa_is_at_bat", "pa_total_bases", "pa_rbi",
]
_REGION = (
    "case when zone in (1, 2, 3) then 'Upper' when zone in (4, 6) then 'Middle' when zone = 5 then 'Heart' when zone in (7, 8, 9) then 'Lower' "
    "when zone in (11, 12) then 'Chase-Up' when zone in (13, 14) then 'Chase-Down' when zone = 99 then 'Unknown' end"
)


@query(
    "int_pitches_enriched",
    f"with {ENRICHED_CTE} select {', '.join(f'{_REGION} as zone_region' if c == 'zone_region' else c for c in _ENRICHED_OUT)} from enriched",
)
def q_enriched(spark, sf_dir):
    return enriched(spark, sf_dir).select(*_ENRICHED_OUT)


_PG_SUMS = {
    "balls_in_play": "is_in_play", "strikes": "is_strike", "balls_total": "is_ball", "called_strikes": "is_called_strike", "whiffs": "is_whiff",
    "fouls": "is_foul", "swings": "is_swing", "in_zone_pitches": "is_in_strike_zone", "chases": "is_chase", "zone_swings": "is_zone_swing",
    "zone_whiffs": "is_zone_whiff", "edge_pitches": "is_edge_pitch", "ump_missed_calls_favor_pitcher": "is_called_strike_outside_zone",
    "ump_missed_calls_favor_batter": "is_ball_inside_zone", "first_pitches": "is_first_pitch", "two_strike_pitches": "is_two_strike",
    "batters_faced": "pa_is_complete", "at_bats_against": "pa_is_at_bat", "hits_allowed": "pa_is_hit", "home_runs_allowed": "pa_is_home_run",
    "walks_allowed": "pa_is_walk", "hit_batters": "pa_is_hit_by_pitch", "strikeouts": "pa_is_strikeout",
    "out_of_zone_pitches": "case when is_in_strike_zone = 0 then 1 else 0 end",
    "first_pitch_strikes": "case when is_first_pitch = 1 and is_strike = 1 then 1 else 0 end",
    "two_strike_whiffs": "case when is_two_strike = 1 and is_whiff = 1 then 1 else 0 end",
}


@query(
    "mart_pitcher_game",
    f"""with {ENRICHED_CTE}, g as (
      select game_pk, season, pitcher_id, max(load_id) as load_id, max(pitcher_hand) as pitcher_hand, count(*) as total_pitches,
        {', '.join(isum(x, n) for n, x in _PG_SUMS.items())},
        round(avg(release_speed) + 1e-9, 4) as avg_velo, max(release_speed) as max_velo, min(release_speed) as min_velo,
        round(avg(cast(spin_rate as double)) + 1e-9, 4) as avg_spin_rate, round(avg(pfx_x) + 1e-9, 4) as avg_h_break, round(avg(pfx_z) + 1e-9, 4) as avg_v_break,
        round(avg(extension) + 1e-9, 4) as avg_extension
      from enriched group by game_pk, season, pitcher_id)
    select *, swings - whiffs as contact, {irate('strikes', 'total_pitches', 'strike_pct')}, {irate('whiffs', 'swings', 'whiff_pct')},
      {irate('in_zone_pitches', 'total_pitches', 'zone_pct')}, {irate('chases', 'out_of_zone_pitches', 'chase_pct')},
      {irate('swings - whiffs', 'swings', 'contact_pct')}, {irate('first_pitch_strikes', 'first_pitches', 'first_pitch_strike_pct')},
      {irate('swings', 'total_pitches', 'swing_pct')}, {irate('called_strikes', 'total_pitches', 'csw_pct')},
      {irate('edge_pitches', 'total_pitches', 'edge_pct')}, {irate('strikeouts', 'batters_faced', 'strikeout_pct')},
      {irate('walks_allowed', 'batters_faced', 'walk_pct')}, {irate('hits_allowed', 'at_bats_against', 'batting_avg_against')} from g""",
)
def q_pitcher_game(spark, sf_dir):
    return rounded(marts.mart_pitcher_game(enriched(spark, sf_dir)), prefix="avg_")


_BG_SUMS = {
    "swings": "is_swing", "whiffs": "is_whiff", "chases": "is_chase", "zone_swings": "is_zone_swing", "called_strikes_taken": "is_called_strike",
    "balls_taken": "is_ball", "fouls": "is_foul", "balls_in_play": "is_in_play", "pitches_in_zone": "is_in_strike_zone",
    "first_pitches": "is_first_pitch", "two_strike_pitches": "is_two_strike", "completed_pas": "pa_is_complete", "at_bats": "pa_is_at_bat",
    "hits": "pa_is_hit", "home_runs": "pa_is_home_run", "rbi": "pa_rbi", "walks": "pa_is_walk", "strikeouts": "pa_is_strikeout",
    "hit_by_pitch": "pa_is_hit_by_pitch", "total_bases": "pa_total_bases",
    "out_of_zone_pitches": "case when is_in_strike_zone = 0 then 1 else 0 end",
    "takes_in_zone": "case when is_in_strike_zone = 1 and is_swing = 0 then 1 else 0 end",
    "first_pitch_swings": "case when is_first_pitch = 1 and is_swing = 1 then 1 else 0 end",
    "first_pitch_in_play": "case when is_first_pitch = 1 and is_in_play = 1 then 1 else 0 end",
    "two_strike_whiffs": "case when is_two_strike = 1 and is_whiff = 1 then 1 else 0 end",
    **{o: f"case when pa_is_complete = 1 and result_event_type = '{k}' then 1 else 0 end" for o, k in (("singles", "single"), ("doubles", "double"), ("triples", "triple"), ("sac_flies", "sac_fly"))},
}
_BB_SUMS = {
    "hard_hits": "is_hard_hit", "barrels": "is_barrel", "sweet_spot_events": "is_sweet_spot",
    **{o: f"case when trajectory_abbrev = '{k}' then 1 else 0 end" for o, k in (("ground_balls", "GB"), ("line_drives", "LD"), ("fly_balls", "FB"), ("popups", "PU"))},
}
_LINE_RATES = ", ".join(
    [
        irate("hits", "at_bats", "batting_avg"),
        irate("hits + walks + hit_by_pitch", "at_bats + walks + hit_by_pitch + sac_flies", "on_base_pct"),
        irate("total_bases", "at_bats", "slugging_pct"),
    ]
)


@query(
    "mart_batter_game",
    f"""with {ENRICHED_CTE}, {BATTED_CTE}, p as (
      select game_pk, season, batter_id, max(load_id) as load_id, max(batter_side) as batter_side, count(*) as pitches_seen,
        count(distinct at_bat_index) as plate_appearances, {', '.join(isum(x, n) for n, x in _BG_SUMS.items())}
      from enriched group by game_pk, season, batter_id),
    b as (select game_pk as g, batter_id as bt, count(*) as bbe, round(avg(exit_velocity) + 1e-9, 4) as avg_exit_velo, max(exit_velocity) as max_exit_velo,
        round(avg(launch_angle) + 1e-9, 4) as avg_launch_angle, round(avg(hit_distance) + 1e-9, 4) as avg_hit_distance, max(hit_distance) as max_hit_distance,
        {', '.join(isum(x, '_' + n) for n, x in _BB_SUMS.items())} from batted group by game_pk, batter_id)
    select p.*, coalesce(bbe, 0) as batted_ball_events, avg_exit_velo, max_exit_velo, avg_launch_angle, avg_hit_distance, max_hit_distance,
      {', '.join(f'coalesce(_{n}, 0) as {n}' for n in _BB_SUMS)},
      {irate('swings', 'pitches_seen', 'swing_pct')}, {irate('whiffs', 'swings', 'whiff_pct')}, {irate('chases', 'out_of_zone_pitches', 'chase_pct')},
      {irate('zone_swings', 'pitches_in_zone', 'zone_swing_pct')}, {irate('_hard_hits', 'bbe', 'hard_hit_pct')}, {irate('_barrels', 'bbe', 'barrel_pct')},
      {irate('_ground_balls', 'bbe', 'gb_pct')}, {irate('_line_drives', 'bbe', 'ld_pct')}, {irate('_fly_balls', 'bbe', 'fb_pct')}, {_LINE_RATES}
    from p left join b on p.game_pk = b.g and p.batter_id = b.bt""",
)
def q_batter_game(spark, sf_dir):
    return rounded(marts.mart_batter_game(enriched(spark, sf_dir), batted(spark, sf_dir)), prefix="avg_")


_MU_SUMS = {
    "swings": "is_swing", "whiffs": "is_whiff", "chases": "is_chase", "balls_in_play": "is_in_play", "strikes": "is_strike",
    "balls_total": "is_ball", "in_zone": "is_in_strike_zone", "completed_pas": "pa_is_complete", "at_bats": "pa_is_at_bat", "hits": "pa_is_hit",
    "home_runs": "pa_is_home_run", "strikeouts": "pa_is_strikeout", "walks": "pa_is_walk", "hit_by_pitch": "pa_is_hit_by_pitch",
    "total_bases": "pa_total_bases", "rbi": "pa_rbi",
    "fastballs": "case when pitch_type_code = 'FF' then 1 else 0 end",
    "breaking_balls": "case when pitch_type_code in ('SL', 'CU', 'KC', 'SV', 'ST') then 1 else 0 end",
    "offspeed": "case when pitch_type_code in ('CH', 'FS', 'FO') then 1 else 0 end",
    "out_of_zone_pitches": "case when is_in_strike_zone = 0 then 1 else 0 end",
    "sac_flies": "case when pa_is_complete = 1 and result_event_type = 'sac_fly' then 1 else 0 end",
}


@query(
    "mart_matchups",
    f"""with {ENRICHED_CTE}, {BATTED_CTE}, m as (
      select season, pitcher_id, batter_id, max(load_id) as load_id, count(*) as total_pitches,
        count(distinct concat(game_pk, '-', at_bat_index)) as plate_appearances, {', '.join(isum(x, n) for n, x in _MU_SUMS.items())},
        round(avg(plate_x) + 1e-9, 4) as avg_plate_x, round(avg(plate_z) + 1e-9, 4) as avg_plate_z
      from enriched group by season, pitcher_id, batter_id),
    b as (select season as s, pitcher_id as pi, batter_id as bt, count(*) as bbe, round(avg(exit_velocity) + 1e-9, 4) as avg_exit_velo,
        max(exit_velocity) as max_exit_velo, round(avg(launch_angle) + 1e-9, 4) as avg_launch_angle, {isum('is_hard_hit', '_hard_hits')}, {isum('is_barrel', '_barrels')}
      from batted group by season, pitcher_id, batter_id)
    select m.*, coalesce(bbe, 0) as batted_ball_events, avg_exit_velo, max_exit_velo, avg_launch_angle, coalesce(_hard_hits, 0) as hard_hits,
      coalesce(_barrels, 0) as barrels, {irate('whiffs', 'swings', 'whiff_pct')}, {irate('chases', 'out_of_zone_pitches', 'chase_pct')},
      {irate('strikes', 'total_pitches', 'strike_pct')}, {irate('_hard_hits', 'bbe', 'hard_hit_pct')}, {irate('fastballs', 'total_pitches', 'fastball_pct')},
      {irate('breaking_balls', 'total_pitches', 'breaking_pct')}, {irate('offspeed', 'total_pitches', 'offspeed_pct')}, {_LINE_RATES},
      {irate('strikeouts', 'completed_pas', 'strikeout_pct')}, {irate('walks', 'completed_pas', 'walk_pct')}
    from m left join b on m.season = b.s and m.pitcher_id = b.pi and m.batter_id = b.bt""",
)
def q_matchups(spark, sf_dir):
    return rounded(marts.mart_matchups(enriched(spark, sf_dir), batted(spark, sf_dir)), prefix="avg_")


_AR_SUMS = {
    "swings": "is_swing", "whiffs": "is_whiff", "called_strikes": "is_called_strike", "chases": "is_chase", "in_play": "is_in_play",
    "fouls": "is_foul", "strikes": "is_strike", "in_zone": "is_in_strike_zone", "edge_pitches": "is_edge_pitch",
    "out_of_zone_pitches": "case when is_in_strike_zone = 0 then 1 else 0 end",
}
_AR_AVGS = {
    "avg_velo": "release_speed", "avg_h_break": "pfx_x", "avg_v_break": "pfx_z", "avg_ivb": "break_vertical_induced", "avg_spin_rate": "spin_rate",
    "avg_spin_direction": "spin_direction", "avg_release_x": "release_pos_x", "avg_release_z": "release_pos_z", "avg_extension": "extension",
}


def _arsenal_sql(keys: str, extra: str) -> str:
    return f"""with {ENRICHED_CTE}, g as (
      select {keys}, {extra} 'type ' || pitch_type_code as pitch_type_description,
        case when pitch_type_code in ('FF', 'SI') then 'Fastball' when pitch_type_code in ('SL', 'CU') then 'Breaking'
          when pitch_type_code = 'CH' then 'Offspeed' else 'Other' end as pitch_category,
        max(load_id) as load_id, count(*) as total_thrown, max(release_speed) as max_velo, min(release_speed) as min_velo,
        {', '.join(f'round(avg(cast({x} as double)) + 1e-9, 4) as {n}' for n, x in _AR_AVGS.items())}, {', '.join(isum(x, n) for n, x in _AR_SUMS.items())}
      from enriched where pitch_type_code is not null group by {keys})
    select *, round(cast(total_thrown as double) / sum(total_thrown) over (partition by season, pitcher_id), 3) as usage_pct,
      {irate('whiffs', 'swings', 'whiff_pct')}, {irate('chases', 'out_of_zone_pitches', 'chase_pct')}, {irate('in_zone', 'total_thrown', 'zone_pct')},
      {irate('strikes', 'total_thrown', 'strike_pct')} from g"""


@query("mart_pitcher_arsenal", _arsenal_sql("season, pitcher_id, pitch_type_code", "max(pitcher_name) as pitcher_name,"))
def q_arsenal(spark, sf_dir):
    types = dims.dim_pitch_type(fr.pitches(spark, sf_dir))
    return rounded(marts.mart_pitcher_arsenal(enriched(spark, sf_dir), types), prefix="avg_")


@query("mart_pitcher_arsenal_as_written", _arsenal_sql("season, pitcher_id, pitcher_name, batter_id, batter_name, pitch_type_code", ""))
def q_arsenal_as_written(spark, sf_dir):
    types = dims.dim_pitch_type(fr.pitches(spark, sf_dir))
    return rounded(marts.mart_pitcher_arsenal(enriched(spark, sf_dir), types, grain="as_written"), prefix="avg_")


@query(
    "fact_at_bats",
    f"""with {PITCHES_CTE}, r as (select *, row_number() over (partition by game_pk, at_bat_index, batter_id, season order by pitch_number, event_id) as rf,
        row_number() over (partition by game_pk, at_bat_index, batter_id, season order by pitch_number desc, event_id desc) as rl from p0 where is_pitch = 1),
    a as (select game_pk, season, at_bat_index, batter_id, max(load_id) as load_id,
        max(case when rl = 1 then pitcher_id end) as pitcher_id, max(case when rl = 1 then pitcher_name end) as pitcher_name,
        max(case when rl = 1 then pitcher_hand end) as pitcher_hand, max(case when rf = 1 then pitcher_id end) as first_pitcher_id,
        max(case when rl = 1 then trajectory end) as trajectory, count(distinct pitcher_id) as pitchers_in_ab,
        max(case when rf = 1 then batter_name end) as batter_name, max(case when rf = 1 then batter_side end) as batter_side, count(*) as total_pitches,
        {isum('is_strike', 'strikes_total')}, {isum('is_ball', 'balls_total')}, {isum(_flag("pitch_result_code = 'F'"), 'fouls')},
        {isum(_flag("pitch_result_code in ('S', 'W', 'T')"), 'swinging_strikes')}, {isum(_flag("call_code = 'C'"), 'called_strikes')},
        max(balls) as final_balls, max(strikes) as final_strikes, max(outs_when_up) as outs_when_up, max(is_in_play) as ended_in_play,
        max(is_out) as ended_in_out, round(avg(release_speed) + 1e-9, 4) as avg_pitch_speed, max(release_speed) as max_pitch_speed,
        max(case when is_in_play = 1 then exit_velocity end) as exit_velocity, max(case when is_in_play = 1 then launch_angle end) as launch_angle,
        max(case when is_in_play = 1 then hit_distance end) as hit_distance,
        {', '.join(f'max(case when is_final_pitch = 1 then result_{c} end) as result_{c}' for c in ('event_type', 'event', 'description', 'rbi', 'is_hit'))},
        max(is_final_pitch) as has_final_pitch, min(start_time) as ab_start_time, max(end_time) as ab_end_time
      from r group by game_pk, season, at_bat_index, batter_id),
    c as (select *, {_complete('has_final_pitch', 'result_event_type')} as is_complete_pa from a)
    select *, {_flag('exit_velocity >= 95')} as is_hard_hit, {_flag('total_pitches >= 6')} as is_long_ab,
      {_flag('is_complete_pa = 1 and result_is_hit = 1')} as is_hit, {_flag("is_complete_pa = 1 and result_event_type = 'home_run'")} as is_home_run,
      {_flag("is_complete_pa = 1 and result_event_type = 'strikeout'")} as is_strikeout, {_flag("is_complete_pa = 1 and result_event_type = 'walk'")} as is_walk,
      {_flag(f"is_complete_pa = 1 and result_event_type not in {_NOT_AB}")} as is_at_bat, {_bases('is_complete_pa', 'result_event_type')} as total_bases from c""",
)
def q_at_bats(spark, sf_dir):
    return rounded(facts.fact_at_bats(fr.pitches(spark, sf_dir)), prefix="avg_")


_BB_OUT = [
    "event_id", "game_pk", "season", "pitch_number", "pitcher_id", "batter_id", "exit_velocity", "launch_angle", "hit_distance", "trajectory",
    "is_hard_hit", "is_barrel", "is_sweet_spot", "trajectory_abbrev", "result_event_type", "total_bases",
]


@query("fact_batted_balls", f"with {PITCHES_CTE}, {BATTED_CTE} select {', '.join(_BB_OUT)}, result_is_hit as is_hit from batted")
def q_batted(spark, sf_dir):
    return batted(spark, sf_dir).select(*_BB_OUT, "is_hit")


# ---- games, results, records -------------------------------------------------------------------

_KEY = NULL_KEY_TEXT


def key_sql(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({c} as varchar), '{_KEY}')" for c in cols) + "))"


GAMES_CTE = f"""g0 as ({fr.GAMES_SQL}),
gm as (select game_pk, try_cast(season as int) as season, game_type, game_date as game_datetime, cast(game_date as date) as game_date,
  try_cast(official_date as date) as official_date, status__abstract_game_state as abstract_game_state, status__coded_game_state as coded_game_state,
  status__detailed_state as detailed_state, status__status_code as status_code, teams__home__team__id as home_team_id,
  coalesce(trim(teams__home__team__name), '') as home_team_name, teams__home__score as home_score,
  case when teams__home__score = teams__away__score then 0 else cast(teams__home__is_winner as int) end as home_is_winner,
  teams__away__team__id as away_team_id, coalesce(trim(teams__away__team__name), '') as away_team_name, teams__away__score as away_score,
  case when teams__home__score = teams__away__score then 0 else cast(teams__away__is_winner as int) end as away_is_winner,
  cast(venue__id as varchar) as venue_id, trim(venue__name) as venue_name, double_header, day_night, games_in_series, series_game_number,
  case when teams__home__score = teams__away__score then 1 else cast(is_tie as int) end as is_tie, _load_id as load_id,
  case when teams__home__score > teams__away__score then teams__home__team__id when teams__away__score > teams__home__score then teams__away__team__id end as winning_team_id,
  case when teams__home__score > teams__away__score then teams__away__team__id when teams__away__score > teams__home__score then teams__home__team__id end as losing_team_id,
  teams__home__score - teams__away__score as run_diff, case when status__detailed_state = 'Final' then 1 else 0 end as is_final,
  case game_type when 'R' then 'Regular Season' when 'S' then 'Spring Training' when 'P' then 'Postseason' else 'Other' end as game_type_desc
 from g0 where status__detailed_state not in ('Cancelled', 'Postponed'))"""
_GAMES_OUT = [
    "game_pk", "season", "game_type", "game_datetime", "game_date", "official_date", "abstract_game_state", "coded_game_state", "detailed_state",
    "status_code", "home_team_id", "home_team_name", "home_score", "home_is_winner", "away_team_id", "away_team_name", "away_score",
    "away_is_winner", "venue_id", "venue_name", "double_header", "day_night", "is_tie", "load_id", "winning_team_id", "losing_team_id",
    "run_diff", "is_final", "game_type_desc",
]


@query("dim_games", f"with {GAMES_CTE} select {', '.join(_GAMES_OUT)} from gm")
def q_dim_games(spark, sf_dir):
    return dims.dim_games(fr.games(spark, sf_dir)).select(*_GAMES_OUT)


@query(
    "dim_game_status",
    f"""with g0 as ({fr.GAMES_SQL}), d as (select distinct status__coded_game_state, status__abstract_game_state, status__detailed_state, status__status_code,
      status__abstract_game_code from g0) select {key_sql('status__coded_game_state', 'status__status_code')} as game_status_key, * from d""",
)
def q_dim_game_status(spark, sf_dir):
    return dims.dim_game_status(fr.games(spark, sf_dir))


@query(
    "dim_game_type",
    f"""with g0 as ({fr.GAMES_SQL}), d as (select distinct game_type as game_type_code from g0)
    select {key_sql('game_type_code')} as game_type_key, game_type_code, case game_type_code when 'R' then 'Regular Season' when 'S' then 'Spring Training' end as game_type_name from d""",
)
def q_dim_game_type(spark, sf_dir):
    return dims.dim_game_type(fr.games(spark, sf_dir))


@query(
    "dim_pitch_type",
    f"""with {PITCHES_CTE} select distinct pitch_type_code, pitch_type_description, pitch_trail_color, case when pitch_type_code in ('FF', 'SI') then 'Fastball'
      when pitch_type_code in ('SL', 'CU') then 'Breaking' when pitch_type_code = 'CH' then 'Offspeed' else 'Other' end as pitch_category
    from p0 where pitch_type_code is not null""",
)
def q_dim_pitch_type(spark, sf_dir):
    return dims.dim_pitch_type(fr.pitches(spark, sf_dir))


@query(
    "dim_challenges",
    f"""with {PITCHES_CTE} select {key_sql('game_pk', "strftime(start_time, '%Y-%m-%d %H:%M:%S')", 'event_id')} as challenge_key, game_pk, has_review,
      review_challenge_team_id, review_is_overturned, review_player_name, review_player_id, review_type, start_time, event_id, load_id from p0 where has_review = 1""",
)
def q_dim_challenges(spark, sf_dir):
    return dims.dim_challenges(fr.pitches(spark, sf_dir)).drop("review_player_link")


@query(
    "dim_teams",
    f"""with t as ({fr.TEAMS_SQL}) select {key_sql('id', 'season')} as team_key, id as team_id, name as team_name, league__id as league_id,
      coalesce(league__name, 'Unknown') as league_name, 'Unknown' as location_name, venue__id as venue_id, season from t""",
)
def q_dim_teams(spark, sf_dir):
    return dims.dim_teams(fr.teams(spark, sf_dir)).select("team_key", "team_id", "team_name", "league_id", "league_name", "location_name", "venue_id", "season")


RESULTS_CTE = f"""g0 as ({fr.GAMES_SQL}), det as ({fr.DETAILS_SQL}), tm as ({fr.TEAMS_SQL}),
s0 as (select g.game_pk, try_cast(g.season as int) as season, g.game_type as game_type_desc, try_cast(g.official_date as date) as game_date, g.game_date as game_datetime,
    g.double_header, g.day_night, g.venue__id as venue_id, g.teams__home__team__id as hid, g.teams__home__team__name as hname, g.teams__home__score as hs,
    cast(g.teams__home__is_winner as int) as hw, g.teams__away__team__id as aid, g.teams__away__team__name as aname, g.teams__away__score as "as",
    cast(g.teams__away__is_winner as int) as aw, g.games_in_series, g.series_game_number,
    cast(coalesce(hour(try_strptime(d.first_pitch__v_text, '%H:%M')), hour(d.first_pitch)) as int) as start_hour,
    case when hl.league__id <> al.league__id then 1 else 0 end as is_interleague
  from g0 g left join det d on g.game_pk = d.game_pk left join tm hl on hl.id = g.teams__home__team__id and hl.season = try_cast(g.season as int)
    left join tm al on al.id = g.teams__away__team__id and al.season = try_cast(g.season as int)
  where g.status__abstract_game_state = 'Final' and g.game_type = 'R' and g.status__detailed_state not in ('Postponed', 'Cancelled') and not g.is_tie),
s1 as (select *, cast(sum(case when series_game_number = 1 then 1 else 0 end) over (partition by hid, aid order by game_date, game_datetime, game_pk rows unbounded preceding) as bigint) as series_id from s0),
res as (
  select game_pk, season, game_type_desc, game_date, game_datetime, hid as team_id, hname as team_name, aid as opponent_team_id, aname as opponent_team_name, 1 as is_home,
    venue_id, hs as team_score, "as" as opponent_score, case when hw = 1 then 'W' else 'L' end as result, double_header, day_night, start_hour, is_interleague,
    series_id, games_in_series, series_game_number from s1
  union all
  select game_pk, season, game_type_desc, game_date, game_datetime, aid, aname, hid, hname, 0,
    venue_id, "as", hs, case when aw = 1 then 'W' else 'L' end, double_header, day_night, start_hour, is_interleague, series_id, games_in_series, series_game_number from s1)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_team_game_results(fr.games(spark, sf_dir), fr.details(spark, sf_dir), fr.teams(spark, sf_dir))


@query("int_team_game_results", f"with {RESULTS_CTE} select * from res")
def q_results(spark, sf_dir):
    return results(spark, sf_dir)


def _run(cond: str, keys: str, name: str) -> str:
    return (
        f"cast(sum(case when {cond} then 1 else 0 end) over (partition by {keys} order by game_date, game_datetime, game_pk rows unbounded preceding) as bigint) as {name}"
    )


def _record_sql() -> str:
    parts = []
    for name, keys in intermediate.RECORD_SPLITS.items():
        if name != "season":
            parts += [_run(f"result = '{r}'", ", ".join(keys), f"{w}_to_date_{name}") for r, w in (("W", "wins"), ("L", "losses"))]
    for name, (col, val) in intermediate.SEASON_RECORDS.items():
        parts += [_run(f"{col} = '{val}' and result = '{r}'", "team_id, season", f"{w}_to_date_{name}") for r, w in (("W", "wins"), ("L", "losses"))]
    return ", ".join(parts)


@query("int_team_game_results_to_date", f"with {RESULTS_CTE} select *, {_record_sql()} from res")
def q_records(spark, sf_dir):
    return intermediate.int_team_game_results_to_date(results(spark, sf_dir))


STANDINGS_CTE = f"""{RESULTS_CTE}, st as (select *, case when result = 'W' then 1 else 0 end as is_win, case when result = 'L' then 1 else 0 end as is_loss,
  case when result = 'T' then 1 else 0 end as is_tie from res)"""


@query("dim_team_standings", f"with {STANDINGS_CTE} select * from st")
def q_standings(spark, sf_dir):
    return dims.dim_team_standings(results(spark, sf_dir))


@query(
    "dim_team_standings_by_date",
    f"""with {STANDINGS_CTE}, d as (select team_id, team_name, season, game_date, count(*) as games_played, {isum('is_win', 'wins')}, {isum('is_loss', 'losses')},
      {isum('is_tie', 'ties')} from st group by team_id, team_name, season, game_date)
    select *, {', '.join(f'cast(sum({c}) over (partition by team_id, season order by game_date rows unbounded preceding) as bigint) as {c}_to_date' for c in ('games_played', 'wins', 'losses', 'ties'))} from d""",
)
def q_standings_by_date(spark, sf_dir):
    return dims.dim_team_standings_by_date(dims.dim_team_standings(results(spark, sf_dir)))


# ---- player lines -------------------------------------------------------------------------------

_OUTS = (
    "case when trim(pitching_innings_pitched) = '' or pitching_innings_pitched is null then null "
    "else cast(split_part(pitching_innings_pitched, '.', 1) as int) * 3 "
    "+ case when contains(pitching_innings_pitched, '.') then cast(split_part(pitching_innings_pitched, '.', 2)[1] as int) else 0 end end"
)
LINES_CTE = f"""{GAMES_CTE}, det as ({fr.DETAILS_SQL}), l0 as ({fr.LINES_SQL}),
ln as (select l.game_pk, g.season, g.game_type_desc, g.game_date, g.game_datetime, l.player_id, l.player_name, l.team_id, l.team_name,
    case when l.is_home then g.away_team_id else g.home_team_id end as opponent_team_id,
    case when l.is_home then g.away_team_name else g.home_team_name end as opponent_team_name, cast(l.is_home as int) as is_home,
    coalesce(position_code, 'Unknown') as position_code, coalesce(position_name, 'Unknown') as position_name, coalesce(position_abbreviation, 'Unknown') as position_abbreviation,
    {_OUTS} as pitching_outs_recorded, {', '.join(c for c in dims.LINE_COLUMNS if c != 'pitching_outs_recorded')}, batting_avg as batting_avg_raw,
    pitching_era as pitching_era_raw, cast(coalesce(hour(try_strptime(d.first_pitch__v_text, '%H:%M')), hour(d.first_pitch)) as int) as start_hour, l._load_id as load_id
  from l0 l join gm g on l.game_pk = g.game_pk left join det d on d.game_pk = l.game_pk where g.game_type = 'R' and g.is_final = 1)"""


def player_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = dims.dim_games(fr.games(spark, sf_dir))
    return intermediate.int_player_game_stats(fr.lines(spark, sf_dir), games, fr.details(spark, sf_dir))


@query("int_player_game_stats", f"with {LINES_CTE} select * from ln")
def q_lines(spark, sf_dir):
    return player_lines(spark, sf_dir).drop("first_pitch", "first_pitch__v_text")


_BOX = ", ".join(
    f"cast(sum(case when is_home = {v} then {src} end) as bigint) as {s}_{o}" for s, v in (("home", 1), ("away", 0)) for o, src in intermediate.BOX_COLUMNS.items()
)
BOX_CTE = f"{LINES_CTE}, bx as (select game_pk, {_BOX}, count(*) as player_rows from ln group by game_pk)"


@query("int_team_game_box", f"with {BOX_CTE} select * from bx")
def q_box(spark, sf_dir):
    return intermediate.int_team_game_box(player_lines(spark, sf_dir))


def _td(c: str) -> str:
    return f"cast(sum({c}) over w as bigint) as {c}_to_date"


@query(
    "dim_player_stats_by_date",
    f"""with {LINES_CTE}, d as (select player_id, player_name, team_id, team_name, season, game_date, count(*) as games_played, count(batting_at_bats) as games_batted,
      count(pitching_outs_recorded) as games_pitched, count(fielding_chances) as games_fielded, {', '.join(isum(c, c) for c in dims.LINE_COLUMNS)}
      from ln group by player_id, player_name, team_id, team_name, season, game_date),
    c as (select player_id, player_name, team_id, team_name, season, game_date, games_played,
      {', '.join(_td(c) for c in ['games_played', 'games_batted', 'games_pitched', 'games_fielded', *dims.LINE_COLUMNS])}
      from d window w as (partition by player_id, season order by game_date, team_id, player_name, team_name rows unbounded preceding))
    select *, concat(cast(pitching_outs_recorded_to_date // 3 as varchar), '.', cast(pitching_outs_recorded_to_date % 3 as varchar)) as pitching_innings_pitched_raw,
      case when pitching_outs_recorded_to_date > 0 then cast(round(cast(pitching_earned_runs_to_date * 9.0::double / (pitching_outs_recorded_to_date / 3.0::double) as decimal(28,12)), 2) as double) end as pitching_era_to_date,
      case when fielding_chances_to_date > 0 then round(cast(fielding_putouts_to_date + fielding_assists_to_date as double) / fielding_chances_to_date, 3) end as fielding_pct_to_date,
      case when batting_at_bats_to_date > 0 then round(cast(batting_hits_to_date as double) / batting_at_bats_to_date, 3) end as batting_avg_to_date from c""",
)
def q_stats_by_date(spark, sf_dir):
    out = dims.dim_player_stats_by_date(dims.dim_player_stats(player_lines(spark, sf_dir)))
    # DuckDB's concat skips NULL, so the text is compared in that form.
    text = F.coalesce("pitching_innings_pitched_to_date", F.lit("."))
    return out.withColumn("pitching_innings_pitched_raw", text).drop("pitching_innings_pitched_to_date")


# ---- games fact ---------------------------------------------------------------------------------


_CODES = ["season", "game_type", "venue__id", "venue__name", *[f"status__{c}" for c in ("coded_game_state", "abstract_game_state", "detailed_state", "status_code", "abstract_game_code")]]


def game_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the small dimensions are made of, distinct; all of them start from this one exchange."""
    return fr.games(spark, sf_dir).select(*_CODES).distinct()


def venues(codes: DataFrame) -> DataFrame:
    ids = codes.select(F.col("venue__id").cast("string").alias("venue_id"), "venue__name").distinct()
    extra = ["venue_link", "location_name", "first_year_of_play", "spring_venue_id", "spring_venue_link"]
    return dims.dim_venue(ids.select("venue_id", F.col("venue__name").alias("venue_name"), *[F.lit(None).cast("string").alias(c) for c in extra]))


def season_rows(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    """Seasons seen in the games, with phases at fixed days of the year."""
    years = (game_codes(spark, sf_dir) if codes is None else codes).select(F.col("season").try_cast("int").alias("season")).distinct()
    marks = {
        "spring_start_date": "-02-20", "spring_end_date": "-03-27", "regular_season_start_date": "-03-28", "regular_season_end_date": "-09-30",
        "post_season_start_date": "-10-01", "post_season_end_date": "-11-02", "all_star_date": "-07-12",
    }
    named = {n: F.concat(F.col("season").cast("string"), F.lit(d)) for n, d in marks.items()}
    empty = [c for c in dims.SEASON_COLUMNS if c not in named and c not in ("season", "season_id")]
    return years.select(
        "season", F.col("season").cast("string").alias("season_id"), *[c.alias(n) for n, c in named.items()], *[F.lit(None).cast("string").alias(c) for c in empty]
    )


_LAST_DAY = dt.date(2001, 12, 31)


@query(
    "dim_date",
    f"""with g0 as ({fr.GAMES_SQL}), ss as (select distinct try_cast(season as int) as season from g0),
    d as (select cast(x as date) as date_actual from range(date '1960-01-01', date '2004-01-01', interval 1 day) t(x))
    select cast(strftime(date_actual, '%Y%m%d') as int) as date_key, date_actual, cast(dayofweek(date_actual) + 1 as int) as day_of_week,
      dayname(date_actual) as day_name, cast(day(date_actual) as int) as day_of_month, cast(dayofyear(date_actual) as int) as day_of_year,
      cast((dayofyear(date_actual) + dayofweek(date_trunc('year', date_actual)) - 1) // 7 + 1 as int) as week_of_year, cast(month(date_actual) as int) as month_number,
      monthname(date_actual) as month_name, cast(quarter(date_actual) as int) as quarter, cast(year(date_actual) as int) as year,
      case when dayofweek(date_actual) in (0, 6) then 1 else 0 end as is_weekend, 0 as is_holiday, season as baseball_season,
      case when date_actual between make_date(season, 2, 20) and make_date(season, 3, 27) then 1 else 0 end as is_spring_training,
      case when date_actual between make_date(season, 3, 28) and make_date(season, 9, 30) then 1 else 0 end as is_regular_season,
      case when date_actual between make_date(season, 10, 1) and make_date(season, 11, 2) then 1 else 0 end as is_postseason,
      case when date_actual = make_date(season, 7, 12) then 1 else 0 end as is_all_star
    from d left join ss on date_actual between make_date(season, 2, 20) and make_date(season, 11, 2)""",
)
def q_dim_date(spark, sf_dir):
    return dims.dim_date(spark, season_rows(spark, sf_dir), as_of=_LAST_DAY).drop("created_at", "updated_at")


@query(
    "dim_season",
    f"""with g0 as ({fr.GAMES_SQL}), ss as (select distinct try_cast(season as int) as season from g0)
    select {key_sql('season')} as season_key, season, cast(season as varchar) as season_id, cast(season as varchar) || '-03-28' as regular_season_start_date, 186 as regular_season_days from ss""",
)
def q_dim_season(spark, sf_dir):
    return dims.dim_season(season_rows(spark, sf_dir)).select("season_key", "season", "season_id", "regular_season_start_date", "regular_season_days")


def game_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, codes = fr.games(spark, sf_dir), game_codes(spark, sf_dir)
    det = fr.details(spark, sf_dir)
    missing = {
        c: F.lit(None).cast("bigint" if c.endswith("_id") else "string")
        for c in ("game_duration_minutes", "weather_condition", "weather_temp", "weather_wind", *[f"{r}_pitcher_{k}" for r in ("winning", "losing", "save") for k in ("id", "name")])
    }
    return facts.fact_games(
        dims.dim_games(raw),
        det.withColumns(missing),
        intermediate.int_team_game_box(player_lines(spark, sf_dir)),
        dims.dim_date(spark, season_rows(spark, sf_dir, codes), as_of=_LAST_DAY),
        dims.dim_teams(fr.teams(spark, sf_dir)),
        venues(codes),
        dims.dim_season(season_rows(spark, sf_dir, codes)),
        dims.dim_game_type(codes),
        dims.dim_game_status(codes),
    )


_NO_HIT = "({b}_hits = 0 and {p}_pitching_hits_allowed = 0 and {p}_pitching_outs >= 27)"
_PERFECT = (
    "({b}_hits = 0 and {b}_walks = 0 and {p}_pitching_hits_allowed = 0 and {p}_pitching_walks = 0 and {p}_errors = 0 and {p}_pitching_outs >= 27 "
    "and coalesce({b}_left_on_base, 0) = 0)"
)


def _either(text: str) -> str:
    return f"({text.format(b='home', p='away')} or {text.format(b='away', p='home')})"


_FACT_PLAIN = [
    "home_doubles", "home_triples", "home_home_runs", "home_rbi", "home_stolen_bases", "away_doubles", "away_rbi", "home_pitching_strikeouts",
    "away_pitching_earned_runs", "home_at_bats", "away_at_bats", "home_pitching_outs", "away_pitching_outs", "home_errors", "away_errors",
    "home_pitching_runs_allowed", "away_pitching_runs_allowed",
]
FACT_GAMES_CTE = f"""{BOX_CTE}, tm as ({fr.TEAMS_SQL}),
fg as (select g.game_pk, g.season, cast(strftime(g.game_date, '%Y%m%d') as int) as game_date_key, cast(strftime(g.official_date, '%Y%m%d') as int) as official_date_key,
    case when hk.id is not null then {key_sql("hk.id", "hk.season")} end as home_team_key, case when ak.id is not null then {key_sql("ak.id", "ak.season")} end as away_team_key,
    {key_sql('g.venue_id')} as venue_key, {key_sql('g.season')} as season_key, {key_sql('g.game_type')} as game_type_key, {key_sql('g.coded_game_state', 'g.status_code')} as game_status_key,
    cast(coalesce(home_score, b.home_runs) as bigint) as home_team_runs, cast(coalesce(away_score, b.away_runs) as bigint) as away_team_runs, home_hits as home_team_hits, away_hits as away_team_hits,
    {', '.join('b.' + c for c in _FACT_PLAIN)},
    case when d.home_runs = home_score and d.away_runs = away_score then d.home_left_on_base end as home_left_on_base,
    case when d.home_runs = home_score and d.away_runs = away_score then d.away_left_on_base end as away_left_on_base,
    winning_team_id, losing_team_id, run_diff, is_final, attendance, is_tie, case when b.game_pk is not null then 1 else 0 end as has_box_score,
    case when is_final = 1 and {_either(_NO_HIT)} then 1 else 0 end as is_no_hitter,
    case when is_final = 1 and {_either(_PERFECT)} then 1 else 0 end as is_perfect_game,
    case when is_final = 1 and (coalesce(home_score, b.home_runs) = 0 or coalesce(away_score, b.away_runs) = 0) then 1 else 0 end as is_shutout
  from gm g left join det d on g.game_pk = d.game_pk
    left join bx b on g.game_pk = b.game_pk and (is_final = 0 or home_score is null or away_score is null or (b.home_runs = home_score and b.away_runs = away_score))
    left join tm hk on hk.id = g.home_team_id and hk.season = g.season left join tm ak on ak.id = g.away_team_id and ak.season = g.season)"""
_FACT_OUT = [
    "game_pk", "season", "game_date_key", "official_date_key", "home_team_key", "away_team_key", "venue_key", "season_key", "game_type_key",
    "game_status_key", "home_team_runs", "away_team_runs", "home_team_hits", "away_team_hits", *_FACT_PLAIN, "home_left_on_base",
    "away_left_on_base", "winning_team_id", "losing_team_id", "run_diff", "is_final", "attendance", "is_tie", "has_box_score", "is_no_hitter",
    "is_perfect_game", "is_shutout",
]


@query("fact_games", f"with {FACT_GAMES_CTE} select * from fg")
def q_fact_games(spark, sf_dir):
    return game_fact(spark, sf_dir).select(*_FACT_OUT)


# ---- history dimension, umpires -----------------------------------------------------------------


@query(
    "dim_player_history",
    f"""with r0 as ({fr.ROSTERS_SQL}), tx as ({fr.TRANSACTIONS_SQL}),
    r1 as (select * from (select *, row_number() over (partition by player_id, season order by _load_id desc, _row_id desc) as rn from r0) where rn = 1),
    h as (select *, {key_sql('team_id', 'jersey_number', 'position__code', 'status__code')} as change_hash from r1),
    pv as (select *, lag(change_hash) over w as ph, lag(team_id) over w as pt from h window w as (partition by player_id order by season, _load_id)),
    ch as (select *, case when ph is null or team_id is distinct from pt then 1 else 0 end as arrival from pv where ph is null or change_hash <> ph),
    cd as (select *, coalesce(case when arrival = 1 then (select max(t.effective_date) from tx t where t.player_id = ch.player_id and t.to_team_id = ch.team_id
        and t.effective_date >= make_date(ch.season - 1, 10, 1) and t.effective_date < make_date(ch.season + 1, 1, 1)) end, make_date(season, 1, 1)) as cand from ch),
    mo as (select *, max(cand) over (partition by player_id order by season, _load_id rows unbounded preceding) as effective_date from cd),
    nx as (select *, lead(effective_date) over (partition by player_id order by season, _load_id) as nxt from mo),
    kp as (select * from nx where nxt is null or nxt > effective_date),
    v as (select *, lead(effective_date) over w - 1 as e, cast(row_number() over w as int) as version_number from kp window w as (partition by player_id order by season, _load_id))
    select {key_sql('player_id', 'version_number')} as player_version_key, player_id, full_name, team_id, jersey_number, position__code, season as effective_season,
      change_hash, version_number, effective_date, coalesce(cast(e as date), date '9999-12-31') as end_date, case when e is null then 1 else 0 end as is_current from v""",
)
def q_dim_player(spark, sf_dir):
    out = dims.dim_player(fr.rosters(spark, sf_dir), fr.transactions(spark, sf_dir))
    return out.drop("position__name", "position__type", "position__abbreviation", "status__code", "status_description")


def umpire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Officials from order lines: the supplier of line 1 stands behind the plate, twice in two loads."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.floor(F.col("l_orderkey") / 25).cast("bigint").alias("game_pk"),
        F.when(F.col("l_linenumber") == 1, "Home Plate").otherwise("First Base").alias("official_type"),
        F.col("l_suppkey").alias("official_id"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("bigint").alias("load_id"),
    )


@query(
    "fact_umpire_performance",
    f"""with {ENRICHED_CTE}, u as (select l_orderkey // 25 as game_pk, l_suppkey as official_id, cast(max(year(l_shipdate) * 100 + month(l_shipdate)) as bigint) as load_id from lineitem where l_linenumber = 1 group by 1, 2),
    bz as (select u.game_pk, u.official_id, u.load_id, pe.zone, count(pe.event_id) as n from u left join enriched pe on pe.game_pk = u.game_pk and pe.is_called_strike_outside_zone = 1 group by 1, 2, 3, 4),
    bs as (select game_pk, official_id, max(load_id) as load_id, cast(sum(n) as bigint) as called_strikes_outside_zone, count(distinct zone) as zones_with_bad_calls from bz group by 1, 2),
    wz as (select * from (select *, row_number() over (partition by game_pk, official_id order by n desc, zone) as rn from bz where zone is not null) where rn = 1),
    cs as (select game_pk, count(*) as t, cast(sum(case when review_is_overturned = 1 then 1 else 0 end) as bigint) as o,
        cast(sum(case when review_is_overturned = 0 then 1 else 0 end) as bigint) as k from p0 where has_review = 1 group by 1)
    select {key_sql('bs.game_pk', 'bs.official_id')} as umpire_performance_key, bs.*, wz.zone as worst_zone, wz.n as worst_zone_count, coalesce(t, 0) as total_challenges,
      coalesce(o, 0) as overturned_challenges, coalesce(k, 0) as upheld_challenges, case when coalesce(t, 0) > 0 then round(cast(o as double) / t * 100, 2) end as overturn_rate_pct
    from bs left join wz on wz.game_pk = bs.game_pk and wz.official_id = bs.official_id left join cs on cs.game_pk = bs.game_pk""",
)
def q_umpire(spark, sf_dir):
    p = fr.pitches(spark, sf_dir)
    return facts.fact_umpire_performance(umpire_rows(spark, sf_dir), enriched(spark, sf_dir), dims.dim_challenges(p))
