"""Stage views: rename raw columns, default names, flags as 0/1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..sources.landing import LOAD_ID, ROW_ID

# Stage column -> raw column of the pitch events.
PITCH_COLUMNS = {
    "event_id": ROW_ID,
    "game_pk": "game_pk",
    "at_bat_index": "at_bat_index",
    "play_id": "play_id",
    "pfx_id": "pfx_id",
    "pitch_number": "pitch_number",
    "event_index": "index",
    "season": "season",
    "load_id": LOAD_ID,
    "start_time": "start_time",
    "end_time": "end_time",
    "event_type": "type",
    "is_pitch": "is_pitch",
    "is_in_play": "is_in_play",
    "result_event_type": "result_event_type",
    "result_event": "result_event",
    "result_description": "result_description",
    "result_rbi": "result_rbi",
    "result_is_hit": "result_is_hit",
    "is_final_pitch": "is_final_pitch",
    "pitch_result_code": "details__code",
    "pitch_result_description": "details__description",
    "call_code": "details__call__code",
    "call_description": "details__call__description",
    "ball_color": "details__ball_color",
    "is_in_play_detail": "details__is_in_play",
    "is_strike": "details__is_strike",
    "is_ball": "details__is_ball",
    "is_out": "details__is_out",
    "balls": "count__balls",
    "strikes": "count__strikes",
    "outs_when_up": "count__outs",
    "batter_id": "batter_id",
    "batter_name": "batter_name",
    "batter_side": "batter_side",
    "pitcher_id": "pitcher_id",
    "pitcher_name": "pitcher_name",
    "pitcher_hand": "pitcher_hand",
    "pitch_type_code": "details__type__code",
    "pitch_type_description": "details__type__description",
    "pitch_trail_color": "details__trail_color",
    "release_speed": "pitch_data__start_speed",
    "plate_speed": "pitch_data__end_speed",
    "plate_time": "pitch_data__plate_time",
    "extension": "pitch_data__extension",
    "plate_x": "pitch_data__coordinates__p_x",
    "plate_z": "pitch_data__coordinates__p_z",
    "release_pos_x": "pitch_data__coordinates__x0",
    "release_pos_y": "pitch_data__coordinates__y0",
    "release_pos_z": "pitch_data__coordinates__z0",
    "vx0": "pitch_data__coordinates__v_x0",
    "vy0": "pitch_data__coordinates__v_y0",
    "vz0": "pitch_data__coordinates__v_z0",
    "ax": "pitch_data__coordinates__a_x",
    "ay": "pitch_data__coordinates__a_y",
    "az": "pitch_data__coordinates__a_z",
    "pfx_x": "pitch_data__coordinates__pfx_x",
    "pfx_z": "pitch_data__coordinates__pfx_z",
    "break_angle": "pitch_data__breaks__break_angle",
    "break_length": "pitch_data__breaks__break_length",
    "break_y": "pitch_data__breaks__break_y",
    "break_vertical": "pitch_data__breaks__break_vertical",
    "break_vertical_induced": "pitch_data__breaks__break_vertical_induced",
    "break_horizontal": "pitch_data__breaks__break_horizontal",
    "spin_rate": "pitch_data__breaks__spin_rate",
    "spin_direction": "pitch_data__breaks__spin_direction",
    "zone": "pitch_data__zone",
    "sz_top": "pitch_data__strike_zone_top",
    "sz_bot": "pitch_data__strike_zone_bottom",
    "sz_width": "pitch_data__strike_zone_width",
    "sz_depth": "pitch_data__strike_zone_depth",
    "pitch_type_confidence": "pitch_data__type_confidence",
    "sz_info_is_strike": "pitch_data__strike_zone_info__is_strike",
    "sz_info_top": "pitch_data__strike_zone_info__strike_zone_top",
    "sz_info_bot": "pitch_data__strike_zone_info__strike_zone_bottom",
    "sz_info_width_inches": "pitch_data__strike_zone_info__width_inches",
    "sz_info_depth_inches": "pitch_data__strike_zone_info__depth_inches",
    "sz_info_edge_distance": "pitch_data__strike_zone_info__edge_distance",
    "baseball_diameter_inches": "pitch_data__strike_zone_info__baseball_diameter_inches",
    "sz_info_plate_x": "pitch_data__strike_zone_info__plate_x",
    "sz_info_plate_y": "pitch_data__strike_zone_info__plate_y",
    "sz_info_plate_z": "pitch_data__strike_zone_info__plate_z",
    "broadcast_x": "pitch_data__coordinates__x",
    "broadcast_y": "pitch_data__coordinates__y",
    "exit_velocity": "hit_data__launch_speed",
    "launch_angle": "hit_data__launch_angle",
    "hit_distance": "hit_data__total_distance",
    "trajectory": "hit_data__trajectory",
    "hit_hardness": "hit_data__hardness",
    "hit_location": "hit_data__location",
    "hit_coord_x": "hit_data__coordinates__coord_x",
    "hit_coord_y": "hit_data__coordinates__coord_y",
    "is_runner_going": "details__runner_going",
    "disengagement_num": "details__disengagement_num",
    "violation_type": "details__violation__type",
    "violation_description": "details__violation__description",
    "violation_player_id": "details__violation__player__id",
    "has_review": "details__has_review",
    "review_is_overturned": "review_details__is_overturned",
    "review_in_progress": "review_details__in_progress",
    "review_type": "review_details__review_type",
    "review_challenge_team_id": "review_details__challenge_team_id",
    "review_player_id": "review_details__player__id",
    "review_player_name": "review_details__player__full_name",
    "review_player_link": "review_details__player__link",
}

# Stage columns whose blanks read 'unknown'.
DEFAULTED = ("batter_name", "pitcher_name", "trajectory")


def _picked(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Renamed projection; a raw column that never arrived is NULL, flags become 0/1."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for new, old in mapping.items():
        c = F.col(f"`{old}`") if old in types else F.lit(None).cast("string")
        if isinstance(types.get(old), T.BooleanType):
            c = c.cast("int")
        out.append((S.text_or(c, "unknown") if new in DEFAULTED else c).alias(new))
    return df.select(*out)


def stg_play_events(play_events: DataFrame) -> DataFrame:
    """Pitches with analysis names."""
    return _picked(play_events, PITCH_COLUMNS)


def stg_player_transactions(player_transactions: DataFrame) -> DataFrame:
    """Transactions with unambiguous date and description names."""
    same = (
        "effective_date", "resolution_date", "type_code", "type_desc", "transaction_category",
        "to_team_id", "to_team_name", "from_team_id", "from_team_name", LOAD_ID, ROW_ID,
    )
    first = {"transaction_id": "transaction_id", "player_id": "player_id", "player_name": "player_name", "transaction_date": "date"}
    return _picked(player_transactions, {**first, "transaction_description": "description", **{c: c for c in same}})


def stg_rosters(rosters: DataFrame) -> DataFrame:
    """Roster rows keyed by player and team."""
    new = {
        "player_id": "person__id", "full_name": "person__full_name", "status_description": "status__description", "team_id": "parent_team_id",
    }
    same = (
        "jersey_number", "position__code", "position__name", "position__type", "position__abbreviation", "status__code",
        "season", "note", LOAD_ID, ROW_ID,
    )
    return _picked(rosters, {**new, **{c: c for c in same}})


def coalesced_family(df: DataFrame, name: str, families: tuple[str, ...]) -> Column:
    """First non-NULL of a column's variants over several prefixes that may be absent."""
    found = [F.col(p + name) for p in families if p + name in df.columns]
    return F.coalesce(*found).alias(name) if found else F.lit(None).cast("string").alias(name)


def stat_view(player_stats: DataFrame, families: tuple[str, ...]) -> DataFrame:
    """One column per statistic over drifting prefixes, e.g. ``("stat__", "hitting__stat__", "batting_stat__")``."""
    names = dict.fromkeys(c[len(p):] for p in families for c in player_stats.columns if c.startswith(p))
    ids = [c for c in ("season", "player__id", "player__full_name", "team__id", "team__name") if c in player_stats.columns]
    return player_stats.select(*ids, *[coalesced_family(player_stats, n, families) for n in names])


def with_variant(df: DataFrame, column: str, cast_to: str) -> DataFrame:
    """Reads a column through its text variant ``<column>__v_text`` where that one parses."""
    variant = f"{column}__v_text"
    if variant not in df.columns:
        return df.withColumn(column, F.col(column).cast(cast_to))
    return df.withColumn(column, F.coalesce(F.col(variant).try_cast(cast_to), F.col(column).cast(cast_to))).drop(variant)
