"""Model-shaped frames derived from the given tables, in Spark and as SQL text.

The given tables hold no games, so order lines stand in for pitches and player lines,
orders for games, rosters and transactions, customers for teams. For pitches 25 orders
make a game (about 100 pitches), each order an at-bat, and 100 orders share eight
pitchers and twenty batters, so games, players and groups grow with the tables. Every expression is
row-wise: the frames grow with the tables and add no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.landing import LOAD_ID, ROW_ID
from .registry import table

# One text per column, readable by both engines, so that the stand-ins cannot drift apart.
_EVENT_ID = "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string))"
_CODE = (
    "case (l_partkey + l_linenumber) % 8 when 0 then 'S' when 1 then 'W' when 2 then 'F' when 3 then 'X' when 4 then 'C' "
    "when 5 then 'B' when 6 then '*B' else 'D' end"
)
_RESULT = (
    "case (l_orderkey + l_linenumber) % 12 when 0 then 'single' when 1 then 'double' when 2 then 'triple' when 3 then 'home_run' "
    "when 4 then 'strikeout' when 5 then 'walk' when 6 then 'hit_by_pitch' when 7 then 'sac_fly' when 8 then 'field_out' "
    "when 9 then 'stolen_base_2b' when 10 then 'wild_pitch' else null end"
)
_TYPE = "case l_partkey % 7 when 0 then 'FF' when 1 then 'SL' when 2 then 'CH' when 3 then 'SI' when 4 then 'CU' when 5 then 'XX' else null end"
_TRAJECTORY = "case l_partkey % 5 when 0 then 'ground_ball' when 1 then 'line_drive' when 2 then 'fly_ball' when 3 then 'popup' else 'unknown' end"

_GAME = "cast(floor(l_orderkey / 25) as bigint)"
_CLUB = "cast(floor(l_orderkey / 100) as bigint)"
_PITCHER = f"{_CLUB} * 8 + l_orderkey % 8 + case when l_suppkey % 25 = 1 then 1 else 0 end"
_BATTER = f"{_CLUB} * 20 + l_orderkey % 20"

PITCHES = {
    "event_id": _EVENT_ID,
    "load_id": "{month}",
    "game_pk": _GAME,
    "at_bat_index": "cast(l_orderkey % 25 as int)",
    "pitch_number": "cast(1 + l_partkey % 4 as int)",
    "season": f"cast(1995 + {_GAME} % 7 as int)",
    "start_time": "l_shipdate",
    "is_pitch": "case when l_suppkey % 50 = 0 then 0 else 1 end",
    "is_in_play": "case when (l_partkey + l_linenumber) % 8 = 3 then 1 else 0 end",
    "pitch_result_code": _CODE,
    "call_code": "case when (l_partkey + l_linenumber) % 8 = 4 then 'C' else 'B' end",
    "is_strike": "case when (l_partkey + l_linenumber) % 8 in (0, 1, 2, 4) then 1 else 0 end",
    "is_ball": "case when (l_partkey + l_linenumber) % 8 in (5, 6) then 1 else 0 end",
    "is_out": "case when l_returnflag = 'A' then 1 else 0 end",
    "balls": "cast(l_linenumber % 4 as int)",
    "strikes": "cast(l_partkey % 3 as int)",
    "outs_when_up": "cast(l_suppkey % 3 as int)",
    "batter_id": _BATTER,
    "batter_name": f"concat('B', cast({_BATTER} as string))",
    "batter_side": "case when l_orderkey % 2 = 0 then 'L' else 'R' end",
    "pitcher_id": _PITCHER,
    "pitcher_name": f"concat('P', cast({_PITCHER} as string))",
    "pitcher_hand": "case when l_suppkey % 3 = 0 then 'L' else 'R' end",
    "pitch_type_code": _TYPE,
    "pitch_type_description": f"concat('type ', {_TYPE})",
    "pitch_trail_color": "cast(null as string)",
    "release_speed": "80.0 + l_quantity / 4",
    "extension": "5.0 + l_tax",
    "plate_x": "case when l_partkey % 11 = 0 then null else (l_quantity - 25) / 20 end",
    "plate_z": "1.0 + l_tax * 40",
    "release_pos_x": "l_discount * 10",
    "release_pos_z": "5.0 + l_discount",
    "pfx_x": "l_tax * 100 - 4",
    "pfx_z": "l_discount * 100 - 5",
    "break_vertical_induced": "l_discount * 50",
    "spin_rate": "2000 + l_partkey % 700",
    "spin_direction": "l_suppkey % 360",
    "zone": "case when l_linenumber = 7 then null else cast(l_partkey % 15 as int) end",
    "sz_top": "cast(3.4 as double)",
    "sz_bot": "cast(1.6 as double)",
    "exit_velocity": "case when (l_partkey + l_linenumber) % 8 in (2, 3) and l_suppkey % 5 <> 0 then 60.0 + l_quantity else null end",
    "launch_angle": "cast(l_partkey % 60 - 10 as double)",
    "hit_distance": "cast(l_quantity * 8 as double)",
    "trajectory": _TRAJECTORY,
    "hit_hardness": "case when l_quantity > 40 then 'hard' when l_quantity > 15 then 'medium' else 'soft' end",
    "hit_location": "cast(l_linenumber as string)",
    "hit_coord_x": "l_quantity * 2",
    "hit_coord_y": "l_quantity * 3",
    "has_review": "case when l_partkey % 40 = 0 then 1 else 0 end",
    "review_is_overturned": "case when l_partkey % 40 = 0 then cast(l_suppkey % 2 as int) else null end",
    "review_player_link": "cast(null as string)",
    "review_challenge_team_id": "l_suppkey",
    "review_player_name": "concat('P', cast(l_suppkey as string))",
    "review_player_id": "l_suppkey",
    "review_type": "case when l_suppkey % 2 = 0 then 'MA' else 'MJ' end",
    "end_time": "l_shipdate",
    "result_event_type": _RESULT,
    "result_event": _RESULT,
    "result_description": "l_linestatus",
    "result_rbi": "case when l_linenumber = 1 then null else cast(l_linenumber % 4 as int) end",
    "result_is_hit": "case when (l_orderkey + l_linenumber) % 12 < 4 then 1 else 0 end",
    "is_final_pitch": "case when l_partkey % 3 = 0 then 1 else 0 end",
}

_TOTAL = "cast(floor(o_totalprice) as bigint)"
GAMES = {
    "game_pk": "o_orderkey",
    "season": "{year_text}",
    "game_type": "case o_orderstatus when 'P' then 'S' else 'R' end",
    "game_date": "o_orderdate",
    "official_date": "{day_text}",
    "status__abstract_game_state": "case when o_orderkey % 50 = 0 then 'Live' else 'Final' end",
    "status__abstract_game_code": "case when o_orderkey % 50 = 0 then 'L' else 'F' end",
    "status__coded_game_state": "case when o_orderkey % 50 = 0 then 'I' else 'F' end",
    "status__detailed_state": "case when o_orderkey % 50 = 0 then 'In Progress' when o_orderkey % 41 = 0 then 'Postponed' else 'Final' end",
    "status__status_code": "case when o_orderkey % 50 = 0 then 'I' else 'F' end",
    "status__start_time_tbd": "o_orderkey % 9 = 0",
    "teams__home__team__id": "o_custkey",
    "teams__home__team__name": "concat('Team ', cast(o_custkey as string))",
    "teams__home__score": f"cast({_TOTAL} % 9 as int)",
    "teams__home__is_winner": f"{_TOTAL} % 9 > o_orderkey % 7",
    "teams__away__team__id": "o_custkey + 1 + o_orderkey % 5",
    "teams__away__team__name": "concat('Team ', cast(o_custkey + 1 + o_orderkey % 5 as string))",
    "teams__away__score": "cast(o_orderkey % 7 as int)",
    "teams__away__is_winner": f"{_TOTAL} % 9 < o_orderkey % 7",
    "venue__id": "o_custkey % 40",
    "venue__name": "concat('  Park ', cast(o_custkey % 40 as string))",
    "game_number": "1",
    "double_header": "case o_orderpriority when '1-URGENT' then 'Y' when '2-HIGH' then 'S' else 'N' end",
    "day_night": "case when o_orderkey % 3 = 0 then 'day' else 'night' end",
    "scheduled_innings": "9",
    "games_in_series": "cast(3 + o_orderkey % 2 as int)",
    "series_game_number": "cast(1 + o_orderkey % 3 as int)",
    "series_description": "cast(null as string)",
    "is_tie": "o_orderkey % 60 = 1",
    "public_facing": "true",
    LOAD_ID: "{month}",
    ROW_ID: "concat('g', cast(o_orderkey as string))",
}

DETAILS = {
    "game_pk": "o_orderkey",
    "first_pitch": "o_orderdate",
    "first_pitch__v_text": (
        "case when o_orderkey % 4 = 0 then null when o_orderkey % 4 = 1 then 'late' else concat(cast(10 + o_orderkey % 12 as string), ':05') end"
    ),
    "attendance": "case when o_orderkey % 6 = 0 then null else cast(floor(o_totalprice / 10) as int) end",
    "home_runs": f"cast({_TOTAL} % 9 as int)",
    "away_runs": "cast(o_orderkey % 7 as int)",
    "home_left_on_base": "cast(o_orderkey % 10 as int)",
    "away_left_on_base": "cast(o_custkey % 10 as int)",
}

LINES = {
    "game_pk": "l_orderkey",
    "player_id": "l_partkey",
    "player_name": "concat('B', cast(l_partkey as string))",
    "team_id": "l_suppkey",
    "team_name": "concat('Team ', cast(l_suppkey as string))",
    "is_home": "l_linenumber % 2 = 1",
    "position_code": "case when l_partkey % 10 = 0 then null else cast(l_partkey % 10 as string) end",
    "position_name": "cast(null as string)",
    "position_abbreviation": "cast(null as string)",
    "pitching_innings_pitched": (
        "case when l_linenumber = 1 then null when l_linenumber = 2 then ' ' when l_linenumber = 3 then cast(l_partkey % 9 as string) "
        "else concat(cast(l_partkey % 9 as string), '.', cast(l_suppkey % 3 as string)) end"
    ),
    "pitching_hits_allowed": "cast(l_partkey % 6 as int)",
    "pitching_runs_allowed": "cast(l_partkey % 4 as int)",
    "pitching_earned_runs": "cast(l_partkey % 3 as int)",
    "pitching_walks": "cast(l_suppkey % 4 as int)",
    "pitching_strikeouts": "cast(l_suppkey % 8 as int)",
    "pitching_home_runs_allowed": "cast(l_partkey % 2 as int)",
    "fielding_putouts": "cast(l_partkey % 5 as int)",
    "fielding_assists": "cast(l_suppkey % 3 as int)",
    "fielding_errors": "cast(l_linenumber % 2 as int)",
    "fielding_chances": "cast(l_partkey % 5 + l_suppkey % 3 + l_linenumber % 2 as int)",
    "batting_at_bats": "case when l_linenumber = 6 then null else cast(l_quantity as int) % 6 end",
    "batting_runs": "cast(l_partkey % 3 as int)",
    "batting_hits": "cast(l_quantity as int) % 4",
    "batting_doubles": "cast(l_partkey % 2 as int)",
    "batting_triples": "0",
    "batting_home_runs": "cast(l_suppkey % 2 as int)",
    "batting_rbi": "cast(l_suppkey % 5 as int)",
    "batting_walks": "cast(l_linenumber % 3 as int)",
    "batting_strikeouts": "cast(l_partkey % 4 as int)",
    "batting_stolen_bases": "0",
    "batting_left_on_base": "cast(l_partkey % 7 as int)",
    "batting_avg": "'.250'",
    "pitching_era": "'3.00'",
    LOAD_ID: "{month}",
}

ROSTERS = {
    "player_id": "o_custkey",
    "full_name": "concat('B', cast(o_custkey as string))",
    "team_id": "o_orderstatus",
    "jersey_number": "cast(o_orderkey % 2 as string)",
    "position__code": "case when o_orderkey % 10 = 0 then null else 'P' end",
    "position__name": "cast(null as string)",
    "position__type": "cast(null as string)",
    "position__abbreviation": "cast(null as string)",
    "status__code": "'A'",
    "status_description": "'Active'",
    "season": "{year}",
    LOAD_ID: "{day_text}",
    ROW_ID: "cast(1000000000000 + o_orderkey as string)",
}

TRANSACTIONS = {
    "player_id": "o_custkey",
    "to_team_id": "o_orderstatus",
    "effective_date": "cast(o_orderdate as date)",
}

TEAMS = {
    "id": "c_custkey",
    "name": "c_name",
    "league__id": "cast(100 + c_nationkey % 2 as bigint)",
    "league__name": "case when c_nationkey % 5 = 0 then null else c_mktsegment end",
    "venue__id": "c_custkey % 40",
}

_DATES = {
    "month": {"spark": "cast(year({0}) * 100 + month({0}) as bigint)", "sql": "cast(year({0}) * 100 + month({0}) as bigint)"},
    "year": {"spark": "year({0})", "sql": "cast(year({0}) as int)"},
    "year_text": {"spark": "cast(year({0}) as string)", "sql": "cast(year({0}) as varchar)"},
    "day_text": {"spark": "date_format({0}, 'yyyy-MM-dd')", "sql": "strftime({0}, '%Y-%m-%d')"},
}


def _texts(columns: dict[str, str], date_col: str, engine: str) -> dict[str, str]:
    fill = {k: v[engine].format(date_col) for k, v in _DATES.items()}
    return {n: t.format(**fill) if "{" in t else t for n, t in columns.items()}


def _frame(df: DataFrame, columns: dict[str, str], date_col: str) -> DataFrame:
    return df.select(*[F.expr(t).alias(n) for n, t in _texts(columns, date_col, "spark").items()])


def _sql(columns: dict[str, str], source: str, date_col: str) -> str:
    body = ",\n  ".join(f"{t} as {n}" for n, t in _texts(columns, date_col, "sql").items())
    return f"select {body} from {source}"


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "lineitem"), PITCHES, "l_shipdate")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "orders"), GAMES, "o_orderdate")


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "orders"), DETAILS, "o_orderdate")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "lineitem"), LINES, "l_shipdate")


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "orders"), ROSTERS, "o_orderdate")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "orders"), TRANSACTIONS, "o_orderdate")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as teams, once per season of the order years."""
    one = _frame(table(spark, sf_dir, "customer"), TEAMS, "")
    return one.select("*", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("season"))


PITCHES_SQL = _sql(PITCHES, "lineitem", "l_shipdate")
GAMES_SQL = _sql(GAMES, "orders", "o_orderdate")
DETAILS_SQL = _sql(DETAILS, "orders", "o_orderdate")
LINES_SQL = _sql(LINES, "lineitem", "l_shipdate")
ROSTERS_SQL = _sql(ROSTERS, "orders", "o_orderdate")
TRANSACTIONS_SQL = _sql(TRANSACTIONS, "orders", "o_orderdate")
TEAMS_SQL = f"select t.*, cast(s as int) as season from ({_sql(TEAMS, 'customer', '')}) t, range(1995, 2002) r(s)"
