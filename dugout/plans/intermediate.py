"""Intermediate models: enriched pitches, player lines, team results and running splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.joins import growing, lookup
from ..operators.reshape import stacked_rows
from ..operators.windows import running, session_counter
from ..sources.landing import HIT_EVENTS, LOAD_ID
from .dims import BATTING, FIELDING, LINE_COLUMNS, PITCHING

# Pitch result codes and plate-appearance results by meaning.
SWING_CODES = ("S", "W", "T", "F", "L", "D", "E", "X")
WHIFF_CODES = ("S", "W", "T")
FOUL_CODES = ("F", "L")
BALL_CODES = ("B", "*B")
CALLED_STRIKE_CODE = "C"
NOT_A_PLATE_APPEARANCE_PREFIXES = ("caught_stealing", "pickoff", "stolen_base")
NOT_A_PLATE_APPEARANCE = ("wild_pitch", "passed_ball", "balk", "other_advance", "runner_double_play", "defensive_indiff")
STRIKEOUTS = ("strikeout", "strikeout_double_play", "strikeout_triple_play")
WALKS = ("walk", "intent_walk")
NOT_AN_AT_BAT = (
    "walk", "intent_walk", "hit_by_pitch", "sac_fly", "sac_bunt", "sac_fly_double_play", "sac_bunt_double_play", "catcher_interf",
)
# Half plate width and edge band in feet.
HALF_PLATE = 0.83
EDGE_BAND = (0.65, 1.0)
EDGE_HEIGHT = 0.25


def complete_appearance(final_pitch: Column, result: Column) -> Column:
    """1 when the final pitch ended a plate appearance rather than a running play."""
    running_play = F.lit(False)
    for prefix in NOT_A_PLATE_APPEARANCE_PREFIXES:
        running_play = running_play | result.startswith(prefix)
    return S.flag((final_pitch == 1) & result.isNotNull() & ~running_play & ~result.isin(*NOT_A_PLATE_APPEARANCE))


def appearance_outcomes(complete: Column, result: Column, is_hit: Column, names: dict[str, str]) -> dict[str, Column]:
    """0/1 outcome columns of a plate appearance, by output name."""
    done = complete == 1
    every = {
        "hit": S.flag(done & (is_hit == 1)),
        "home_run": S.flag(done & (result == "home_run")),
        "strikeout": S.flag(done & result.isin(*STRIKEOUTS)),
        "walk": S.flag(done & result.isin(*WALKS)),
        "hit_by_pitch": S.flag(done & (result == "hit_by_pitch")),
        "at_bat": S.flag(done & ~result.isin(*NOT_AN_AT_BAT)),
        "total_bases": F.when(done, total_bases(result)).otherwise(F.lit(0)),
    }
    return {out: every[kind] for kind, out in names.items()}


def total_bases(result: Column) -> Column:
    """1 to 4 for the hits, else 0."""
    bases = F.lit(0)
    for n, kind in reversed(list(enumerate(HIT_EVENTS, 1))):
        bases = F.when(result == kind, n).otherwise(bases)
    return bases


# Stage columns passed on.
_PASSED = [
    "event_id", "load_id", "game_pk", "at_bat_index", "play_id", "pfx_id", "pitch_number", "event_index", "season", "start_time", "end_time",
    "event_type", "is_pitch", "is_in_play", "pitch_result_code", "pitch_result_description", "call_code", "call_description", "ball_color",
    "is_in_play_detail", "is_strike", "is_ball", "is_out", "balls", "strikes", "outs_when_up", "batter_id", "batter_name", "batter_side",
    "pitcher_id", "pitcher_name", "pitcher_hand", "pitch_type_code", "pitch_type_description", "pitch_trail_color", "release_speed",
    "plate_speed", "plate_time", "extension", "plate_x", "plate_z", "release_pos_x", "release_pos_y", "release_pos_z", "vx0", "vy0", "vz0",
    "ax", "ay", "az", "pfx_x", "pfx_z", "break_angle", "break_length", "break_y", "break_vertical", "break_vertical_induced",
    "break_horizontal", "spin_rate", "spin_direction", "zone", "sz_top", "sz_bot", "sz_width", "sz_depth", "pitch_type_confidence",
    "exit_velocity", "launch_angle", "hit_distance", "has_review", "result_event_type", "result_event", "result_description", "result_rbi",
    "result_is_hit", "is_final_pitch",
]


def int_pitches_enriched(pitches: DataFrame, zones: DataFrame) -> DataFrame:
    """Pitch flags. Flags about the zone are NULL where tracking missed the pitch.

    Columns that a source does not have are left out, so thin sources work too.
    """
    have = set(pitches.columns)
    p = pitches.select(*[c for c in _PASSED if c in have])
    p = p.withColumns({"zone": F.coalesce("zone", F.lit(99)), "result_is_hit": F.col("result_is_hit").cast("int"), "is_final_pitch": F.col("is_final_pitch").cast("int")})
    x, z, top, bot = (F.col(c) for c in ("plate_x", "plate_z", "sz_top", "sz_bot"))
    code, result = F.col("pitch_result_code"), F.col("result_event_type")
    j = lookup(
        p, zones, {"zone_id": "zone"}, {"zone_description": "zone_description", "zone_region": "zone_region", "_in_zone": "is_in_zone"}
    )
    # Shared predicates become columns of their own: each is computed once per pitch and
    # the flag expressions stay small.
    j = j.withColumns(
        {
            "has_location": S.flag(x.isNotNull() & z.isNotNull() & top.isNotNull() & bot.isNotNull()),
            "_inside": x.between(-HALF_PLATE, HALF_PLATE) & z.between(bot, top),
            "_edge": F.abs(x).between(*EDGE_BAND) | (F.abs(z - top) < EDGE_HEIGHT) | (F.abs(z - bot) < EDGE_HEIGHT),
            "is_swing": S.flag(code.isin(*SWING_CODES)),
            "is_whiff": S.flag(code.isin(*WHIFF_CODES)),
            "is_called_strike": S.flag(code == CALLED_STRIKE_CODE),
            "is_foul": S.flag(code.isin(*FOUL_CODES)),
            "pa_is_complete": complete_appearance(F.col("is_final_pitch"), result),
        }
    )
    located, inside = F.col("has_location") == 1, F.col("_inside")
    swing, whiff, called = (F.col(c) == 1 for c in ("is_swing", "is_whiff", "is_called_strike"))
    flags = j.withColumns(
        {
            "is_in_zone": F.coalesce("_in_zone", F.lit(0)),
            "is_in_strike_zone": S.known_flag(located, inside),
            "is_chase": S.known_flag(located, swing & ~inside),
            "is_zone_swing": S.known_flag(located, swing & inside),
            "is_zone_whiff": S.known_flag(located, whiff & inside),
            "is_edge_pitch": S.known_flag(located, F.col("_edge")),
            "is_called_strike_outside_zone": S.known_flag(located, called & ~inside),
            "is_ball_inside_zone": S.known_flag(located, code.isin(*BALL_CODES) & inside),
            "is_two_strike": S.flag(F.col("strikes") == 2),
            "is_first_pitch": S.flag(F.col("pitch_number") == 1),
            "count_leverage": F.when(F.col("strikes") > F.col("balls"), "Ahead").when(F.col("balls") > F.col("strikes"), "Behind").otherwise("Even"),
        }
    ).drop("_in_zone", "_inside", "_edge")
    names = {k: f"pa_is_{k}" for k in ("hit", "home_run", "strikeout", "walk", "hit_by_pitch", "at_bat")} | {"total_bases": "pa_total_bases"}
    outcomes = appearance_outcomes(F.col("pa_is_complete"), result, F.col("result_is_hit"), names)
    rbi = F.when(F.col("pa_is_complete") == 1, F.coalesce("result_rbi", F.lit(0))).otherwise(F.lit(0))
    return flags.withColumns({**outcomes, "pa_rbi": rbi})


def _local_start(details: DataFrame) -> DataFrame:
    """Start hour inputs, read through the text variant where it exists."""
    text = F.col("first_pitch__v_text") if "first_pitch__v_text" in details.columns else F.col("first_pitch").cast("string")
    ts = F.col("first_pitch").cast("string").try_cast("timestamp")
    return details.select("game_pk", F.col("first_pitch").alias("first_pitch"), text.alias("first_pitch__v_text"), S.start_hour(text, ts).alias("start_hour"))


def int_player_game_stats(player_game_stats: DataFrame, games: DataFrame, game_details: DataFrame) -> DataFrame:
    """Player lines of final regular-season games, with opponent, outs and start hour."""
    final = games.where((F.col("game_type") == "R") & (F.col("is_final") == 1)).select(
        "game_pk", "season", "game_type_desc", "game_date", "game_datetime", "home_team_id", "home_team_name", "away_team_id", "away_team_name"
    )
    j = player_game_stats.join(growing(final), "game_pk").join(growing(_local_start(game_details)), "game_pk", "left")
    home = F.col("is_home").cast("int") == 1
    lines = [f"pitching_{c}" for c in PITCHING[1:]] + [f"fielding_{c}" for c in FIELDING] + [f"batting_{c}" for c in BATTING]
    return j.select(
        *["game_pk", "season", "game_type_desc", "game_date", "game_datetime", "player_id", "player_name", "team_id", "team_name"],
        F.when(home, F.col("away_team_id")).otherwise(F.col("home_team_id")).alias("opponent_team_id"),
        F.when(home, F.col("away_team_name")).otherwise(F.col("home_team_name")).alias("opponent_team_name"),
        F.col("is_home").cast("int").alias("is_home"),
        *[F.coalesce(c, F.lit("Unknown")).alias(c) for c in ("position_code", "position_name", "position_abbreviation")],
        S.innings_to_outs("pitching_innings_pitched").alias("pitching_outs_recorded"),
        *lines,
        F.col("batting_avg").alias("batting_avg_raw"),
        F.col("pitching_era").alias("pitching_era_raw"),
        *["first_pitch", "first_pitch__v_text", "start_hour"],
        F.col(LOAD_ID).alias("load_id"),
    )


# Box-score column -> player-line column.
BOX_COLUMNS = {
    "runs": "batting_runs", "hits": "batting_hits", "doubles": "batting_doubles", "triples": "batting_triples",
    "home_runs": "batting_home_runs", "rbi": "batting_rbi", "stolen_bases": "batting_stolen_bases", "strikeouts": "batting_strikeouts",
    "walks": "batting_walks", "at_bats": "batting_at_bats", "pitching_strikeouts": "pitching_strikeouts", "pitching_walks": "pitching_walks",
    "pitching_hits_allowed": "pitching_hits_allowed", "pitching_runs_allowed": "pitching_runs_allowed",
    "pitching_earned_runs": "pitching_earned_runs", "pitching_home_runs_allowed": "pitching_home_runs_allowed",
    "pitching_outs": "pitching_outs_recorded", "errors": "fielding_errors",
}


def int_team_game_box(lines: DataFrame) -> DataFrame:
    """Home and away sums of the player lines per game; NULL when a side has no row."""
    sums = [
        F.sum(F.when(F.col("is_home") == side, F.col(src))).alias(f"{name}_{out}")
        for name, side in (("home", 1), ("away", 0))
        for out, src in BOX_COLUMNS.items()
    ]
    return lines.groupBy("game_pk").agg(*sums, F.count(F.lit(1)).alias("player_rows"))


def int_team_game_results(games: DataFrame, game_details: DataFrame, teams: DataFrame) -> DataFrame:
    """Two rows (home, away) per final regular-season game, with a series id.

    The series id counts first games of a series over the whole history of a
    (home, away) pair, so a late game renumbers its pair and nothing else.
    """
    kept = games.where(
        (F.col("status__abstract_game_state") == "Final")
        & (F.col("game_type") == "R")
        & ~F.col("status__detailed_state").isin("Postponed", "Cancelled")
        & (F.col("is_tie").cast("int") != 1)
    ).select(
        "game_pk",
        F.col("season").cast("string").try_cast("int").alias("season"),
        F.col("game_type").alias("game_type_desc"),
        F.col("official_date").cast("string").try_cast("date").alias("game_date"),
        F.col("game_date").alias("game_datetime"),
        *["double_header", "day_night", F.col("venue__id").alias("venue_id")],
        *[F.col(f"teams__{s}__team__id").alias(f"{s}_team_id") for s in ("home", "away")],
        *[F.col(f"teams__{s}__team__name").alias(f"{s}_team_name") for s in ("home", "away")],
        *[F.col(f"teams__{s}__score").alias(f"{s}_score") for s in ("home", "away")],
        *[F.col(f"teams__{s}__is_winner").cast("int").alias(f"{s}_is_winner") for s in ("home", "away")],
        *["games_in_series", "series_game_number"],
    )
    j = kept.join(growing(_local_start(game_details).select("game_pk", "start_hour")), "game_pk", "left")
    for s in ("home", "away"):
        j = lookup(j, teams, {"id": f"{s}_team_id", "season": "season"}, {f"{s}_league": "league__id"}, grows=True)
    starts = F.col("series_game_number") == 1
    pair = ["home_team_id", "away_team_id"]
    j = session_counter(j, pair, ["game_date", "game_datetime", "game_pk"], starts, "series_id")
    crosses = S.flag(F.col("home_league") != F.col("away_league"))

    def side(me: str, other: str, home: int) -> dict[str, Column]:
        return {
            "team_id": F.col(f"{me}_team_id"),
            "team_name": F.col(f"{me}_team_name"),
            "opponent_team_id": F.col(f"{other}_team_id"),
            "opponent_team_name": F.col(f"{other}_team_name"),
            "team_score": F.col(f"{me}_score"),
            "opponent_score": F.col(f"{other}_score"),
            "is_home": F.lit(home),
            "result": F.when(F.col(f"{me}_is_winner") == 1, "W").otherwise("L"),
        }

    j = j.withColumn("is_interleague", crosses)
    keep = [
        "game_pk", "season", "game_type_desc", "game_date", "game_datetime", "double_header", "day_night", "venue_id", "start_hour",
        "is_interleague", "series_id", "games_in_series", "series_game_number",
    ]
    return stacked_rows(j, [side("home", "away", 1), side("away", "home", 0)], keep).select(*RESULT_COLUMNS)


# Result columns in order.
RESULT_COLUMNS = [
    "game_pk", "season", "game_type_desc", "game_date", "game_datetime", "team_id", "team_name", "opponent_team_id", "opponent_team_name",
    "is_home", "venue_id", "team_score", "opponent_score", "result", "double_header", "day_night", "start_hour", "is_interleague",
    "series_id", "games_in_series", "series_game_number",
]
# Split -> keys of its running record.
RECORD_SPLITS = {
    "venue": ["team_id", "season", "venue_id"],
    "opponent": ["team_id", "season", "opponent_team_id", "is_home"],
    "season": ["team_id", "season"],
    "start_hour": ["team_id", "season", "start_hour"],
    "interleague": ["team_id", "season", "is_interleague"],
    "series": ["team_id", "opponent_team_id", "is_home", "series_id"],
    "games_in_series": ["team_id", "season", "games_in_series"],
    "series_game_number": ["team_id", "season", "series_game_number"],
}
# Records kept inside the season split: name -> (column, value).
SEASON_RECORDS = {
    "doubleheader_n": ("double_header", "N"), "doubleheader_y": ("double_header", "Y"), "doubleheader_s": ("double_header", "S"),
    "day_night_day": ("day_night", "day"), "day_night_night": ("day_night", "night"),
}


def int_team_game_results_to_date(results: DataFrame) -> DataFrame:
    """Running win/loss records of nine splits, up to and including each game.

    All splits share ``team_id``, so the rows are shuffled once on it. A team's rows are
    bounded by their grain, one a game.
    """
    wins, losses = S.flag(F.col("result") == "W"), S.flag(F.col("result") == "L")
    order = ["venue", "opponent", *SEASON_RECORDS, "start_hour", "interleague", "series", "games_in_series", "series_game_number"]
    measures = {}
    for name in order:
        if name in SEASON_RECORDS:
            c, v = SEASON_RECORDS[name]
            measures[f"wins_to_date_{name}"] = ("season", "sum", S.flag((F.col(c) == v) & (F.col("result") == "W")))
            measures[f"losses_to_date_{name}"] = ("season", "sum", S.flag((F.col(c) == v) & (F.col("result") == "L")))
        else:
            measures[f"wins_to_date_{name}"] = (name, "sum", wins)
            measures[f"losses_to_date_{name}"] = (name, "sum", losses)
    by = ["game_date", "game_datetime", "game_pk"]
    return running(results.select(*RESULT_COLUMNS), RECORD_SPLITS, by, measures, spread=["team_id"])
