"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.joins import conditional_lookup, growing, lookup, version_at
from ..operators.windows import dedup_latest, first_last
from ..sources.landing import LOAD_ID, ROW_ID
from .dims import draft_year_text, latest_draft_picks
from .intermediate import WHIFF_CODES, appearance_outcomes, complete_appearance, total_bases

# Batted-ball thresholds (mph, degrees) and trajectory short names.
HARD_HIT = 95.0
BARREL_SPEED = 98.0
BARREL_ANGLES = (26, 30)
SWEET_SPOT = (8, 32)
TRAJECTORIES = {"ground_ball": "GB", "line_drive": "LD", "fly_ball": "FB", "popup": "PU"}
LONG_AT_BAT = 6
FULL_GAME_OUTS = 27


def fact_at_bats(pitches: DataFrame) -> DataFrame:
    """One row per (game, at-bat, batter): one aggregation after one exchange of the pitches.

    An at-bat is a few pitches, and its partial results (with the pitchers, to be counted once) are
    wider than they are: the pitches are dealt by at-bat instead of combined before the exchange.

    The last pitch names the pitcher, the first names the batter; contact values come
    from the in-play pitch and the result from the final pitch.
    """
    grain = ["game_pk", "season", "at_bat_index", "batter_id"]
    p = pitches.where(F.col("is_pitch") == 1).repartition(*grain)
    in_play, final = F.col("is_in_play").cast("int") == 1, F.col("is_final_pitch").cast("int") == 1
    first, last = first_last(
        ["pitch_number", "event_id"],
        {"first_pitcher_id": "pitcher_id", "batter_name": "batter_name", "batter_side": "batter_side"},
        {"pitcher_id": "pitcher_id", "pitcher_name": "pitcher_name", "pitcher_hand": "pitcher_hand", "trajectory": "trajectory"},
    )
    a = p.groupBy(*grain).agg(
        F.max("load_id").alias("load_id"),
        first,
        last,
        F.count_distinct("pitcher_id").alias("pitchers_in_ab"),
        F.count(F.lit(1)).alias("total_pitches"),
        F.sum(F.col("is_strike").cast("int")).alias("strikes_total"),
        F.sum(F.col("is_ball").cast("int")).alias("balls_total"),
        F.sum(S.flag(F.col("pitch_result_code") == "F")).alias("fouls"),
        F.sum(S.flag(F.col("pitch_result_code").isin(*WHIFF_CODES))).alias("swinging_strikes"),
        F.sum(S.flag(F.col("call_code") == "C")).alias("called_strikes"),
        F.max("balls").alias("final_balls"),
        F.max("strikes").alias("final_strikes"),
        F.max("outs_when_up").alias("outs_when_up"),
        F.max(F.col("is_in_play").cast("int")).alias("ended_in_play"),
        F.max(F.col("is_out").cast("int")).alias("ended_in_out"),
        F.avg("release_speed").alias("avg_pitch_speed"),
        F.max("release_speed").alias("max_pitch_speed"),
        *[F.max(F.when(in_play, F.col(c))).alias(c) for c in ("exit_velocity", "launch_angle", "hit_distance")],
        *[F.max(F.when(final, F.col(f"result_{c}"))).alias(f"result_{c}") for c in ("event_type", "event", "description", "rbi")],
        F.max(F.when(final, F.col("result_is_hit").cast("int"))).alias("result_is_hit"),
        F.max(F.col("is_final_pitch").cast("int")).alias("has_final_pitch"),
        F.min("start_time").alias("ab_start_time"),
        F.max("end_time").alias("ab_end_time"),
    )
    a = a.select("*", "_first.*", "_last.*").drop("_first", "_last")
    result = F.col("result_event_type")
    a = a.withColumn("is_complete_pa", complete_appearance(F.col("has_final_pitch"), result))
    names = {k: f"is_{k}" for k in ("hit", "home_run", "strikeout", "walk", "at_bat")} | {"total_bases": "total_bases"}
    return a.withColumns(
        {
            "is_hard_hit": S.flag(F.col("exit_velocity") >= HARD_HIT),
            "is_long_ab": S.flag(F.col("total_pitches") >= LONG_AT_BAT),
            **appearance_outcomes(F.col("is_complete_pa"), result, F.col("result_is_hit"), names),
        }
    )


# Pitch columns kept for batted balls.
_BATTED = [
    "event_id", "game_pk", "season", "at_bat_index", "pitch_number", "load_id", "pitcher_id", "batter_id", "pitch_type_code", "batter_side",
    "pitcher_hand", "balls", "strikes", "outs_when_up", "exit_velocity", "launch_angle", "hit_distance", "trajectory", "hit_hardness",
    "hit_location", "hit_coord_x", "hit_coord_y", "release_speed", "plate_x", "plate_z", "pitch_type_description",
]


def fact_batted_balls(pitches: DataFrame) -> DataFrame:
    """Balls in play with a measured exit speed."""
    b = pitches.where((F.col("is_in_play") == 1) & F.col("exit_velocity").isNotNull())
    have = set(b.columns)
    speed, angle = F.col("exit_velocity"), F.col("launch_angle")
    return b.select(
        *[c for c in _BATTED if c in have],
        S.flag(speed >= HARD_HIT).alias("is_hard_hit"),
        S.flag((speed >= BARREL_SPEED) & angle.between(*BARREL_ANGLES)).alias("is_barrel"),
        S.flag(angle.between(*SWEET_SPOT)).alias("is_sweet_spot"),
        S.code_label("trajectory", TRAJECTORIES, "UNK").alias("trajectory_abbrev"),
        "is_out",
        *[f"result_{c}" for c in ("event_type", "event", "description", "rbi") if f"result_{c}" in have],
        F.col("result_is_hit").cast("int").alias("is_hit"),
        total_bases(F.col("result_event_type")).alias("total_bases"),
    )


def fact_draft(draft: DataFrame, dim: DataFrame) -> DataFrame:
    """Measures of each pick, keyed through the cleaned draft year."""
    s = latest_draft_picks(draft).withColumn("_year", draft_year_text())
    keys = dim.select(
        "draft_key", "person_id", F.col("person_draft_year").alias("_year"), F.col("pick_number").alias("_pick"), F.col("round_pick_number").alias("_round_pick")
    )
    cond = (
        (F.col("person__id") == F.col("person_id"))
        & (s["_year"] == keys["_year"])
        & (F.col("pick_number") == F.col("_pick"))
        & (F.col("round_pick_number") == F.col("_round_pick"))
    )
    return s.join(growing(keys), cond).select(
        "draft_key",
        "person__draft_year",
        "person_id",
        *[F.col(c).cast("int").alias(c) for c in ("pick_number", "round_pick_number", "rank")],
        S.money("pick_value").alias("pick_value"),
        S.money("signing_bonus").alias("signing_bonus"),
        F.col("person__current_age").cast("int").alias("current_age"),
    )


def fact_games(
    games: DataFrame,
    details: DataFrame,
    box: DataFrame,
    dates: DataFrame,
    teams: DataFrame,
    venues: DataFrame,
    seasons: DataFrame,
    game_types: DataFrame,
    game_statuses: DataFrame,
) -> DataFrame:
    """One row per game: eight dimension keys, both box-score sides and rare-event flags.

    A box score counts only when its runs agree with the final score (or there is no
    final score to check against).
    """
    d = details.withColumnsRenamed({c: f"gd_{c}" for c in details.columns if c != "game_pk"})
    b = box.withColumnsRenamed({c: f"bx_{c}" for c in box.columns if c != "game_pk"})
    hs, as_ = F.col("home_score"), F.col("away_score")
    agrees = (F.col("bx_home_runs") == hs) & (F.col("bx_away_runs") == as_)
    accept = (F.col("is_final") == 0) | hs.isNull() | as_.isNull() | agrees
    j = conditional_lookup(games.join(growing(d), "game_pk", "left"), b, ["game_pk"], accept)
    j = j.withColumns(
        {
            "_home": F.coalesce(hs, F.col("bx_home_runs")),
            "_away": F.coalesce(as_, F.col("bx_away_runs")),
            "_details_agree": (F.col("gd_home_runs") == hs) & (F.col("gd_away_runs") == as_),
        }
    )
    j = lookup(j, dates, {"date_actual": F.col("game_date").cast("date")}, {"game_date_key": "date_key"})
    j = lookup(j, dates, {"date_actual": "official_date"}, {"official_date_key": "date_key"})
    for side in ("home", "away"):
        j = lookup(j, teams, {"team_id": f"{side}_team_id", "season": "season"}, {f"{side}_team_key": "team_key"}, grows=True)
    j = lookup(j, venues.withColumn("venue_id", F.col("venue_id").cast("string")), {"venue_id": "venue_id"}, {"venue_key": "venue_key"})
    j = lookup(j, seasons, {"season": "season"}, {"season_key": "season_key"})
    j = lookup(j, game_types, {"game_type_code": "game_type"}, {"game_type_key": "game_type_key"})
    states = game_statuses.dropDuplicates(["status__coded_game_state", "status__status_code"])
    j = lookup(j, states, {"status__coded_game_state": "coded_game_state", "status__status_code": "status_code"}, {"game_status_key": "game_status_key"})

    def bx(c: str):
        return F.col(f"bx_{c}")

    final = F.col("is_final") == 1

    def no_hits(bat: str, pitch: str):
        return (bx(f"{bat}_hits") == 0) & (bx(f"{pitch}_pitching_hits_allowed") == 0) & (bx(f"{pitch}_pitching_outs") >= FULL_GAME_OUTS)

    def perfect(bat: str, pitch: str):
        walks = (bx(f"{bat}_walks") == 0) & (bx(f"{pitch}_pitching_walks") == 0)
        return no_hits(bat, pitch) & walks & (bx(f"{pitch}_errors") == 0) & (F.coalesce(f"gd_{bat}_left_on_base", F.lit(0)) == 0)

    bat = ["doubles", "triples", "home_runs", "rbi", "stolen_bases"]
    pitch = ["strikeouts", "walks", "hits_allowed", "earned_runs", "home_runs_allowed"]
    out = [
        *["game_pk", "season", "game_date_key", "official_date_key", "home_team_key", "away_team_key", "venue_key", "season_key"],
        *["game_type_key", "game_status_key"],
        F.col("_home").alias("home_team_runs"),
        F.col("_away").alias("away_team_runs"),
        *[bx(f"{s}_hits").alias(f"{s}_team_hits") for s in ("home", "away")],
        *[bx(f"{s}_pitching_runs_allowed").alias(f"{s}_pitching_runs_allowed") for s in ("home", "away")],
    ]
    for s in ("home", "away"):
        out += [bx(f"{s}_{c}").alias(f"{s}_{c}") for c in bat]
        out += [bx(f"{s}_strikeouts").alias(f"{s}_batting_strikeouts"), bx(f"{s}_walks").alias(f"{s}_batting_walks")]
        out += [F.when(F.col("_details_agree"), F.col(f"gd_{s}_left_on_base")).alias(f"{s}_left_on_base")]
    out += [bx(f"{s}_pitching_{c}").alias(f"{s}_pitching_{c}") for s in ("home", "away") for c in pitch]
    out += [bx(f"{s}_{c}").alias(f"{s}_{c}") for c in ("at_bats", "pitching_outs", "errors") for s in ("home", "away")]
    out += ["winning_team_id", "losing_team_id", "run_diff", "is_final"]
    out += [F.col(f"gd_{r}_pitcher_{c}").alias(f"{r}_pitcher_{c}") for r in ("winning", "losing", "save") for c in ("id", "name")]
    out += [
        F.col(f"gd_{c}").alias(c)
        for c in ("attendance", "game_duration_minutes", "first_pitch", "weather_condition", "weather_temp", "weather_wind")
    ]
    out += [
        S.flag(final & (no_hits("home", "away") | no_hits("away", "home"))).alias("is_no_hitter"),
        S.flag(final & (perfect("home", "away") | perfect("away", "home"))).alias("is_perfect_game"),
        S.flag(final & ((F.col("_home") == 0) | (F.col("_away") == 0))).alias("is_shutout"),
        "is_tie",
        S.flag(F.col("_matched")).alias("has_box_score"),
        "load_id",
        ROW_ID,
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    ]
    return j.select(*out)


# Season-stat column -> payload statistic, by group, with decimal types.
_STAT_BATTING = {
    "age": "age", "games_played": "games_played", "games_started": "games_started", "at_bats": "at_bats", "runs": "runs", "hits": "hits",
    "doubles": "doubles", "triples": "triples", "home_runs": "home_runs", "rbi": "rbi", "stolen_bases": "stolen_bases",
    "caught_stealing": "caught_stealing", "walks": "base_on_balls", "strikeouts": "strike_outs", "batting_average": "avg",
    "on_base_percentage": "obp", "slugging_percentage": "slg", "ops": "ops",
}
_STAT_PITCHING = {
    "wins": "wins", "losses": "losses", "era": "era", "games_finished": "games_finished", "saves": "saves",
    "save_opportunities": "save_opportunities", "holds": "holds", "innings_pitched": "innings_pitched", "hits_per9_inn": "hits_per9_inn",
    "hits_allowed": None, "runs_allowed": None, "earned_runs": "earned_runs", "home_runs_allowed": None, "walks_allowed": None,
    "strikeouts_pitched": "strike_outs", "whip": "whip",
}
_STAT_FIELDING = {
    "games_at_position": "games", "putouts": "put_outs", "assists": "assists", "errors": "errors", "double_plays": "double_plays",
    "fielding_percentage": "fielding",
}
_STAT_DECIMALS = {
    "batting_average": "decimal(5,3)", "on_base_percentage": "decimal(5,3)", "slugging_percentage": "decimal(5,3)", "ops": "decimal(5,3)",
    "era": "decimal(6,2)", "hits_per9_inn": "decimal(6,2)", "whip": "decimal(6,3)", "fielding_percentage": "decimal(5,3)",
}
_STAT_FAMILIES = {
    "batting": ("stat__", "hitting__stat__", "batting_stat__"),
    "pitching": ("stat__", "pitching__stat__", "pitching_stat__"),
    "fielding": ("stat__", "fielding__stat__", "fielding_stat__"),
}


def fact_player_stats(player_stats: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame, valid_on: Column | None = None) -> DataFrame:
    """Season statistics with player, team and season keys.

    The player's key is that of the current version, as written, or, with ``valid_on`` (a day
    of the row, such as the end of its season), of the version valid then. A statistic is
    read from the first of its column families that has it.
    """
    have = set(player_stats.columns)

    def stat(group: str, out: str, name: str | None):
        if name is None:
            return F.lit(None).cast("long").alias(out)
        found = [F.col(p + name) for p in _STAT_FAMILIES[group] if p + name in have]
        c = F.coalesce(*found) if found else F.lit(None).cast("string")
        if out in _STAT_DECIMALS:
            c = c.cast("string").try_cast(_STAT_DECIMALS[out])
        return c.alias(out)

    positions = [F.col(c) for c in ("position__code", "fielding_position__code", "batting_position__code") if c in have]
    j = player_stats
    if valid_on is None:
        j = lookup(j, players.where("is_current = 1"), {"player_id": "player__id"}, {"player_key": "player_version_key"}, grows=True)
    else:
        dated = j.withColumn("_valid_on", valid_on)
        j = version_at(dated, players, {"player_id": "player__id"}, "_valid_on", ("effective_date", "end_date"), {"player_key": "player_version_key"}, [ROW_ID], chunk=F.year("_time"))
    j = lookup(j, teams, {"team_id": "team__id", "season": "season"}, {"team_key": "team_key"}, grows=True)
    j = lookup(j, seasons, {"season": "season"}, {"season_key": "season_key"})
    return j.select(
        *["player_key", "team_key", "season_key", "season"],
        *[stat("batting", o, n) for o, n in _STAT_BATTING.items()],
        *[stat("pitching", o, n) for o, n in _STAT_PITCHING.items()],
        (F.coalesce(*positions) if positions else F.lit(None).cast("string")).alias("position_code"),
        *[stat("fielding", o, n) for o, n in _STAT_FIELDING.items()],
        F.lit(None).cast("double").alias("war"),
        LOAD_ID,
        ROW_ID,
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def fact_umpire_performance(umpires: DataFrame, pitches: DataFrame, challenges: DataFrame) -> DataFrame:
    """Every home-plate umpire with missed calls, worst zone and challenges.

    Missed calls are counted per game and zone before the join, so the pitches are
    shuffled as small partial counts and a clean game still gets its row.
    """
    latest = [F.col("load_id").desc()]
    plate = umpires.where(F.col("official_type") == "Home Plate")
    plate = dedup_latest(plate, ["game_pk", "official_id", "official_type"], latest).select("game_pk", "official_id", "load_id")
    missed = pitches.where(F.col("is_called_strike_outside_zone") == 1)
    by_zone = missed.groupBy("game_pk", "zone").agg(F.count("event_id").alias("n"))
    place = F.when(F.col("zone").isNotNull(), F.struct(F.col("n").alias("n"), (-F.col("zone")).alias("z")))
    by_game = by_zone.groupBy("game_pk").agg(
        F.sum("n").alias("_missed"), F.count("zone").alias("_zones"), F.max(place).alias("_worst")
    )
    reviews = challenges.groupBy("game_pk").agg(
        F.count(F.lit(1)).alias("_total"),
        F.sum(S.flag(F.col("review_is_overturned").cast("int") == 1)).alias("_over"),
        F.sum(S.flag(F.col("review_is_overturned").cast("int") == 0)).alias("_upheld"),
    )
    j = plate.join(growing(by_game), "game_pk", "left").join(growing(reviews), "game_pk", "left")
    zero = F.lit(0).cast("long")
    return j.select(
        S.surrogate_key(["game_pk", "official_id"]).alias("umpire_performance_key"),
        *["game_pk", "official_id", "load_id"],
        F.coalesce("_missed", zero).alias("called_strikes_outside_zone"),
        F.coalesce("_zones", zero).alias("zones_with_bad_calls"),
        (-F.col("_worst.z")).alias("worst_zone"),
        F.col("_worst.n").alias("worst_zone_count"),
        F.coalesce("_total", zero).alias("total_challenges"),
        F.coalesce("_over", zero).alias("overturned_challenges"),
        F.coalesce("_upheld", zero).alias("upheld_challenges"),
        F.round(F.try_divide(F.col("_over").cast("double"), F.nullif(F.col("_total"), zero)) * 100, 2).alias("overturn_rate_pct"),
    )
