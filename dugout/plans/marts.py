"""Marts: pitcher and batter games, matchups, arsenals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.windows import share_of_total


def _sum(name: str, out: str) -> Column:
    return F.sum(name).alias(out)


def _count_if(cond: Column, out: str) -> Column:
    return F.sum(S.flag(cond)).alias(out)


def _max_letter(name: str) -> Column:
    """Largest one-letter code of a group, through its code point: a numeric maximum keeps
    the aggregation hash-based, where one over text would need a sort."""
    top = F.max(F.ascii(name))
    return F.when(top == 0, "").otherwise(F.char(top)).alias(name)


def _rates(ratios: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {out: S.rate(n, d) for out, (n, d) in ratios.items()}


def _is(name: str) -> Column:
    return F.col(name) == 1


def mart_pitcher_game(pitches: DataFrame) -> DataFrame:
    """Pitcher performance per game from one aggregation over pitches."""
    sums = {
        "balls_in_play": "is_in_play", "strikes": "is_strike", "balls_total": "is_ball", "called_strikes": "is_called_strike",
        "whiffs": "is_whiff", "fouls": "is_foul", "swings": "is_swing", "in_zone_pitches": "is_in_strike_zone", "chases": "is_chase",
        "zone_swings": "is_zone_swing", "zone_whiffs": "is_zone_whiff", "edge_pitches": "is_edge_pitch",
        "ump_missed_calls_favor_pitcher": "is_called_strike_outside_zone", "ump_missed_calls_favor_batter": "is_ball_inside_zone",
        "first_pitches": "is_first_pitch", "two_strike_pitches": "is_two_strike", "batters_faced": "pa_is_complete",
        "at_bats_against": "pa_is_at_bat", "hits_allowed": "pa_is_hit", "home_runs_allowed": "pa_is_home_run", "walks_allowed": "pa_is_walk",
        "hit_batters": "pa_is_hit_by_pitch", "strikeouts": "pa_is_strikeout",
    }
    g = pitches.groupBy("game_pk", "season", "pitcher_id").agg(
        F.max("load_id").alias("load_id"),
        _max_letter("pitcher_hand"),
        F.count(F.lit(1)).alias("total_pitches"),
        *[_sum(src, out) for out, src in sums.items()],
        _count_if(F.col("is_in_strike_zone") == 0, "out_of_zone_pitches"),
        _count_if(_is("is_first_pitch") & _is("is_strike"), "first_pitch_strikes"),
        _count_if(_is("is_two_strike") & _is("is_whiff"), "two_strike_whiffs"),
        F.avg("release_speed").alias("avg_velo"),
        F.max("release_speed").alias("max_velo"),
        F.min("release_speed").alias("min_velo"),
        F.avg(F.col("spin_rate").cast("double")).alias("avg_spin_rate"),
        F.avg("pfx_x").alias("avg_h_break"),
        F.avg("pfx_z").alias("avg_v_break"),
        F.avg("extension").alias("avg_extension"),
    )
    g = g.withColumn("contact", F.col("swings") - F.col("whiffs"))
    return g.withColumns(
        _rates(
            {
                "strike_pct": ("strikes", "total_pitches"),
                "whiff_pct": ("whiffs", "swings"),
                "zone_pct": ("in_zone_pitches", "total_pitches"),
                "chase_pct": ("chases", "out_of_zone_pitches"),
                "contact_pct": ("contact", "swings"),
                "first_pitch_strike_pct": ("first_pitch_strikes", "first_pitches"),
                "swing_pct": ("swings", "total_pitches"),
                "csw_pct": ("called_strikes", "total_pitches"),
                "edge_pct": ("edge_pitches", "total_pitches"),
                "strikeout_pct": ("strikeouts", "batters_faced"),
                "walk_pct": ("walks_allowed", "batters_faced"),
                "batting_avg_against": ("hits_allowed", "at_bats_against"),
            }
        )
    )


def _contact(batted: DataFrame, keys: list[str], extra: bool) -> DataFrame:
    """Batted-ball aggregates per key."""
    aggs = [
        F.count(F.lit(1)).alias("batted_ball_events"),
        F.avg("exit_velocity").alias("avg_exit_velo"),
        F.max("exit_velocity").alias("max_exit_velo"),
        F.avg("launch_angle").alias("avg_launch_angle"),
        _sum("is_hard_hit", "hard_hits"),
        _sum("is_barrel", "barrels"),
    ]
    if extra:
        kinds = {"ground_balls": "GB", "line_drives": "LD", "fly_balls": "FB", "popups": "PU"}
        aggs += [
            F.avg("hit_distance").alias("avg_hit_distance"),
            F.max("hit_distance").alias("max_hit_distance"),
            _sum("is_sweet_spot", "sweet_spot_events"),
            *[_count_if(F.col("trajectory_abbrev") == k, out) for out, k in kinds.items()],
        ]
    return batted.groupBy(*keys).agg(*aggs)


def _batting_line() -> dict[str, Column]:
    return {
        "batting_avg": S.rate("hits", "at_bats"),
        "on_base_pct": S.on_base_rate("hits", "walks", "hit_by_pitch", "at_bats", "sac_flies"),
        "slugging_pct": S.rate("total_bases", "at_bats"),
    }


def _zero(names: tuple[str, ...]) -> dict[str, Column]:
    return {n: F.coalesce(n, F.lit(0)) for n in names}


def mart_batter_game(pitches: DataFrame, batted: DataFrame) -> DataFrame:
    """Batter performance per game: discipline, contact and box line."""
    sums = {
        "swings": "is_swing", "whiffs": "is_whiff", "chases": "is_chase", "zone_swings": "is_zone_swing",
        "called_strikes_taken": "is_called_strike", "balls_taken": "is_ball", "fouls": "is_foul", "balls_in_play": "is_in_play",
        "pitches_in_zone": "is_in_strike_zone", "first_pitches": "is_first_pitch", "two_strike_pitches": "is_two_strike",
        "completed_pas": "pa_is_complete", "at_bats": "pa_is_at_bat", "hits": "pa_is_hit", "home_runs": "pa_is_home_run", "rbi": "pa_rbi",
        "walks": "pa_is_walk", "strikeouts": "pa_is_strikeout", "hit_by_pitch": "pa_is_hit_by_pitch", "total_bases": "pa_total_bases",
    }
    done = _is("pa_is_complete")
    kinds = {"singles": "single", "doubles": "double", "triples": "triple", "sac_flies": "sac_fly"}
    p = pitches.groupBy("game_pk", "season", "batter_id").agg(
        F.max("load_id").alias("load_id"),
        _max_letter("batter_side"),
        F.count(F.lit(1)).alias("pitches_seen"),
        F.count_distinct("at_bat_index").alias("plate_appearances"),
        *[_sum(src, out) for out, src in sums.items()],
        _count_if(F.col("is_in_strike_zone") == 0, "out_of_zone_pitches"),
        _count_if(_is("is_in_strike_zone") & (F.col("is_swing") == 0), "takes_in_zone"),
        _count_if(_is("is_first_pitch") & _is("is_swing"), "first_pitch_swings"),
        _count_if(_is("is_first_pitch") & _is("is_in_play"), "first_pitch_in_play"),
        _count_if(_is("is_two_strike") & _is("is_whiff"), "two_strike_whiffs"),
        *[_count_if(done & (F.col("result_event_type") == k), out) for out, k in kinds.items()],
    )
    j = p.join(_contact(batted, ["game_pk", "batter_id"], extra=True), ["game_pk", "batter_id"], "left")
    rates = _rates(
        {
            "swing_pct": ("swings", "pitches_seen"),
            "whiff_pct": ("whiffs", "swings"),
            "chase_pct": ("chases", "out_of_zone_pitches"),
            "zone_swing_pct": ("zone_swings", "pitches_in_zone"),
            "hard_hit_pct": ("hard_hits", "batted_ball_events"),
            "barrel_pct": ("barrels", "batted_ball_events"),
            "gb_pct": ("ground_balls", "batted_ball_events"),
            "ld_pct": ("line_drives", "batted_ball_events"),
            "fb_pct": ("fly_balls", "batted_ball_events"),
        }
    )
    counts = ("batted_ball_events", "hard_hits", "barrels", "sweet_spot_events", "ground_balls", "line_drives", "fly_balls", "popups")
    return j.withColumns({**rates, **_batting_line()}).withColumns(_zero(counts))


def mart_matchups(pitches: DataFrame, batted: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Season totals per pitcher and batter.

    ``touched`` limits the work to whole (season, pitcher, batter) groups, for
    incremental refreshes that recompute a group from all its pitches.
    """
    keys = ["season", "pitcher_id", "batter_id"]
    if touched is not None:
        pitches = pitches.join(touched.select(*keys).distinct(), keys, "left_semi")
        batted = batted.join(touched.select(*keys).distinct(), keys, "left_semi")
    sums = {
        "swings": "is_swing", "whiffs": "is_whiff", "chases": "is_chase", "balls_in_play": "is_in_play", "strikes": "is_strike",
        "balls_total": "is_ball", "in_zone": "is_in_strike_zone", "completed_pas": "pa_is_complete", "at_bats": "pa_is_at_bat",
        "hits": "pa_is_hit", "home_runs": "pa_is_home_run", "strikeouts": "pa_is_strikeout", "walks": "pa_is_walk",
        "hit_by_pitch": "pa_is_hit_by_pitch", "total_bases": "pa_total_bases", "rbi": "pa_rbi",
    }
    kinds = {"fastballs": ("FF",), "breaking_balls": ("SL", "CU", "KC", "SV", "ST"), "offspeed": ("CH", "FS", "FO")}
    # NULL parts count as empty text, so a pitch without a game or at-bat still counts.
    appearance = F.concat_ws("-", F.coalesce(F.col("game_pk").cast("string"), F.lit("")), F.coalesce(F.col("at_bat_index").cast("string"), F.lit("")))
    m = pitches.groupBy(*keys).agg(
        F.max("load_id").alias("load_id"),
        F.count(F.lit(1)).alias("total_pitches"),
        F.count_distinct(appearance).alias("plate_appearances"),
        *[_count_if(F.col("pitch_type_code").isin(*codes), out) for out, codes in kinds.items()],
        *[_sum(src, out) for out, src in sums.items()],
        _count_if(F.col("is_in_strike_zone") == 0, "out_of_zone_pitches"),
        F.avg("plate_x").alias("avg_plate_x"),
        F.avg("plate_z").alias("avg_plate_z"),
        _count_if(_is("pa_is_complete") & (F.col("result_event_type") == "sac_fly"), "sac_flies"),
    )
    j = m.join(_contact(batted, keys, extra=False), keys, "left")
    rates = _rates(
        {
            "whiff_pct": ("whiffs", "swings"),
            "chase_pct": ("chases", "out_of_zone_pitches"),
            "strike_pct": ("strikes", "total_pitches"),
            "hard_hit_pct": ("hard_hits", "batted_ball_events"),
            "fastball_pct": ("fastballs", "total_pitches"),
            "breaking_pct": ("breaking_balls", "total_pitches"),
            "offspeed_pct": ("offspeed", "total_pitches"),
            "strikeout_pct": ("strikeouts", "completed_pas"),
            "walk_pct": ("walks", "completed_pas"),
        }
    )
    return j.withColumns({**rates, **_batting_line()}).withColumns(_zero(("batted_ball_events", "hard_hits", "barrels")))


def mart_pitcher_arsenal(pitches: DataFrame, pitch_types: DataFrame, grain: str = "documented") -> DataFrame:
    """Results per pitcher, season and pitch type.

    ``grain="as_written"`` also splits by batter and names, the form existing tables have.
    """
    if grain not in ("documented", "as_written"):
        raise ValueError("grain must be 'documented' or 'as_written'")
    keys = ["season", "pitcher_id", "pitch_type_code"]
    if grain == "as_written":
        keys = ["season", "pitcher_id", "pitcher_name", "batter_id", "batter_name", "pitch_type_code"]
    sums = {
        "swings": "is_swing", "whiffs": "is_whiff", "called_strikes": "is_called_strike", "chases": "is_chase", "in_play": "is_in_play",
        "fouls": "is_foul", "strikes": "is_strike", "in_zone": "is_in_strike_zone", "edge_pitches": "is_edge_pitch",
    }
    avgs = {
        "avg_h_break": "pfx_x", "avg_v_break": "pfx_z", "avg_ivb": "break_vertical_induced", "avg_spin_rate": "spin_rate",
        "avg_spin_direction": "spin_direction", "avg_release_x": "release_pos_x", "avg_release_z": "release_pos_z", "avg_extension": "extension",
    }
    names = [] if grain == "as_written" else [F.max("pitcher_name").alias("pitcher_name")]
    g = pitches.where(F.col("pitch_type_code").isNotNull()).groupBy(*keys).agg(
        *names,
        F.max("load_id").alias("load_id"),
        F.count(F.lit(1)).alias("total_thrown"),
        F.avg("release_speed").alias("avg_velo"),
        F.max("release_speed").alias("max_velo"),
        F.min("release_speed").alias("min_velo"),
        *[F.avg(F.col(src).cast("double")).alias(out) for out, src in avgs.items()],
        *[_sum(src, out) for out, src in sums.items()],
        _count_if(F.col("is_in_strike_zone") == 0, "out_of_zone_pitches"),
    )
    labels = pitch_types.groupBy("pitch_type_code").agg(
        F.max("pitch_type_description").alias("pitch_type_description"), F.max("pitch_category").alias("pitch_category")
    )
    g = g.join(labels, "pitch_type_code", "left")
    g = share_of_total(g, ["season", "pitcher_id"], "total_thrown", "usage_pct")
    return g.withColumns(
        _rates(
            {
                "whiff_pct": ("whiffs", "swings"),
                "chase_pct": ("chases", "out_of_zone_pitches"),
                "zone_pct": ("in_zone", "total_thrown"),
                "strike_pct": ("strikes", "total_thrown"),
            }
        )
    )
