"""Content audits: named reconciliations over the model tables.

An audit has failing rows and a population of the same grain and filters. Audits that
look at one row of one table are declared as labelled checks, so that all of a
table's audits are told in a single scan.

Fixed values: names and kinds of audits, labels of violations, result columns and limits
stand in results and are what users filter by.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.joins import growing
from ..operators.windows import neighbor

Models = dict[str, DataFrame]
c = F.col


@dataclass
class Audit:
    """Failing rows and population as functions of the model tables."""

    name: str
    kind: str
    needs: Sequence[str]
    failing: Callable[[Models], DataFrame]
    population: Callable[[Models], DataFrame]

    @property
    def table(self) -> str:
        return self.needs[0]


@dataclass
class RowAudit:
    """Labelled checks on the rows of one table; a row fails when a label applies."""

    name: str
    kind: str
    table: str
    checks: dict[str, Column]
    keep: Sequence[str]
    within: Column | None = None
    label: str = "violations"
    needs: Sequence[str] = field(default_factory=list)

    def __post_init__(self):
        self.needs = [self.table]

    def inside(self) -> Column:
        """Whether a row belongs to the audit's population."""
        return F.lit(True) if self.within is None else F.coalesce(self.within, F.lit(False))

    def fails(self) -> Column:
        return self.inside() & (S.violations(self.checks) != "")

    def failing(self, m: Models) -> DataFrame:
        df = m[self.table]
        keep = [k for k in self.keep if k in df.columns]
        return df.where(self.inside()).select(*keep, S.violations(self.checks).alias(self.label)).where(c(self.label) != "")

    def population(self, m: Models) -> DataFrame:
        return m[self.table].where(self.inside())


def _confirmed() -> Column:
    def side(bat: str, pitch: str) -> Column:
        return (c(f"{bat}_team_hits") == 0) & (c(f"{pitch}_pitching_hits_allowed") == 0) & (c(f"{pitch}_pitching_outs") >= 27)

    return F.coalesce(side("home", "away") | side("away", "home"), F.lit(False))


def _differs(pairs: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {label: c(a) != c(b) for label, (a, b) in pairs.items()}


def _mirror_pairs() -> dict[str, tuple[str, str]]:
    out = {}
    stats = {
        "hits": ("team_hits", "hits_allowed"), "runs": ("team_runs", "runs_allowed"), "walks": ("batting_walks", "walks"),
        "strikeouts": ("batting_strikeouts", "strikeouts"), "hr": ("home_runs", "home_runs_allowed"),
    }
    for label, (bat, pitch) in stats.items():
        for me, other in (("home", "away"), ("away", "home")):
            out[f"{me}_{label}"] = (f"{me}_{bat}", f"{other}_pitching_{pitch}")
    return out


def _composition() -> dict[str, Column]:
    out = {}
    for s in ("home", "away"):
        out[f"{s}_xbh_gt_hits"] = c(f"{s}_doubles") + c(f"{s}_triples") + c(f"{s}_home_runs") > c(f"{s}_team_hits")
        out[f"{s}_hr_gt_runs"] = c(f"{s}_home_runs") > c(f"{s}_team_runs")
        out[f"{s}_er_gt_runs_allowed"] = c(f"{s}_pitching_earned_runs") > c(f"{s}_pitching_runs_allowed")
        out[f"{s}_hra_gt_hits_allowed"] = c(f"{s}_pitching_home_runs_allowed") > c(f"{s}_pitching_hits_allowed")
    return out


def _outside(col: str, lo: float, hi: float) -> Column:
    return ~c(col).between(lo, hi)


def _or(name: str, value: int) -> Column:
    return F.coalesce(c(name), F.lit(value))


def _final() -> Column:
    return c("is_final") == 1


def _no_tie() -> Column:
    return _or("is_tie", 0) == 0


_KEYS = ("home_team_key", "away_team_key", "venue_key", "season_key", "game_type_key", "game_status_key", "game_date_key", "official_date_key")


def _perfect_side() -> Column:
    def side(s: str) -> Column:
        return (c(f"{s}_team_hits") == 0) & (c(f"{s}_batting_walks") == 0) & (c(f"{s}_team_runs") == 0)

    return F.coalesce(side("home") | side("away"), F.lit(False))

def row_audits() -> list[RowAudit]:
    """Audits that look at one row of one table."""
    return [
        RowAudit(
            "business_logic_no_hitter_flag_consistency", "custom_business_logic", "fact_games",
            {
                "flagged_but_not_confirmed": (c("is_no_hitter") == 1) & ((c("is_final") == 0) | ~_confirmed()),
                "confirmed_but_not_flagged": (c("is_no_hitter") == 0) & _final() & _confirmed(),
            },
            ["game_pk", "is_final", "is_no_hitter", "home_team_hits", "away_pitching_hits_allowed", "away_pitching_outs", "away_team_hits", "home_pitching_hits_allowed", "home_pitching_outs"],
            label="issue",
        ),
        RowAudit(
            "business_logic_shutout_flag_consistency", "custom_business_logic", "fact_games",
            {
                "flagged_but_no_zero_run_side": (c("is_shutout") == 1) & ~((_or("home_team_runs", -1) == 0) | (_or("away_team_runs", -1) == 0)),
                "zero_run_side_not_flagged": (c("is_shutout") == 0) & _final() & ((c("home_team_runs") == 0) | (c("away_team_runs") == 0)),
            },
            ["game_pk", "is_final", "is_shutout", "home_team_runs", "away_team_runs"],
            label="issue",
        ),
        RowAudit(
            "business_logic_run_diff_consistency", "custom_business_logic", "fact_games",
            {"run_diff": (c("run_diff") != c("home_team_runs") - c("away_team_runs")) & (c("run_diff") != c("away_team_runs") - c("home_team_runs"))},
            ["game_pk", "home_team_runs", "away_team_runs", "run_diff"],
            within=c("run_diff").isNotNull() & c("home_team_runs").isNotNull() & c("away_team_runs").isNotNull(),
        ),
        RowAudit(
            "business_logic_perfect_game_implies_no_hitter", "custom_business_logic", "fact_games",
            {
                "not_no_hitter": c("is_no_hitter") == 0,
                "not_shutout": c("is_shutout") == 0,
                "perfect_side_scored_per_schedule_feed": ~_perfect_side(),
            },
            ["game_pk", "season", "home_team_hits", "home_batting_walks", "home_team_runs", "away_team_hits", "away_batting_walks", "away_team_runs"],
            within=c("is_perfect_game") == 1,
        ),
        RowAudit(
            "reconciliation_box_score_batting_vs_pitching", "custom_reconciliation", "fact_games", _differs(_mirror_pairs()),
            ["game_pk", "home_team_hits", "away_pitching_hits_allowed", "away_team_hits", "home_pitching_hits_allowed", "home_team_runs", "away_pitching_runs_allowed", "away_team_runs", "home_pitching_runs_allowed"],
            within=_final() & (c("season") >= 1999) & (c("has_box_score") == 1),
            label="mismatches",
        ),
        RowAudit("business_logic_fact_games_stat_composition", "custom_business_logic", "fact_games", _composition(), ["game_pk"]),
        RowAudit(
            "business_logic_winner_loser_distinct", "custom_business_logic", "fact_games",
            {
                "same_winning_losing_team": c("winning_team_id") == c("losing_team_id"),
                "same_winning_losing_pitcher": c("winning_pitcher_id") == c("losing_pitcher_id"),
                "final_game_missing_winner_or_loser": _final() & _no_tie() & (c("winning_team_id").isNull() | c("losing_team_id").isNull()),
                "tie_has_winner": (c("is_tie") == 1) & c("winning_team_id").isNotNull(),
            },
            ["game_pk", "is_final", "is_tie", "winning_team_id", "losing_team_id", "winning_pitcher_id", "losing_pitcher_id"],
        ),
        RowAudit("integrity_fact_games_dimension_keys", "custom_integrity", "fact_games", {k: c(k).isNull() for k in _KEYS}, ["game_pk", "season", "load_id"], label="null_keys"),
        RowAudit(
            "range_fact_games_values", "custom_range", "fact_games",
            {
                "negative_runs": (c("home_team_runs") < 0) | (c("away_team_runs") < 0),
                "negative_hits": (c("home_team_hits") < 0) | (c("away_team_hits") < 0),
                "attendance_out_of_range": _outside("attendance", 0, 120000),
                "duration_out_of_range": _final() & _outside("game_duration_minutes", 0, 720),
            },
            ["game_pk", "home_team_runs", "away_team_runs", "home_team_hits", "away_team_hits", "attendance", "game_duration_minutes"],
        ),
        RowAudit(
            "business_logic_standings_by_date_identity", "custom_business_logic", "dim_team_standings_by_date",
            {
                "daily_wlt_ne_games": S.safe_add(["wins", "losses", "ties"]) != _or("games_played", 0),
                "to_date_wlt_ne_games": S.safe_add(["wins_to_date", "losses_to_date", "ties_to_date"]) != _or("games_played_to_date", 0),
                "to_date_less_than_daily": c("games_played_to_date") < c("games_played"),
            },
            ["team_id", "season", "game_date", "games_played", "wins", "losses", "ties", "games_played_to_date", "wins_to_date", "losses_to_date", "ties_to_date"],
        ),
        RowAudit(
            "business_logic_player_game_stat_sanity", "custom_business_logic", "int_player_game_stats",
            {
                "hits_gt_at_bats": c("batting_hits") > c("batting_at_bats"),
                "xbh_gt_hits": c("batting_doubles") + c("batting_triples") + c("batting_home_runs") > c("batting_hits"),
                "hr_gt_runs": c("batting_home_runs") > c("batting_runs"),
                "er_gt_runs_allowed": c("pitching_earned_runs") > c("pitching_runs_allowed"),
                "chances_ne_po_a_e": c("fielding_chances") != c("fielding_putouts") + c("fielding_assists") + c("fielding_errors"),
                "negative_values": (c("batting_at_bats") < 0) | (c("batting_hits") < 0) | (c("pitching_outs_recorded") < 0),
            },
            ["game_pk", "player_id", "player_name"],
        ),
        RowAudit(
            "business_logic_dim_season_date_order", "custom_business_logic", "dim_season",
            {
                "regular_start_after_end": c("regular_season_start_date") > c("regular_season_end_date"),
                "post_before_regular_end": c("post_season_start_date") < c("regular_season_end_date"),
                "post_start_after_end": c("post_season_start_date") > c("post_season_end_date"),
                "season_start_after_end": c("season_start_date") > c("season_end_date"),
                "all_star_outside_regular": (c("all_star_date") < c("regular_season_start_date")) | (c("all_star_date") > c("regular_season_end_date")),
            },
            ["season", "regular_season_start_date", "regular_season_end_date", "post_season_start_date", "post_season_end_date", "all_star_date", "season_start_date", "season_end_date"],
        ),
        RowAudit(
            "range_fact_at_bats_values", "custom_range", "fact_at_bats",
            {
                "final_balls": _outside("final_balls", 0, 4),
                "final_strikes": _outside("final_strikes", 0, 3),
                "outs_when_up": _outside("outs_when_up", 0, 2),
                "no_pitches": c("total_pitches") < 1,
                "max_speed_lt_avg": c("max_pitch_speed") < c("avg_pitch_speed"),
                "ends_before_start": c("ab_end_time") < c("ab_start_time"),
            },
            ["game_pk", "at_bat_index", "batter_id", "pitcher_id"],
        ),
        RowAudit(
            "range_fact_batted_balls_values", "custom_range", "fact_batted_balls",
            {
                "exit_velocity": _outside("exit_velocity", 0, 125),
                "launch_angle": _outside("launch_angle", -90, 90),
                "hit_distance": _outside("hit_distance", 0, 550),
                "barrel_not_hard_hit": (c("is_barrel") == 1) & (c("is_hard_hit") == 0),
            },
            ["event_id", "game_pk", "at_bat_index", "pitch_number", "exit_velocity", "launch_angle", "hit_distance", "is_barrel", "is_hard_hit"],
        ),
        RowAudit(
            "business_logic_pitches_enriched_consistency", "custom_business_logic", "int_pitches_enriched",
            {
                "release_speed": _outside("release_speed", 30, 110),
                "plate_speed_gt_release": c("plate_speed") > c("release_speed"),
                "spin_rate": _outside("spin_rate", 0, 4000),
                "balls": _outside("balls", 0, 4),
                "strikes": _outside("strikes", 0, 3),
                "outs_when_up": _outside("outs_when_up", 0, 2),
                "whiff_without_swing": (c("is_whiff") == 1) & (c("is_swing") == 0),
                "called_strike_with_swing": (c("is_called_strike") == 1) & (c("is_swing") == 1),
                "chase_in_zone": (c("is_chase") == 1) & (c("is_in_strike_zone") == 1),
            },
            ["event_id", "game_pk", "at_bat_index", "pitch_number"],
            within=c("is_pitch") == 1,
        ),
        RowAudit(
            "business_logic_umpire_challenge_totals", "custom_business_logic", "fact_umpire_performance",
            {
                "overturned_plus_upheld_ne_total": S.safe_add(["overturned_challenges", "upheld_challenges"]) != _or("total_challenges", 0),
                "overturn_rate_mismatch": (c("total_challenges") > 0)
                & ~(
                    (F.abs(c("overturn_rate_pct") - S.safe_divide(c("overturned_challenges") * 100.0, "total_challenges")) <= 0.1)
                    | (F.abs(c("overturn_rate_pct") - S.safe_divide(c("overturned_challenges") * 1.0, "total_challenges")) <= 0.001)
                ),
            },
            ["game_pk", "official_id", "total_challenges", "overturned_challenges", "upheld_challenges", "overturn_rate_pct"],
        ),
    ]


def _with_schedule(m: Models) -> DataFrame:
    """Games fact with the schedule's team ids and scores."""
    g = m["dim_games"].select("game_pk", "home_team_id", "away_team_id", "home_score", "away_score")
    return m["fact_games"].join(growing(g), "game_pk")


def _winning_population(m: Models) -> DataFrame:
    return _with_schedule(m).where(_final() & _no_tie() & c("home_team_runs").isNotNull() & c("away_team_runs").isNotNull())


def _winning_failing(m: Models) -> DataFrame:
    home, away, won = c("home_team_runs"), c("away_team_runs"), c("winning_team_id")
    bad = ((home > away) & ~won.eqNullSafe(c("home_team_id"))) | ((away > home) & ~won.eqNullSafe(c("away_team_id")))
    return _winning_population(m).where(bad).select("game_pk", "home_team_runs", "away_team_runs", "home_team_id", "away_team_id", "winning_team_id")


def _score_population(m: Models) -> DataFrame:
    d = m["dim_game_details"].select("game_pk", c("home_runs").alias("gd_home_runs"), c("away_runs").alias("gd_away_runs"))
    return m["dim_games"].where("is_final = 1").join(growing(d), "game_pk")


def _score_failing(m: Models) -> DataFrame:
    bad = ~c("home_score").eqNullSafe(c("gd_home_runs")) | ~c("away_score").eqNullSafe(c("gd_away_runs"))
    return _score_population(m).where(bad).select("game_pk", "season", "game_type", "home_score", "gd_home_runs", "away_score", "gd_away_runs")


def _mirrored(m: Models) -> DataFrame:
    """Home rows beside the away row of the same game."""
    s = m["dim_team_standings"]
    cols = ["team_score", "opponent_score", "is_win", "is_loss", "is_tie"]
    away = s.where("is_home = 0").select("game_pk", c("team_id").alias("opponent_team_id"), *[c(x).alias(f"a_{x}") for x in cols])
    return s.where("is_home = 1").join(growing(away), ["game_pk", "opponent_team_id"])


def _mirror_failing(m: Models) -> DataFrame:
    checks = {
        "scores_not_mirrored": (c("team_score") != c("a_opponent_score")) | (c("opponent_score") != c("a_team_score")),
        "results_not_mirrored": (c("is_win") != c("a_is_loss")) | (c("is_loss") != c("a_is_win")) | (c("is_tie") != c("a_is_tie")),
        "home_result_flags_not_exclusive": c("is_win") + c("is_loss") + c("is_tie") != 1,
        "home_win_without_more_runs": (c("is_win") == 1) & (c("team_score") <= c("opponent_score")),
        "away_win_without_more_runs": (c("a_is_win") == 1) & (c("a_team_score") <= c("a_opponent_score")),
    }
    out = _mirrored(m).withColumn("violations", S.violations(checks)).where("violations <> ''")
    return out.select(
        "game_pk", c("team_id").alias("home_team_id"), c("opponent_team_id").alias("away_team_id"), c("team_score").alias("home_score"), c("a_team_score").alias("away_score"),
        c("is_win").alias("home_is_win"), c("a_is_win").alias("away_is_win"), c("is_tie").alias("home_is_tie"), c("a_is_tie").alias("away_is_tie"), "violations",
    )


def _player_totals(m: Models) -> DataFrame:
    """Player sums per (game, team) beside the accepted team box, unpivoted in one scan."""
    players = m["int_player_game_stats"].groupBy("game_pk", "team_id").agg(
        F.sum("batting_hits").alias("player_hits"), F.sum("batting_runs").alias("player_runs"), F.sum("batting_home_runs").alias("player_hr")
    )

    def side(s: str) -> Column:
        cols = {"team_id": f"{s}_team_id", "team_hits": f"{s}_team_hits", "team_runs": f"{s}_team_runs", "team_hr": f"{s}_home_runs"}
        return F.struct(*[c(v).alias(k) for k, v in cols.items()])

    boxes = _with_schedule(m).where(_final() & (c("has_box_score") == 1)).select("game_pk", F.inline(F.array(side("home"), side("away"))))
    return boxes.join(growing(players), ["game_pk", "team_id"])


def _player_totals_failing(m: Models) -> DataFrame:
    bad = F.lit(False)
    for s in ("hits", "runs", "hr"):
        bad = bad | ~c(f"team_{s}").eqNullSafe(c(f"player_{s}"))
    return _player_totals(m).where(bad)


def _rejected(m: Models) -> DataFrame:
    box = m["int_team_game_box"].select("game_pk", "player_rows", c("home_runs").alias("box_home_runs"), c("away_runs").alias("box_away_runs"))
    return _with_schedule(m).where(_final()).join(growing(box), "game_pk")


def _history_failing(m: Models) -> DataFrame:
    """Players without one current version, or with inverted or overlapping ranges."""
    v = neighbor(m["dim_player"], ["player_id"], ["version_number"], {"prev_end": c("end_date")})
    out = v.groupBy("player_id").agg(
        F.count_if(c("is_current") == 1).alias("current_rows"),
        F.count_if(c("end_date") < c("effective_date")).alias("inverted_ranges"),
        F.count_if(c("effective_date") <= c("prev_end")).alias("overlapping_ranges"),
    )
    return out.where("current_rows <> 1 or inverted_ranges > 0 or overlapping_ranges > 0")


def _team_duplicates(m: Models) -> DataFrame:
    t = m["dim_teams"]
    text = lambda x: c(x).cast("string").alias(x)
    none = lambda x: F.lit(None).cast("string").alias(x)
    by_id = t.groupBy("team_id", "season").agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    by_key = t.groupBy("team_key").agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    return by_id.select(F.lit("duplicate_team_id_season").alias("issue"), text("team_id"), text("season"), none("team_key"), "row_count").unionByName(
        by_key.select(F.lit("duplicate_team_key").alias("issue"), none("team_id"), none("season"), "team_key", "row_count")
    )


def _usage(m: Models) -> DataFrame:
    return m["mart_pitcher_arsenal"].groupBy("season", "pitcher_id").agg(F.sum("usage_pct").alias("total_usage_pct"), F.count(F.lit(1)).alias("pitch_types"))


def _seasons_of_events(m: Models) -> DataFrame:
    return m["fact_games"].groupBy("season").agg(F.sum("is_no_hitter").alias("no_hitters"), F.sum("is_perfect_game").alias("perfect_games"))


def table_audits() -> list[Audit]:
    """Audits over groups or several tables."""
    return [
        Audit("business_logic_winning_team_consistency", "custom_business_logic", ["fact_games", "dim_games"], _winning_failing, _winning_population),
        Audit(
            "range_fact_games_rare_event_counts", "custom_range", ["fact_games"],
            lambda m: _seasons_of_events(m).where("no_hitters > 12 or perfect_games > 3"),
            lambda m: m["fact_games"].where(c("season").isNotNull()).select("season").distinct(),
        ),
        Audit("reconciliation_game_details_runs_vs_dim_games_score", "custom_reconciliation", ["dim_game_details", "dim_games"], _score_failing, _score_population),
        Audit(
            "uniqueness_fact_games_game_pk", "custom_uniqueness", ["fact_games"],
            lambda m: m["fact_games"].groupBy("game_pk").agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1 or game_pk is null"),
            lambda m: m["fact_games"].select("game_pk").distinct(),
        ),
        Audit(
            "integrity_team_standings_two_rows_per_game", "custom_integrity", ["dim_team_standings"],
            lambda m: m["dim_team_standings"].groupBy("game_pk").agg(F.count(F.lit(1)).alias("row_count"), F.sum("is_home").alias("home_rows")).where("row_count <> 2 or home_rows <> 1"),
            lambda m: m["dim_team_standings"].select("game_pk").distinct(),
        ),
        Audit("business_logic_team_standings_symmetry", "custom_business_logic", ["dim_team_standings"], _mirror_failing, lambda m: m["dim_team_standings"].where("is_home = 1")),
        Audit("reconciliation_player_batting_vs_team_box", "custom_reconciliation", ["int_player_game_stats", "fact_games", "dim_games"], _player_totals_failing, _player_totals),
        Audit(
            "integrity_fact_games_rejected_box_scores", "custom_integrity", ["fact_games", "dim_games", "int_team_game_box"],
            lambda m: _rejected(m).where("has_box_score = 0").select("game_pk", "season", "player_rows", "home_score", "box_home_runs", "away_score", "box_away_runs"),
            _rejected,
        ),
        Audit("uniqueness_dim_player_one_current_row", "custom_uniqueness", ["dim_player"], _history_failing, lambda m: m["dim_player"].where(c("player_id").isNotNull()).select("player_id").distinct()),
        Audit("uniqueness_dim_teams_team_id_season", "custom_uniqueness", ["dim_teams"], _team_duplicates, lambda m: m["dim_teams"]),
        Audit(
            "business_logic_pitcher_arsenal_usage_total", "custom_business_logic", ["mart_pitcher_arsenal"],
            lambda m: _usage(m).where(~((F.abs(c("total_usage_pct") - 100.0) <= 1.0) | (F.abs(c("total_usage_pct") - 1.0) <= 0.01))),
            _usage,
        ),
    ]



def registry() -> dict[str, Audit | RowAudit]:
    """All audits by name (built on call: columns need a running session)."""
    return {a.name: a for a in [*row_audits(), *table_audits()]}
