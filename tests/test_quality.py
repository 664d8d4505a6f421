from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from dugout.plans import runs, serving
from dugout.quality import audits as A
from dugout.quality import compare as C
from dugout.quality import expectations as E
from dugout.quality import generic as Q
from dugout.quality import runner as U


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def fails(df):
    return df.count()


def test_generic_row_tests(spark):
    ids = frame(spark, [(-1,), (11,), (None,)], "id int")
    assert fails(Q.accepted_range(ids, "id", 0, 10)) == 2 and fails(Q.accepted_range(ids, "id", -1, 11)) == 0 and fails(Q.accepted_range(ids, "id", -1, 11, inclusive=False)) == 2
    assert fails(Q.not_null(ids, "id")) == 1 and fails(Q.unique(ids.union(ids), "id")) == 2
    assert fails(Q.accepted_values(ids, "id", [-1])) == 1 and fails(Q.not_accepted_values(ids, "id", [11, 12])) == 1
    sums = frame(spark, [(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    assert fails(Q.expression_is_true(sums, "col_a + col_b = 1")) == 0 and fails(Q.expression_is_true(sums, "= 0.5", "col_a")) == 2
    text = frame(spark, [("",), (" ",), ("a",), (None,)], "t string")
    assert fails(Q.not_empty_string(text, "t")) == 2 and fails(Q.not_empty_string(text, "t", trim=False)) == 1
    with pytest.raises(ValueError):
        Q.accepted_range(ids, "id")


def test_generic_group_tests(spark):
    f = frame(spark, [("a", 1), (None, 1), (None, 2)], "field string, g int")
    assert fails(Q.at_least_one(f, "field")) == 0 and fails(Q.at_least_one(f, "field", ["g"])) == 1 and fails(Q.at_least_one(f, "field", ["g"], compat=True)) == 0
    c = frame(spark, [(1, 1), (1, 1), (1, 2)], "col_a int, field int")
    assert fails(Q.not_constant(c, "col_a")) == 1 and fails(Q.not_constant(c, "field")) == 0 and fails(Q.not_constant(c, "field", ["field"])) == 2
    assert fails(Q.unique_combination(c, ["col_a", "field"])) == 1 and fails(Q.unique_combination(frame(spark, [(None, 1), (None, 1)], "a int, b int"), ["a", "b"])) == 1
    assert fails(Q.not_null_proportion(f, "field", 0.5)) == 1 and fails(Q.not_null_proportion(f, "field", 0.3, 0.4)) == 0
    a, b = frame(spark, [(1,), (2,), (3,)], "x int"), frame(spark, [(1,), (2,), (4,)], "x int")
    assert fails(Q.relationships(a, "x", b, "x")) == 1 and fails(Q.relationships_where(a, "x", b, "x", "x <> 3")) == 0
    assert fails(Q.cardinality_equality(a, "x", b, "x")) == 2 and fails(Q.equality(a, a)) == 0 and fails(Q.equality(a, b)) == 2


def test_count_tests(spark):
    a, b = frame(spark, [(1, "x"), (1, "y"), (2, "x")], "g int, v string"), frame(spark, [(1, "x"), (1, "y"), (3, "x"), (3, "z")], "g int, v string")
    assert Q.equal_rowcount(a, b).first().diff_count == 1
    grouped = {r.g_a or r.g_b: r.diff_count for r in Q.equal_rowcount(a, b, ["g"]).collect()}
    assert grouped == {1: 0, 2: None, 3: None}
    assert Q.fewer_rows_than(a, b).first().row_count_delta == 0 and Q.fewer_rows_than(b, a).first().row_count_delta == 1 and Q.fewer_rows_than(a, a).first().row_count_delta == 1
    res = U.test_result("equal", Q.equal_rowcount(a, b, ["g"]), fail_calc=F.sum(F.coalesce("diff_count", F.lit(0)))).first()
    assert (res.failures, res.status) == (0, "pass")
    assert U.test_result("t", a, severity="warn").first().status == "warn"


def test_ranges_and_sequences(spark):
    r = frame(spark, [(0, 1), (1, 2), (2, 4)], "a int, b int")
    assert fails(Q.mutually_exclusive_ranges(r, "a", "b", gaps="not_allowed")) == 0 and fails(Q.mutually_exclusive_ranges(r, "a", "b", gaps="required")) == 2
    g = frame(spark, [(1, 0, 1), (1, 2, None), (2, 0, 5), (2, 3, 6)], "s int, a int, b int")
    assert [tuple(x)[:3] for x in Q.mutually_exclusive_ranges(g, "a", "b", "s").orderBy("lower_bound").collect()] == [(2, 0, 5), (1, 2, None)]
    z = frame(spark, [(1, 1), (1, 2)], "a int, b int")
    assert fails(Q.mutually_exclusive_ranges(z, "a", "b")) == 1 and fails(Q.mutually_exclusive_ranges(z, "a", "b", zero_length=True)) == 0
    even = frame(spark, [(1, 2), (1, 4), (1, 6), (2, 9)], "k int, v int")
    assert fails(Q.sequential_values(even, "v", 2)) == 1 and fails(Q.sequential_values(even, "v", 2, group_by=["k"])) == 0
    h = frame(spark, [(dt.datetime(2021, 1, 1, i),) for i in (0, 1, 3)], "t timestamp")
    assert fails(Q.sequential_values(h, "t", 1, "hour")) == 1
    up = frame(spark, [(1, 1.0), (2, 2.0), (3, 2.0), (4, None)], "i int, v double")
    assert fails(E.values_increasing(up, "v", "i")) == 1 and fails(E.values_increasing(up, "v", "i", strictly=False)) == 0 and fails(E.values_decreasing(up, "v", "i")) == 2


def test_recency(spark):
    t = frame(spark, [("a", dt.datetime(2024, 1, 10)), ("b", dt.datetime(2024, 1, 2))], "g string, t timestamp")
    assert fails(Q.recency(t, "t", "day", 1, as_of="2024-01-10 12:00:00")) == 0 and fails(Q.recency(t, "t", "day", 1, group_by=["g"], as_of="2024-01-10")) == 1
    assert fails(E.rows_recent(t, "t", "day", 1, as_of="2024-01-12")) == 1 and fails(E.rows_recent(t.where("false"), "t", "day", 1, as_of="2024-01-12")) == 1
    assert fails(E.grouped_rows_recent(t, ["g"], "t", "day", 3, as_of="2024-01-11")) == 1


def test_expectations_on_values(spark):
    d = frame(spark, [(1, 0.0, 0.2, "a", "b"), (2, 0.5, 0.3, "B", "b"), (3, 1.0, 0.0, "c", None), (None, None, None, None, None)], "i int, x double, y double, s string, u string")
    assert fails(E.values_between(d, "x", 0, 1)) == 0 and fails(E.values_between(d, "x", 0, 1, strictly=True)) == 2
    assert fails(E.values_in_set(d, "s", ["a", "B", "c"])) == 1 and fails(E.values_not_in_set(d, "s", ["a"])) == 1
    assert fails(E.values_null(d, "u")) == 2 and fails(E.values_not_null(d, "u")) == 2 and fails(E.values_unique(d, "u")) == 1 and fails(E.values_unique(d, "i")) == 0
    assert fails(E.compound_columns_unique(d.union(d), ["i", "s"])) == 3
    assert fails(E.compound_columns_unique(d.union(d), ["s", "u"], ignore_row_if="any_value_is_missing")) == 2
    assert fails(E.values_of_type(d, "i", "int")) == 0 and fails(E.values_in_type_list(d, "i", ["string", "double"])) == 1
    assert fails(E.pair_a_greater_than_b(d, "x", "y")) == 1 and fails(E.pair_equal(d, "s", "u")) == 2 and fails(E.pair_in_set(d, "i", "s", [(1, "a"), (2, "B")])) == 1
    assert fails(E.select_values_unique_within_record(d, ["s", "u"])) == 1 and fails(E.multicolumn_sum_equal(d, ["x", "y"], 2)) == 0 and fails(E.multicolumn_sum_equal(d, ["x"], "y")) == 1
    assert fails(E.value_lengths_equal(d, "s", 1)) == 0 and fails(E.value_lengths_between(d, "s", 2, 3)) == 3
    assert fails(E.match_like(d, "s", "a%")) == 2 and fails(E.not_match_like(d, "s", "a%")) == 1 and fails(E.match_like_list(d, "s", ["a", "B"], "any")) == 1 and fails(E.not_match_like_list(d, "s", ["a", "B"], "all")) == 2
    assert fails(E.match_regex(d, "s", "[a-z]")) == 1 and fails(E.match_regex(d, "s", "[a-z]", "i")) == 0 and fails(E.not_match_regex(d, "s", "b", "i")) == 1
    assert fails(E.match_regex_list(d, "s", ["a", "c"], "all")) == 3 and fails(E.not_match_regex_list(d, "s", ["a", "c"], "any")) == 0
    assert fails(E.consistent_casing(frame(spark, [("a",), ("A",), ("b",)], "v string"), "v")) == 1 and fails(E.consistent_casing(d, "i", display=True)) == 0


def test_expectations_on_aggregates(spark):
    d = frame(spark, [("a", 1), ("a", 2), ("b", 3), ("b", None)], "g string, v int")
    assert fails(E.distinct_count_equal(d, "v", 3)) == 0 and fails(E.distinct_count_greater_than(d, "v", 3)) == 1 and fails(E.distinct_count_less_than(d, "v", 2, ["g"])) == 1
    assert fails(E.distinct_values_in_set(d, "v", [1, 2, 3])) == 1 and fails(E.distinct_values_contain_set(d, "v", [1, 9])) == 1 and fails(E.distinct_values_equal_set(d, "v", [1, 2, 9])) == 3
    assert fails(E.max_between(d, "v", 3, 3)) == 0 and fails(E.min_between(d, "v", 2)) == 1 and fails(E.mean_between(d, "v", 2, 2)) == 0 and fails(E.median_between(d, "v", 2, 2)) == 0
    assert fails(E.sum_between(d, "v", 3, 3, group_by=["g"])) == 0 and fails(E.stdev_between(d, "v", 1, 1)) == 0 and fails(E.quantile_between(d, "v", 0.5, 3, group_by=["g"])) == 1
    assert fails(E.proportion_of_unique_values_between(d, "v", 1, 1)) == 0 and fails(E.unique_value_count_between(d, "g", 3)) == 1
    assert E.nth_most_common_value(d, "g", 2).first().value_field == "b" and fails(E.most_common_value_in_set(d, "g", ["a"], 1)) == 0 and fails(E.most_common_value_in_set(d, "g", ["a"], 2)) == 1 and fails(E.most_common_value_in_set(d, "g", ["a"], 9)) == 0
    assert fails(E.distinct_count_equal_other_table(d, "v", d)) == 0 and fails(E.row_count_equal_other_table(d, d.union(d))) == 1 and fails(E.row_count_equal_other_table(d.union(d), d, factor=2)) == 0
    assert fails(E.row_count_equal(d, 4)) == 0 and fails(E.row_count_between(d, 3, group_by=["g"])) == 2
    other = frame(spark, [("a", 4), ("c", 1)], "h string, w int")
    diff = E.aggregation_equal_other_table(d, F.sum("v"), other, F.sum("w"), ["g"], ["h"])
    assert {(r.col_1, r.expression_difference) for r in diff.collect()} == {("a", 1), ("b", 3), ("c", 1)}
    with pytest.raises(ValueError):
        E.expression_between(d, "v")


def test_expectations_on_shape(spark):
    d = frame(spark, [(1, 2)], "a int, b int")
    assert fails(E.column_exists(d, "B", 2)) == 0 and fails(E.column_exists(d, "b", 1)) == 1 and fails(E.column_exists(d, "z")) == 1
    assert fails(E.column_count_between(d, 1, 2)) == 0 and fails(E.column_count_equal_other_table(d, d.select("a"))) == 1
    assert fails(E.columns_contain_set(d, ["A", "z"])) == 1 and fails(E.columns_match_ordered_list(d, ["b", "a"])) == 2 and fails(E.columns_match_set(d, ["b", "c"])) == 2 and fails(E.columns_not_contain_set(d, ["A"])) == 1


def test_distributions(spark):
    r = random.Random(1)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), g, 100.0 + r.random()) for i in range(60) for g in ("a", "b")]
    rows = [(d, g, 5000.0 if (d.day, d.month, g) == (20, 2, "a") else v) for d, g, v in rows]
    t = frame(spark, rows, "d timestamp, g string, v double")
    bad = E.within_n_moving_stdevs(t, "v", "d", ["g"], sigma_threshold=6, take_diffs=False, as_of="2024-02-25").collect()
    assert [(x.metric_period.day, x.g) for x in bad] == [(20, "a")]
    assert fails(E.within_n_moving_stdevs(t, "v", "d", ["g"], sigma_threshold_lower=-1e9, sigma_threshold_upper=1e9, as_of="2024-02-25")) == 0
    s = frame(spark, [(i, 1.0) for i in range(20)] + [(99, 1000.0)], "k int, v double")
    assert [x.k for x in E.within_n_stdevs(s, "v", ["k"], 3).collect()] == [99]
    days = frame(spark, [(dt.datetime(2024, 1, i),) for i in (1, 2, 5, 6)], "d timestamp")
    assert [x.date_day.day for x in E.data_for_every_n_datepart(days, "d").orderBy("date_day").collect()] == [3, 4]
    assert [x.date_day.day for x in E.data_for_every_n_datepart(days, "d", interval=2).collect()] == [3]
    assert fails(E.data_for_every_n_datepart(days, "d", exclusion="date_day < timestamp '2024-01-04'")) == 1


def test_history_tests(spark):
    d = dt.date
    h = frame(spark, [(1, 1, d(2020, 1, 1), d(2020, 12, 31), 0), (1, 2, d(2021, 1, 5), d(9999, 12, 31), 1), (2, 1, d(2020, 1, 1), d(2020, 6, 1), 0), (2, 2, d(2020, 6, 1), d(2020, 1, 1), 0)], "player_id int, version_number int, effective_date date, end_date date, is_current int")
    assert fails(E.history_gaps(h)) == 2 and fails(E.history_overlaps(h)) == 1 and fails(E.history_one_current(h)) == 1
    r = A.registry()["uniqueness_dim_player_one_current_row"].failing({"dim_player": h}).collect()
    assert [tuple(x) for x in r] == [(2, 0, 1, 1)]


def game_row(**kw):
    cols = {"game_pk": 1, "season": 2024, "is_final": 1, "is_no_hitter": 0, "is_perfect_game": 0, "is_shutout": 0, "is_tie": 0, "has_box_score": 1, "run_diff": 2, "winning_team_id": 1, "losing_team_id": 2, "load_id": 1}
    for s in ("home", "away"):
        cols |= {f"{s}_team_runs": 3 if s == "home" else 1, f"{s}_team_hits": 5, f"{s}_batting_walks": 1, f"{s}_batting_strikeouts": 1, f"{s}_home_runs": 0, f"{s}_doubles": 0, f"{s}_triples": 0}
        cols |= {f"{s}_pitching_hits_allowed": 5, f"{s}_pitching_runs_allowed": 1 if s == "home" else 3, f"{s}_pitching_walks": 1, f"{s}_pitching_strikeouts": 1, f"{s}_pitching_home_runs_allowed": 0, f"{s}_pitching_earned_runs": 1, f"{s}_pitching_outs": 27}
    cols |= {k: 9 for k in ("winning_pitcher_id", "attendance", "game_duration_minutes")} | {"losing_pitcher_id": 8}
    cols |= {k: "k" for k in ("home_team_key", "away_team_key", "venue_key", "season_key", "game_type_key", "game_status_key")} | {"game_date_key": 1, "official_date_key": 1}
    return cols | kw


def test_audits_run_fused(spark):
    rows = [
        game_row(), game_row(game_pk=2, is_no_hitter=1), game_row(game_pk=3, away_team_hits=0, home_pitching_hits_allowed=0), game_row(game_pk=4, is_shutout=1, run_diff=9), game_row(game_pk=5, is_perfect_game=1),
        game_row(game_pk=6, home_team_hits=6, home_doubles=7), game_row(game_pk=7, winning_team_id=2), game_row(game_pk=8, venue_key=None, attendance=-1), game_row(game_pk=8, winning_team_id=None, is_tie=None),
    ]
    keys = list(rows[0])
    schema = ", ".join(f"{k} {'string' if isinstance(rows[0][k], str) else 'long'}" for k in keys)
    fg = frame(spark, [tuple(r[k] for k in keys) for r in rows], schema)
    dg = frame(spark, [(i, 1, 2, 3, 1) for i in range(1, 9)], "game_pk long, home_team_id long, away_team_id long, home_score long, away_score long")
    res = {r.test_name: r for r in U.run_audits({"fact_games": fg, "dim_games": dg}).collect()}
    want = {
        "business_logic_no_hitter_flag_consistency": 2, "business_logic_shutout_flag_consistency": 1, "business_logic_run_diff_consistency": 1, "business_logic_winning_team_consistency": 2,
        "business_logic_perfect_game_implies_no_hitter": 1, "range_fact_games_rare_event_counts": 0, "reconciliation_box_score_batting_vs_pitching": 1, "business_logic_fact_games_stat_composition": 1,
        "business_logic_winner_loser_distinct": 2, "integrity_fact_games_dimension_keys": 1, "uniqueness_fact_games_game_pk": 1, "range_fact_games_values": 1,
    }
    assert {k: v.failure_count for k, v in res.items()} == want
    keys_audit = res["integrity_fact_games_dimension_keys"]
    assert json.loads(keys_audit.sample_json)[0]["null_keys"] == "venue_key;" and keys_audit.rows_compared == 9 and round(keys_audit.perfect_match_pct, 2) == 88.89
    assert res["business_logic_perfect_game_implies_no_hitter"].rows_compared == 1 and res["range_fact_games_rare_event_counts"].perfect_match_pct == 100
    only = U.run_audits({"fact_games": fg}, ["range_fact_games_values"], samples=False)
    assert U.audit_log_rows(only).first().model_name == "fact_games :: range_fact_games_values"
    assert len(A.registry()) == 27


def test_audits_over_several_tables(spark):
    st = frame(spark, [(1, 1, 2, 1, 3, 1, 1, 0, 0), (1, 2, 1, 0, 1, 3, 0, 1, 0), (2, 1, 2, 1, 3, 1, 1, 0, 0)], "game_pk int, team_id int, opponent_team_id int, is_home int, team_score int, opponent_score int, is_win int, is_loss int, is_tie int")
    reg = A.registry()
    assert fails(reg["integrity_team_standings_two_rows_per_game"].failing({"dim_team_standings": st})) == 1
    assert fails(reg["business_logic_team_standings_symmetry"].failing({"dim_team_standings": st})) == 0
    assert fails(reg["business_logic_team_standings_symmetry"].failing({"dim_team_standings": st.withColumn("is_win", F.lit(1))})) == 1
    t = frame(spark, [(1, 2024, "k"), (1, 2024, "k"), (2, 2024, "z")], "team_id int, season int, team_key string")
    assert sorted(r.issue for r in reg["uniqueness_dim_teams_team_id_season"].failing({"dim_teams": t}).collect()) == ["duplicate_team_id_season", "duplicate_team_key"]
    u = frame(spark, [(2024, 1, 0.6), (2024, 1, 0.4), (2024, 2, 0.5)], "season int, pitcher_id int, usage_pct double")
    assert fails(reg["business_logic_pitcher_arsenal_usage_total"].failing({"mart_pitcher_arsenal": u})) == 1
    g = frame(spark, [(1, 2024, "R", 1, 3, 1), (2, 2024, "R", 1, 3, None)], "game_pk int, season int, game_type string, is_final int, home_score int, away_score int")
    d = frame(spark, [(1, 3, 1), (2, 3, 0)], "game_pk int, home_runs int, away_runs int")
    assert fails(reg["reconciliation_game_details_runs_vs_dim_games_score"].failing({"dim_games": g, "dim_game_details": d})) == 1
    fg = frame(spark, [(1, 2024, 1, 1, 5, 3, 0, 5, 1, 0), (2, 2024, 1, 0, None, None, None, None, None, None)], "game_pk int, season int, is_final int, has_box_score int, home_team_hits int, home_team_runs int, home_home_runs int, away_team_hits int, away_team_runs int, away_home_runs int")
    dg = frame(spark, [(1, 10, 20, 3, 1), (2, 10, 20, 3, 1)], "game_pk int, home_team_id int, away_team_id int, home_score int, away_score int")
    ps = frame(spark, [(1, 10, 5, 3, 0), (1, 20, 4, 1, 0)], "game_pk int, team_id int, batting_hits int, batting_runs int, batting_home_runs int")
    m = {"fact_games": fg, "dim_games": dg, "int_player_game_stats": ps, "int_team_game_box": frame(spark, [(2, 30, 1, 1)], "game_pk int, player_rows int, home_runs int, away_runs int")}
    assert [r.team_id for r in reg["reconciliation_player_batting_vs_team_box"].failing(m).collect()] == [20]
    assert [r.game_pk for r in reg["integrity_fact_games_rejected_box_scores"].failing(m).collect()] == [2]


def test_comparisons(spark, rows):
    a = frame(spark, [(1, "x"), (2, None), (3, "z"), (3, "z")], "id int, v string")
    b = frame(spark, [(1, "x"), (2, None), (4, "q")], "id int, v string")
    got = {(r.in_a, r.in_b): (r["count"], float(r.percent_of_total)) for r in C.compare_queries(a, b).collect()}
    assert got == {(True, True): (2, 50.0), (True, False): (1, 25.0), (False, True): (1, 25.0)}
    log = C.audit_row(C.compare_queries(a, b), "m", "base").first()
    assert (log.rows_compared, log.missing_from_a, log.missing_from_b, float(log.perfect_match_pct)) == (4, 1, 1, 50.0)
    one = a.dropDuplicates()
    st = {r.match_status: r.count_records for r in C.compare_column_values(one, b, ["id"], "v").collect()}
    assert st == {"perfect match": 1, "both are null": 1, "missing from a": 1, "missing from b": 1}
    v = C.compare_all_columns(one, b, ["id"]).where("column_name = 'v'").first()
    assert (v.perfect_match, v.null_in_a, v.null_in_b, v.missing_from_a, v.missing_from_b, v.conflicting_values) == (2, 1, 1, 1, 1, 0)
    assert rows(C.compare_row_counts(a, b)) == [("a", 4), ("b", 3)]
    t = frame(spark, [(1, "k", "r1"), (2, "k", "r2"), (3, "j", "r3")], "n int, k string, row_id string")
    assert rows(C.without_duplicates(t, ["k"], "row_id"), "row_id") == [("r1",), ("r3",)] and rows(C.rows_to_remove(t, ["k"], "row_id")) == [("r2",)]
    assert rows(C.without_rows(t, t.where("n = 3"), "row_id"), "n") == [(1,), (2,)]
    rep = C.failure_report({"not_null_dim_games_game_pk": t, "odd": t.where("false")}).collect()
    assert [(r.test_type, r.tested, r.failure_count) for r in rep] == [("not_null", "dim_games_game_pk", 3), (None, None, 0)] and len(json.loads(rep[0].rows_json)) == 3


def run_rows(spark):
    ts = dt.datetime(2024, 1, 20)
    return frame(
        spark,
        [(1, "r", "a", "fact", "success", 10, 12, 2, 5.0, ts, ts, None), (2, "r", "a", "fact", "error", 10, 10, 0, 5.0, ts, ts, "boom"), (3, "r", "b", "mart", "success", 10, 15, 2, 5.0, ts, ts, None),
         (4, "r", "c", "dimension", "success", 0, 0, 0, 5.0, ts, ts, None), (5, "r", "old", "fact", "success", 1, 1, 0, 5.0, ts, ts, None)],
        "id long, run_id string, model_name string, model_layer string, status string, start_record_count long, end_record_count long, records_added long, elapsed_seconds double, start_time timestamp, created_at timestamp, error_message string",
    )


def test_run_analytics(spark, rows):
    log = run_rows(spark)
    retired = frame(spark, [("old",), (None,)], "model_name string")
    empty = frame(spark, [], "model_name string, start_record_count_low long, start_record_count_high long, end_record_count_low long, end_record_count_high long, records_added_count_low long, records_added_count_high long, elapsed_seconds_low double, elapsed_seconds_high double")
    as_of = F.lit("2024-01-21").cast("timestamp")
    s = runs.status_summary(log, empty, retired)
    got = {r.model_name: r for r in s.collect()}
    assert {k: v.status_color for k, v in got.items()} == {"a": "danger", "b": "warning", "c": "warning"}
    assert got["b"].recon_warnings == ["reconciliation mismatch — start (10) + added (2) = 12 expected, but end is 15 (3 more than expected)"] and len(got["c"].zero_warnings) == 1 and got["a"].zero_warnings == []
    assert runs.overall_health(s).first()[0] == "red" and runs.overall_health(s.where("false")).first()[0] == "unknown"
    p = json.loads(runs.alert_payload(s, runs.overall_health(s), as_of).first()[0])
    assert (p["health"], p["total_models"], p["red_count"], p["failures"][0]["error"], p["generated_at"]) == ("red", 3, 1, "boom", "2024-01-21T00:00:00Z") and len(p["zero_row_warnings"]) == 1
    seeded = runs.seeded_ranges(log, empty, retired, as_of=as_of)
    assert rows(seeded.where("model_name = 'b'"), "end_record_count_low", "end_record_count_high", "elapsed_seconds_low") == [(12, 18, 2.5)]
    flagged = runs.status_summary(log, seeded.withColumn("end_record_count_high", F.lit(14)), retired).where("model_name = 'b'").first()
    assert flagged.status_color == "danger" and flagged.issues == ["end_record_count 15 > max 14"]
    fr = {r.model_name: (r.total_runs, r.failures, str(r.failure_rate_pct)) for r in runs.failure_rates(log, 7, retired, as_of).collect()}
    assert fr["a"] == (2, 1, "50.00")
    assert [r.model_layer for r in runs.run_summary(log, "r").collect()][0] == "dimension" and runs.run_totals(log).first().models == 5
    assert runs.run_history(log, 30, "a", as_of=as_of).count() == 2


def test_execution_lineage_and_edits(spark, rows):
    ex = frame(spark, [("m", "error", 1.0, dt.datetime(2024, 1, 1), "i1"), ("m", "success", 2.0, dt.datetime(2024, 1, 2), "i2"), ("n", "success", 1.0, dt.datetime(2024, 1, 1), "i1")], "name string, status string, total_node_runtime double, compile_started_at timestamp, command_invocation_id string")
    assert rows(runs.latest_executions(ex), "name", "status_color") == [("m", "success"), ("n", "success")] and runs.latest_executions(ex, invocation="i1").count() == 2
    inv = frame(spark, [("i1", 1), ("i2", 2)], "command_invocation_id string, run_started_at int")
    assert runs.latest_invocation(inv).first()[0] == "i2"
    tl = frame(spark, [("p.Dim", "C", "nn", "pass", 0, 2), ("p.Dim", "C", "nn", "fail", 1, 1), ("p.Dim", None, "row", "fail", 1, 1), ("p.Dim", "d", "u", "pass", 3, 1)], "model_name string, column_name string, test_name string, status string, failures int, run_started_at int")
    ml = frame(spark, [("dim", "c", "Stage", 1), ("dim", "d", "Stage", 1), ("dim", None, "Stage", 1)], "model string, column_name string, layer string, refreshed_at int")
    assert rows(runs.lineage_with_tests(ml, tl, "DIM"), "column_name", "test_status") == [(None, "no_test"), ("c", "pass"), ("d", "fail")]
    ed = frame(spark, [(1, "m", "f", 1), (2, runs.CONFIG_EDIT, "url", 2), (3, "m", "g", 3)], "id int, model_name string, field_name string, changed_at int")
    assert [r.id for r in runs.range_edits(ed).collect()] == [3, 1] and rows(runs.edited_models(ed)) == [("m",)] and runs.config_edits(ed).columns == ["id", "field_name", "changed_at"]
    au = frame(spark, [("m", 98.0, 1), ("m", 99.5, 2), ("n", None, 1)], "model_name string, perfect_match_pct double, run_at int")
    assert rows(runs.latest_audits(au), "model_name", "status_color") == [("m", "warning"), ("n", "success")] and [r.status_color for r in runs.audit_history(au, "m").collect()] == ["warning", "danger"]
    gt = frame(spark, [("t", "fail", 1.0, "b", None), ("t", "pass", 2.0, "a", None), ("u", "pass", 1.0, "a", None)], "source_table string, status string, elapsed double, test_name string, message string")
    assert rows(runs.grouped_test_results(gt), "model_name", "status", "elapsed_seconds", "error_message") == [("source_test_t", "FAILURE", 3.0, "b: fail"), ("source_test_u", "SUCCESS", 1.0, None)]


def test_serving(spark, rows):
    day = dt.datetime
    g = frame(spark, [(1, 2024, "R", dt.date(2024, 4, 1), day(2024, 4, 1, 13), 1, 2), (2, 2024, "R", dt.date(2024, 4, 1), day(2024, 4, 1, 19), 2, 1), (3, 2024, "R", dt.date(2024, 4, 2), day(2024, 4, 2), 1, 3)], "game_pk long, season int, game_type string, game_date date, game_datetime timestamp, home_team_id long, away_team_id long").withColumn("venue_name", F.lit("Park"))
    tm = frame(spark, [(1, "A", "AA", 2023), (1, "A", "AB", 2024), (2, "B", "BB", 2024)], "team_id long, team_name string, abbreviation string, season int")
    lines = frame(spark, [(1, 7, 3, 1, 0, 4, 1), (2, 7, 6, 2, 1, 4, 2), (3, 7, 9, 9, 9, 4, 4)], "game_pk long, player_id long, pitching_outs_recorded int, pitching_earned_runs int, pitching_walks int, batting_at_bats int, batting_hits int")
    zero = [f"pitching_{c}" for c in ("hits_allowed", "runs_allowed", "strikeouts", "home_runs_allowed")] + [f"batting_{c}" for c in ("runs", "doubles", "triples", "home_runs")]
    lines = lines.withColumns({c: F.lit(0) for c in zero})
    fg = frame(spark, [(1, 7, 8, None), (2, 9, 7, 7)], "game_pk long, winning_pitcher_id long, losing_pitcher_id long, save_pitcher_id long")
    t = {"dim_games": g, "dim_teams": tm, "int_player_game_stats": lines, "fact_games": fg}
    assert rows(serving.teams(t), "team_id", "abbreviation") == [(1, "AB"), (2, "BB")]
    assert rows(serving.games(t, season=2024), "game_pk") == [(1,), (2,)] and rows(serving.games(t, team_id=1), "game_pk") == [(1,), (2,), (3,)] and rows(serving.games(t, team_id=1, opponent_id=2), "game_pk") == [(1,), (2,)]
    with pytest.raises(ValueError):
        serving.games(t)
    y = serving.player_ytd(t, 2, 7, "pitcher").first()
    assert (y.games_played, y.wins, y.losses, y.saves, y.innings_pitched, str(y.era), str(y.whip)) == (2, 1, 1, 1, "3.0", "9.00", "0.33")
    b = serving.player_ytd(t, 2, 7).first()
    assert (b.games_played, b.at_bats, b.hits, b["avg"]) == (2, 8, 3, ".375") and serving.player_ytd(t, 1, 99).first().at_bats is None
    people = frame(spark, [(7, "P", "6' 1\"", 200, "City", None, "USA", None, "Right", "1990-01-01", 34, "Pitcher", "2015-01-01")], "id long, full_name string, height string, weight int, birth_city string, birth_state_province string, birth_country string, bat_side__description string, pitch_hand__description string, birth_date string, current_age int, primary_position__name string, mlb_debut_date string")
    r = serving.player_detail({"players": people}, 7).first()
    assert r.birth_place == "City, USA" and r["height/weight"] == "6' 1\" 200 lbs." and r["Bats/Throws"] == "Bats  Throws Right"
    ps = frame(spark, [(1, 7, 1, "A", 2023), (2, 7, 1, "A", 2024)], "game_pk long, player_id long, team_id long, team_name string, season int")
    tt = {"players": people, "dim_player_stats": ps, "dim_games": g}
    assert serving.team_players(tt, 1).count() == 1 and serving.team_players(tt, 1, season=2022).count() == 0 and serving.team_players(tt, 1, game_pk=1).count() == 1 and serving.game_player_detail(tt, 1).first().team_name == "A"
    aw = {"dim_award": frame(spark, [("MVP", "Most")], "award_id string, award_name string"), "dim_award_recipient": frame(spark, [("MVP", 7, 1, "2024", "d", "x"), ("MVP", 8, None, "2020", "d", "x")], "award_id string, player_id long, team_id long, season string, award_date string, award_name string"), "dim_teams": tm}
    assert rows(serving.all_awards(aw), "player_id", "award_name", "team") == [(7, "Most", "AB"), (8, "Most", "Unknown")] and serving.player_awards(aw, 7).count() == 1


def test_audits_read_a_table_once(spark, tmp_path):
    """All row audits of a table, samples included, from one scan that reads only their columns."""
    from dugout.catalog import audit_queries  # noqa: F401
    from dugout.catalog.audit_queries import _GAME

    path = str(tmp_path / "games")
    spark.range(50).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit("2024-01-01").alias("o_orderdate")).select(*[F.expr(e).alias(n) for n, e in _GAME.items()], F.lit(1).alias("unused")).write.parquet(path)
    games = spark.read.parquet(path)
    audits = [a for a in A.row_audits() if a.table == "fact_games"]
    plan = U._row_audit_parts(games, audits, True)._jdf.queryExecution().executedPlan().toString()
    assert len(audits) == 9 and plan.count("FileScan") == 1 and "unused" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_samples_are_the_first_rows_with_repeats(spark):
    rows = [(i % 4, -1, 0, 0, 0, 1, 5, 5) for i in range(300)]
    fg = frame(spark, rows, "game_pk long, home_team_runs long, away_team_runs long, home_team_hits long, away_team_hits long, is_final long, attendance long, game_duration_minutes long")
    got = U.run_audits({"fact_games": fg}, ["range_fact_games_values"]).first()
    sample = json.loads(got.sample_json)
    assert (got.failure_count, got.rows_compared, got.perfect_match_pct) == (300, 300, 0.0)
    assert len(sample) == U.SAMPLE_ROWS and {s["game_pk"] for s in sample} == {"0"} and sample[0]["violations"] == "negative_runs;"
    none = U.run_audits({"fact_games": fg.where("false")}, ["range_fact_games_values"]).first()
    assert (none.failure_count, none.rows_compared, none.perfect_match_pct, none.sample_json) == (0, 0, 100.0, "[]")


def test_fused_expectations(spark, tmp_path):
    from dugout.quality import fused as X

    df = frame(spark, [(1, "a", "x"), (1, "b", None), (2, "b", "y"), (None, "ccc", "y")], "k int, t string, u string")
    checks = [X.distinct_count("k", 3), X.unique_share("t", 0.9), X.unique(["k", "t"]), X.unique(["t"]), X.in_set("u", ["x", "y"]), X.not_in_set("u", ["x"]), X.null("u"), X.not_null("u"), X.lengths("t", 1, 2), X.column_sum(["k", "k"], "k"), X.row_count(1, 3)]
    assert {(r.expectation, r.observed) for r in X.failed(df, checks).collect()} == {
        ("distinct_count(k)", 2.0), ("unique_share(t)", 0.75), ("repeated(t)", 1.0), ("not_in_set(u)", 1.0), ("in_forbidden_set(u)", 1.0), ("not_null(u)", 3.0), ("null(u)", 1.0), ("length(t)", 1.0), ("sum(k+k-k)", 4.0), ("row_count", 4.0),
    }
    assert X.failed(df.where("false"), [X.row_count(1)]).first().observed == 0.0
    assert {(r.t, r.observed) for r in X.failed(df, [X.distinct_count("k", 2)], ["t"]).collect()} == {("a", 1.0), ("ccc", 0.0)} | {("b", 2.0)} - {("b", 2.0)}
    df.write.parquet(str(tmp_path / "t"))
    plan = X.failed(spark.read.parquet(str(tmp_path / "t")), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
