from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dugout.plans import dims, facts, intermediate, marts, stage
from dugout.sources.landing import LOAD_ID, ROW_ID
from test_models_support import raw_games


def pitch_frame(spark, rows, extra=""):
    schema = (
        "event_id string, load_id string, game_pk long, season int, at_bat_index int, pitch_number int, pitch_result_code string, balls int, strikes int, "
        "outs_when_up int, plate_x double, plate_z double, sz_top double, sz_bot double, zone int, result_event_type string, result_rbi int, "
        "result_is_hit boolean, is_final_pitch boolean" + extra
    )
    return spark.createDataFrame(rows, schema)


def test_missing_location_is_unknown(spark):
    rows = [
        ("e1", "l", 1, 2024, 0, 1, "S", 0, 0, 0, 1.20, 2.50, 3.40, 1.60, 12, None, None, None, False),
        ("e2", "l", 1, 2024, 0, 2, "S", 0, 1, 0, None, None, None, None, None, "home_run", 2, True, True),
        ("e3", "l", 1, 2024, 1, 1, "C", 0, 1, 0, 0.0, 2.5, 3.4, 1.6, 5, "stolen_base_2b", None, False, True),
    ]
    got = {r["event_id"]: r for r in intermediate.int_pitches_enriched(pitch_frame(spark, rows), dims.dim_zone(spark)).collect()}
    assert (got["e1"].is_in_strike_zone, got["e1"].is_chase, got["e1"].is_edge_pitch) == (0, 1, 0)
    assert (got["e2"].is_in_strike_zone, got["e2"].is_chase, got["e2"].is_edge_pitch, got["e2"].has_location) == (None, None, None, 0)
    assert got["e2"].zone == 99 and got["e2"].zone_region == "Unknown" and got["e2"].pa_total_bases == 4 and got["e2"].pa_rbi == 2
    assert got["e3"].pa_is_complete == 0 and got["e3"].zone_region == "Heart" and got["e3"].is_in_zone == 1


def test_pitching_change_is_one_at_bat(spark):
    cols = "event_id string, load_id string, game_pk long, season int, at_bat_index int, pitch_number int, pitcher_id long, pitcher_name string, pitcher_hand string, batter_id long, batter_name string, batter_side string, is_pitch int, is_strike int, is_ball int, is_in_play int, is_out int, pitch_result_code string, call_code string, balls int, strikes int, outs_when_up int, release_speed double, exit_velocity double, launch_angle double, hit_distance double, trajectory string, result_event_type string, result_event string, result_description string, result_rbi int, result_is_hit int, is_final_pitch int, start_time timestamp, end_time timestamp"

    def row(n, pitcher, name, ev=None, play=0, final=0):
        return (f"e{n}", "l1", 1, 2024, 0, n, pitcher, name, "R", 500, f"B{n}", "L", 1, 1, 0, play, 0, "F", "C", 0, 1, 0, 90.0, ev, 10.0, 100.0, "line_drive", "single" if final else None, None, None, 1 if final else None, final, final, None, None)

    p = spark.createDataFrame([row(1, 100, "A. Rodriguez", 99.0), row(2, 200, "Z. Rodriguez"), row(3, 200, "Z. Rodriguez", 80.0, 1, 1)], cols)
    got = facts.fact_at_bats(p).collect()
    assert len(got) == 1
    r = got[0]
    # The last pitch names the pitcher and the first the batter; a hard foul is not hard contact.
    assert (r.total_pitches, r.pitchers_in_ab, r.pitcher_id, r.pitcher_name, r.first_pitcher_id, r.batter_name) == (3, 2, 200, "Z. Rodriguez", 100, "B1")
    assert (r.exit_velocity, r.is_hard_hit, r.is_hit, r.is_at_bat, r.total_bases, r.is_complete_pa) == (80.0, 0, 1, 1, 1, 1)


def umpire_inputs(spark, loads, missed):
    ump = spark.createDataFrame([(1, 10, "Home Plate", load) for load in loads] + [(1, 11, "First Base", loads[0])], "game_pk long, official_id long, official_type string, load_id string")
    pit = spark.createDataFrame([(1, f"e{i}", z, 1) for i, z in enumerate(missed)] + [(1, "x", 5, 0)], "game_pk long, event_id string, zone int, is_called_strike_outside_zone int")
    ch = spark.createDataFrame([], "game_pk long, review_is_overturned int")
    return ump, pit, ch


def test_perfect_umpire_gets_a_row(spark):
    r = facts.fact_umpire_performance(*umpire_inputs(spark, ["load-1"], [])).collect()
    assert [(x.called_strikes_outside_zone, x.zones_with_bad_calls, x.total_challenges, x.worst_zone, x.overturn_rate_pct) for x in r] == [(0, 0, 0, None, None)]


def test_umpire_in_two_loads_does_not_fan_out(spark):
    r = facts.fact_umpire_performance(*umpire_inputs(spark, ["load-1", "load-2"], [12])).collect()
    assert [(x.called_strikes_outside_zone, x.load_id, x.worst_zone) for x in r] == [(1, "load-2", 12)]


def test_worst_zone_tie_takes_smallest(spark):
    r = facts.fact_umpire_performance(*umpire_inputs(spark, ["load-1"], [13, 12, 12, 13])).first()
    assert (r.worst_zone, r.worst_zone_count, r.zones_with_bad_calls) == (12, 2, 2)


def roster(spark, rows):
    schema = f"player_id long, full_name string, team_id string, jersey_number int, position__code string, position__name string, position__type string, position__abbreviation string, status__code string, status_description string, season int, {LOAD_ID} string, {ROW_ID} string"
    return spark.createDataFrame([(p, "N", t, j, "P", None, None, None, "A", "Active", s, load, f"{p}{s}{load}") for p, t, j, s, load in rows], schema)


def test_history_repeat_trade(spark, rows):
    r = roster(spark, [(1, "A", 9, 2022, "1"), (1, "B", 9, 2023, "2"), (1, "A", 9, 2024, "3"), (1, "Z", 9, 2024, "0"), (2, "A", 1, 2023, "1"), (2, "A", 2, 2024, "1"), (2, "A", 2, 2025, "1")])
    tx = spark.createDataFrame([(1, "A", dt.date(2022, 3, 1)), (1, "B", dt.date(2023, 7, 15)), (1, "A", dt.date(2024, 8, 1)), (2, "A", dt.date(2022, 11, 5))], "player_id long, to_team_id string, effective_date date")
    d = dims.dim_player(r, tx)
    day = dt.date
    assert rows(d.where("player_id = 1"), "version_number", "team_id", "effective_date", "end_date", "is_current") == [
        (1, "A", day(2022, 3, 1), day(2023, 7, 14), 0), (2, "B", day(2023, 7, 15), day(2024, 7, 31), 0), (3, "A", day(2024, 8, 1), day(9999, 12, 31), 1),
    ]
    # An off-season move dates the first version; a jersey change starts on January 1.
    assert rows(d.where("player_id = 2"), "version_number", "jersey_number", "effective_date") == [(1, 1, day(2022, 11, 5)), (2, 2, day(2024, 1, 1))]


def test_canonical_position(spark, rows):
    players = spark.createDataFrame([("9", "Outfielder", "Outfielder", "OF")], "primary_position__code string, primary_position__name string, primary_position__type string, primary_position__abbreviation string")
    other = lambda n: spark.createDataFrame([("9", n, n, n), ("8", n, n, n), (None, n, n, n)], "position__code string, position__name string, position__type string, position__abbreviation string")
    got = dims.dim_position(players, other("Right Field"), other("RF"))
    assert rows(got, "position_code", "position_name") == [("8", "Right Field"), ("9", "Outfielder")]


def test_dim_games_ties_and_unknown_scores(spark, rows):
    g = dims.dim_games(raw_games(spark, [(1, "2024-05-01", 1, 2, 3, 3, "Final", 1), (2, "2024-05-02", 1, 2, None, None, "Final", 2), (3, "2024-05-03", 1, 2, 1, 4, "Final", 3), (4, "2024-05-03", 1, 2, 0, 0, "Cancelled", 1)]))
    got = rows(g, "game_pk", "is_tie", "home_is_winner", "away_is_winner", "winning_team_id", "run_diff", "is_final", "venue_name")
    assert got == [(1, 1, 0, 0, None, 0, 1, "Park"), (2, 0, None, None, None, None, 1, "Park"), (3, 0, 0, 1, 2, -3, 1, "Park")]


def game_tables(spark, games):
    import test_models_support as ts

    return ts.game_tables(spark, games)


def test_unfinished_game_has_no_flags(spark):
    g = dims.dim_games(raw_games(spark, [(1, "2024-05-01", 1, 2, 0, 0, "Suspended", 1), (2, "2024-05-02", 1, 2, 2, 0, "Final", 1), (3, "2024-05-02", 1, 2, 2, 0, "Final", 1)]))
    t = game_tables(spark, g)
    got = {r.game_pk: r for r in facts.fact_games(g, **t).collect()}
    assert len(got) == 3
    assert (got[1].is_no_hitter, got[1].is_shutout, got[1].has_box_score) == (0, 0, 0)
    assert (got[2].is_no_hitter, got[2].is_perfect_game, got[2].is_shutout, got[2].has_box_score) == (1, 1, 1, 1)
    # Runs of the box score disagree with the final score: it is not used.
    assert (got[3].is_no_hitter, got[3].is_shutout, got[3].has_box_score, got[3].home_team_hits) == (0, 1, 0, None)
    assert got[2].game_date_key == 20240502 and got[2].home_team_key is not None and got[2].venue_key is not None and got[2].season_key is not None


def test_results_series_and_records(spark, rows):
    games = raw_games(spark, [(1, "2024-04-01", 1, 2, 3, 1, "Final", 1), (2, "2024-04-02", 1, 2, 0, 1, "Final", 2), (3, "2024-06-01", 1, 2, 5, 1, "Final", 1), (4, "2024-07-01", 2, 1, 5, 1, "Final", 1), (5, "2024-07-02", 2, 1, 5, 1, "Postponed", 1)])
    det = spark.createDataFrame([(1, "2024-04-01 13:05:00", None), (2, None, "19:10")], "game_pk long, first_pitch string, first_pitch__v_text string")
    teams = spark.createDataFrame([(1, 2024, 103), (2, 2024, 104)], "id long, season int, league__id long")
    r = intermediate.int_team_game_results(games, det, teams)
    assert rows(r.where("team_id = 1"), "game_pk", "result", "series_id", "is_home", "start_hour", "is_interleague") == [(1, "W", 1, 1, 13, 1), (2, "L", 1, 1, 19, 1), (3, "W", 2, 1, None, 1), (4, "L", 1, 0, None, 1)]
    rec = intermediate.int_team_game_results_to_date(r)
    got = rows(rec.where("team_id = 1"), "game_pk", "wins_to_date_venue", "losses_to_date_venue", "wins_to_date_series", "wins_to_date_start_hour", "wins_to_date_day_night_night", "losses_to_date_opponent")
    assert got == [(1, 1, 0, 1, 1, 1, 0), (2, 1, 1, 1, 0, 1, 1), (3, 2, 1, 1, 1, 2, 1), (4, 2, 2, 0, 1, 2, 1)]


def test_player_lines_and_box(spark, rows):
    g = dims.dim_games(raw_games(spark, [(1, "2024-04-01", 1, 2, 3, 1, "Final", 1), (2, "2024-04-01", 1, 2, 3, 1, "Suspended", 1)]))
    cols = [f"pitching_{c}" for c in dims.PITCHING[1:]] + [f"fielding_{c}" for c in dims.FIELDING] + [f"batting_{c}" for c in dims.BATTING]
    schema = f"game_pk long, player_id long, player_name string, team_id long, team_name string, is_home boolean, position_code string, position_name string, position_abbreviation string, pitching_innings_pitched string, batting_avg string, pitching_era string, {LOAD_ID} string, " + ", ".join(f"{c} int" for c in cols)
    line = lambda pk, pid, home, ip: (pk, pid, f"P{pid}", 1 if home else 2, "T", home, None, None, None, ip, None, None, "1", *[1 for _ in cols])
    src = spark.createDataFrame([line(1, 7, True, "6.1"), line(1, 8, True, None), line(2, 9, False, "1.0")], schema)
    det = spark.createDataFrame([(1, None, "19:10")], "game_pk long, first_pitch string, first_pitch__v_text string")
    lines = intermediate.int_player_game_stats(src, g, det)
    assert rows(lines, "player_id", "pitching_outs_recorded", "opponent_team_id", "position_code", "start_hour") == [(7, 19, 2, "Unknown", 19), (8, None, 2, "Unknown", 19)]
    box = intermediate.int_team_game_box(lines).first()
    assert (box.home_runs, box.home_pitching_outs, box.away_runs, box.player_rows) == (2, 19, None, 2)
    by_date = dims.dim_player_stats_by_date(dims.dim_player_stats(lines)).where("player_id = 7").first()
    assert (by_date.pitching_innings_pitched_to_date, by_date.games_pitched_to_date, by_date.batting_avg_to_date, by_date.fielding_pct_to_date) == ("6.1", 1, 1.0, 2.0)


def test_awards_draft_schools(spark, rows):
    base = f"player_id long, player_name string, position_code string, position_name string, position_type string, position_abbreviation string, team_id long, award_id string, award_name string, award_date string, season string, notes string, {LOAD_ID} string, {ROW_ID} string"
    a = spark.createDataFrame([(1, "N", None, None, None, None, None, "MVP", "Old name", None, "2023", None, "1", "r1"), (1, "N", None, None, None, None, 5, "MVP", "MVP award", None, "2023", "n", "2", "r2")], base)
    aw = dims.dim_award(a)
    assert rows(aw, "award_id", "award_name") == [("MVP", "MVP award")]
    assert rows(dims.dim_award_recipient(a, aw), "player_id", "team_id", "award_name", "load_id") == [(1, 5, "MVP award", "2")]
    ds = f"person__id long, round_pick_number int, pick_number int, person__draft_year string, person__full_name string, person__current_age int, rank int, pick_value string, signing_bonus string, school__name string, school__city string, school__state string, school__country string, school__school_class string, {LOAD_ID} string, {ROW_ID} string"
    d = spark.createDataFrame([(1, 1, 1, " 2024", " ", 20, 1, "$1,000", "x", "U", "Old", None, None, None, "1", "r1"), (1, 1, 1, " 2024", "Jo Doe", 21, 1, "$2,000.50", None, "U", "New", None, None, None, "2", "r2"), (None, 1, 2, "2024", "X", 1, 1, None, None, None, None, None, None, None, "1", "r3")], ds)
    dim = dims.dim_draft(d)
    assert rows(dim, "person_id", "person_full_name", "person_first_name", "person_draft_year") == [(1, "Jo Doe", "Unknown", "2024")]
    assert [(r.person_id, str(r.pick_value), r.signing_bonus, r.current_age) for r in facts.fact_draft(d, dim).collect()] == [(1, "2000.50", None, 21)]
    kinds = spark.createDataFrame([("U", "4YR", "rule")], "school_name string, school_type string, classified_by string")
    assert rows(dims.dim_school(d, kinds), "school__name", "school__city", "school_type") == [("U", "New", "4YR")]


def test_season_stats_fact(spark, rows):
    ps = spark.createDataFrame([(5, 7, 2024, ".301", "3.50", 10, "r", "1")], f"player__id long, team__id long, season int, batting_stat__avg string, pitching_stat__era string, batting_stat__hits int, {ROW_ID} string, {LOAD_ID} string")
    players = spark.createDataFrame([(5, "k1", 1), (5, "k0", 0)], "player_id long, player_version_key string, is_current int")
    teams = spark.createDataFrame([(7, 2024, "t")], "team_id long, season int, team_key string")
    seasons = spark.createDataFrame([(2024, "s")], "season int, season_key string")
    got = facts.fact_player_stats(ps, players, teams, seasons).collect()
    assert len(got) == 1 and (got[0].player_key, got[0].team_key, got[0].season_key, str(got[0].batting_average), str(got[0].era), got[0].hits, got[0].war) == ("k1", "t", "s", "0.301", "3.50", 10, None)
    view = stage.stat_view(ps, ("stat__", "batting_stat__"))
    assert rows(view, "avg", "hits") == [(".301", 10)]
    v = stage.with_variant(spark.createDataFrame([("1", "x"), ("2", "7")], "a string, a__v_text string"), "a", "int")
    assert rows(v) == [(1,), (7,)]


def test_matchups_touched_groups_are_whole(spark, rows):
    from dugout.catalog import frames as fr
    from dugout.catalog import model_queries as M

    sf = "/root/testdata/sf0.001"
    e, b = M.enriched(spark, sf), M.batted(spark, sf)
    touched = e.where("pitcher_id = 3").select("season", "pitcher_id", "batter_id")
    part = marts.mart_matchups(e, b, touched)
    full = marts.mart_matchups(e, b).where("pitcher_id = 3")
    assert rows(part, "season", "batter_id", "total_pitches", "hits") == rows(full, "season", "batter_id", "total_pitches", "hits")
    assert fr.pitches(spark, sf).count() == e.count()
