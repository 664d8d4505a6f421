from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from dugout.plans import intermediate, registry, stage
from dugout.sources import landing as L
from dugout.sources import schemas as X
from dugout.sources import tables as T
from dugout.streaming import incremental as I
from test_models_support import raw_games

TEAM = {"id": 1, "name": "Home"}


def landed(spark, tmp_path, name, schema, *payloads):
    d = tmp_path / name
    d.mkdir(exist_ok=True)
    (d / "part.json").write_text("\n".join(json.dumps(p) for p in payloads))
    return L.read_landed(spark, str(d), schema)


def game(pk, kind="R", state="Final", detailed="Final"):
    side = lambda i, s, w: {"team": {"id": i, "name": f"T{i}"}, "score": s, "isWinner": w}
    return {
        "gamePk": pk, "gameType": kind, "season": "2024", "gameDate": "2024-05-01T19:00:00Z", "officialDate": "2024-05-01",
        "status": {"abstractGameState": state, "detailedState": detailed, "codedGameState": "F", "statusCode": "F"},
        "teams": {"home": side(1, 3, True), "away": side(2, 1, False)}, "venue": {"id": 9, "name": "Park"}, "isTie": False, "seriesGameNumber": 1,
    }


def test_schedule(spark, tmp_path, rows):
    sched = {"dates": [{"games": [game(1), game(2, "E"), game(3, state="Live"), game(4, detailed="Postponed")]}, {"games": [game(1), game(5, "P")]}]}
    g = L.games(landed(spark, tmp_path, "schedule", X.SCHEDULE, sched))
    assert rows(g, "game_pk", "teams__home__team__id", "teams__away__score", "status__start_time_tbd") == [(1, 1, 1, None), (5, 1, 1, None)]


def pitch(i, is_pitch=True, **kw):
    return {"playId": f"p{i}", "index": i, "isPitch": is_pitch, "pitchNumber": i, "details": {"code": "S", "type": {"code": "FF"}, **kw}, "pitchData": {"startSpeed": 95.5, "coordinates": {"pX": 0.1, "vX0": 1.5}, "strikeZoneTop": 3.4}}


PBP = {
    "request": {"season": 2024, "gamePk": 7},
    "allPlays": [
        {"atBatIndex": 0, "matchup": {"batter": {"id": 5, "fullName": ""}, "pitcher": {"id": 6, "fullName": "P"}, "batSide": {"code": "L"}, "pitchHand": {"code": "R"}}, "result": {"eventType": "single", "event": "Single", "rbi": 1},
         "playEvents": [pitch(1), pitch(2, isInPlay=True), {"isPitch": False, "index": 3}]},
        {"atBatIndex": 1, "matchup": {}, "result": {}, "playEvents": [{"isPitch": False}]},
    ],
}


def test_play_by_play_to_stage(spark, tmp_path, rows):
    ev = L.stamped(L.play_events(landed(spark, tmp_path, "pbp", X.PLAY_BY_PLAY, PBP)), "1", ["game_pk", "play_id"])
    assert rows(ev, "play_id", "is_final_pitch", "result_is_hit", "is_in_play", "result_rbi") == [("p1", False, True, False, 1), ("p2", True, True, True, 1)]
    st = stage.stg_play_events(ev)
    assert len(st.columns) == len(stage.PITCH_COLUMNS)
    r = st.where("play_id = 'p2'").first()
    assert (r.batter_name, r.pitcher_name, r.trajectory, r.is_in_play, r.release_speed, r.vx0, r.plate_x, r.sz_top, r.pitch_type_code) == ("unknown", "P", "unknown", 1, 95.5, 1.5, 0.1, 3.4, "FF")


BOX = {
    "request": {"gamePk": 7},
    "teams": {
        "home": {"team": TEAM, "players": {"ID1": {"person": {"id": 1, "fullName": "A"}, "position": {"code": "9"}, "stats": {"batting": {"atBats": 4, "baseOnBalls": 1}, "pitching": {"inningsPitched": "6.1"}}}}},
        "away": {"team": {"id": 2, "name": "Away"}, "players": {"ID2": {"person": {"id": 2}}}},
    },
    "officials": [{"officialType": "Home Plate", "official": {"id": 50, "fullName": "U"}}],
    "info": [{"label": "Att", "value": "44,392"}, {"label": "First pitch", "value": "7:07 PM"}, {"label": "T", "value": "3:22"}, {"label": "T", "value": "3:30"}, {"label": ""}],
}


def test_box_score_jobs(spark, tmp_path, rows):
    b = landed(spark, tmp_path, "box", X.BOX_SCORE, BOX)
    assert rows(L.player_game_stats(b), "player_id", "team_id", "is_home", "batting_at_bats", "batting_walks", "pitching_innings_pitched") == [(1, 1, True, 4, 1, "6.1"), (2, 2, False, None, None, None)]
    assert rows(L.umpires(b)) == [(7, "Home Plate", 50, "U")]


def test_game_details_fall_back(spark, tmp_path):
    b = landed(spark, tmp_path, "box", X.BOX_SCORE, BOX, {**BOX, "request": {"gamePk": 8}})
    live = landed(
        spark, tmp_path, "live", X.LIVE_FEED,
        {"request": {"gamePk": 7}, "gameData": {"weather": {"condition": "Clear"}, "gameInfo": {}, "datetime": {}}, "liveData": {"decisions": {}, "boxscore": {"teams": {"home": {"teamStats": {"batting": {"runs": 3, "errors": 0}, "pitching": {"errors": 2}}}}}}},
        {"request": {"gamePk": 8}, "gameData": {"gameInfo": {"attendance": 100, "gameDurationMinutes": 150}, "datetime": {"time": "1:05", "ampm": "PM"}}, "liveData": {"decisions": {"winner": {"id": 4, "fullName": "W"}}}},
    )
    line = landed(spark, tmp_path, "line", X.LINE_SCORE, {"request": {"gamePk": 7}, "decisions": {"winner": {"id": 11, "fullName": "LW"}}}, {"request": {"gamePk": 8}, "decisions": {"winner": {"id": 12}, "save": {"id": 13}}})
    got = {r.game_pk: r for r in L.game_details(live, b, line).collect()}
    a = got[7]
    assert (a.attendance, a.first_pitch, a.game_duration_minutes, a.winning_pitcher_id, a.winning_pitcher_name, a.home_runs, a.home_errors, a.weather_condition) == (44392, "19:07", 210, 11, "LW", 3, 2, "Clear")
    c = got[8]
    assert (c.attendance, c.first_pitch, c.game_duration_minutes, c.winning_pitcher_id, c.save_pitcher_id) == (100, "13:05", 150, 4, None)


def test_people_jobs(spark, tmp_path, rows):
    tx = landed(spark, tmp_path, "tx", X.TRANSACTIONS, {"transactions": [{"id": 1, "person": {"id": 5, "fullName": "A"}, "date": "2023-11-01", "toTeam": {"id": 9}}, {"id": 1}, {"id": 2, "date": "2024-01-01"}, {"id": 3, "person": {"id": 6}, "effectiveDate": "x"}]})
    flat = L.transactions(tx)
    assert flat.count() == 3 and set(rows(flat.where("transaction_id > 1"), "transaction_category", "description")) == {("team", ""), ("player", "")}
    assert {r.season for r in L.player_season_transactions(flat).collect()} <= {2023}
    teams = landed(spark, tmp_path, "teams", X.TEAMS, {"request": {"season": 2023, "sportId": 1}, "teams": [{"id": 1, "name": "A", "season": 2023}, {"id": 1, "season": 2023}]}, {"request": {"season": 2024, "sportId": 11}, "teams": [{"id": 1, "parentOrgId": 3}]})
    assert rows(L.teams(teams), "id", "season") == [(1, 2023), (1, 2024)] and rows(L.minor_league_teams(teams), "id", "parent_org_id") == [(1, 3)]
    draft = landed(spark, tmp_path, "draft", X.DRAFT, {"drafts": {"rounds": [{"picks": [{"pickNumber": 1, "person": {"id": 4, "draftYear": 2024, "batSide": {"code": "L"}}}, {"pickNumber": 2}]}, {"picks": []}]}})
    assert rows(L.draft_picks(draft), "pick_number", "person__id", "person__bat_side__code") == [(1, 4, "L"), (2, None, None)]
    aw = landed(spark, tmp_path, "aw", X.AWARDS, {"request": {"awardId": "MVP", "season": 2024}, "awards": [{"id": "MVP", "player": {"id": 3, "primaryPosition": {"code": "9"}}}]}, {"request": {"awardId": "retirex"}, "awards": [{"id": "RETIREX"}]})
    assert rows(L.award_recipients(aw), "award_id", "season", "position_code") == [("MVP", "2024", "9")]
    ro = landed(spark, tmp_path, "ro", X.ROSTERS, {"request": {"season": 2024, "teamId": 8}, "roster": [{"person": {"id": 1, "fullName": "N"}, "position": {"code": "P"}, "status": {"code": "A"}}]})
    assert rows(L.rosters(ro), "person__id", "season", "parent_team_id", "status__code") == [(1, 2024, 8, "A")]
    co = landed(spark, tmp_path, "co", X.COACHES, {"request": {"season": 2024, "sportId": 1}, "team": {"id": 8, "parentOrgId": 99}, "roster": [{"person": {"id": 1}, "jobId": "M"}, {"person": {"id": 2}}]}, {"request": {"season": 2024, "sportId": 11}, "team": {"id": 9, "parentOrgId": 99}, "roster": [{"person": {"id": 3}, "jobId": "H"}]})
    coaches = L.team_coaches(co)
    assert rows(coaches, "person_id", "parent_org_id", "level") == [(1, 8, "MLB"), (3, 99, "AAA")]
    pe = landed(spark, tmp_path, "pe", X.PEOPLE, {"people": [{"id": 1, "fullName": "N", "primaryPosition": {"code": "X", "name": "Unknown"}, "education": {"colleges": [{"name": "U"}]}}, {"id": 2, "primaryPosition": {"code": "P", "name": "Pitcher"}}]})
    det = L.people_details(pe, F.lit("2024-01-01"))
    assert [(r.id, r.primary_position__code, r.college_count, r.high_school_count, r.education_json) for r in det.orderBy("id").collect()] == [(1, None, 1, 0, '{"colleges":[{"name":"U"}]}'), (2, "P", 0, 0, None)]
    wanted = L.people_in_scope(coaches, "all", flat, L.players(pe))
    assert rows(wanted) == [(1,), (2,), (3,), (5,), (6,)]
    assert rows(L.people_needing_details(wanted, det)) == [(3,), (5,), (6,)] and L.people_needing_details(wanted, det, refresh=True).count() == 5
    se = landed(spark, tmp_path, "se", X.SEASONS, {"seasons": [{"seasonId": "2024", "lastDate1stHalf": "2024-07-14"}, {"seasonId": "2024"}]})
    assert rows(L.seasons(se), "season", "season_id") == [(2024, "2024")] and "last_date1st_half" in L.seasons(se).columns


def test_season_stats_groups(spark, tmp_path, rows):
    page = lambda g, pid, stat: {"request": {"season": 2024, "group": g}, "stats": [{"splits": [{"player": {"id": pid}, "team": {"id": 1}, "stat": stat}]}]}
    st = landed(spark, tmp_path, "st", X.STATS, page("hitting", 1, {"hits": 5, "avg": ".300"}), page("pitching", 1, {"era": "3.00"}), page("fielding", 2, {"errors": 2, "hitsPer9Inn": "1"}))
    got = L.player_season_stats(st)
    assert rows(got, "season", "player__id", "batting_stat__hits", "pitching_stat__era", "fielding_stat__errors") == [(2024, 1, 5, "3.00", None), (2024, 2, None, None, 2)]
    assert "fielding_stat__hits_per9_inn" in got.columns and "batting_position__code" in got.columns


def test_store_merge_and_logs(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "store"))
    a = spark.createDataFrame([(1, 2023, "x", 1), (2, 2024, "y", 1), (None, 2024, "n", 1)], "id int, season int, v string, load_id int")
    store.merge("t", a, ["id"], partition_by="season")
    u = spark.createDataFrame([(2, 2024, "old", 2, "new"), (2, 2024, "z", 3, "new"), (None, 2024, "m", 2, None), (3, 2024, "q", 2, None)], "id int, season int, v string, load_id int, extra string")
    store.merge("t", u, ["id"], [F.desc("load_id")], partition_by="season")
    assert rows(store.read("t"), "id", "v") == [(None, "m"), (1, "x"), (2, "z"), (3, "q")]
    assert rows(store.merge("t", u.where("id = 3"), ["id"], full_refresh=True), "id") == [(3,)]
    assert T.high_water(store.read("t"), "load_id") == 2 and store.tables() == ["t"]
    assert rows(T.newer_than(u, "load_id", 2), "v") == [("z",)] and T.newer_than(u, "load_id", None).count() == 4 and T.newer_than(u, "load_id", None, strict_empty=True).count() == 0
    store.quarantine("not_null_t", u.where("extra is null"))
    assert store.read("failures__not_null_t").count() == 2
    step = store.counted_step("load", "t", lambda: store.append("t", store.read("t")))
    assert tuple(step.first())[2:] == (1, 2, 1) and store.read("event_log").count() == 2
    store.keep_children("t", spark.createDataFrame([(9,)], "id int"), "id")
    assert store.read("t").count() == 0
    with pytest.raises(KeyError):
        store.read("missing")


def test_seeds_and_catalog(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_text("id,name\n1,a\n2,\n")
    assert rows(T.read_seed(spark, str(tmp_path / "s.csv"), "id int, name string")) == [(1, "a"), (2, None)]
    assert rows(T.literal_rows(spark, [(1, "o'x"), (2, None), (3, "a\\nb\\'")], "a int, b string")) == [(1, "o'x"), (2, None), (3, "a\\nb\\'")]
    for n in ("events_20180101", "events_20180102", "other"):
        spark.sql(f"drop table if exists {n}")
        spark.range(2).write.option("path", str(tmp_path / n)).saveAsTable(n)
    assert T.tables_by_pattern(spark, "def%", "EVENTS_%") == ["default.events_20180101", "default.events_20180102"]
    assert T.tables_by_prefix(spark, "default", "events_", exclude="%02") == ["default.events_20180101"]
    from dugout.operators.reshape import union_relations

    assert union_relations(T.relations(spark, T.tables_by_prefix(spark, "default", "events_"))).count() == 4
    for n in ("events_20180101", "events_20180102", "other"):
        spark.sql(f"drop table {n}")
    cols = T.sync_columns(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([], "b long, c string"))
    assert cols.columns == ["b", "c"] and rows(cols) == [(2, None)]


def split_loads(df, by):
    return df.where(by), df.where(~by)


def test_incremental_law(spark, tmp_path, rows):
    """full(A u B) == refresh(refresh(A), B), also when B holds earlier games."""
    games = raw_games(spark, [(i, f"2024-{4 + i % 5:02d}-{1 + i % 27:02d}", 1 + i % 2, 2 - i % 2, i % 7, i % 5, "Final", 1 + i % 3) for i in range(1, 41)])
    det = spark.createDataFrame([(i, None, "19:10" if i % 3 else None) for i in range(1, 41)], "game_pk long, first_pitch string, first_pitch__v_text string")
    teams = spark.createDataFrame([(1, 2024, 103), (2, 2024, 104)], "id long, season int, league__id long")
    build = lambda g: intermediate.int_team_game_results(g, det, teams)
    first, second = split_loads(games, F.col("game_pk") % 3 != 0)
    store = T.TableStore(spark, str(tmp_path / "s"))
    keys = ["game_pk", "team_id"]
    everything, pair = first.unionByName(second), ["teams__home__team__id", "teams__away__team__id"]
    home = lambda a, b: F.when(F.col("is_home") == 1, F.col(a)).otherwise(F.col(b))
    pairs = dict(zip(pair, [home("team_id", "opponent_team_id"), home("opponent_team_id", "team_id")]))
    refresh = lambda name, src, make, group, touched=None: I.refresh_groups(store, name, src, make, group, keys, target_load=None, touched=touched, in_target=pairs if name == "res" else None)
    refresh("res", first, build, pair)
    refresh("rec", store.read("res"), intermediate.int_team_game_results_to_date, ["team_id"])
    refresh("res", everything, build, pair, second)
    full = build(games)
    assert rows(store.read("res"), "game_pk", "team_id", "series_id", "result") == rows(full, "game_pk", "team_id", "series_id", "result")
    refresh("rec", store.read("res"), intermediate.int_team_game_results_to_date, ["team_id"], build(second))
    want = intermediate.int_team_game_results_to_date(full)
    assert rows(store.read("rec"), *sorted(want.columns)) == rows(want, *sorted(want.columns))


def test_prior_totals_mode(spark, rows):
    """The parity mode agrees with a rebuild when new games follow the stored ones."""
    games = raw_games(spark, [(i, f"2024-05-{i:02d}", 1, 2, i % 4, 2, "Final", 1 + i % 3) for i in (1, 2, 3, 4, 5, 8, 9) if i % 4 != 2])
    det = spark.createDataFrame([(1, None, "19:10")], "game_pk long, first_pitch string, first_pitch__v_text string")
    teams = spark.createDataFrame([(1, 2024, 103)], "id long, season int, league__id long")
    res = intermediate.int_team_game_results(games, det, teams)
    want = intermediate.int_team_game_results_to_date(res)
    got = I.records_with_prior(intermediate.int_team_game_results_to_date(res.where("game_pk < 5")), res)
    cols = sorted(want.columns)
    assert rows(got, *cols) == rows(want.where("game_pk >= 5"), *cols)
    batch = res.where("is_home = 1").select("*", F.col("team_id").alias("home_team_id"), F.col("opponent_team_id").alias("away_team_id")).drop("series_id")
    again = I.series_with_prior(res.where("game_pk < 9"), batch, days=3)
    assert rows(again, "game_pk", "series_id") == rows(res.where("is_home = 1 and game_pk >= 5"), "game_pk", "series_id")


def test_refresh_rows_and_groups(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "s"))
    src = spark.createDataFrame([(1, "a", 5, 1), (2, "b", 6, 1), (3, "a", 7, 2)], "id int, k string, v int, load_id int")
    build = lambda d: d.groupBy("k").agg(F.sum("v").alias("v"), F.max("load_id").alias("load_id"))
    I.refresh_groups(store, "g", src.where("load_id = 1"), build, ["k"], ["k"])
    assert rows(I.refresh_groups(store, "g", src, build, ["k"], ["k"]), "k", "v") == [("a", 12), ("b", 6)]
    I.refresh_rows(store, "r", src.where("load_id = 1"), lambda d: d, ["id"], "load_id")
    assert I.refresh_rows(store, "r", src, lambda d: d, ["id"], "load_id").count() == 3
    assert rows(I.new_rows(src, src.where("id < 3"), ["id"]), "id") == [(3,)]
    assert rows(I.not_yet_loaded(src.select("id"), src.where("id = 1"), "id")) == [(2,), (3,)]
    assert I.retry_rejected(src, src.where("id = 1"), ["id"], src.where("load_id = 2")).count() == 2
    import datetime as dt

    assert I.yearly_due(None, "y") and not I.yearly_due(spark.createDataFrame([("2024",), ("x",)], "y string"), "y", dt.date(2024, 5, 1))


def test_refresh_all_equals_build_all(spark, tmp_path, rows):
    """Two loads, the second with earlier games, a changed one and one that is no longer final."""
    def raw(first, second):
        games = lambda some, load: raw_games(spark, some).withColumn(L.LOAD_ID, F.lit(load))
        g = games(first, "1") if second is None else games(first, "1").unionByName(games(second, "2"))
        det = g.select("game_pk", F.lit(None).cast("string").alias("first_pitch"), F.lit("19:10").alias("first_pitch__v_text"), L.LOAD_ID)
        teams = spark.createDataFrame([(1, 2024, 103), (2, 2024, 104)], "id long, season int, league__id long")
        return {"games": g, "game_details": det, "teams": teams}

    row = lambda i, day, score, state="Final": (i, day, 1 + i % 2, 2 - i % 2, score, 2, state, 1 + i % 3)
    old = [row(i, f"2024-05-{i:02d}", i % 7 + 3) for i in range(5, 15)]
    new = [row(1, "2024-04-01", 9), row(6, "2024-05-06", 1), row(7, "2024-05-07", 9, "In Progress")]
    store = T.TableStore(spark, str(tmp_path / "s"))
    only = ["dim_games", "dim_game_type", "int_team_game_results", "int_team_game_results_to_date", "dim_team_standings"]
    models = {n: m for n, m in registry.models().items() if n in only}
    original, registry.models = registry.models, lambda as_of=None: models
    try:
        registry.refresh_all(raw(old, None), store)
        later = raw([g for g in old if g[0] not in (6, 7)], new)
        got, want = registry.refresh_all(later, store), registry.build_all(later)
        for name in only:
            assert sorted(got[name].columns) == sorted(want[name].columns)
            assert rows(got[name], *sorted(want[name].columns)) == rows(want[name], *sorted(want[name].columns)), name
        # A load with a smaller id comes last, as text and as a number.
        late = raw([g for g in old if g[0] not in (6, 7)], new)
        more = raw([row(20, "2024-05-20", 4), row(2, "2024-04-02", 5)], None)
        late = {n: df.unionByName(more[n].withColumn(L.LOAD_ID, F.lit("0"))) if n != "teams" else df for n, df in late.items()}
        got, want = registry.refresh_all(late, store), registry.build_all(late)
        for name in only:
            assert rows(got[name], *sorted(want[name].columns)) == rows(want[name], *sorted(want[name].columns)), name
        assert got["dim_games"].where("game_pk in (2, 20)").count() == 2
        later = late
        versions = store.path("dim_games")
        registry.refresh_all(later, store)
        assert store.path("dim_games") == versions  # nothing new, nothing written
    finally:
        registry.models = original


def test_refresh_drops_rows_that_no_longer_qualify(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "s"))
    src = spark.createDataFrame([(1, "a", 5, 1), (2, "b", 6, 1), (2, "b", -9, 2), (3, None, 7, 1), (3, None, -7, 2)], "id int, k string, v int, load_id int")
    build = lambda d: d.groupBy("id", "k").agg(F.sum("v").alias("v"), F.max("load_id").alias("load_id")).where("v > 0")
    I.refresh_groups(store, "g", src.where("load_id = 1"), build, ["k"], ["id"])
    got = I.refresh_groups(store, "g", src, build, ["k"], ["id"])
    assert rows(got) == rows(build(src)) == [(1, "a", 5, 1)]


def test_merge_follows_a_key_into_another_partition(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "s"))
    store.merge("t", spark.createDataFrame([(1, "x"), (2, "x")], "id int, part string"), ["id"], partition_by="part")
    got = store.merge("t", spark.createDataFrame([(1, "y")], "id int, part string"), ["id"], partition_by="part")
    assert rows(got, "id", "part") == [(1, "y"), (2, "x")]
    twice = spark.createDataFrame([(1, "y"), (1, "z")], "id int, part string")
    with pytest.raises(Exception, match="give their order"):
        T.merge_upsert(got, twice, ["id"]).collect()
    assert rows(T.merge_upsert(got, twice.where("part = 'y'").union(twice.where("part = 'y'")), ["id"]), "id", "part") == [(1, "y"), (2, "x")]


def test_append_of_a_batch_repairs_a_broken_write(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "s"))
    batch = spark.createDataFrame([(1,), (2,)], "id int")
    I.append_batch(store, "t", batch.where("id = 1"), "s", 0, 0)  # what a write that stopped half way left
    I.append_batch(store, "t", batch, "s", 0, 0)
    I.append_batch(store, "t", spark.createDataFrame([(3,)], "id int"), "s", 1, 0)
    assert rows(store.read("t"), "id") == [(1,), (2,), (3,)]
    broken = tmp_path / "s" / "t" / "v000001_s_000000000002"
    broken.mkdir()
    assert store.read("t").count() == 3 and I._next_load(store, "t") == 2


def test_streaming_upsert(spark, tmp_path, rows):
    store = T.TableStore(spark, str(tmp_path / "s"))
    land = tmp_path / uuid.uuid4().hex  # a folder no earlier run has a checkpoint for
    land.mkdir()
    flat = lambda d: L.games(d).select("game_pk", "teams__home__score")

    def drop(name, g):
        (land / name).write_text(json.dumps({"dates": [{"games": g}]}))

    def go():
        q = I.stream_upsert(spark, str(land), X.SCHEDULE, flat, store, "games", ["game_pk"], str(tmp_path / "cp"))
        assert q.awaitTermination(120)

    drop("a.json", [game(1), game(2)])
    go()
    changed = game(2)
    changed["teams"]["home"]["score"] = 8
    drop("b.json", [changed, game(3)])
    go()
    assert rows(store.read("games"), "game_pk", "teams__home__score") == [(1, 3), (2, 8), (3, 3)]
    go()
    assert store.read("games").count() == 3


def test_build_all_registry(spark, tmp_path):
    ev = L.stamped(L.play_events(landed(spark, tmp_path, "pbp", X.PLAY_BY_PLAY, PBP)), "1", ["game_pk", "play_id"])
    se = L.seasons(landed(spark, tmp_path, "se", X.SEASONS, {"seasons": [{"seasonId": "2024", "springStartDate": "2024-02-20", "postSeasonEndDate": "2024-11-01"}]}))
    store = T.TableStore(spark, str(tmp_path / "wh"))
    t = registry.build_all({"play_events": ev, "seasons": se}, store)
    assert t["mart_pitcher_game"].first().batters_faced == 1 and t["fact_at_bats"].count() == 1
    assert "int_pitches_enriched" in store.tables() and "stg_play_events" not in store.tables() and "fact_games" not in t
    assert t["dim_date"].where("is_spring_training = 1 or baseball_season = 2024").count() > 200
    names = list(registry.models())
    for n, m in registry.models().items():
        assert all(i not in names or names.index(i) < names.index(n) for i in m.inputs)


def test_newest_request_wins(spark, tmp_path, rows):
    """Later answers beat earlier ones, unknown times come last, the first place in an answer counts."""

    def answer(at, *people):
        return {"request": {"at": at} if at else {}, "people": [{"id": i, "fullName": n} for i, n in people]}

    payloads = landed(spark, tmp_path, "people", X.PEOPLE, answer("2024-01-01T00:00:00Z", (1, "old"), (2, "first"), (2, "second")), answer(None, (1, "unknown"), (3, "only")), answer("2024-02-01T00:00:00Z", (1, "new")))
    assert rows(L.players(payloads), "id", "full_name") == [(1, "new"), (2, "first"), (3, "only")]
    assert rows(L.people_details(payloads, F.lit("x")), "id", "full_name") == [(1, "new"), (2, "first"), (3, "only")]
    again = landed(spark, tmp_path, "tx", X.TRANSACTIONS, *[{"request": {"at": f"2024-0{m}-01T00:00:00Z"}, "transactions": [{"id": 1, "typeCode": str(m)}]} for m in (2, 3, 1)])
    assert rows(L.transactions(again), "transaction_id", "type_code") == [(1, "3")]
    twice = landed(spark, tmp_path, "umps", X.BOX_SCORE, *[{"request": {"gamePk": g, "at": f"2024-01-0{d}T00:00:00Z"}, "officials": [{"officialType": "HP", "official": {"id": d}}]} for g, d in ((1, 1), (1, 2), (2, 1))])
    assert rows(L.umpires(L.newest_requests(twice, ["gamePk"])), "game_pk", "official_id") == [(1, 2), (2, 1)]


def test_season_stats_of_several_teams(spark, tmp_path, rows):
    def answer(at, group, *splits):
        return {"request": {"season": 2024, "group": group, "at": at}, "stats": [{"splits": [{"player": {"id": p}, "team": {"id": t}, "stat": {"homeRuns": h}} for p, t, h in splits]}]}

    payloads = landed(spark, tmp_path, "stats", X.STATS, answer("2024-01-01T00:00:00Z", "hitting", (1, 10, 5), (1, 20, 6)), answer("2024-02-01T00:00:00Z", "hitting", (1, 30, 7), (1, 40, 8)), answer("2024-03-01T00:00:00Z", "pitching", (1, 50, 9), (2, 60, 1)))
    assert rows(L.player_season_stats(payloads), "player__id", "team__id", "batting_stat__home_runs", "pitching_stat__home_runs") == [(1, 30, 7, 9), (2, 60, None, 1)]


def test_flatten_reads_only_the_fields_it_needs(spark, tmp_path):
    """Payloads kept as Parquet: officials are read without the players beside them, schedules without what no column needs."""

    def scan(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        return next(x for x in df._jdf.queryExecution().explainString(mode).splitlines() if "ReadSchema" in x)

    for name, schema in (("box", X.BOX_SCORE), ("plays", X.PLAY_BY_PLAY)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    umpires = scan(L.umpires(spark.read.parquet(str(tmp_path / "box"))))
    assert "officials" in umpires and "gamePk" in umpires and "players" not in umpires and "label" not in umpires and "season" not in umpires
    plays = scan(L.play_events(spark.read.parquet(str(tmp_path / "plays"))).select("game_pk", "play_id"))
    assert "request:struct<gamePk:bigint>" in plays
