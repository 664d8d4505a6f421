"""Plans and payloads whose cost grows no faster than the tables: over small tables built here."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from dugout.catalog import QUERIES
from dugout.catalog import landing_queries as Q
from dugout.operators.windows import SPREAD_TASKS
from dugout.plans import serving


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("growth"))
    n = spark.range(240)
    day = F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("1995-03-01").cast("timestamp"))
    orders = n.select(
        (F.col("id") * 100).alias("o_orderkey"), (F.col("id") % 20).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 13.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"),
    )
    orders.write.parquet(f"{d}/orders.parquet")
    spark.range(40).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("c_name"), (F.col("id") % 25).alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment"), F.lit(1.0).alias("c_acctbal"),
    ).write.parquet(f"{d}/customer.parquet")
    spark.range(30).select(F.col("id").alias("p_partkey")).write.parquet(f"{d}/part.parquet")
    spark.range(480).select(
        (F.floor(F.col("id") / 2) * 100).alias("l_orderkey"), (1 + F.col("id") % 2).alias("l_linenumber"), (F.col("id") % 30).alias("l_partkey"),
        (F.col("id") % 10).alias("l_suppkey"), F.lit(5.0).alias("l_quantity"), F.lit(100.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
        F.lit(0.02).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit("1995-03-01").cast("timestamp").alias("l_shipdate"),
    ).write.parquet(f"{d}/lineitem.parquet")
    return d


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "serve_game_players_stats", "int_team_game_results", "int_team_game_results_to_date", "serve_game_matchups", "serve_games_by_season",
        "dim_team_standings", "dim_team_standings_by_date", "audit_standings_symmetry", "serve_game_team_records", "serve_game_players",
    ],
)
def test_tables_that_grow_are_not_broadcast(spark, tables, name):
    out = QUERIES[name](spark, tables)
    plan = plan_of(out)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("name", ["fact_games", "audit_fact_games_keys"])
def test_game_fact_joins_games_boxes_and_teams_by_merge(spark, tables, name):
    """Details, lines, box scores and both teams merge; only the small dimensions may be broadcast."""
    joins = [x for x in plan_of(QUERIES[name](spark, tables)).splitlines() if "HashJoin" in x]
    assert not [x for x in joins if "game_pk" in x or "team_id" in x]


def test_split_records_are_dealt_to_a_stated_number_of_tasks(spark, tables):
    plan = plan_of(QUERIES["int_team_game_results_to_date"](spark, tables))
    line = next(x for x in plan.splitlines() if "Exchange" in x and "REPARTITION" in x)
    assert f", {SPREAD_TASKS})" in line and "REPARTITION_BY_NUM" in line


def test_teams_are_dealt_before_they_are_sorted(spark, tables):
    out = QUERIES["serve_teams"](spark, tables)
    plan = plan_of(out)
    assert plan.rindex("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert out.count() == 40 and out.select("season").distinct().collect()[0][0] == 2001


@pytest.mark.parametrize("name", ["fact_at_bats"])
def test_at_bats_take_one_exchange(spark, tables, name):
    assert plan_of(QUERIES[name](spark, tables)).count("Exchange hashpartitioning") == 1


def test_daily_totals_and_running_sums_share_an_exchange(spark, tables):
    plan = plan_of(QUERIES["dim_player_stats_by_date"](spark, tables))
    assert plan.count("Exchange hashpartitioning(player_id") == 1


def test_a_player_of_a_game_is_named_once(spark, tables):
    got = QUERIES["serve_game_players"](spark, tables).collect()
    assert len(got) == len(set(got)) and {r.full_name for r in got} == {f"B{i}" for i in range(30)}


def test_role_of_a_line_is_no_filter_on_computed_counts(spark):
    """Planning doubles the constraints of a filter for every computed count in it: with some twenty they fill the driver."""
    n, bits = F.col("id"), {"pitching_walks": 1, "batting_hits": 2, "fielding_errors": 4}
    lines = spark.range(9).select(
        F.lit(1).alias("game_pk"), n.alias("player_id"), F.lit(1).alias("is_home"),
        *[F.lit("x").alias(x) for x in ("player_name", "team_name", "position_name", "pitching_era_raw", "batting_avg_raw")],
        *[F.when(n == 0, -1).when(n < 8, n.bitwiseAND(bit)).alias(x) for x, bit in bits.items()],
        *[F.lit(None).cast("int").alias(x) for x in (*serving.PITCHING_LINE, *serving.FIELDING_LINE, *serving.BATTING_LINE) if x not in bits],
    )
    out = serving.game_players_stats({"dim_player_stats": lines})
    assert "Filter" not in plan_of(out)
    # Player 0 has negative counts and player 8 none: neither played.
    want = ["Pitcher", "Batter/Fielder", "Both", "Batter/Fielder", "Pitcher", "Batter/Fielder", "Both"]
    assert [(r.player_id, r.player_role) for r in out.collect()] == list(enumerate(want, 1))
    assert out.columns[:7] == ["game_pk", "player_id", "player_name", "team_name", "is_home", "position_name", "player_role"]
    assert serving.game_players_stats({"dim_player_stats": lines}, game_pk=2).count() == 0


def _answers(monkeypatch):
    """Counts the landed answers of each name and keeps their folders."""
    seen, read = {}, Q.L.read_landed

    def counted(spark, path, schema):
        seen[path.rpartition("/")[2].split("-")[1]] = (spark.read.text(path).count(), path)
        return read(spark, path, schema)

    monkeypatch.setattr(Q.L, "read_landed", counted)
    return seen


def test_draft_answers_hold_a_bounded_range_of_picks(spark, tables, monkeypatch):
    seen = _answers(monkeypatch)
    got = QUERIES["landing_draft_picks"](spark, tables)
    # 240 picks of one season, whose keys reach 23,900: three blocks.
    assert seen["draft"][0] == 3
    assert sorted(r.bis_player_id for r in got.collect()) == [i * 100 for i in range(240)]


def test_play_events_are_dealt_once_and_landed_compressed(spark, tables, monkeypatch):
    seen = _answers(monkeypatch)
    got = QUERIES["landing_play_events"](spark, tables)
    assert glob.glob(f"{seen['plays'][1]}/*.json.gz")
    plan = plan_of(got)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.rindex("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    # 480 lines without those of suppliers 0 and 5; every third game answers twice and is read once.
    assert got.count() == 384
