"""Headline queries on the local machine: prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from dugout.catalog import QUERIES
from dugout.session import get_spark

HEADLINE = [
    "int_pitches_enriched",
    "mart_pitcher_game",
    "mart_batter_game",
    "mart_matchups",
    "mart_pitcher_arsenal",
    "fact_at_bats",
    "fact_games",
    "fact_umpire_performance",
    "int_team_game_results",
    "int_team_game_results_to_date",
    "dim_team_standings_by_date",
    "dim_player_stats_by_date",
    "dim_player_history",
    "window_running_totals",
    "join_asof_previous_purchase",
    "agg_exact_quantile",
    "incremental_merge_upsert",
    "test_mutually_exclusive_ranges",
    "compare_all_columns",
    "fiscal_periods",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    os.environ.setdefault("DUGOUT_DRIVER_MEMORY", "16g")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_spark("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        took = []
        for i in range(runs + 1):  # the first run warms up
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(took[1:] or took), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
