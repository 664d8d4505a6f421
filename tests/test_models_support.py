"""Small dimension tables around a set of games."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dugout.plans import dims, intermediate
from dugout.sources.landing import LOAD_ID, ROW_ID


def game_tables(spark, games):
    box_cols = [f"{s}_{c}" for s in ("home", "away") for c in intermediate.BOX_COLUMNS]

    def box(pk, home_runs):
        v = {c: 0 for c in box_cols} | {"home_runs": home_runs, "home_hits": 5, "home_pitching_outs": 27, "away_pitching_outs": 24, "home_rbi": home_runs}
        return (pk, *[v[c] for c in box_cols], 30)

    boxes = spark.createDataFrame([box(2, 2), box(3, 7)], "game_pk long, " + ", ".join(f"{c} long" for c in box_cols) + ", player_rows long")
    details = games.select("game_pk", *[F.lit(None).cast("int").alias(c) for c in dims.DETAIL_COLUMNS if c != "game_pk"])
    seasons = spark.createDataFrame([(2024,)], "season int").select("season", *[F.lit("2024-03-01").alias(c) for c in dims.SEASON_COLUMNS if c != "season"])
    return {
        "details": details,
        "box": boxes,
        "dates": dims.dim_date(spark, seasons, as_of=dt.date(2024, 1, 1)),
        "teams": spark.createDataFrame([(1, 2024, "t1"), (2, 2024, "t2")], "team_id long, season int, team_key string"),
        "venues": spark.createDataFrame([(1, "v1")], "venue_id long, venue_key string"),
        "seasons": dims.dim_season(seasons),
        "game_types": spark.createDataFrame([("R", "k")], "game_type_code string, game_type_key string"),
        "game_statuses": spark.createDataFrame([("F", "F", "k")], "status__coded_game_state string, status__status_code string, game_status_key string"),
    }


def raw_games(spark, rows):
    schema = f"game_pk long, season string, game_type string, game_date timestamp, official_date string, status__abstract_game_state string, status__coded_game_state string, status__detailed_state string, status__status_code string, status__start_time_tbd boolean, teams__home__team__id long, teams__home__team__name string, teams__home__score int, teams__home__is_winner boolean, teams__away__team__id long, teams__away__team__name string, teams__away__score int, teams__away__is_winner boolean, venue__id long, venue__name string, game_number int, double_header string, day_night string, scheduled_innings int, games_in_series int, series_game_number int, series_description string, is_tie boolean, public_facing boolean, {LOAD_ID} string, {ROW_ID} string"
    out = []
    for pk, day, home, away, hs, as_, state, no in rows:
        hw = None if hs is None else hs > as_
        out.append((pk, day[:4], "R", dt.datetime.fromisoformat(day + " 19:00:00"), day, "Final", "F", state, "F", False, home, f"T{home}", hs, hw, away, f"T{away}", as_, None if hw is None else not hw, 1, " Park ", 1, "N", "night", 9, 3, no, None, False, True, "1", f"g{pk}"))
    return spark.createDataFrame(out, schema)
