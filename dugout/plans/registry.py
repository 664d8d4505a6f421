"""The model graph: name -> inputs, builder, key. Inputs come before their users."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import loads
from ..sources.landing import LOAD_ID
from ..sources.tables import TableStore, in_groups, replace_groups
from . import dims, facts, intermediate, marts, stage

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """``view`` models stay lazy, the others are written.

    ``by_game``: a game's rows come from that game's rows of the inputs that have games,
    so a refresh may rebuild touched games only.
    """

    inputs: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    keys: tuple[str, ...] = ()
    view: bool = False
    partition_by: str | None = None
    by_game: bool = False


BY_GAME = {
    "dim_games", "dim_game_details", "dim_game_umpires", "dim_challenges", "int_player_game_stats", "dim_player_stats", "int_team_game_box", "int_pitches_enriched",
    "fact_at_bats", "fact_batted_balls", "fact_umpire_performance", "mart_batter_game", "mart_pitcher_game",
}


def _m(build, *inputs: str, keys: tuple[str, ...] = (), view: bool = False, partition_by: str | None = None) -> Model:
    return Model(inputs, lambda t: build(*[t[i] for i in inputs]), keys, view, partition_by)


def models(as_of: dt.date | None = None) -> dict[str, Model]:
    """All models in build order. ``int_pitches_enriched`` has five users and is written once."""
    graph = {
        "stg_play_events": _m(stage.stg_play_events, "play_events", view=True),
        "stg_player_transactions": _m(stage.stg_player_transactions, "player_transactions", view=True),
        "stg_rosters": _m(stage.stg_rosters, "rosters", view=True),
        "dim_award": _m(dims.dim_award, "award_recipients", keys=("award_id",)),
        "dim_award_recipient": _m(dims.dim_award_recipient, "award_recipients", "dim_award", keys=("recipient_key",)),
        "dim_challenges": _m(dims.dim_challenges, "stg_play_events", keys=("game_pk", "start_time", "event_id")),
        "dim_date": Model(("seasons",), lambda t: dims.dim_date(t["seasons"].sparkSession, t["seasons"], as_of), ("date_key",)),
        "dim_draft": _m(dims.dim_draft, "draft", keys=("draft_key",)),
        "dim_game_details": _m(dims.dim_game_details, "game_details", keys=("game_pk",)),
        "dim_game_umpires": _m(dims.dim_game_umpires, "umpires", keys=("game_umpire_key",)),
        "dim_game_status": _m(dims.dim_game_status, "games"),
        "dim_game_type": _m(dims.dim_game_type, "games", keys=("game_type_code",)),
        "dim_pitch_type": _m(dims.dim_pitch_type, "stg_play_events"),
        "dim_venue": _m(dims.dim_venue, "venues", keys=("venue_id",)),
        "dim_season": _m(dims.dim_season, "seasons", keys=("season",)),
        "dim_zone": Model(("seasons",), lambda t: dims.dim_zone(t["seasons"].sparkSession), ("zone_id",)),
        "dim_games": _m(dims.dim_games, "games", keys=("game_pk",)),
        "dim_player": _m(dims.dim_player, "stg_rosters", "stg_player_transactions", keys=("player_id", "version_number")),
        "dim_position": _m(dims.dim_position, "players", "player_stats", "rosters", keys=("position_code",)),
        "dim_school": _m(dims.dim_school, "draft", "school_type_lookup", keys=("school_key",)),
        "dim_teams": _m(dims.dim_teams, "teams", keys=("team_id", "season")),
        "int_player_game_stats": _m(intermediate.int_player_game_stats, "player_game_stats", "dim_games", "game_details", keys=("game_pk", "player_id")),
        "dim_player_stats": _m(dims.dim_player_stats, "int_player_game_stats", keys=("game_pk", "player_id")),
        "dim_player_stats_by_date": _m(dims.dim_player_stats_by_date, "dim_player_stats"),
        "int_team_game_box": _m(intermediate.int_team_game_box, "int_player_game_stats", keys=("game_pk",)),
        "int_pitches_enriched": _m(intermediate.int_pitches_enriched, "stg_play_events", "dim_zone", keys=("event_id",), partition_by="season"),
        "int_team_game_results": _m(intermediate.int_team_game_results, "games", "game_details", "teams", keys=("game_pk", "team_id")),
        "int_team_game_results_to_date": _m(intermediate.int_team_game_results_to_date, "int_team_game_results", keys=("game_pk", "team_id")),
        "dim_team_standings": _m(dims.dim_team_standings, "int_team_game_results", keys=("game_pk", "team_id")),
        "dim_team_standings_by_date": _m(dims.dim_team_standings_by_date, "dim_team_standings"),
        "fact_at_bats": _m(facts.fact_at_bats, "stg_play_events", keys=("game_pk", "at_bat_index", "batter_id")),
        "fact_batted_balls": _m(facts.fact_batted_balls, "stg_play_events", keys=("event_id",)),
        "fact_draft": _m(facts.fact_draft, "draft", "dim_draft", keys=("draft_key",)),
        "fact_games": _m(
            facts.fact_games, "dim_games", "dim_game_details", "int_team_game_box", "dim_date", "dim_teams", "dim_venue", "dim_season", "dim_game_type",
            "dim_game_status", keys=("game_pk",),
        ),
        "fact_player_stats": _m(facts.fact_player_stats, "player_stats", "dim_player", "dim_teams", "dim_season"),
        "fact_umpire_performance": _m(facts.fact_umpire_performance, "dim_game_umpires", "int_pitches_enriched", "dim_challenges", keys=("game_pk", "official_id")),
        "mart_batter_game": _m(marts.mart_batter_game, "int_pitches_enriched", "fact_batted_balls", keys=("game_pk", "batter_id")),
        "mart_matchups": _m(marts.mart_matchups, "int_pitches_enriched", "fact_batted_balls", keys=("season", "pitcher_id", "batter_id")),
        "mart_pitcher_arsenal": _m(marts.mart_pitcher_arsenal, "int_pitches_enriched", "dim_pitch_type", keys=("season", "pitcher_id", "pitch_type_code")),
        "mart_pitcher_game": _m(marts.mart_pitcher_game, "int_pitches_enriched", keys=("game_pk", "pitcher_id")),
    }
    return {name: replace(m, by_game=name in BY_GAME) for name, m in graph.items()}


def build_all(raw: Tables, store: TableStore | None = None, only: list[str] | None = None, as_of: dt.date | None = None) -> Tables:
    """Builds the models whose inputs are there, in order.

    With a store every table model is written and read back, so later models start from
    files; without one everything stays lazy.
    """
    t = dict(raw)
    for name, model in models(as_of).items():
        if (only is not None and name not in only) or any(i not in t for i in model.inputs):
            continue
        df = model.build(t)
        if store is not None and not model.view:
            df = store.overwrite(name, df, [model.partition_by] if model.partition_by else [])
        t[name] = df
    return t


SEEN, TOUCHED, GAME = "_loads_seen", "_touched_games", "game_pk"


def refresh_all(raw: Tables, store: TableStore, as_of: dt.date | None = None, full_refresh: bool = False) -> Tables:
    """Brings the stored models to the loads in ``raw``; the result is that of :func:`build_all`.

    A ledger holds every load seen; a raw table without a load beyond it is taken as
    unchanged, and so is every model on it. Loads may come late, with smaller ids than
    others. Where all changes are to tables with games, models kept by game rebuild the
    games of the new loads and replace them; every other model on a changed table is
    rebuilt whole. A raw table without loads counts as unchanged after the first time: give
    ``full_refresh`` when one was edited.
    """
    seen = None if full_refresh or not store.exists(SEEN) else store.read(SEEN)
    known = set() if seen is None else {r["source"] for r in seen.where(F.col("load") == loads.TABLE).collect()}
    new = {n: loads.unseen(n, df, seen, LOAD_ID) for n, df in raw.items() if n in known and LOAD_ID in df.columns}
    new = {n: df for n, df in new.items() if not df.isEmpty()}
    state = {n: "all" if n not in known else "same" if n not in new else "games" if GAME in df.columns else "all" for n, df in raw.items()}
    if changed := [n for n, s in state.items() if s == "games"]:
        touched = store.overwrite(TOUCHED, functools.reduce(DataFrame.unionByName, [new[n].select(GAME) for n in changed]).distinct())
    t = dict(raw)
    for name, model in models(as_of).items():
        if any(i not in t for i in model.inputs):
            continue
        seen = {state[i] for i in model.inputs}
        if model.view:
            t[name], state[name] = model.build(t), "all" if "all" in seen else "games" if "games" in seen else "same"
            continue
        if not store.exists(name) or "all" in seen or "games" in seen and not model.by_game:
            t[name], state[name] = store.overwrite(name, model.build(t), [model.partition_by] if model.partition_by else []), "all"
        elif "games" in seen:
            part = {i: in_groups(t[i], touched, [GAME]) if GAME in t[i].columns else t[i] for i in model.inputs}
            rows = replace_groups(store.read(name), touched, model.build(part), {GAME: F.col(GAME)})
            t[name], state[name] = store.overwrite(name, rows, [model.partition_by] if model.partition_by else []), "games"
        else:
            t[name], state[name] = store.read(name), "same"
    store.overwrite(SEEN, loads.ledger(raw, LOAD_ID))
    return t
