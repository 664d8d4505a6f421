"""Read queries over the star schema. ``t`` maps table names to DataFrames.

Id arguments default to None, which answers for every id at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.joins import growing, lookup
from ..operators.windows import dedup_latest
from .dims import BATTING, FIELDING, PITCHING
from .intermediate import RECORD_SPLITS, SEASON_RECORDS

Tables = dict[str, DataFrame]
c = F.col


def _only(df: DataFrame, **ids: object) -> DataFrame:
    """Rows of the given ids; None means all."""
    for col, v in ids.items():
        if v is not None:
            df = df.where(c(col) == F.lit(v))
    return df


def seasons(t: Tables, before: int | None = None) -> DataFrame:
    """Seasons, newest first; ``before`` leaves out later ones where the caller asks for it."""
    known = t["dim_season"] if before is None else t["dim_season"].where(c("season") < before)
    return known.select("season").distinct().orderBy(F.desc("season"))


def teams(t: Tables) -> DataFrame:
    """Latest season row per team, dealt by team before the rows are put in order."""
    latest = dedup_latest(t["dim_teams"].repartition("team_id"), ["team_id"], [c("season").desc()])
    return latest.select("team_id", "team_name", "abbreviation", "season").orderBy("team_name", "team_id")


def _both_teams(t: Tables, games: DataFrame, names: bool, required: bool = False) -> DataFrame:
    """Games with both teams' names in their two roles."""
    out = games
    for s in ("home", "away"):
        take = {f"{s}_team_abbr": "abbreviation", f"_{s}_known": "team_id"} | ({f"{s}_team_name": "team_name"} if names else {})
        if names:
            out = out.drop(f"{s}_team_name")
        out = lookup(out, t["dim_teams"], {"team_id": f"{s}_team_id", "season": "season"}, take, grows=True)
    if required:
        out = out.where(c("_home_known").isNotNull() & c("_away_known").isNotNull())
    extra = [f"{s}_team_name" for s in ("home", "away")] if names else []
    return out.select("game_pk", "game_date", "season", "home_team_id", "away_team_id", "home_team_abbr", "away_team_abbr", *extra)


def games_by_season(t: Tables, season: int | None = None) -> DataFrame:
    return _both_teams(t, _only(t["dim_games"], season=season), names=False, required=True).orderBy(F.desc("game_date"), "game_pk")


def games_by_team(t: Tables, team_id: int) -> DataFrame:
    mine = (c("home_team_id") == team_id) | (c("away_team_id") == team_id)
    return _both_teams(t, t["dim_games"].where(mine), names=True).orderBy(F.desc("game_date"), "game_pk")


def games_by_team_and_opponent(t: Tables, team_id: int, opponent_id: int) -> DataFrame:
    """Head-to-head games, both ways round."""
    h, a = c("home_team_id"), c("away_team_id")
    pair = ((h == team_id) & (a == opponent_id)) | ((h == opponent_id) & (a == team_id))
    return _both_teams(t, t["dim_games"].where(pair), names=False).orderBy(F.desc("game_date"), "game_pk")


def games(t: Tables, season: int | None = None, team_id: int | None = None, opponent_id: int | None = None) -> DataFrame:
    """Routes to the season, team or head-to-head list."""
    if team_id and opponent_id:
        return games_by_team_and_opponent(t, team_id, opponent_id)
    if team_id:
        return games_by_team(t, team_id)
    if season:
        return games_by_season(t, season)
    raise ValueError("give season or team_id")


def game_details(t: Tables, game_pk: int | None = None) -> DataFrame:
    venue = t["dim_games"].select("game_pk", "venue_name")
    return _only(t["dim_game_details"], game_pk=game_pk).join(growing(venue), "game_pk")


def game_season(t: Tables, game_pk: int | None = None) -> DataFrame:
    return _only(t["dim_games"], game_pk=game_pk).select("season")


def game_matchup(t: Tables, game_pk: int | None = None) -> DataFrame:
    out = _both_teams(t, _only(t["dim_games"], game_pk=game_pk), names=True)
    return out.select("game_pk", "game_date", "home_team_id", "away_team_id", "home_team_name", "away_team_name")


def game_venue(t: Tables, game_pk: int | None = None) -> DataFrame:
    g = _only(t["dim_games"], game_pk=game_pk).select("game_pk", c("venue_id").cast("string").alias("venue_id"))
    v = t["dim_venue"].select(c("venue_id").cast("string").alias("venue_id"), "venue_name", "location_name", "first_year_of_play")
    out = g.join(v, "venue_id").select("game_pk", "venue_name", "location_name", "first_year_of_play")
    return out if game_pk is None else out.drop("game_pk")


def game_umpires(t: Tables, game_pk: int | None = None) -> DataFrame:
    return _only(t["dim_game_umpires"], game_pk=game_pk).select("game_pk", "official_type", "official_id", "full_name")


def game_umpire_performance(t: Tables, game_pk: int | None = None) -> DataFrame:
    names = t["dim_game_umpires"].select("game_pk", "official_id", "full_name")
    return _only(t["fact_umpire_performance"], game_pk=game_pk).join(growing(names), ["game_pk", "official_id"])


def game_players(t: Tables, game_pk: int | None = None) -> DataFrame:
    """Batters and pitchers of a game: two columns become rows, then an equi-join.

    Dealt by player first: one exchange serves the distinct rows and the join, and no task
    that reads holds the distinct rows of its files.
    """
    seen = _only(t["fact_at_bats"], game_pk=game_pk).select("game_pk", F.explode(F.array("batter_id", "pitcher_id")).alias("player_id"))
    seen = seen.where(c("player_id").isNotNull()).repartition("player_id").distinct()
    who = t["dim_player"].select("player_id", "full_name", "position__name").distinct()
    out = seen.join(growing(who), "player_id").select("game_pk", "player_id", "full_name", "position__name")
    return out.orderBy("full_name") if game_pk is None else out.drop("game_pk").orderBy("full_name")


def _any_positive(names: list[str]) -> Column:
    hit = F.lit(False)
    for n in names:
        hit = hit | F.coalesce(c(n) > 0, F.lit(False))
    return hit


PITCHING_LINE = [f"pitching_{n}" for n in PITCHING]
FIELDING_LINE = [f"fielding_{n}" for n in FIELDING]
BATTING_LINE = [f"batting_{n}" for n in BATTING]


def player_role() -> Column:
    """What a player did in a game, from the line's counts."""
    pitched, batted, fielded = _any_positive(PITCHING_LINE), _any_positive(BATTING_LINE), _any_positive(FIELDING_LINE)
    return F.when(pitched & batted, "Both").when(pitched, "Pitcher").when(fielded | batted, "Batter/Fielder").otherwise("Did Not Play")


def game_players_stats(t: Tables, game_pk: int | None = None) -> DataFrame:
    """Lines of everyone who played, with role and innings text.

    The role is exploded from an array that is empty for those who did not play. A filter on it
    would be pushed down to the read with all the counts it is made of, and the planner doubles
    such a filter's constraints, in the driver's memory, for every count that is computed there.
    """
    ids = [] if game_pk is not None else ["game_pk"]
    played = F.array_remove(F.array(player_role()), "Did Not Play")
    out = _only(t["dim_player_stats"], game_pk=game_pk).select(
        *ids,
        *["player_id", "player_name", "team_name", "is_home", "position_name"],
        F.explode(played).alias("player_role"),
        "pitching_outs_recorded",
        S.outs_to_innings("pitching_outs_recorded").alias("innings_pitched"),
        *PITCHING_LINE[1:],
        "pitching_era_raw",
        *FIELDING_LINE,
        *BATTING_LINE,
        "batting_avg_raw",
    )
    return out.orderBy(F.desc("is_home"), "position_name", "player_id")


def all_players(t: Tables) -> DataFrame:
    return t["dim_player"].select("player_id", "full_name", "position__name").orderBy("full_name")


def all_venues(t: Tables) -> DataFrame:
    return t["dim_venue"].select("venue_name", "location_name", "first_year_of_play").orderBy("venue_name")


def all_umpires(t: Tables) -> DataFrame:
    return t["dim_game_umpires"].select("official_id", "full_name").distinct().orderBy("full_name", "official_id")


def all_draft_picks(t: Tables) -> DataFrame:
    return t["dim_draft"].orderBy(F.desc("person_draft_year"), "round_pick_number", "pick_number")


def team_draft(t: Tables, team_id: int) -> DataFrame:
    return all_draft_picks({"dim_draft": _only(t["dim_draft"], team_id=team_id)})


def _awards(t: Tables, recipients: DataFrame) -> DataFrame:
    names = t["dim_award"].select("award_id", "award_name")
    won = recipients.drop("award_name").join(names, "award_id")
    team = t["dim_teams"].withColumn("season", c("season").cast("string"))
    won = lookup(won, team, {"team_id": "team_id", "season": "season"}, {"_abbr": "abbreviation"})
    return won.select("award_name", "award_id", "player_id", "season", "award_date", F.coalesce("_abbr", F.lit("Unknown")).alias("team"))


def all_awards(t: Tables) -> DataFrame:
    return _awards(t, t["dim_award_recipient"]).orderBy(F.desc("season"), F.desc("award_date"), "award_name")


def player_awards(t: Tables, player_id: int) -> DataFrame:
    return _awards(t, _only(t["dim_award_recipient"], player_id=player_id)).orderBy(F.desc("season"))


def player_season_stats(t: Tables, player_key: str | None = None) -> DataFrame:
    """Season statistics with the team's short name, newest first."""
    s = lookup(_only(t["fact_player_stats"], player_key=player_key), t["dim_teams"], {"team_key": "team_key"}, {"team_abbr": "abbreviation"})
    hidden = {"player_key", "team_key", "season_key", "created_at", "updated_at"}
    return s.select(*[x for x in s.columns if x not in hidden and not x.startswith("_")]).orderBy(F.desc("season"))


def _bio(name_team: bool) -> list[Column]:
    place = F.concat_ws(", ", "birth_city", "birth_state_province", "birth_country")
    size = S.joined(c("height"), F.lit(" "), c("weight").cast("string"), F.lit(" lbs."))
    hands = S.joined(F.lit("Bats "), c("bat_side__description"), F.lit(" Throws "), c("pitch_hand__description"))
    team = [c("team_name")] if name_team else []
    return [
        c("id"), c("full_name"), *team, c("birth_date"), c("current_age"), size.alias("height/weight"), c("primary_position__name").alias("position"),
        c("mlb_debut_date").alias("debut"), hands.alias("Bats/Throws"), place.alias("birth_place"),
    ]


def player_detail(t: Tables, player_id: int | None = None) -> DataFrame:
    return _only(t["players"], id=player_id).select(*_bio(False)).withColumn("birthplace", c("birth_place"))


def player_transactions(t: Tables, player_id: int | None = None) -> DataFrame:
    return _only(t["player_transactions"], player_id=player_id).select("date", "description").orderBy(F.desc("date"))


def player_draft(t: Tables, player_id: int) -> DataFrame:
    """The player's latest pick."""
    home = F.concat_ws(", ", "home_city", "home_state", "home_country")
    school = F.concat_ws(", ", "school_name", "school_city", "school_state", "school_country")
    born = F.concat_ws(", ", "person_birth_city", "person_birth_state_province", "person_birth_country")
    return _only(t["dim_draft"], person_id=player_id).select(
        c("person_draft_year").alias("draft_year"),
        c("round_pick_number").alias("round"),
        c("round_pick_number").alias("pick"),
        "person_primary_position_name",
        born.alias("birth_location"),
        home.alias("home_location"),
        school.alias("school_location"),
        "draft_type_description",
    ).orderBy(F.desc("draft_year"), "round", "draft_type_description", "school_location").limit(1)


def game_player_detail(t: Tables, game_pk: int) -> DataFrame:
    """Bios of a game's players with the team they played for."""
    seen = _only(t["dim_player_stats"], game_pk=game_pk).select(c("player_id").alias("id"), "team_id", "team_name").distinct()
    return t["players"].join(seen, "id").select(*_bio(True)).orderBy("team_name", "full_name")


def team_players(t: Tables, team_id: int, season: int | None = None, game_pk: int | None = None) -> DataFrame:
    """Everyone who appeared for a team in a season: the given one, the game's, or the latest with data."""
    stats = _only(t["dim_player_stats"], team_id=team_id)
    if season is not None:
        stats = stats.where(c("season") == season)
    elif game_pk is not None:
        stats = stats.where(c("season") == game_season(t, game_pk).scalar())
    else:
        stats = stats.where(c("season") == team_latest_season(t, team_id).scalar())
    seen = stats.groupBy(c("player_id").alias("id")).agg(F.max("team_name").alias("team_name"))
    return t["players"].join(seen, "id").select(*_bio(True)).orderBy("full_name")


def team_latest_season(t: Tables, team_id: int) -> DataFrame:
    return _only(t["dim_player_stats"], team_id=team_id).agg(F.max("season").alias("season"))


def player_batting_at_bats(t: Tables, player_id: int) -> DataFrame:
    return _only(t["fact_at_bats"], batter_id=player_id).orderBy("game_pk", "at_bat_index")


def player_pitching_at_bats(t: Tables, player_id: int) -> DataFrame:
    return _only(t["fact_at_bats"], pitcher_id=player_id).orderBy("game_pk", "at_bat_index")


def _season_upto(t: Tables, game_pk: int, player_id: int) -> DataFrame:
    """The player's lines of the anchor game's season and type, up to its start time.

    The anchor is a one-row lookup by key, used as scalar subqueries instead of a join.
    """
    anchor = t["dim_games"].where(c("game_pk") == game_pk)
    at = lambda col: anchor.select(col).scalar()
    g = t["dim_games"].where((c("season") == at("season")) & (c("game_type") == at("game_type")) & (c("game_datetime") <= at("game_datetime")))
    return _only(t["int_player_game_stats"], player_id=player_id).join(g.select("game_pk"), "game_pk")


def player_ytd_pitching(t: Tables, game_pk: int, player_id: int) -> DataFrame:
    """Season to date as of a game: decisions, totals and rates from the totals."""
    s = _season_upto(t, game_pk, player_id).where(_any_positive(PITCHING_LINE))
    roles = {"wins": "winning", "losses": "losing", "saves": "save"}
    f = t["fact_games"].select("game_pk", *[f"{r}_pitcher_id" for r in roles.values()])
    s = s.join(f, "game_pk", "left")
    sums = {"hits_allowed": "hits_allowed", "runs_allowed": "runs_allowed", "earned_runs": "earned_runs", "walks": "walks", "strikeouts": "strikeouts", "home_runs_allowed": "home_runs_allowed"}
    a = s.agg(
        F.count_distinct("game_pk").alias("games_played"),
        *[F.sum(S.flag(c(f"{r}_pitcher_id") == c("player_id"))).alias(n) for n, r in roles.items()],
        F.sum("pitching_outs_recorded").alias("_outs"),
        *[F.sum(f"pitching_{src}").alias(out) for out, src in sums.items()],
    )

    def per(factor: int, num: Column, kind: str) -> Column:
        return F.try_divide(num.cast("decimal(20,1)") * factor, F.nullif(c("_outs"), F.lit(0))).cast(kind)

    return a.select(
        "games_played", *roles, S.outs_to_innings("_outs").alias("innings_pitched"), *sums,
        per(27, c("earned_runs"), "decimal(6,2)").alias("era"),
        per(3, c("hits_allowed") + c("walks"), "decimal(5,2)").alias("whip"),
        per(27, c("strikeouts"), "decimal(5,2)").alias("k_per9"),
    )


def player_ytd_batting(t: Tables, game_pk: int, player_id: int) -> DataFrame:
    s = _season_upto(t, game_pk, player_id)
    names = ["at_bats", "runs", "hits", "doubles", "triples", "home_runs"]
    a = s.agg(F.count_distinct("game_pk").alias("games_played"), *[F.sum(f"batting_{n}").alias(n) for n in names])
    return a.withColumn("avg", S.rate_text(F.try_divide(c("hits").cast("double"), F.nullif(c("at_bats"), F.lit(0)))))


def player_ytd(t: Tables, game_pk: int, player_id: int, role: str = "batter") -> DataFrame:
    return player_ytd_pitching(t, game_pk, player_id) if role == "pitcher" else player_ytd_batting(t, game_pk, player_id)


def team_detail(t: Tables, team_id: int | None = None) -> DataFrame:
    return _only(t["dim_teams"], team_id=team_id)


def team_venue(t: Tables, team_id: int | None = None) -> DataFrame:
    v = t["dim_venue"].select(c("venue_id").cast("string").alias("venue_id"), "venue_name", "location_name", "first_year_of_play")
    mine = _only(t["dim_teams"], team_id=team_id).select("team_id", "season", c("venue_id").cast("string").alias("venue_id"))
    out = mine.join(v, "venue_id").select("team_id", "season", "venue_name", "location_name", "first_year_of_play")
    return out if team_id is None else out.drop("team_id", "season")


def game_team_records(t: Tables, game_pk: int | None = None) -> DataFrame:
    """Running records of both teams as of a game."""
    splits = [s for s in RECORD_SPLITS if s != "season"] + list(SEASON_RECORDS)
    first = [
        "team_id", "team_name", "is_home", "opponent_team_name", "result", "venue_id", "double_header", "day_night", "start_hour",
        "is_interleague", "games_in_series", "series_game_number",
    ]
    ids = ["game_pk"] if game_pk is None else []
    out = _only(t["int_team_game_results_to_date"], game_pk=game_pk)
    return out.select(*ids, *first, *[f"{w}_to_date_{s}" for s in splits for w in ("wins", "losses")]).orderBy(F.desc("is_home"))
