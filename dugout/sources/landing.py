"""Flatten jobs: landed JSON payloads to raw tables.

Each job is a narrow projection with ``explode``; a payload is one game, team or
season, so the arrays that are exploded are small and rows stay where they were read.

Where one thing is in several answers, the newest request wins (``request.at``, unknown
times last); within one answer the first place wins. What is still tied is told apart by
its content, so a repeated run gives the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..operators.joins import growing, not_in
from ..operators.reshape import id_union
from ..operators.windows import dedup_latest

LOAD_ID = "_load_id"
ROW_ID = "_row_id"

# Plate-appearance results that are hits; schedule rows never loaded;
# levels of play by sport id.
HIT_EVENTS = ("single", "double", "triple", "home_run")
SKIPPED_GAME_TYPES = ("E", "A")
SKIPPED_GAME_STATES = ("Cancelled", "Postponed")
LEVELS = {1: "MLB", 11: "AAA", 12: "AA", 13: "High-A", 14: "Single-A", 16: "Rookie"}
STAT_GROUPS = {"hitting": "batting", "pitching": "pitching", "fielding": "fielding", "running": "running"}


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed JSON lines with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def snake(name: str) -> str:
    """camelCase to snake_case."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])|(?<=[A-Z])([A-Z])(?=[a-z])", lambda m: "_" + m.group(0), name).lower()


def flattened(df: DataFrame) -> DataFrame:
    """Nested structs to columns joined by two underscores, names in snake case."""

    def walk(schema: T.StructType, at: Column | None, prefix: str) -> list[Column]:
        out = []
        for f in schema.fields:
            c = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
            name = prefix + snake(f.name)
            out += walk(f.dataType, c, name + "__") if isinstance(f.dataType, T.StructType) else [c.alias(name)]
        return out

    return df.select(*walk(df.schema, None, ""))


def stamped(df: DataFrame, load_id: str, keys: list[str]) -> DataFrame:
    """Adds the load id and a row id made of load and keys."""
    return df.withColumns({LOAD_ID: F.lit(load_id), ROW_ID: S.surrogate_key([F.lit(load_id), *keys])})


_AT = "_at"


def newest_requests(payloads: DataFrame, keys: list[str]) -> DataFrame:
    """Of the answers to one request, told by its parameters ``keys``, the newest.

    Hardly any request has two answers in one file, so the payloads are dealt by request
    before they are put in order: no reading task sorts whole files of them.
    """
    marks = {f"_request_{k}": F.col(f"request.{k}") for k in keys}
    return dedup_latest(payloads.withColumns(marks).repartition(*marks), list(marks), [F.col("request.at").desc_nulls_last()]).drop(*marks)


def _one_each(rows: DataFrame, keys: list[str], places: list[str]) -> DataFrame:
    """One row a key: of the newest request, there at the first place; drops the columns that say so."""
    rest = [c for c in rows.columns if c != _AT and c not in places]
    return dedup_latest(rows, keys, [F.col(_AT).desc_nulls_last(), *places, F.xxhash64(*rest)]).select(*rest)


def _exploded(payloads: DataFrame, array: str, *more: Column) -> DataFrame:
    """The structs of an array as columns, with the request's time and the place."""
    at = F.col("request.at").alias(_AT)
    return payloads.select(at, *more, F.posexplode(array).alias("_place", "_x")).select(_AT, "_place", *[c for c in ["asked"] if more], "_x.*")


def games(schedule: DataFrame) -> DataFrame:
    """One row per finished, non-exhibition game, once per game id."""
    days = schedule.select(F.col("request.at").alias(_AT), F.posexplode("dates").alias("_day", "d"))
    one = days.select(_AT, "_day", F.posexplode("d.games").alias("_place", "g")).select(_AT, "_day", "_place", "g.*")
    one = one.where(
        ~F.coalesce("gameType", F.lit("")).isin(*SKIPPED_GAME_TYPES)
        & ~F.coalesce("status.detailedState", F.lit("")).isin(*SKIPPED_GAME_STATES)
        & (F.col("status.abstractGameState") == "Final")
    )
    return flattened(_one_each(one, ["gamePk"], ["_day", "_place"]))


def play_events(play_by_play: DataFrame) -> DataFrame:
    """One row per pitch with its plate appearance's result copied on."""
    plays = play_by_play.select(F.col("request.season").alias("season"), F.col("request.gamePk").alias("gamePk"), F.explode("allPlays").alias("p"))
    pitch_places = F.transform("p.playEvents", lambda e, i: F.when(e["isPitch"], i))
    events = plays.withColumn("last", F.array_max(pitch_places)).select("*", F.posexplode("p.playEvents").alias("pos", "e"))
    result = F.col("p.result")
    out = events.where("e.isPitch").select(
        "season",
        "gamePk",
        F.col("p.atBatIndex").alias("atBatIndex"),
        "e.*",
        F.coalesce("e.details.isInPlay", F.lit(False)).alias("isInPlay"),
        result["eventType"].alias("result_event_type"),
        result["event"].alias("result_event"),
        result["description"].alias("result_description"),
        result["rbi"].alias("result_rbi"),
        F.coalesce(result["eventType"].isin(*HIT_EVENTS), F.lit(False)).alias("result_is_hit"),
        (F.col("pos") == F.col("last")).alias("is_final_pitch"),
        F.col("p.matchup.batter.id").alias("batter_id"),
        F.col("p.matchup.batter.fullName").alias("batter_name"),
        F.col("p.matchup.batSide.code").alias("batter_side"),
        F.col("p.matchup.pitcher.id").alias("pitcher_id"),
        F.col("p.matchup.pitcher.fullName").alias("pitcher_name"),
        F.col("p.matchup.pitchHand.code").alias("pitcher_hand"),
    )
    return flattened(out)


# Raw column -> payload field of each box-score group.
BATTING_LINE = {
    "at_bats": "atBats", "runs": "runs", "hits": "hits", "doubles": "doubles", "triples": "triples", "home_runs": "homeRuns",
    "rbi": "rbi", "walks": "baseOnBalls", "strikeouts": "strikeOuts", "stolen_bases": "stolenBases", "left_on_base": "leftOnBase",
    "avg": "avg",
}
PITCHING_LINE = {
    "innings_pitched": "inningsPitched", "hits_allowed": "hits", "runs_allowed": "runs", "earned_runs": "earnedRuns",
    "walks": "baseOnBalls", "strikeouts": "strikeOuts", "home_runs_allowed": "homeRuns", "era": "era",
}
FIELDING_LINE = {"putouts": "putOuts", "assists": "assists", "errors": "errors", "chances": "chances"}


def player_game_stats(box_scores: DataFrame) -> DataFrame:
    """One row per player and game from both sides of the box score."""

    def side(name: str, home: bool) -> Column:
        return F.struct(F.lit(home).alias("is_home"), F.col(f"teams.{name}.team").alias("team"), F.col(f"teams.{name}.players").alias("players"))

    sides = box_scores.select(F.col("request.gamePk").alias("game_pk"), F.inline(F.array(side("home", True), side("away", False))))
    rows = sides.select("game_pk", "is_home", "team", F.explode("players").alias("slot", "p"))
    lines = [("batting", BATTING_LINE), ("pitching", PITCHING_LINE), ("fielding", FIELDING_LINE)]
    return rows.select(
        "game_pk",
        F.col("p.person.id").alias("player_id"),
        F.col("p.person.fullName").alias("player_name"),
        F.col("team.id").alias("team_id"),
        F.col("team.name").alias("team_name"),
        "is_home",
        F.col("p.position.code").alias("position_code"),
        F.col("p.position.name").alias("position_name"),
        F.col("p.position.abbreviation").alias("position_abbreviation"),
        *[F.col(f"p.stats.{g}.{src}").alias(f"{g}_{out}") for g, line in lines for out, src in line.items()],
    )


def umpires(box_scores: DataFrame) -> DataFrame:
    """One row per official of a game."""
    return box_scores.select(F.col("request.gamePk").alias("game_pk"), F.explode("officials").alias("o")).select(
        "game_pk",
        F.col("o.officialType").alias("official_type"),
        F.col("o.official.id").alias("official_id"),
        F.col("o.official.fullName").alias("full_name"),
    )


def game_details(live: DataFrame, box_scores: DataFrame, line_scores: DataFrame) -> DataFrame:
    """Weather, decisions and team totals; gaps are filled from box score, then line score."""
    pk = F.col("request.gamePk").alias("game_pk")
    feed = newest_requests(live, ["gamePk"]).select(pk, "gameData", "liveData")
    cleaned = F.transform(
        F.filter("info", lambda i: (i["label"] != "") & (i["value"] != "")),
        lambda i: F.struct(F.lower(F.trim(i["label"])).alias("k"), F.trim(i["value"]).alias("v")),
    )
    # The last of several equal labels wins.
    last_of = F.filter(cleaned, lambda x, i: ~F.exists(F.slice(cleaned, i + 2, F.size(cleaned)), lambda y: y["k"] == x["k"]))
    box = newest_requests(box_scores.select("request", "info"), ["gamePk"]).select(pk, F.map_from_entries(last_of).alias("info"))
    line = newest_requests(line_scores, ["gamePk"]).select(pk, F.col("decisions").alias("ls"))
    j = feed.join(growing(box), "game_pk", "left").join(growing(line), "game_pk", "left")

    def label(name: str) -> Column:
        return F.try_element_at("info", F.lit(name))

    def positive(c: Column) -> Column:
        return F.nullif(c, F.lit(0))

    game, dec = F.col("gameData"), F.col("liveData.decisions")
    att_text = F.regexp_replace(F.coalesce(F.nullif(label("att"), F.lit("")), label("attendance")), ",", "")
    attendance = F.coalesce(positive(game["gameInfo"]["attendance"]), F.trim(att_text).try_cast("int"))
    clock = game["datetime"]
    first_pitch = F.coalesce(S.clock_to_24h(clock["time"], clock["ampm"]), S.clock_to_24h(label("first pitch")))
    # The box score is consulted only when attendance or first pitch is missing.
    box_used = positive(game["gameInfo"]["attendance"]).isNull() | S.clock_to_24h(clock["time"], clock["ampm"]).isNull()
    duration = game["gameInfo"]["gameDurationMinutes"]
    duration = F.when(box_used, F.coalesce(positive(duration), S.duration_minutes(label("t")), duration)).otherwise(duration)
    no_winner = positive(dec["winner"]["id"]).isNull()

    def decision(role: str, field: str) -> Column:
        own = dec[role][field]
        return F.when(no_winner, F.coalesce(own, F.col("ls")[role][field])).otherwise(own)

    out = [
        "game_pk",
        game["weather"]["condition"].alias("weather_condition"),
        game["weather"]["temp"].alias("weather_temp"),
        game["weather"]["wind"].alias("weather_wind"),
        attendance.alias("attendance"),
        first_pitch.alias("first_pitch"),
        game["gameInfo"]["firstPitch"].alias("first_pitch_utc_raw"),
        duration.alias("game_duration_minutes"),
    ]
    for role, name in (("winner", "winning"), ("loser", "losing"), ("save", "save")):
        out += [decision(role, "id").alias(f"{name}_pitcher_id"), decision(role, "fullName").alias(f"{name}_pitcher_name")]
    for side in ("home", "away"):
        stats = F.col("liveData.boxscore.teams")[side]["teamStats"]
        bat, pit = stats["batting"], stats["pitching"]
        skip = ("at_bats", "avg")
        out += [bat[src].alias(f"{side}_{o}") for o, src in BATTING_LINE.items() if o not in skip]
        skip = ("innings_pitched", "era")
        out += [pit[src].alias(f"{side}_pitching_{o}") for o, src in PITCHING_LINE.items() if o not in skip]
        out.append(F.coalesce(positive(bat["errors"]), pit["errors"]).alias(f"{side}_errors"))
    return j.select(*out)


def transactions(payloads: DataFrame) -> DataFrame:
    """One row per transaction id over all yearly windows."""
    t = _one_each(_exploded(payloads, "transactions"), ["id"], ["_place"])
    player = F.col("person.id")
    return t.select(
        F.col("id").alias("transaction_id"),
        "date",
        F.col("effectiveDate").alias("effective_date"),
        F.col("resolutionDate").alias("resolution_date"),
        F.col("typeCode").alias("type_code"),
        F.col("typeDesc").alias("type_desc"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.when(F.coalesce(player, F.lit(0)) != 0, "player").otherwise("team").alias("transaction_category"),
        player.isNotNull().alias("has_player"),
        player.alias("player_id"),
        F.col("person.fullName").alias("player_name"),
        F.col("fromTeam.id").alias("from_team_id"),
        F.col("fromTeam.name").alias("from_team_name"),
        F.col("toTeam.id").alias("to_team_id"),
        F.col("toTeam.name").alias("to_team_name"),
    )


def player_season_transactions(flat: DataFrame) -> DataFrame:
    """Player transactions with the calendar year they took effect in."""
    when = F.coalesce(F.col("effective_date").cast("string"), F.col("date").cast("string"))
    out = flat.where(F.col("player_id").isNotNull()).withColumn("season", F.substring(when, 1, 4).try_cast("int"))
    return out.where(F.col("season").isNotNull()).select(
        "player_id", "season", "transaction_id", "player_name", "from_team_id", "from_team_name", "to_team_id", "to_team_name",
        "type_code", "type_desc", "description", "date", "effective_date", "resolution_date",
    )


def teams(payloads: DataFrame) -> DataFrame:
    """One row per team and season, never collapsed across seasons."""
    t = _exploded(payloads, "teams", F.col("request.season").alias("asked"))
    t = t.withColumn("season", F.coalesce("season", "asked")).drop("asked")
    return flattened(_one_each(t.where(F.col("id").isNotNull()), ["id", "season"], ["_place"]))


def minor_league_teams(payloads: DataFrame) -> DataFrame:
    """Teams below the top level, in a table of their own."""
    return teams(payloads.where(F.col("request.sportId") != 1))


def draft_picks(payloads: DataFrame) -> DataFrame:
    """One row per pick; the table is appended to and deduplicated downstream."""
    picks = payloads.select(F.explode("drafts.rounds").alias("r")).select(F.explode("r.picks").alias("p")).select("p.*")
    return flattened(picks)


def players(payloads: DataFrame) -> DataFrame:
    """One row per person id; the table is replaced on each load."""
    return flattened(_one_each(_exploded(payloads, "people").drop("education"), ["id"], ["_place"]))


def award_recipients(payloads: DataFrame) -> DataFrame:
    """Award winners without retired-number awards."""
    keep = ~F.upper(F.coalesce("request.awardId", F.lit("RETIRE"))).startswith("RETIRE")
    a = payloads.where(keep).select(F.col("request.season").alias("asked"), F.explode("awards").alias("a"))
    position = F.col("a.player.primaryPosition")
    return a.select(
        F.col("a.id").alias("award_id"),
        F.col("a.name").alias("award_name"),
        F.col("a.date").alias("award_date"),
        F.coalesce(S.blank_to_null("a.season"), F.col("asked").cast("string")).alias("season"),
        F.col("a.team.id").alias("team_id"),
        F.col("a.player.id").alias("player_id"),
        F.col("a.player.nameFirstLast").alias("player_name"),
        *[position[p].alias(f"position_{p}") for p in ("code", "name", "type", "abbreviation")],
        F.col("a.notes").alias("notes"),
    )


def rosters(payloads: DataFrame) -> DataFrame:
    """Roster rows stamped with the season and team they were asked for."""
    r = payloads.select(F.col("request.season").alias("season"), F.col("request.teamId").alias("parentTeamId"), F.explode("roster").alias("r"))
    return flattened(r.select("r.*", "season", "parentTeamId"))


def team_coaches(payloads: DataFrame) -> DataFrame:
    """One row per team, season, person and job."""
    sport = F.col("request.sportId")
    labels = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    c = payloads.select("request", "team", F.explode("roster").alias("c"))
    return c.select(
        F.col("request.season").alias("season"),
        sport.alias("sport_id"),
        F.try_element_at(labels, sport).alias("level"),
        F.col("team.id").alias("team_id"),
        F.col("team.name").alias("team_name"),
        F.when(sport == 1, F.col("team.id")).otherwise(F.col("team.parentOrgId")).alias("parent_org_id"),
        F.col("c.person.id").alias("person_id"),
        F.col("c.person.fullName").alias("full_name"),
        F.col("c.jobId").alias("job_id"),
        F.col("c.job").alias("job"),
        F.col("c.title").alias("title"),
        F.col("c.jerseyNumber").alias("jersey_number"),
    ).na.drop(subset=["person_id", "job_id"])


def people_in_scope(coaches: DataFrame, scope: str = "coaches", flat_transactions: DataFrame | None = None, player_list: DataFrame | None = None) -> DataFrame:
    """Ids whose details are wanted: coaches, or coaches, transacted players and players."""
    ids = [coaches.select(F.col("person_id").alias("id"))]
    if scope == "all":
        ids += [flat_transactions.select(F.col("player_id").alias("id")), player_list.select("id")]
    elif scope != "coaches":
        raise ValueError("scope must be 'coaches' or 'all'")
    return id_union([i.where(F.col("id").isNotNull()) for i in ids])


def people_needing_details(wanted: DataFrame, loaded: DataFrame | None = None, refresh: bool = False) -> DataFrame:
    """Wanted ids that are not loaded yet (all of them on refresh)."""
    return wanted if refresh or loaded is None else not_in(wanted, ["id"], loaded)


def people_details(payloads: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Personal details with school counts and the education block as JSON text."""
    p = _one_each(_exploded(payloads, "people"), ["id"], ["_place"])
    position = F.when(F.col("primaryPosition.code") != "X", F.col("primaryPosition"))
    edu = F.col("education")
    has_schools = edu["highschools"].isNotNull() | edu["colleges"].isNotNull()
    plain = [
        "id", "fullName", "firstName", "lastName", "birthDate", "birthCity", "birthStateProvince", "birthCountry", "deathDate", "isPlayer", "active",
    ]
    return p.select(
        *[F.col(c).alias(snake(c)) for c in plain],
        position["code"].alias("primary_position__code"),
        position["name"].alias("primary_position__name"),
        F.col("batSide.code").alias("bat_side__code"),
        F.col("pitchHand.code").alias("pitch_hand__code"),
        *[F.col(c).alias(snake(c)) for c in ("draftYear", "mlbDebutDate", "lastPlayedDate")],
        F.coalesce(F.size(edu["highschools"]), F.lit(0)).cast("long").alias("high_school_count"),
        F.coalesce(F.size(edu["colleges"]), F.lit(0)).cast("long").alias("college_count"),
        F.when(has_schools, F.to_json(edu)).alias("education_json"),
        (F.current_timestamp() if fetched_at is None else fetched_at).cast("string").alias("fetched_at"),
    )


def player_season_stats(payloads: DataFrame) -> DataFrame:
    """Four stat groups merged into one row per season and player, prefixed by group.

    One aggregation instead of three full joins: each group fills its own struct.
    """
    asked = [F.col(f"request.{c}").alias(n) for c, n in (("season", "season"), ("group", "grp"), ("at", _AT))]
    splits = payloads.select(*asked, F.explode("stats").alias("s")).select("season", "grp", _AT, F.posexplode("s.splits").alias("_place", "x"))
    rows = splits.where(F.col("x.player.id").isNotNull()).withColumn("player__id", F.col("x.player.id"))
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for i, g in enumerate(STAT_GROUPS) for v in (g, i)]), F.col("grp")), F.lit(len(STAT_GROUPS)))
    # A player of several teams has a split for each: that of the newest request, there the first, stands for its group.
    newest = F.struct(F.coalesce(F.unix_micros(_AT), F.lit(-(2**63))).alias("at"), (-F.col("_place")).alias("place"), F.xxhash64("x").alias("h"))
    lead = F.struct((-rank).alias("rank"), newest.alias("newest"))
    picks = [F.max_by("x.player", lead).alias("player"), F.max_by("x.team", lead).alias("team")]
    for grp, prefix in STAT_GROUPS.items():
        mine = F.when(F.col("grp") == grp, newest)
        picks += [F.max_by("x.position", mine).alias(f"{prefix}_position"), F.max_by("x.stat", mine).alias(f"{prefix}_stat")]
    return flattened(rows.groupBy("season", "player__id").agg(*picks).drop("player__id"))


def seasons(payloads: DataFrame) -> DataFrame:
    """Season calendar; the table is replaced on each load."""
    s = _one_each(_exploded(payloads, "seasons"), ["seasonId"], ["_place"])
    return flattened(s.withColumn("season", F.col("seasonId").try_cast("int")))


def latest_load(df: DataFrame, keys: list[str]) -> DataFrame:
    """Newest load per key."""
    return dedup_latest(df, keys, [F.col(LOAD_ID).desc(), F.col(ROW_ID).desc()])


# Raw table -> (write disposition, merge keys).
DISPOSITIONS = {
    "games": ("merge", ["game_pk"]),
    "play_events": ("merge", ["game_pk", "play_id"]),
    "player_game_stats": ("merge", ["game_pk", "player_id"]),
    "umpires": ("merge", ["game_pk", "official_type"]),
    "game_details": ("merge", ["game_pk"]),
    "player_transactions": ("merge", ["transaction_id"]),
    "player_season_transactions": ("merge", ["player_id", "season", "transaction_id"]),
    "teams": ("merge", ["id", "season"]),
    "minor_league_teams": ("merge", ["id", "season"]),
    "draft": ("append", []),
    "players": ("replace", []),
    "award_recipients": ("merge", ["award_id", "season", "player_id"]),
    "rosters": ("merge", ["person__id", "season", "status__code", "parent_team_id"]),
    "team_coaches": ("merge", ["team_id", "season", "person_id", "job_id"]),
    "people_details": ("merge", ["id"]),
    "player_stats": ("merge", ["season", "player__id"]),
    "seasons": ("replace", []),
}
