"""Dimension tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalar as S
from ..operators.joins import date_in_range, growing, lookup
from ..operators.reshape import by_priority, bounds_spine
from ..operators.windows import dedup_latest, running_sum
from ..sources.landing import LOAD_ID, ROW_ID
from ..sources.tables import literal_rows

# Game type labels, once for the schedule and once for the type table.
GAME_TYPE_GROUPS = {"R": "Regular Season", "S": "Spring Training", "P": "Postseason"}
GAME_TYPES = {
    "R": "Regular Season", "S": "Spring Training", "P": "Postseason", "D": "Division Series", "L": "League Championship Series",
    "W": "World Series", "F": "Wild Card", "A": "All-Star Game", "E": "Exhibition",
}
# Pitch categories.
PITCH_CATEGORIES = {
    "FF": "Fastball", "SI": "Fastball", "FC": "Fastball", "SL": "Breaking", "CU": "Breaking", "KC": "Breaking", "SV": "Breaking",
    "ST": "Breaking", "CH": "Offspeed", "FS": "Offspeed", "FO": "Offspeed", "SC": "Offspeed", "KN": "Offspeed", "EP": "Offspeed",
    "CS": "Breaking",
}
# Strike-zone grid (id, description, in zone, region).
ZONES = [
    (1, "Top-Left", 1, "Upper"), (2, "Top-Center", 1, "Upper"), (3, "Top-Right", 1, "Upper"),
    (4, "Middle-Left", 1, "Middle"), (5, "Middle-Center", 1, "Heart"), (6, "Middle-Right", 1, "Middle"),
    (7, "Bottom-Left", 1, "Lower"), (8, "Bottom-Center", 1, "Lower"), (9, "Bottom-Right", 1, "Lower"),
    (11, "Above-Left", 0, "Chase-Up"), (12, "Above-Right", 0, "Chase-Up"),
    (13, "Below-Left", 0, "Chase-Down"), (14, "Below-Right", 0, "Chase-Down"), (99, "Unknown Zone", 0, "Unknown"),
]
FIRST_DATE = "1960-01-01"
OPEN_END = "9999-12-31"


def newest_first():
    """Latest load wins; the row id breaks ties."""
    return [F.col(LOAD_ID).desc(), F.col(ROW_ID).desc()]


def keyed(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """Puts a hashed key in front."""
    return df.select(S.surrogate_key(cols).alias(name), "*")


def dim_award(award_recipients: DataFrame) -> DataFrame:
    """One row per award id; the newest load decides its name."""
    known = award_recipients.where(F.col("award_id").isNotNull())
    one = dedup_latest(known, ["award_id"], newest_first()).select("award_id", "award_name")
    return keyed(one, "award_key", ["award_id"])


def dim_award_recipient(award_recipients: DataFrame, awards: DataFrame) -> DataFrame:
    """Latest load per (player, award, season) with the award looked up."""
    won = award_recipients.where(F.col("player_id").isNotNull())
    one = dedup_latest(won, ["player_id", "award_id", "season"], newest_first())
    one = lookup(one.drop("award_name"), awards, {"award_id": "award_id"}, {"award_key": "award_key", "award_name": "award_name"})
    text = [
        "player_name", "position_code", "position_name", "position_type", "position_abbreviation",
    ]
    return one.select(
        S.surrogate_key(["player_id", "award_id", "season"]).alias("recipient_key"),
        F.col("player_id").cast("long").alias("player_id"),
        *[F.col(c).cast("string").alias(c) for c in text],
        S.clean_text("team_id", "0").cast("long").alias("team_id"),
        "award_key",
        *[F.col(c).cast("string").alias(c) for c in ("award_id", "award_name", "award_date", "season", "notes")],
        F.col(LOAD_ID).alias("load_id"),
        F.col(ROW_ID).alias("event_id"),
    )


def dim_challenges(pitches: DataFrame) -> DataFrame:
    """Pitches whose call was reviewed."""
    cols = [
        "game_pk", "review_player_link", "has_review", "review_challenge_team_id", "review_is_overturned", "review_player_name",
        "review_player_id", "review_type", "start_time", "event_id", "load_id",
    ]
    return keyed(pitches.where("has_review = 1").select(*cols), "challenge_key", ["game_pk", "start_time", "event_id"])


def dim_date(spark: SparkSession, seasons: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Days from 1960 to the end of the year after next, with season phases.

    A day that fell into two seasons' ranges would be doubled; the later season wins.
    """
    last_year = (as_of or dt.date.today()).year + 2
    bounds = spark.range(1).select(
        F.lit(FIRST_DATE).cast("date").cast("timestamp").alias("a"), F.lit(f"{last_year + 1}-01-01").cast("date").cast("timestamp").alias("b")
    )
    days = bounds_spine(bounds, "day", "a", "b", "date_actual").select(F.col("date_actual").cast("date").alias("date_actual"))
    marks = ["spring_start_date", "spring_end_date", "regular_season_start_date", "regular_season_end_date", "post_season_start_date", "post_season_end_date", "all_star_date"]
    phases = seasons.select("season", *[F.col(c).try_cast("date").alias(c) for c in marks])
    j = date_in_range(days, "date_actual", phases, "spring_start_date", "post_season_end_date", ["season", *marks])
    j = dedup_latest(j, ["date_actual"], [F.col("season").desc_nulls_last()])
    d = F.col("date_actual")
    dow = F.dayofweek(d)
    return j.select(
        D.date_key(d).alias("date_key"),
        "date_actual",
        dow.alias("day_of_week"),
        D.day_name(d, short=False).alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        D.us_week_of_year(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        D.month_name(d, short=False).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        S.flag(dow.isin(1, 7)).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        F.col("season").alias("baseball_season"),
        S.flag(d.between(F.col("spring_start_date"), F.col("spring_end_date"))).alias("is_spring_training"),
        S.flag(d.between(F.col("regular_season_start_date"), F.col("regular_season_end_date"))).alias("is_regular_season"),
        S.flag(d.between(F.col("post_season_start_date"), F.col("post_season_end_date"))).alias("is_postseason"),
        S.flag(d == F.col("all_star_date")).alias("is_all_star"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


# Attributes of the draft dimension, by kind of clean-up.
_DRAFT_NAMES = ("full_name", "first_name", "last_name")
_DRAFT_PERSON_TEXT = (
    "middle_name", "use_name", "use_last_name", "nick_name", "boxscore_name", "name_slug", "name_title", "name_suffix", "name_matrilineal",
    "pronunciation", "birth_city", "birth_state_province", "birth_country", "death_city", "death_state_province", "death_country", "gender",
    "height", "strike_zone_top", "strike_zone_bottom", "bat_side__code", "bat_side__description", "pitch_hand__code",
    "pitch_hand__description", "primary_number", "primary_position__code", "primary_position__name", "primary_position__type",
    "primary_position__abbreviation", "link",
)
_DRAFT_PERSON_DATES = ("birth_date", "death_date", "mlb_debut_date", "last_played_date")
_DRAFT_OTHER = (
    "home__city", "home__state", "home__country", "headshot_link", "team__id", "team__name", "team__link", "team__all_star_status",
    "team__spring_league__id", "team__spring_league__name", "team__spring_league__abbreviation", "team__spring_league__link",
    "school__name", "school__city", "school__state", "school__country", "draft_type__code", "draft_type__description",
)
DRAFT_KEY = ["round_pick_number", "pick_number", "person__id", "person__draft_year"]


def draft_year_text() -> Column:
    """Draft year as clean text, '0' when it is not a number."""
    return S.clean_text(F.col("person__draft_year").cast("string").try_cast("int"), "0")


def latest_draft_picks(draft: DataFrame) -> DataFrame:
    """Newest load per pick."""
    return dedup_latest(draft, DRAFT_KEY, newest_first())


def dim_draft(draft: DataFrame) -> DataFrame:
    """Descriptive attributes of each pick."""
    d = latest_draft_picks(draft.where(F.col("person__id").isNotNull()))
    have = set(d.columns)

    def one(c: str):
        return F.col(c) if c in have else F.lit(None).cast("string")

    def flat(c: str) -> str:
        return c.replace("__", "_")

    return d.select(
        S.surrogate_key(DRAFT_KEY).alias("draft_key"),
        F.col("person__id").alias("person_id"),
        one("bis_player_id").alias("bis_player_id"),
        "round_pick_number",
        "pick_number",
        *[S.clean_text(one(f"person__{c}"), "Unknown").alias(f"person_{c}") for c in _DRAFT_NAMES],
        *[one(f"person__{c}").alias(f"person_{flat(c)}") for c in _DRAFT_PERSON_TEXT],
        *[one(f"person__{c}").cast("string").try_cast("date").alias(f"person_{c}") for c in _DRAFT_PERSON_DATES],
        one("person__weight").cast("int").alias("person_weight"),
        one("person__active").alias("person_is_active"),
        one("person__is_player").alias("person_is_player"),
        one("person__is_verified").alias("person_is_verified"),
        draft_year_text().alias("person_draft_year"),
        *[one(c).alias(flat(c)) for c in _DRAFT_OTHER],
        one("school__school_class").alias("school_class"),
        F.col(ROW_ID).alias("source_row_id"),
    )


# Team totals kept per side in the game details.
_DETAIL_BAT = ("runs", "hits", "doubles", "triples", "home_runs", "rbi", "stolen_bases", "strikeouts", "walks", "left_on_base")
_DETAIL_PITCH = ("strikeouts", "walks", "hits_allowed", "runs_allowed", "earned_runs", "home_runs_allowed")
DETAIL_COLUMNS = (
    ["game_pk", "weather_condition", "weather_temp", "weather_wind", "attendance", "first_pitch", "game_duration_minutes"]
    + [f"{r}_pitcher_{c}" for r in ("winning", "losing", "save") for c in ("id", "name")]
    + [f"{s}_{c}" for s in ("home", "away") for c in _DETAIL_BAT]
    + [f"{s}_pitching_{c}" for s in ("home", "away") for c in _DETAIL_PITCH]
)


def dim_game_details(game_details: DataFrame) -> DataFrame:
    """Weather, decisions and team totals per game."""
    return game_details.select(*DETAIL_COLUMNS, F.col(LOAD_ID).alias("load_id"), ROW_ID)


def dim_game_umpires(umpires: DataFrame) -> DataFrame:
    """Officials per game and load."""
    return umpires.select(
        S.surrogate_key(["game_pk", LOAD_ID, "official_id", "official_type"]).alias("game_umpire_key"),
        "game_pk",
        "official_type",
        "official_id",
        S.clean_text("full_name", "Unknown").alias("full_name"),
        F.col(LOAD_ID).alias("load_id"),
    )


def dim_game_status(games: DataFrame) -> DataFrame:
    """Distinct game states."""
    cols = [f"status__{c}" for c in ("coded_game_state", "abstract_game_state", "detailed_state", "status_code", "abstract_game_code")]
    found = games.where(F.col(cols[0]).isNotNull()).select(*cols).distinct()
    return keyed(found, "game_status_key", ["status__coded_game_state", "status__status_code"])


def dim_game_type(games: DataFrame) -> DataFrame:
    """Distinct game types with labels."""
    found = games.where(F.col("game_type").isNotNull()).select(F.col("game_type").alias("game_type_code")).distinct()
    return keyed(found, "game_type_key", ["game_type_code"]).withColumn("game_type_name", S.code_label("game_type_code", GAME_TYPES, "Unknown"))


def dim_pitch_type(pitches: DataFrame) -> DataFrame:
    """Distinct pitch types with their category."""
    cols = ["pitch_type_code", "pitch_type_description", "pitch_trail_color"]
    found = pitches.where(F.col("pitch_type_code").isNotNull()).select(*cols).distinct()
    return found.withColumn("pitch_category", S.code_label("pitch_type_code", PITCH_CATEGORIES, "Other"))


def dim_venue(venues: DataFrame) -> DataFrame:
    """Venues with a key."""
    cols = ["venue_id", "venue_name", "venue_link", "location_name", "first_year_of_play", "spring_venue_id", "spring_venue_link"]
    return keyed(venues.select(*cols), "venue_key", ["venue_id"])


# Season calendar columns.
SEASON_COLUMNS = [
    "season", "season_id", "has_wildcard", "pre_season_start_date", "pre_season_end_date", "spring_start_date", "spring_end_date",
    "regular_season_start_date", "last_date1st_half", "all_star_date", "first_date2nd_half", "regular_season_end_date",
    "post_season_start_date", "post_season_end_date", "season_start_date", "season_end_date", "offseason_start_date",
    "off_season_end_date", "qualifier_plate_appearances", "qualifier_outs_pitched",
]


def dim_season(seasons: DataFrame) -> DataFrame:
    """Season calendar with the length of the regular season."""
    days = F.datediff(F.col("regular_season_end_date").try_cast("date"), F.col("regular_season_start_date").try_cast("date"))
    return keyed(seasons.select(*SEASON_COLUMNS), "season_key", ["season"]).withColumn("regular_season_days", days)


def dim_zone(spark: SparkSession) -> DataFrame:
    """The 14 strike-zone cells, as literal rows whose size the planner knows (so it broadcasts them)."""
    return literal_rows(spark, ZONES, "zone_id int, zone_description string, is_in_zone int, zone_region string")


def dim_games(games: DataFrame) -> DataFrame:
    """Typed schedule rows with winner, loser, margin and tie handling."""
    kept = games.where(~F.col("status__detailed_state").isin("Cancelled", "Postponed"))
    home, away = F.col("teams__home__score"), F.col("teams__away__score")
    level = home == away

    def unless_level(c: str, value: int):
        return F.when(level, F.lit(value)).otherwise(F.col(c).cast("int"))

    first = kept.select(
        F.col("game_pk").cast("long").alias("game_pk"),
        F.col("season").cast("string").try_cast("int").alias("season"),
        "game_type",
        F.col("game_date").cast("timestamp").alias("game_datetime"),
        F.col("game_date").cast("date").alias("game_date"),
        F.col("official_date").cast("string").try_cast("date").alias("official_date"),
        F.col("status__abstract_game_state").alias("abstract_game_state"),
        F.col("status__coded_game_state").alias("coded_game_state"),
        F.col("status__detailed_state").alias("detailed_state"),
        F.col("status__status_code").alias("status_code"),
        F.col("status__start_time_tbd").alias("is_start_time_tbd"),
        F.col("teams__home__team__id").alias("home_team_id"),
        S.clean_text("teams__home__team__name", "").alias("home_team_name"),
        home.alias("home_score"),
        unless_level("teams__home__is_winner", 0).alias("home_is_winner"),
        F.col("teams__away__team__id").alias("away_team_id"),
        S.clean_text("teams__away__team__name", "").alias("away_team_name"),
        away.alias("away_score"),
        unless_level("teams__away__is_winner", 0).alias("away_is_winner"),
        S.clean_text("venue__id", "").alias("venue_id"),
        S.clean_text("venue__name", "").alias("venue_name"),
        *["game_number", "double_header", "day_night", "scheduled_innings", "games_in_series", "series_game_number", "series_description"],
        unless_level("is_tie", 1).alias("is_tie"),
        "public_facing",
        F.col(LOAD_ID).alias("load_id"),
        ROW_ID,
    )
    h, a = F.col("home_score"), F.col("away_score")
    return first.withColumns(
        {
            "winning_team_id": F.when(h > a, F.col("home_team_id")).when(a > h, F.col("away_team_id")),
            "losing_team_id": F.when(h > a, F.col("away_team_id")).when(a > h, F.col("home_team_id")),
            "run_diff": h - a,
            "is_final": S.flag(F.col("detailed_state") == "Final"),
            "game_type_desc": S.code_label("game_type", GAME_TYPE_GROUPS, "Other"),
        }
    )


def dim_player(rosters: DataFrame, transactions: DataFrame) -> DataFrame:
    """Player history: one row per version of (team, jersey, position, status).

    Rosters are first reduced to one row per player and season, so every window below
    runs over at most one row per season of a player. The arrival date is the latest
    transaction into the team between October 1 of the year before and the end of the
    season; a transaction is therefore filed under its own year and, from October on,
    also under the next, which makes the match an equi-join on (player, team, season).
    """
    one = dedup_latest(rosters, ["player_id", "season"], newest_first()).withColumn("season", F.col("season").cast("int"))
    tracked = ["team_id", "jersey_number", "position__code", "status__code"]
    hashed = one.withColumn("change_hash", S.surrogate_key(tracked))
    w = Window.partitionBy("player_id").orderBy("season", LOAD_ID)
    prev_hash, prev_team = F.lag("change_hash").over(w), F.lag("team_id").over(w)
    changes = (
        hashed.withColumns({"_prev_hash": prev_hash, "_prev_team": prev_team})
        .where(F.col("_prev_hash").isNull() | (F.col("change_hash") != F.col("_prev_hash")))
        .withColumn("_arrival", F.col("_prev_hash").isNull() | ~F.col("team_id").eqNullSafe(F.col("_prev_team")))
    )
    day = F.col("effective_date").cast("date")
    year = F.year(day)
    own_year = transactions.where(day.isNotNull()).select("player_id", F.col("to_team_id").alias("team_id"), day.alias("_day"), year.alias("_year"))
    filed = own_year.select(
        "player_id", "team_id", "_day", F.explode(F.when(F.month("_day") >= 10, F.array("_year", F.col("_year") + 1)).otherwise(F.array("_year"))).alias("season")
    )
    arrivals = filed.groupBy("player_id", "team_id", "season").agg(F.max("_day").alias("_tx_day"))
    dated = changes.join(growing(arrivals), ["player_id", "team_id", "season"], "left").withColumn(
        "_candidate", F.coalesce(F.when(F.col("_arrival"), F.col("_tx_day")), F.make_date("season", F.lit(1), F.lit(1)))
    )
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    dated = dated.withColumn("effective_date", F.max("_candidate").over(upto))
    dated = dated.withColumn("_next", F.lead("effective_date").over(w))
    kept = dated.where(F.col("_next").isNull() | (F.col("_next") > F.col("effective_date")))
    kept = kept.withColumns({"_end": F.date_sub(F.lead("effective_date").over(w), 1), "version_number": F.row_number().over(w)})
    return kept.select(
        S.surrogate_key(["player_id", "version_number"]).alias("player_version_key"),
        *["player_id", "full_name", "team_id", "jersey_number", "position__code", "position__name", "position__type", "position__abbreviation"],
        *["status__code", "status_description"],
        F.col("season").alias("effective_season"),
        *["change_hash", "version_number", "effective_date"],
        F.coalesce("_end", F.lit(OPEN_END).cast("date")).alias("end_date"),
        S.flag(F.col("_end").isNull()).alias("is_current"),
    )


def dim_position(players: DataFrame, player_stats: DataFrame, rosters: DataFrame) -> DataFrame:
    """One row per position code from the most trusted source that has it."""
    parts = ("code", "name", "type", "abbreviation")

    def source(df: DataFrame, prefix: str) -> DataFrame:
        return df.where(F.col(f"{prefix}code").isNotNull()).select(*[F.col(f"{prefix}{p}").alias(f"position_{p}") for p in parts])

    every = by_priority([source(players, "primary_position__"), source(player_stats, "position__"), source(rosters, "position__")])
    order = [F.col("source_priority").asc(), *[F.col(f"position_{p}").asc_nulls_last() for p in parts[1:]]]
    return keyed(dedup_latest(every, ["position_code"], order).drop("source_priority"), "position_key", ["position_code"])


def dim_school(draft: DataFrame, school_types: DataFrame) -> DataFrame:
    """Latest description per school with its type."""
    cols = [f"school__{c}" for c in ("name", "city", "state", "country", "school_class")]
    one = dedup_latest(draft.where(F.col("school__name").isNotNull()), ["school__name"], newest_first()).select(*cols)
    typed = lookup(one, school_types, {"school_name": "school__name"}, {"school_type": "school_type", "classified_by": "classified_by"})
    return keyed(typed, "school_key", ["school__name"])


# Team columns, raw name -> dimension name where they differ.
_TEAM_RENAMED = {
    "team_id": "id", "team_name": "name", "league_id": "league__id", "league_name": "league__name", "division_id": "division__id",
    "division_name": "division__name", "sport_id": "sport__id", "sport_name": "sport__name", "venue_id": "venue__id",
    "spring_venue_id": "spring_venue__id", "spring_league_id": "spring_league__id", "spring_league_name": "spring_league__name",
    "spring_league_abbreviation": "spring_league__abbreviation", "is_active": "active",
}
_TEAM_COLUMNS = [
    "team_id", "team_name", "team_code", "file_code", "abbreviation", "location_name", "franchise_name", "club_name", "short_name",
    "league_id", "league_name", "division_id", "division_name", "sport_id", "sport_name", "venue_id", "spring_venue_id",
    "spring_league_id", "spring_league_name", "spring_league_abbreviation", "all_star_status", "is_active", "first_year_of_play", "season",
]


def dim_teams(teams: DataFrame) -> DataFrame:
    """One row per team and season."""
    have = set(teams.columns)

    def one(c: str):
        raw = _TEAM_RENAMED.get(c, c)
        col = F.col(raw) if raw in have else F.lit(None).cast("string")
        if c in ("location_name", "league_name", "division_name"):
            col = F.coalesce(col, F.lit("Unknown"))
        if c == "first_year_of_play":
            col = col.cast("string").try_cast("int")
        return col.alias(c)

    rows = teams.where(F.col("id").isNotNull()).select(*[one(c) for c in _TEAM_COLUMNS])
    return keyed(rows, "team_key", ["team_id", "season"]).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})


# Columns of the standings table.
STANDING_COLUMNS = [
    "game_pk", "season", "game_type_desc", "game_date", "game_datetime", "team_id", "team_name", "opponent_team_id", "opponent_team_name",
    "is_home", "venue_id", "team_score", "opponent_score", "result", "is_win", "is_loss", "is_tie", "double_header", "day_night",
    "start_hour", "is_interleague", "series_id", "games_in_series", "series_game_number",
]


def dim_team_standings(results: DataFrame) -> DataFrame:
    """Results with 0/1 win, loss and tie flags."""
    flags = {n: S.flag(F.col("result") == r) for n, r in (("is_win", "W"), ("is_loss", "L"), ("is_tie", "T"))}
    return results.withColumns(flags).select(*STANDING_COLUMNS)


def dim_team_standings_by_date(standings: DataFrame) -> DataFrame:
    """Daily totals and season-to-date totals.

    After the daily aggregate a (team, season) has at most one row per day, so the
    running window is bounded and needs no cutting.
    """
    daily = standings.groupBy("team_id", "team_name", "season", "game_date").agg(
        F.count(F.lit(1)).alias("games_played"), F.sum("is_win").alias("wins"), F.sum("is_loss").alias("losses"), F.sum("is_tie").alias("ties")
    )
    measures = {f"{c}_to_date": c for c in ("games_played", "wins", "losses", "ties")}
    return running_sum(daily, ["team_id", "season"], ["game_date", "team_name"], measures)


# Player-line columns.
PITCHING = ["outs_recorded", "hits_allowed", "runs_allowed", "earned_runs", "walks", "strikeouts", "home_runs_allowed"]
FIELDING = ["putouts", "assists", "errors", "chances"]
BATTING = ["at_bats", "runs", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts", "stolen_bases", "left_on_base"]
LINE_COLUMNS = [f"pitching_{c}" for c in PITCHING] + [f"fielding_{c}" for c in FIELDING] + [f"batting_{c}" for c in BATTING]


def dim_player_stats(lines: DataFrame) -> DataFrame:
    """Projection of the per-game player lines."""
    ids = [
        "game_pk", "season", "game_type_desc", "game_date", "game_datetime", "player_id", "player_name", "team_id", "team_name",
        "opponent_team_id", "opponent_team_name", "is_home", "position_code", "position_name", "position_abbreviation",
    ]
    return lines.select(*ids, *LINE_COLUMNS, "batting_avg_raw", "pitching_era_raw", "start_hour")


def dim_player_stats_by_date(stats: DataFrame) -> DataFrame:
    """Season-to-date player totals per day, rates from the cumulative counts.

    The daily aggregate bounds a (player, season) to the days and teams of a season. A player
    has about one line a day, so the lines are dealt by player and season as they are: that one
    exchange serves the aggregate and the running sums.
    """
    keys = ["player_id", "player_name", "team_id", "team_name", "season", "game_date"]
    games = {"games_played": F.lit(1), "games_batted": "batting_at_bats", "games_pitched": "pitching_outs_recorded", "games_fielded": "fielding_chances"}
    daily = stats.repartition("player_id", "season").groupBy(*keys).agg(
        *[F.count(c).alias(n) for n, c in games.items()], *[F.sum(c).alias(c) for c in LINE_COLUMNS]
    )
    measures = {f"{c}_to_date": c for c in [*games, *LINE_COLUMNS]}
    r = running_sum(daily, ["player_id", "season"], ["game_date", "team_id", "player_name", "team_name"], measures)
    outs = F.col("pitching_outs_recorded_to_date")

    def td(group: str, names: list[str]) -> list[str]:
        return [f"{group}_{n}_to_date" for n in names]

    return r.select(
        *keys,
        "games_played",
        *[f"{g}_to_date" for g in games],
        "pitching_outs_recorded_to_date",
        S.outs_to_innings(outs).alias("pitching_innings_pitched_to_date"),
        *td("pitching", PITCHING[1:]),
        S.earned_run_average("pitching_earned_runs_to_date", outs).alias("pitching_era_to_date"),
        *td("fielding", FIELDING),
        S.fielding_percentage("fielding_putouts_to_date", "fielding_assists_to_date", "fielding_chances_to_date").alias("fielding_pct_to_date"),
        *td("batting", BATTING),
        F.when(F.col("batting_at_bats_to_date") > 0, S.rate("batting_hits_to_date", "batting_at_bats_to_date")).alias("batting_avg_to_date"),
    )
