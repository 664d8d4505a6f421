"""Flatten jobs over payloads that are nested from the given tables, landed as JSON lines and read back.

Each payload part is a list of (place in the payload, raw column, expression); the expression
is one text for both engines. Answers repeat: an older and a newer request hold the same
games, teams or people with other values, and a place may name one thing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import landing as L
from ..sources import partitioned as P
from ..sources import schemas as X
from .registry import query, rounded, table

Fields = list[tuple[str, str, str]]
OLD, NEW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def nested(fields: Fields) -> Column:
    """One struct with every expression at its place."""
    top: dict[str, Fields] = {}
    for path, alias, sql in fields:
        head, _, rest = path.partition(".")
        top.setdefault(head, []).append((rest, alias, sql))
    return F.struct(*[(F.expr(own[0][2]) if own[0][0] == "" else nested(own)).alias(head) for head, own in top.items()])


def columns(fields: Fields) -> str:
    return ", ".join(f"{sql} as {alias}" for _, alias, sql in fields)


def listed(rows: DataFrame, keys: list[str], order: list[str], item: str, name: str) -> DataFrame:
    """Rows of a key as an array of ``item``, in order."""
    ordered = F.sort_array(F.collect_list(F.struct(*order, item)))
    return rows.groupBy(*keys).agg(F.transform(ordered, lambda x: x[item]).alias(name))


def block(key: str, size: int) -> Column:
    """Block of an integer key, so that one answer holds a bounded range of keys however large the table is."""
    return F.floor(F.col(key) / size).alias("block")


def request(**fields: str) -> Column:
    return F.struct(*[F.expr(v).alias(k) for k, v in fields.items()])


def landed(payloads: DataFrame, schema: str, name: str) -> DataFrame:
    spark = payloads.sparkSession
    path = P.work_folder(spark, f"landed-{name}")
    payloads.write.json(path, compression="gzip")
    return L.read_landed(spark, path, schema)


# ---- schedule -----------------------------------------------------------------------------------

_URGENT = "o_orderpriority = '1-URGENT'"
_HOME = "cast(o_orderkey % 11 as int)"


def _game(home: str) -> Fields:
    return [
        ("gamePk", "game_pk", "o_orderkey"),
        ("season", "season", "substring(cast(o_orderdate as string), 1, 4)"),
        ("gameType", "game_type", "case o_orderkey % 10 when 0 then 'E' when 1 then 'A' else 'R' end"),
        ("officialDate", "official_date", "substring(cast(o_orderdate as string), 1, 10)"),
        ("status.abstractGameState", "status__abstract_game_state", "case when o_orderkey % 7 = 3 then 'Live' else 'Final' end"),
        ("status.detailedState", "status__detailed_state", "case o_orderstatus when 'P' then 'Postponed' when 'F' then 'Cancelled?' else 'Final' end"),
        ("status.startTimeTBD", "status__start_time_tbd", "o_orderkey % 2 = 0"),
        ("teams.home.team.id", "teams__home__team__id", "o_custkey"),
        ("teams.home.team.name", "teams__home__team__name", "concat('T', cast(o_custkey as string))"),
        ("teams.home.score", "teams__home__score", home),
        ("teams.home.isWinner", "teams__home__is_winner", f"{home} > cast(o_custkey % 7 as int)"),
        ("teams.away.score", "teams__away__score", "cast(o_custkey % 7 as int)"),
        ("venue.id", "venue__id", "o_custkey % 30"),
        ("doubleHeader", "double_header", "case when o_orderkey % 5 = 0 then 'Y' end"),
        ("seriesGameNumber", "series_game_number", "cast(1 + o_orderkey % 4 as int)"),
    ]


@query(
    "landing_games",
    f"select {columns(_game(f'{_HOME} + case when {_URGENT} then cast(1 as int) else cast(0 as int) end'))} from orders where o_orderkey % 10 > 1 and o_orderstatus <> 'P' and o_orderkey % 7 <> 3",
)
def q_games(spark, sf):
    """Schedules by customer and day; urgent orders come again in a newer answer, high ones twice in one answer."""
    orders = table(spark, sf, "orders").withColumn("day", F.expr("substring(cast(o_orderdate as string), 1, 10)"))

    def answers(rows: DataFrame, at: str, home: str, later: int = 0) -> DataFrame:
        return rows.select("o_custkey", "day", F.lit(at).alias("at"), F.lit(later).alias("later"), "o_orderkey", nested(_game(home)).alias("g"))

    twice = orders.where("o_orderpriority = '2-HIGH'")
    rows = answers(orders, OLD, _HOME).unionByName(answers(orders.where(_URGENT), NEW, f"{_HOME} + 1")).unionByName(answers(twice, OLD, "cast(99 as int)", 1))
    days = listed(rows, ["at", "o_custkey", "day"], ["later", "o_orderkey"], "g", "games").withColumn("d", F.struct("games"))
    payloads = listed(days, ["at", "o_custkey"], ["day"], "d", "dates").select(request(teamId="o_custkey", at="cast(at as timestamp)").alias("request"), "dates")
    return L.games(landed(payloads, X.SCHEDULE, "schedule")).select([a for _, a, _ in _game(_HOME)])


# ---- play by play, box scores, details -----------------------------------------------------------

_ID = "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string))"
_PITCH = "l_suppkey % 5 <> 0"
_EVENT: Fields = [
    ("playId", "play_id", _ID),
    ("isPitch", "is_pitch", _PITCH),
    ("pitchNumber", "pitch_number", "cast(l_linenumber as int)"),
    ("details.code", "details__code", "case l_partkey % 4 when 0 then 'S' when 1 then 'B' when 2 then 'X' end"),
    ("details.isInPlay", "details__is_in_play", "case when l_partkey % 4 = 2 then true end"),
    ("details.call.code", "details__call__code", "l_returnflag"),
    ("count.balls", "count__balls", "cast(l_linenumber % 4 as int)"),
    ("pitchData.startSpeed", "pitch_data__start_speed", "70.0 + l_quantity / 2"),
    ("pitchData.coordinates.pX", "pitch_data__coordinates__p_x", "case when l_partkey % 9 > 0 then l_discount * 10 end"),
    ("pitchData.zone", "pitch_data__zone", "cast(l_partkey % 14 as int)"),
    ("hitData.launchSpeed", "hit_data__launch_speed", "case when l_partkey % 4 = 2 then l_extendedprice / 1000 end"),
]


def _result(key: str, shift: int = 0) -> str:
    return f"case ({key} + {shift}) % 6 when 0 then 'single' when 1 then 'home_run' when 2 then 'strikeout' when 3 then 'walk' when 4 then 'double' end"


_NEWER = "cast(floor(l_orderkey / 25) as bigint) % 3 = 0"
_RESULT_NOW = f"case when {_NEWER} then {_result('l_orderkey', 1)} else {_result('l_orderkey')} end"


@query(
    "landing_play_events",
    f"""with n as (select *, row_number() over (partition by l_orderkey order by l_linenumber, {_ID}) as pos from lineitem),
    m as (select *, max(case when {_PITCH} then pos end) over (partition by l_orderkey) as last, {_RESULT_NOW} as result_now from n)
    select cast(1990 + floor(l_orderkey / 25) % 30 as int) as season, cast(floor(l_orderkey / 25) as bigint) as game_pk, cast(l_orderkey % 25 as int) as at_bat_index, {columns(_EVENT).replace("70.0 + l_quantity / 2", "round(70.0 + l_quantity / 2, 4)").replace("l_extendedprice / 1000 end", "round(l_extendedprice / 1000 + 1e-9, 4) end").replace("l_discount * 10 end", "round(l_discount * 10 + 1e-9, 4) end")},
      l_partkey % 4 = 2 as is_in_play, result_now as result_event_type, cast(l_orderkey % 4 as int) as result_rbi, coalesce(result_now in ('single', 'double', 'triple', 'home_run'), false) as result_is_hit, pos = last as is_final_pitch, l_orderkey % 90 as batter_id, l_orderkey % 40 as pitcher_id
    from m where {_PITCH}""",
)
def q_play_events(spark, sf):
    """Games of 25 at-bats; every third game was asked for again, with other results."""
    # Dealt by game while the rows are flat: both lists of a game and its answers need no further exchange.
    dealt = table(spark, sf, "lineitem").withColumn("game", F.expr("cast(floor(l_orderkey / 25) as bigint)")).repartition("game")
    lines = dealt.withColumns({"e": nested(_EVENT), "id": F.expr(_ID)})
    events = listed(lines, ["game", "l_orderkey"], ["l_linenumber", "id"], "e", "playEvents")

    def play(at: str, shift: int) -> Column:
        result = F.expr(f"named_struct('eventType', {_result('l_orderkey', shift)}, 'rbi', cast(l_orderkey % 4 as int))").alias("result")
        who = F.expr("named_struct('batter', named_struct('id', l_orderkey % 90), 'pitcher', named_struct('id', l_orderkey % 40))").alias("matchup")
        return F.struct(F.lit(at).alias("at"), F.struct(F.expr("cast(l_orderkey % 25 as int)").alias("atBatIndex"), who, result, "playEvents").alias("p"))

    answers = F.when(F.expr("game % 3 = 0"), F.array(play(OLD, 0), play(NEW, 1))).otherwise(F.array(play(OLD, 0)))
    plays = events.select("game", "l_orderkey", F.inline(answers))
    payloads = listed(plays, ["at", "game"], ["l_orderkey"], "p", "allPlays")
    payloads = payloads.select(request(season="cast(1990 + game % 30 as int)", gamePk="game", at="cast(at as timestamp)").alias("request"), "allPlays")
    flat = L.play_events(L.newest_requests(landed(payloads, X.PLAY_BY_PLAY, "plays"), ["gamePk"]))
    more = ["is_in_play", "result_event_type", "result_rbi", "result_is_hit", "is_final_pitch", "batter_id", "pitcher_id"]
    return rounded(flat.select("season", "game_pk", "at_bat_index", *[a for _, a, _ in _EVENT], *more))


_PLAYER: Fields = [
    ("person.id", "player_id", "c_custkey"),
    ("person.fullName", "player_name", "c_name"),
    ("position.code", "position_code", "cast(c_nationkey % 10 as string)"),
    ("position.abbreviation", "position_abbreviation", "case c_nationkey % 3 when 0 then 'P' when 1 then 'C' end"),
    ("stats.batting.atBats", "batting_at_bats", "cast(c_custkey % 6 as int)"),
    ("stats.batting.homeRuns", "batting_home_runs", "cast(c_custkey % 3 as int)"),
    ("stats.batting.baseOnBalls", "batting_walks", "case when c_custkey % 4 > 0 then cast(c_custkey % 4 as int) end"),
    ("stats.batting.avg", "batting_avg", "concat('.', cast(100 + c_custkey % 300 as string))"),
    ("stats.pitching.inningsPitched", "pitching_innings_pitched", "case when c_nationkey % 3 = 0 then concat(cast(c_custkey % 9 as string), '.', cast(c_custkey % 3 as string)) end"),
    ("stats.pitching.hits", "pitching_hits_allowed", "case when c_nationkey % 3 = 0 then cast(c_custkey % 12 as int) end"),
    ("stats.fielding.putOuts", "fielding_putouts", "cast(c_custkey % 8 as int)"),
]
_GAME_OF = "cast(floor(c_custkey / 20) as bigint)"


def _box_scores(spark, sf) -> DataFrame:
    """A game for every 20 customers, who play on its two sides; officials and labels come from the number of the game."""
    people = table(spark, sf, "customer").select(F.expr(_GAME_OF).alias("game"), F.expr("c_custkey % 2 = 0").alias("home"), F.expr("concat('ID', cast(c_custkey as string))").alias("slot"), nested(_PLAYER).alias("p"))
    slots = people.groupBy("game").agg(*[F.map_from_entries(F.collect_list(F.when(F.col("home") == side, F.struct("slot", "p")))).alias(n) for n, side in (("h", True), ("a", False))])
    side = lambda n, shift: F.struct(F.expr(f"named_struct('id', game % 30 + {shift}, 'name', concat('T', cast(game % 30 + {shift} as string)))").alias("team"), F.col(n).alias("players")).alias({"h": "home", "a": "away"}[n])
    officials = F.expr("transform(sequence(0, 3), i -> named_struct('officialType', concat('Base ', cast(i as string)), 'official', named_struct('id', game * 4 + i, 'fullName', concat('U', cast((game * 4 + i) % 50 as string)))))")
    labels = F.expr("array(named_struct('label', 'Att', 'value', '1'), named_struct('label', ' att ', 'value', concat(cast(20 + game % 20 as string), ',', cast(100 + game % 800 as string), '')), named_struct('label', 'T', 'value', concat('2:', lpad(cast(game % 60 as string), 2, '0'), ' (0:10 delay)')), named_struct('label', 'First pitch', 'value', concat(cast(1 + game % 11 as string), ':05 PM')), named_struct('label', '', 'value', 'x'))")
    return slots.select(F.col("game"), F.struct(side("h", 0), side("a", 100)).alias("teams"), officials.alias("officials"), labels.alias("info"))


def _asked(rows: DataFrame, at: str = OLD) -> DataFrame:
    return rows.select(request(gamePk="game", at=f"timestamp '{at}'").alias("request"), *[c for c in rows.columns if c != "game"])


@query(
    "landing_player_game_stats",
    f"select {_GAME_OF} as game_pk, c_custkey % 2 = 0 as is_home, {_GAME_OF} % 30 + case when c_custkey % 2 = 0 then 0 else 100 end as team_id, {columns(_PLAYER)}, cast(null as varchar) as pitching_era from customer",
)
def q_player_game_stats(spark, sf):
    flat = L.player_game_stats(landed(_asked(_box_scores(spark, sf)), X.BOX_SCORE, "box"))
    return flat.select("game_pk", "is_home", "team_id", *[a for _, a, _ in _PLAYER], "pitching_era")


@query(
    "landing_umpires",
    f"""with g as (select distinct {_GAME_OF} as game from customer)
    select game as game_pk, concat('Base ', cast(i as varchar)) as official_type, game * 4 + i as official_id, concat('U', cast((game * 4 + i) % 50 as varchar)) as full_name from g, range(4) as r(i)""",
)
def q_umpires(spark, sf):
    return L.umpires(landed(_asked(_box_scores(spark, sf)), X.BOX_SCORE, "box"))


@query(
    "landing_game_details",
    f"""with g as (select distinct {_GAME_OF} as game from customer)
    select game as game_pk, case game % 3 when 0 then 'Clear' when 1 then 'Dome' end as weather_condition,
      cast(case when game % 4 > 0 then 30000 + game else (20 + game % 20) * 1000 + 100 + game % 800 end as int) as attendance,
      case when game % 5 > 0 then '19:10' else lpad(cast(13 + game % 11 as varchar), 2, '0') || ':05' end as first_pitch,
      cast(case when game % 2 > 0 then 150 + game % 50 when game % 4 > 0 and game % 5 > 0 then 0 else 120 + game % 60 end as int) as game_duration_minutes,
      case when game % 6 > 0 then game * 10 + case when game % 7 = 0 then 5 else 0 end else game * 10 + 1 end as winning_pitcher_id,
      case when game % 6 > 0 then null else game * 10 + 2 end as losing_pitcher_id,
      cast(game % 9 as int) as home_runs, cast(case when game % 8 = 0 then 2 else game % 8 end as int) as home_errors, cast(null as int) as away_runs
    from g""",
)
def q_game_details(spark, sf):
    """Gaps of the live feed are filled from the box score's labels and the line score; some games were asked for again."""
    box = _box_scores(spark, sf)
    games = box.select("game")
    clock = "named_struct('time', case when game % 5 > 0 then '7:10' end, 'ampm', 'PM')"
    info = "named_struct('attendance', cast(case when game % 4 > 0 then 30000 + game else 0 end as int), 'gameDurationMinutes', cast(case when game % 2 > 0 then 150 + game % 50 else 0 end as int))"

    def live(rows: DataFrame, at: str, shift: int) -> DataFrame:
        return _asked(
            rows.select(
                "game",
                F.expr(f"named_struct('weather', named_struct('condition', case game % 3 when 0 then 'Clear' when 1 then 'Dome' end), 'gameInfo', {info}, 'datetime', {clock})").alias("gameData"),
                F.expr(f"named_struct('decisions', named_struct('winner', named_struct('id', case when game % 6 > 0 then game * 10 + {shift} end)), 'boxscore', named_struct('teams', named_struct('home', named_struct('teamStats', named_struct('batting', named_struct('runs', cast(game % 9 as int), 'errors', cast(game % 8 as int)), 'pitching', named_struct('errors', 2))))))").alias("liveData"),
            ),
            at,
        )

    feed = live(games, OLD, 0).unionByName(live(games.where("game % 7 = 0"), NEW, 5))
    line = _asked(games.select("game", F.expr("named_struct('winner', named_struct('id', game * 10 + 1), 'loser', named_struct('id', game * 10 + 2))").alias("decisions")))
    flat = L.game_details(landed(feed, X.LIVE_FEED, "live"), landed(_asked(box), X.BOX_SCORE, "box"), landed(line, X.LINE_SCORE, "line"))
    return flat.select("game_pk", "weather_condition", "attendance", "first_pitch", "game_duration_minutes", "winning_pitcher_id", "losing_pitcher_id", "home_runs", "home_errors", "away_runs")


# ---- draft, people, season statistics -------------------------------------------------------------

_PICK: Fields = [
    ("bisPlayerId", "bis_player_id", "o_orderkey"),
    ("pickRound", "pick_round", "cast(1 + o_orderkey % 20 as string)"),
    ("pickNumber", "pick_number", "cast(o_orderkey % 600 as int)"),
    ("signingBonus", "signing_bonus", "case when o_orderkey % 3 > 0 then cast(1000 * (o_orderkey % 90) as string) end"),
    ("person.id", "person__id", "o_custkey"),
    ("person.primaryPosition.code", "person__primary_position__code", "cast(o_custkey % 10 as string)"),
    ("team.id", "team__id", "o_orderkey % 30"),
    ("team.springLeague.name", "team__spring_league__name", "case when o_orderkey % 2 = 0 then 'Cactus' end"),
    ("school.name", "school__name", "concat('School ', cast(o_custkey % 100 as string))"),
    ("draftType.code", "draft_type__code", "substring(o_orderpriority, 1, 1)"),
]


@query("landing_draft_picks", f"select {columns(_PICK)} from orders")
def q_draft_picks(spark, sf):
    """Picks by season and round, in answers of a bounded range of picks."""
    picks = table(spark, sf, "orders").select(F.expr("year(o_orderdate)").alias("season"), F.expr("o_orderkey % 20").alias("round"), block("o_orderkey", 10_000), "o_orderkey", nested(_PICK).alias("p"))
    rounds = listed(picks, ["season", "block", "round"], ["o_orderkey"], "p", "picks").withColumn("r", F.struct("picks"))
    payloads = listed(rounds, ["season", "block"], ["round"], "r", "rounds").select(request(season="season").alias("request"), F.struct("rounds").alias("drafts"))
    return L.draft_picks(landed(payloads, X.DRAFT, "draft")).select([a for _, a, _ in _PICK])


def _person(name: str) -> Fields:
    return [
        ("id", "id", "c_custkey"),
        ("fullName", "full_name", name),
        ("birthDate", "birth_date", "concat('19', cast(70 + c_nationkey as string), '-05-01')"),
        ("active", "active", "c_acctbal > 0"),
        ("primaryPosition.code", "primary_position__code", "case when c_custkey % 5 = 0 then 'X' else cast(c_custkey % 5 as string) end"),
        ("batSide.code", "bat_side__code", "case when c_custkey % 3 = 0 then 'L' else 'R' end"),
        ("draftYear", "draft_year", "cast(1990 + c_nationkey as int)"),
    ]


_SHOWN = "case when c_mktsegment = 'BUILDING' then concat(c_name, '!') else c_name end"


@query(
    "landing_people_details",
    f"""select {columns(_person(_SHOWN)).replace("case when c_custkey % 5 = 0 then 'X' else", "case when c_custkey % 5 = 0 then null else")},
      cast(c_custkey % 3 as bigint) as high_school_count, cast(case when c_custkey % 4 = 0 then 1 else 0 end as bigint) as college_count,
      case when c_custkey % 3 > 0 or c_custkey % 4 = 0 then
        '{{' || case when c_custkey % 3 > 0 then '"highschools":[' || array_to_string(list_transform(range(c_custkey % 3), lambda i: '{{"name":"H' || i || '"}}'), ',') || ']' else '' end
        || case when c_custkey % 3 > 0 and c_custkey % 4 = 0 then ',' else '' end || case when c_custkey % 4 = 0 then '"colleges":[{{"name":"C","city":"Town"}}]' else '' end || '}}' end as education_json
    from customer where c_custkey % 50 <> 7""",
)
def q_people_details(spark, sf):
    """People by nation in answers of a bounded range of them, some asked for again under another name; those already loaded are left out."""
    customers = table(spark, sf, "customer")
    schools = F.expr("named_struct('highschools', case when c_custkey % 3 > 0 then transform(sequence(0, cast(c_custkey % 3 as int) - 1), i -> named_struct('name', concat('H', cast(i as string)))) end, 'colleges', case when c_custkey % 4 = 0 then array(named_struct('name', 'C', 'city', 'Town')) end)")

    def answers(rows: DataFrame, at: str, name: str) -> DataFrame:
        return rows.select("c_nationkey", block("c_custkey", 10_000), F.lit(at).alias("at"), "c_custkey", F.struct(nested(_person(name)).getField("id").alias("id"), *[nested(_person(name)).getField(p.partition(".")[0]).alias(p.partition(".")[0]) for p, _, _ in _person(name)[1:]], schools.alias("education")).alias("p"))

    rows = answers(customers, OLD, "c_name").unionByName(answers(customers.where("c_mktsegment = 'BUILDING'"), NEW, "concat(c_name, '!')"))
    payloads = listed(rows, ["at", "c_nationkey", "block"], ["c_custkey"], "p", "people").select(request(at="cast(at as timestamp)").alias("request"), "people")
    people = landed(payloads, X.PEOPLE, "people")
    loaded = customers.where("c_custkey % 50 = 7").select(F.col("c_custkey").alias("id"))
    wanted = L.people_needing_details(L.people_in_scope(customers.select(F.col("c_custkey").alias("person_id"))), loaded)
    details = L.people_details(people, F.lit("2024-03-01")).join(wanted, "id", "left_semi")
    return details.select(*[a for _, a, _ in _person("c_name")], "high_school_count", "college_count", "education_json")


_STAT = {
    "hitting": [("homeRuns", "home_runs", "cast(o_orderkey % 40 as int)"), ("avg", "avg", "concat('.', cast(200 + o_orderkey % 150 as string))")],
    "pitching": [("wins", "wins", "cast(o_orderkey % 20 as int)"), ("inningsPitched", "innings_pitched", "concat(cast(o_orderkey % 200 as string), '.1')")],
    "fielding": [("putOuts", "put_outs", "cast(o_orderkey % 300 as int)")],
    "running": [("stolenBases", "stolen_bases", "cast(o_orderkey % 60 as int)")],
}
_GROUP = "case o_orderkey % 5 when 0 then 'hitting' when 1 then 'pitching' when 2 then 'fielding' when 3 then 'running' else 'hitting' end"


@query(
    "landing_player_season_stats",
    f"""with s as (select *, cast(year(o_orderdate) as int) as season, {_GROUP} as grp, o_orderpriority = '1-URGENT' as again from orders),
    r as (select *, row_number() over (partition by season, o_custkey, grp order by again desc, o_orderkey) as nth from s),
    t as (select *, case grp when 'hitting' then 0 when 'pitching' then 1 when 'fielding' then 2 else 3 end as rank from r where nth = 1)
    select season, o_custkey as player__id, arg_min(o_orderkey % 30 + case when again then 100 else 0 end, rank) as team__id,
      {", ".join(f"max(case when grp = '{g}' then {sql} end) as {L.STAT_GROUPS[g]}_stat__{alias}" for g, fields in _STAT.items() for _, alias, sql in fields)},
      max(case when grp = 'hitting' then cast(o_orderkey % 10 as varchar) end) as batting_position__code
    from t group by season, o_custkey""",
)
def q_player_season_stats(spark, sf):
    """Splits of four groups, a bounded range of players to an answer; a player has several teams a season, and urgent ones come in a newer answer."""
    orders = table(spark, sf, "orders").withColumns({"season": F.expr("cast(year(o_orderdate) as int)"), "grp": F.expr(_GROUP)})
    stat = F.struct(*[F.expr(sql).alias(src) for fields in _STAT.values() for src, _, sql in fields]).alias("stat")

    def answers(rows: DataFrame, at: str, shift: int) -> DataFrame:
        team = F.expr(f"named_struct('id', o_orderkey % 30 + {shift})").alias("team")
        who, place = F.expr("named_struct('id', o_custkey)").alias("player"), F.expr("named_struct('code', cast(o_orderkey % 10 as string))").alias("position")
        return rows.select("season", "grp", block("o_custkey", 1_000), F.lit(at).alias("at"), "o_orderkey", F.struct(who, team, place, stat).alias("x"))

    rows = answers(orders, OLD, 0).unionByName(answers(orders.where(_URGENT), NEW, 100))
    splits = listed(rows, ["season", "grp", "at", "block"], ["o_orderkey"], "x", "splits")
    payloads = splits.select(F.expr("named_struct('season', season, 'group', grp, 'at', cast(at as timestamp))").alias("request"), F.array(F.struct("splits")).alias("stats"))
    flat = L.player_season_stats(landed(payloads, X.STATS, "stats"))
    return flat.withColumn("season", F.col("season").cast("int")).select("season", "player__id", "team__id", *[f"{L.STAT_GROUPS[g]}_stat__{a}" for g, fields in _STAT.items() for _, a, _ in fields], "batting_position__code")
