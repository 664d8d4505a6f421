"""Star load with history: draft dimension and fact, season statistics, versions valid at a day.

Raw tables are stand-ins: a column for each expression (one text for both engines) over the
orders, which come in two loads; the second repeats the urgent ones with other values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import joins as J
from ..plans import dims, facts
from ..sources.landing import LOAD_ID, ROW_ID
from .registry import query, table

_URGENT = "o_orderpriority = '1-URGENT'"


def _raw(spark, sf, columns: dict[str, str], again: dict[str, str], keys: str = "o_orderkey") -> DataFrame:
    """Both loads: all orders, then the urgent ones with the expressions of ``again``."""
    orders = table(spark, sf, "orders")

    def load(rows: DataFrame, number: str, own: dict[str, str]) -> DataFrame:
        return rows.select(*[F.expr(e).alias(n) for n, e in own.items()], F.lit(number).alias(LOAD_ID), F.expr(f"concat('{number}-', cast({keys} as string))").alias(ROW_ID))

    return load(orders, "1", columns).unionByName(load(orders.where(_URGENT), "2", columns | again))


def _cte(columns: dict[str, str], again: dict[str, str], keys: str = "o_orderkey") -> str:
    """The newest row of each order, as the loads leave it."""
    shown = ", ".join(f"case when {_URGENT} then {again[n]} else {e} end as {n}" if n in again else f"{e} as {n}" for n, e in columns.items())
    return f"raw as (select {shown}, case when {_URGENT} then '2' else '1' end as {LOAD_ID}, concat(case when {_URGENT} then '2-' else '1-' end, cast({keys} as string)) as {ROW_ID}, o_orderkey from orders)"


def _text(n: int, word: str) -> str:
    return f"case when o_orderkey % {n} = 0 then null else concat('{word}', cast(o_orderkey % {n + 3} as string)) end"


# ---- draft --------------------------------------------------------------------------------------

_PERSON_TEXTS = (
    "middle_name use_name use_last_name nick_name boxscore_name name_slug name_title name_suffix name_matrilineal pronunciation birth_city birth_state_province birth_country "
    "death_city death_state_province death_country gender height strike_zone_top strike_zone_bottom bat_side__code bat_side__description pitch_hand__code pitch_hand__description "
    "primary_number primary_position__code primary_position__name primary_position__type primary_position__abbreviation link"
).split()
_OTHER_TEXTS = (
    "home__city home__state home__country headshot_link team__name team__link team__all_star_status team__spring_league__id team__spring_league__name team__spring_league__abbreviation "
    "team__spring_league__link school__name school__city school__state school__country draft_type__code draft_type__description"
).split()
_DRAFT = {
    "person__id": "case when o_orderkey % 101 = 0 then null else o_custkey end",
    "bis_player_id": "o_orderkey * 2",
    "round_pick_number": "cast(o_orderkey % 40 as int)",
    "pick_number": "cast(o_orderkey as int)",
    "person__draft_year": "case o_orderkey % 9 when 0 then 'n/a' when 1 then ' 2019 ' else cast(2010 + o_orderkey % 9 as string) end",
    "person__full_name": "case when o_orderkey % 7 = 0 then '  ' else concat(' Name ', cast(o_custkey as string), ' ') end",
    "person__first_name": _text(6, "First"),
    "person__last_name": "concat('Last', cast(o_custkey as string))",
    **{f"person__{c}": _text(4 + i % 9, f"{c} ") for i, c in enumerate(_PERSON_TEXTS)},
    "person__birth_date": "case o_orderkey % 8 when 0 then 'unknown' when 1 then null else concat('200', cast(o_orderkey % 10 as string), '-03-0', cast(1 + o_orderkey % 9 as string)) end",
    "person__death_date": "cast(null as string)",
    "person__mlb_debut_date": "case when o_orderkey % 3 = 0 then '2024-05-01' end",
    "person__last_played_date": "case when o_orderkey % 30 = 0 then '2024-13-01' end",
    "person__weight": "cast(150 + o_orderkey % 100 as int)",
    "person__active": "o_orderkey % 2 = 0",
    "person__is_player": "true",
    "person__is_verified": "o_orderkey % 5 = 0",
    "person__current_age": "cast(18 + o_orderkey % 6 as int)",
    "team__id": "o_orderkey % 30",
    **{c: _text(5 + i % 7, f"{c} ") for i, c in enumerate(_OTHER_TEXTS)},
    "school__school_class": _text(4, "4YR "),
    "rank": "cast(case when o_orderkey % 4 = 0 then null else o_orderkey % 500 end as int)",
    "pick_value": "case o_orderkey % 5 when 0 then '' when 1 then 'n/a' else concat('$', cast(1 + o_orderkey % 9 as string), ',', cast(100 + o_orderkey % 900 as string), '.50') end",
    "signing_bonus": "case when o_orderkey % 3 > 0 then cast(1000 * (o_orderkey % 90) as string) end",
}
_DRAFT_AGAIN = {"person__full_name": "concat('New ', cast(o_custkey as string))", "signing_bonus": "'$2,500'", "person__weight": "cast(222 as int)", "school__name": "'Transfer'"}
_YEAR = "coalesce(cast(try_cast(trim(person__draft_year) as int) as varchar), '0')"
_MARK = S.NULL_KEY_TEXT
_DRAFT_KEY = "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({c} as varchar), '{_MARK}')" for c in ("round_pick_number", "pick_number", "person__id", "person__draft_year")) + "))"
_CLEAN = "coalesce(nullif(trim({0}), ''), 'Unknown') as {1}".format


@query(
    "dim_draft",
    f"""with {_cte(_DRAFT, _DRAFT_AGAIN)} select {_DRAFT_KEY} as draft_key, person__id as person_id, bis_player_id, round_pick_number, pick_number,
      {", ".join(_CLEAN(f"person__{c}", f"person_{c}") for c in ("full_name", "first_name", "last_name"))},
      {", ".join(f"person__{c} as person_{c.replace('__', '_')}" for c in _PERSON_TEXTS)},
      {", ".join(f"try_cast(person__{c} as date) as person_{c}" for c in ("birth_date", "death_date", "mlb_debut_date", "last_played_date"))},
      person__weight as person_weight, person__active as person_is_active, person__is_player as person_is_player, person__is_verified as person_is_verified, {_YEAR} as person_draft_year, team__id as team_id,
      {", ".join(f"{c} as {c.replace('__', '_')}" for c in _OTHER_TEXTS)}, school__school_class as school_class, {ROW_ID} as source_row_id
    from raw where person__id is not null""",
)
def q_dim_draft(spark, sf):
    return dims.dim_draft(_raw(spark, sf, _DRAFT, _DRAFT_AGAIN))


@query(
    "fact_draft",
    f"""with {_cte(_DRAFT, _DRAFT_AGAIN)} select {_DRAFT_KEY} as draft_key, person__draft_year, person__id as person_id, pick_number, round_pick_number, rank,
      try_cast(replace(replace(pick_value, '$', ''), ',', '') as decimal(18,2)) as pick_value, try_cast(replace(replace(signing_bonus, '$', ''), ',', '') as decimal(18,2)) as signing_bonus, person__current_age as current_age
    from raw where person__id is not null""",
)
def q_fact_draft(spark, sf):
    """Picks meet the dimension through the draft year that both sides clean the same way."""
    raw = _raw(spark, sf, _DRAFT, _DRAFT_AGAIN)
    return facts.fact_draft(raw, dims.dim_draft(raw))


# ---- season statistics --------------------------------------------------------------------------

_NUMBERS = (
    "age games_played games_started at_bats runs hits doubles triples home_runs rbi stolen_bases caught_stealing base_on_balls strike_outs wins losses games_finished saves save_opportunities holds "
    "earned_runs games put_outs assists errors double_plays"
).split()
_RATES = {"avg": 3, "obp": 3, "slg": 3, "ops": 3, "era": 2, "hits_per9_inn": 2, "whip": 3, "fielding": 3}


def _rate(n: int) -> str:
    return f"case o_orderkey % {n + 6} when 0 then '-.--' when 1 then null else concat(cast(o_orderkey % 4 as string), '.', cast(100 + o_orderkey % 800 as string), '4') end"


_STATS = {
    "season": "cast(year(o_orderdate) as int)",
    "player__id": "o_custkey",
    "team__id": "case when o_orderkey % 13 = 0 then 999999 else o_orderkey % 30 end",
    **{f"stat__{c}": f"cast(case when o_orderkey % {5 + i % 4} = 0 then null else o_orderkey % {20 + i} end as int)" for i, c in enumerate(_NUMBERS)},
    **{f"stat__{c}": _rate(i) for i, c in enumerate(_RATES)},
    "stat__innings_pitched": "concat(cast(o_orderkey % 200 as string), '.1')",
    "batting_stat__home_runs": "cast(o_orderkey % 50 as int)",
    "batting_stat__strike_outs": "cast(o_orderkey % 70 as int)",
    "pitching_stat__strike_outs": "cast(case when o_orderkey % 4 = 0 then null else o_orderkey % 80 end as int)",
    "position__code": "case when o_orderkey % 6 > 0 then cast(o_orderkey % 10 as string) end",
    "fielding_position__code": "case when o_orderkey % 12 > 0 then 'F' end",
}
_STATS_AGAIN = {"stat__home_runs": "cast(77 as int)", "stat__avg": "'.250'"}
_PLAIN = {n: n for n in _NUMBERS} | {"walks": "base_on_balls", "strikeouts": "strike_outs", "putouts": "put_outs", "games_at_position": "games"}
_FAMILIES = {"home_runs": "coalesce(stat__home_runs, batting_stat__home_runs)", "strikeouts": "coalesce(stat__strike_outs, batting_stat__strike_outs)", "strikeouts_pitched": "coalesce(stat__strike_outs, pitching_stat__strike_outs)"}
_SHOWN = [n for n in _PLAIN if n not in ("base_on_balls", "strike_outs", "put_outs", "games", "home_runs", "strikeouts")]
_RATE_NAMES = {"batting_average": "avg", "on_base_percentage": "obp", "slugging_percentage": "slg", "ops": "ops", "era": "era", "hits_per9_inn": "hits_per9_inn", "whip": "whip", "fielding_percentage": "fielding"}
_VERSIONS = """versions as (select o_custkey as player_id, cast(o_orderdate as date) as effective_date,
      case when o_orderkey % 19 = 0 then cast(o_orderdate as date) else coalesce(lead(cast(o_orderdate as date)) over w - 1, date '9999-12-31') end as end_date,
      case when lead(o_orderkey) over w is null then 1 else 0 end as is_current, concat('v', cast(o_orderkey as varchar)) as player_version_key
    from (select * from orders qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey) = 1) window w as (partition by o_custkey order by o_orderdate))"""


def _versions(spark, sf) -> DataFrame:
    """Orders as versions of their customers, one a day; some end early and leave a gap."""
    day, w = F.col("o_orderdate").cast("date"), Window.partitionBy("o_custkey").orderBy("o_orderdate")
    first = table(spark, sf, "orders").withColumn("nth", F.row_number().over(Window.partitionBy("o_custkey", "o_orderdate").orderBy("o_orderkey"))).where("nth = 1")
    following = F.lead(day).over(w)
    return first.select(
        F.col("o_custkey").alias("player_id"), day.alias("effective_date"),
        F.when(F.col("o_orderkey") % 19 == 0, day).otherwise(F.coalesce(F.date_sub(following, 1), F.lit("9999-12-31").cast("date"))).alias("end_date"),
        F.when(following.isNull(), 1).otherwise(0).alias("is_current"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("player_version_key"),
    )


_STATS_SQL = f"""
      case when team__id < 30 and season % 5 > 0 then concat('t', cast(team__id as varchar), '-', cast(season as varchar)) end as team_key, case when season <> 1997 then concat('s', cast(season as varchar)) end as season_key, season,
      {", ".join(f"cast(stat__{_PLAIN[n]} as {{t}}) as {n}".format(t="int") for n in _SHOWN)}, {", ".join(f"{e} as {n}" for n, e in _FAMILIES.items())},
      {", ".join(f"cast(try_cast(stat__{src} as decimal({6 if n in ('era', 'hits_per9_inn', 'whip') else 5},{_RATES[src]})) as double) as {n}" for n, src in _RATE_NAMES.items())},
      stat__innings_pitched as innings_pitched, {", ".join(f"cast(null as bigint) as {n}" for n in ("hits_allowed", "runs_allowed", "home_runs_allowed", "walks_allowed"))}, cast(null as double) as war,
      coalesce(position__code, fielding_position__code) as position_code, {LOAD_ID}, {ROW_ID}"""


def _stats(spark, sf):
    """Newest load of the statistics with its dimensions; decimals as doubles for the comparison."""
    raw = dims.dedup_latest(_raw(spark, sf, _STATS, _STATS_AGAIN).withColumn("key", F.split_part(ROW_ID, F.lit("-"), F.lit(2))), ["key"], dims.newest_first()).drop("key")
    seasons = table(spark, sf, "orders").select(F.expr("cast(year(o_orderdate) as int)").alias("season")).distinct()
    teams = seasons.where("season % 5 > 0").select("season", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(29).cast("long"))).alias("team_id"))
    teams = teams.withColumn("team_key", F.expr("concat('t', cast(team_id as string), '-', cast(season as string))"))
    return raw, teams, seasons.where("season <> 1997").withColumn("season_key", F.expr("concat('s', cast(season as string))"))


def _compared(fact: DataFrame) -> DataFrame:
    return fact.drop("created_at", "updated_at").withColumns({n: F.col(n).cast("double") for n in _RATE_NAMES})


@query(
    "fact_player_stats",
    f"with {_cte(_STATS, _STATS_AGAIN)}, {_VERSIONS} select player_version_key as player_key, {_STATS_SQL} from raw left join versions on player_id = player__id and is_current = 1",
)
def q_fact_player_stats(spark, sf):
    raw, teams, seasons = _stats(spark, sf)
    return _compared(facts.fact_player_stats(raw, _versions(spark, sf), teams, seasons))


@query(
    "fact_player_stats_valid_version",
    f"with {_cte(_STATS, _STATS_AGAIN)}, {_VERSIONS} select player_version_key as player_key, {_STATS_SQL} from raw left join versions on player_id = player__id and make_date(season, 6, 30) between effective_date and end_date",
)
def q_fact_player_stats_valid(spark, sf):
    """Each season's statistics with the version of the player that was valid in its middle."""
    raw, teams, seasons = _stats(spark, sf)
    return _compared(facts.fact_player_stats(raw, _versions(spark, sf), teams, seasons, F.make_date("season", F.lit(6), F.lit(30))))


@query(
    "join_version_at",
    f"""with {_VERSIONS} select o_orderkey, player_version_key as version, effective_date as since from orders
      left join versions on player_id = o_custkey and cast(o_orderdate as date) + cast(o_orderkey % 50 as int) between effective_date and end_date""",
)
def q_version_at(spark, sf):
    """Every order some days later, with the version of its customer valid then; keys are texts that need cleaning on both sides."""
    fact = table(spark, sf, "orders").select("o_orderkey", F.expr("concat(' ', cast(o_custkey as string))").alias("who"), F.expr("date_add(cast(o_orderdate as date), cast(o_orderkey % 50 as int))").alias("day"))
    versions = _versions(spark, sf).withColumn("player_id", F.concat(F.col("player_id").cast("string"), F.lit("  ")))
    take = {"version": "player_version_key", "since": "effective_date"}
    found = J.version_at(fact, versions, {"player_id": "who"}, "day", ("effective_date", "end_date"), take, ["o_orderkey"], F.trim, F.year("_time"))
    return found.select("o_orderkey", "version", "since")
