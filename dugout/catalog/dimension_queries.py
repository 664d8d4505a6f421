"""Small dimensions over stand-in frames: awards, positions, schools, umpires.

Orders stand in for awards and officials; customers, suppliers and parts for the three
sources of positions; customers for draft picks. One text per column serves both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import dims
from ..sources.landing import LOAD_ID, ROW_ID
from .model_queries import key_sql
from .registry import query, table

_LOAD = "cast(year(o_orderdate) * 100 + month(o_orderdate) as string)"
AWARDS = {
    "award_id": "case when o_orderkey % 29 = 0 then null else o_orderpriority end",
    "award_name": "concat(o_orderpriority, ' ', o_orderstatus)",
    "player_id": "case when o_orderkey % 17 = 0 then null else o_custkey end",
    "player_name": "concat('P', cast(o_custkey as string))",
    "season": "cast(year(o_orderdate) as string)",
    "position_code": "cast(o_orderkey % 9 as string)",
    "position_name": "concat('Position ', cast(o_orderkey % 9 as string))",
    "position_type": "case when o_orderkey % 2 = 0 then 'Infielder' else 'Outfielder' end",
    "position_abbreviation": "case when o_orderkey % 5 = 0 then null else 'X' end",
    "team_id": "case when o_orderkey % 11 = 0 then '  ' else cast(o_orderkey % 30 as string) end",
    "award_date": "cast(o_orderkey as string)",
    "notes": "cast(null as string)",
    LOAD_ID: _LOAD,
    ROW_ID: "cast(o_orderkey as string)",
}
UMPIRES = {
    "game_pk": "o_orderkey",
    "official_id": "o_custkey",
    "official_type": "o_orderpriority",
    "full_name": "case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then '   ' else concat(' Umpire ', cast(o_custkey as string), ' ') end",
    LOAD_ID: _LOAD,
}


def _position(prefix: str, key: str, codes: int) -> dict[str, str]:
    return {
        f"{prefix}code": f"case when {key} % 13 = 0 then null else cast({key} % {codes} as string) end",
        f"{prefix}name": f"case when {key} % 5 = 0 then null else concat('Name ', cast({key} % 3 as string)) end",
        f"{prefix}type": f"concat('Type ', cast({key} % 4 as string))",
        f"{prefix}abbreviation": f"case when {key} % 7 = 0 then null else cast({key} % 6 as string) end",
    }


PLAYERS, STATS, ROSTERS = _position("primary_position__", "c_custkey", 7), _position("position__", "s_suppkey", 9), _position("position__", "p_partkey", 12)
DRAFT = {
    "school__name": "case when c_custkey % 19 = 0 then null else concat('School ', cast(c_custkey % 50 as string)) end",
    "school__city": "concat('City ', cast(c_custkey as string))",
    "school__state": "c_mktsegment",
    "school__country": "case when c_custkey % 3 = 0 then null else 'USA' end",
    "school__school_class": "concat('Class ', cast(c_custkey % 4 as string))",
    LOAD_ID: "cast(c_nationkey as string)",
    ROW_ID: "cast(c_custkey as string)",
}
SCHOOL_TYPES = {
    "school_name": "concat('School ', cast(n_nationkey as string))",
    "school_type": "case when n_regionkey = 0 then 'HS' else '4YR' end",
    "classified_by": "case when n_nationkey % 2 = 0 then 'name' else 'seed' end",
}


def frame(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).select(*[F.expr(e).alias(c) for c, e in columns.items()])


def frame_sql(name: str, columns: dict[str, str]) -> str:
    return f"select {', '.join(f'{e} as {c}' for c, e in columns.items())} from {name}"


def _newest(source: str, keys: str, where: str) -> str:
    return f"select * from (select *, row_number() over (partition by {keys} order by {LOAD_ID} desc, {ROW_ID} desc) as rn from {source} where {where}) where rn = 1"


_AWARD_CTE = f"with a0 as ({frame_sql('orders', AWARDS)}), aw as (select {key_sql('award_id')} as award_key, award_id, award_name from ({_newest('a0', 'award_id', 'award_id is not null')}))"


@query("dim_award", f"{_AWARD_CTE} select * from aw")
def q_award(spark, sf_dir):
    return dims.dim_award(frame(spark, sf_dir, "orders", AWARDS))


@query(
    "dim_award_recipient",
    f"""{_AWARD_CTE}, r as ({_newest('a0', 'player_id, award_id, season', 'player_id is not null')})
    select {key_sql('r.player_id', 'r.award_id', 'r.season')} as recipient_key, r.player_id, r.player_name, r.position_code, r.position_name, r.position_type, r.position_abbreviation,
      cast(case when trim(r.team_id) = '' then '0' else r.team_id end as bigint) as team_id, aw.award_key, r.award_id, aw.award_name, r.award_date, r.season, r.notes, r.{LOAD_ID} as load_id, r.{ROW_ID} as event_id
    from r left join aw on aw.award_id = r.award_id""",
)
def q_award_recipient(spark, sf_dir):
    rows = frame(spark, sf_dir, "orders", AWARDS)
    return dims.dim_award_recipient(rows, dims.dim_award(rows))


@query(
    "dim_position",
    "with every as ("
    + " union all ".join(
        f"select {i} as pr, {p}code as position_code, {p}name as position_name, {p}type as position_type, {p}abbreviation as position_abbreviation from ({frame_sql(t, cols)}) where {p}code is not null"
        for i, (t, p, cols) in enumerate((("customer", "primary_position__", PLAYERS), ("supplier", "position__", STATS), ("part", "position__", ROSTERS)))
    )
    + f"""), o as (select *, row_number() over (partition by position_code order by pr, position_name nulls last, position_type nulls last, position_abbreviation nulls last) as rn from every)
    select {key_sql('position_code')} as position_key, position_code, position_name, position_type, position_abbreviation from o where rn = 1""",
)
def q_position(spark, sf_dir):
    return dims.dim_position(frame(spark, sf_dir, "customer", PLAYERS), frame(spark, sf_dir, "supplier", STATS), frame(spark, sf_dir, "part", ROSTERS))


@query(
    "dim_school",
    f"""with d0 as ({frame_sql('customer', DRAFT)}), st as ({frame_sql('nation', SCHOOL_TYPES)}), o as ({_newest('d0', 'school__name', 'school__name is not null')})
    select {key_sql('school__name')} as school_key, school__name, school__city, school__state, school__country, school__school_class, st.school_type, st.classified_by from o left join st on st.school_name = o.school__name""",
)
def q_school(spark, sf_dir):
    return dims.dim_school(frame(spark, sf_dir, "customer", DRAFT), frame(spark, sf_dir, "nation", SCHOOL_TYPES))


@query(
    "dim_game_umpires",
    f"""with u as ({frame_sql('orders', UMPIRES)}) select {key_sql('game_pk', LOAD_ID, 'official_id', 'official_type')} as game_umpire_key, game_pk, official_type, official_id,
      coalesce(nullif(trim(full_name), ''), 'Unknown') as full_name, {LOAD_ID} as load_id from u""",
)
def q_umpires(spark, sf_dir):
    return dims.dim_game_umpires(frame(spark, sf_dir, "orders", UMPIRES))
