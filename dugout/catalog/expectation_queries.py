"""Expectations on distributions, values, lengths and row counts, over data that fail them."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality import expectations as E
from ..quality import fused as X
from .registry import query, table


def _named(parts: dict[str, DataFrame], *columns: str) -> DataFrame:
    rows = [df.select(F.lit(n).alias("what"), *columns) for n, df in parts.items()]
    return functools.reduce(DataFrame.unionByName, rows)


@query(
    "expect_fused_in_one_scan",
    """with g as (select o_orderpriority, count(*) as n, count(distinct o_custkey) as d, count(distinct o_custkey)::double / count(o_custkey) as u, count(*) - count(distinct (o_custkey, o_orderdate)) as r,
        count(*) filter (o_orderstatus not in ('F', 'O')) as s, count(*) filter (o_orderstatus = 'P') as f, count(*) filter (length(o_orderpriority) > 8) as l, sum(o_totalprice) - sum(o_custkey) as x, count(distinct o_orderdate) as dd from orders group by 1)
    select o_orderpriority, 'distinct_count(o_custkey)' as expectation, round(d::double, 4) as observed from g where d > 1300 or d < 100
    union all select o_orderpriority, 'unique_share(o_custkey)', round(u + 1e-9, 4) from g where u < 0.45
    union all select o_orderpriority, 'repeated(o_custkey,o_orderdate)', r from g where r <> 0
    union all select o_orderpriority, 'not_in_set(o_orderstatus)', s from g where s <> 0
    union all select o_orderpriority, 'in_forbidden_set(o_orderstatus)', f from g where f <> 0
    union all select o_orderpriority, 'null(o_orderdate)', 0 from g where false
    union all select o_orderpriority, 'not_null(o_orderstatus)', n from g
    union all select o_orderpriority, 'length(o_orderpriority)', l from g where l <> 0
    union all select o_orderpriority, 'sum(o_totalprice-o_custkey)', round(x + 1e-9, 1) from g where x <> 0
    union all select o_orderpriority, 'row_count', n from g where n < 2990
    union all select o_orderpriority, 'distinct_count(o_orderdate)', dd from g where dd < 1700""",
)
def q_fused(spark, sf):
    """Eleven expectations of every priority, exact distinct counts among them, from one scan."""
    checks = [
        X.distinct_count("o_custkey", 100, 1300), X.unique_share("o_custkey", 0.45), X.unique(["o_custkey", "o_orderdate"]), X.in_set("o_orderstatus", ["F", "O"]), X.not_in_set("o_orderstatus", ["P"]),
        X.not_null("o_orderdate"), X.null("o_orderstatus"), X.lengths("o_orderpriority", None, 8), X.column_sum(["o_totalprice"], "o_custkey"), X.row_count(2990), X.distinct_count("o_orderdate", 1700),
    ]
    found = X.failed(table(spark, sf, "orders"), checks, ["o_orderpriority"])
    wide = F.col("expectation").startswith("sum(")
    return found.withColumn("observed", F.when(wide, F.round(F.col("observed") + 1e-9, 1)).otherwise(F.round(F.col("observed") + 1e-9, 4)))


@query(
    "expect_distinct_counts",
    """with g as (select c_nationkey, count(distinct c_mktsegment) as n from customer where c_custkey % 3 = 0 group by 1)
    select 'greater' as what, c_nationkey from g where not n > 4 union all select 'less', c_nationkey from g where not n < 5 union all select 'equal', c_nationkey from g where n <> 5
    union all select 'share', c_nationkey from (select c_nationkey, count(distinct c_mktsegment)::double / count(c_mktsegment) as u from customer group by 1) where u > 0.085 or u < 0.07""",
)
def q_distinct_counts(spark, sf):
    c, by, some = table(spark, sf, "customer"), ["c_nationkey"], "c_custkey % 3 = 0"
    return _named(
        {
            "greater": E.distinct_count_greater_than(c, "c_mktsegment", 4, by, some),
            "less": E.distinct_count_less_than(c, "c_mktsegment", 5, by, some),
            "equal": E.distinct_count_equal(c, "c_mktsegment", 5, by, some),
            "share": E.proportion_of_unique_values_between(c, "c_mktsegment", 0.07, 0.085, group_by=by),
        },
        "c_nationkey",
    )


@query(
    "expect_distinct_count_other_table",
    """select (select count(distinct c_custkey) from customer) as expression, (select count(distinct o_custkey) from orders where o_orderstatus = 'P') as compare_expression,
      abs((select count(distinct c_custkey) from customer) - (select count(distinct o_custkey) from orders where o_orderstatus = 'P')) as expression_difference""",
)
def q_distinct_other(spark, sf):
    found = E.distinct_count_equal_other_table(table(spark, sf, "customer"), "c_custkey", table(spark, sf, "orders"), "o_custkey", other_where="o_orderstatus = 'P'")
    return found.select("expression", "compare_expression", "expression_difference")


@query(
    "expect_values_in_sets",
    """with d as (select doc_id, case when doc_id % 7 = 0 then null else lang end as lang, source from documents)
    select 'in' as what, lang as value_field, count(*) as n from d where lang is null or lang not in ('en', 'de') group by 2 union all select 'not_in', lang, count(*) from d where lang = 'fr' group by 2
    union all select 'null', lang, count(*) from d where lang is not null group by 2 union all select 'not_null', lang, count(*) from d where lang is null group by 2""",
)
def q_values_in_sets(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("lang")).alias("lang"))
    value = F.col("lang").alias("value_field")
    found = {"in": E.values_in_set(d, "lang", ["en", "de"]), "not_in": E.values_not_in_set(d, "lang", ["fr"]), "null": E.values_null(d, "lang").select(value), "not_null": E.values_not_null(d, "lang").select(value)}
    return _named(found, "value_field").groupBy("what", "value_field").agg(F.count(F.lit(1)).alias("n"))


@query("expect_values_unique", "select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1")
def q_values_unique(spark, sf):
    return E.compound_columns_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query(
    "expect_value_lengths",
    """select 'between' as what, c_custkey from customer where length(c_mktsegment) < 9 or length(c_mktsegment) > 9 union all select 'strictly', c_custkey from customer where not (length(c_mktsegment) > 8 and length(c_mktsegment) < 10)
    union all select 'equal', c_custkey from customer where length(c_mktsegment) <> 10""",
)
def q_value_lengths(spark, sf):
    c = table(spark, sf, "customer")
    return _named({"between": E.value_lengths_between(c, "c_mktsegment", 9, 9), "strictly": E.value_lengths_between(c, "c_mktsegment", 8, 10, strictly=True), "equal": E.value_lengths_equal(c, "c_mktsegment", 10)}, "c_custkey")


@query(
    "expect_multicolumn_sums",
    """select 'number' as what, l_returnflag, l_linenumber from lineitem group by 2, 3 having sum(l_orderkey) + sum(l_linenumber) <> 1000
    union all select 'column', l_returnflag, l_linenumber from lineitem group by 2, 3 having sum(l_linenumber) + count(*) * 1 <> sum(l_suppkey)""",
)
def q_sums(spark, sf):
    li, by = table(spark, sf, "lineitem"), ["l_returnflag", "l_linenumber"]
    return _named({"number": E.multicolumn_sum_equal(li, ["l_orderkey", "l_linenumber"], 1000, by), "column": E.multicolumn_sum_equal(li, ["l_linenumber", 1], "l_suppkey", by)}, *by)


@query(
    "expect_row_counts",
    """with g as (select o_custkey, count(*) as n from orders group by 1), p as (select o_custkey, count(*) as n from orders where o_orderstatus = 'P' group by 1)
    select 'between' as what, o_custkey, n from g where n < 5 or n > 17 union all select 'equal', o_custkey, n from g where n <> 10
    union all select 'other', coalesce(g.o_custkey, c_custkey), n from g full join customer on c_custkey = g.o_custkey where coalesce(n, 0) <> coalesce(case when c_custkey is not null then 1 end, 0)
    union all select 'factor', g.o_custkey, g.n from g left join p using (o_custkey) where g.n <> coalesce(p.n, 0) * 4""",
)
def q_row_counts(spark, sf):
    o, by = table(spark, sf, "orders"), ["o_custkey"]
    found = {
        "between": E.row_count_between(o, 5, 17, by).withColumnRenamed("expression", "n"),
        "equal": E.row_count_equal(o, 10, by).join(o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "o_custkey"),
        "other": E.row_count_equal_other_table(o, table(spark, sf, "customer"), by, ["c_custkey"]).select(F.col("col_1").alias("o_custkey"), F.col("expression").alias("n")),
        "factor": E.row_count_equal_other_table(o, o, by, factor=4, other_where="o_orderstatus = 'P'").select(F.col("col_1").alias("o_custkey"), F.col("expression").alias("n")),
    }
    return _named(found, "o_custkey", "n")


@query(
    "expect_history_rules",
    """with v as (select o_custkey as player_id, cast(o_orderdate as date) as effective_date, cast(o_orderdate as date) + cast(o_orderkey % 90 as int) as end_date, case when o_orderkey % 11 = 0 then 1 else 0 end as is_current from orders),
    n as (select *, lead(effective_date) over (partition by player_id order by effective_date, end_date) as next_start from v)
    select 'gap' as what, player_id, count(*) as n from (select *, lead(effective_date) over (partition by player_id order by effective_date) as next_start from (select distinct player_id, effective_date, max(end_date) over (partition by player_id, effective_date) as end_date from v)) where end_date + 1 <> next_start group by 2
    union all select 'overlap', player_id, count(*) from n where next_start <= end_date group by 2 union all select 'current', player_id, cast(sum(is_current) as bigint) from v group by 2 having sum(is_current) <> 1""",
)
def q_history_rules(spark, sf):
    """Orders as versions: gaps and overlaps between them, and customers without exactly one current one."""
    start = F.col("o_orderdate").cast("date")
    v = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("player_id"), start.alias("effective_date"), F.date_add(start, (F.col("o_orderkey") % 90).cast("int")).alias("end_date"), F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(0).alias("is_current")
    )
    one_a_day = v.groupBy("player_id", "effective_date").agg(F.max("end_date").alias("end_date"))
    n = F.count(F.lit(1)).alias("n")
    found = {
        "gap": E.history_gaps(one_a_day).groupBy("player_id").agg(n),
        "overlap": E.history_overlaps(v).groupBy("player_id").agg(n),
        "current": E.history_one_current(v).select("player_id", F.col("current_rows").alias("n")),
    }
    return _named(found, "player_id", "n")
