"""Tests, expectations, audits and comparisons over the given tables and the stand-in models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..plans import dims, facts
from ..quality import audits as A
from ..quality import compare as C
from ..quality import expectations as E
from ..quality import generic as Q
from ..quality import runner as U
from . import frames as fr
from . import model_queries as M
from .registry import query, rounded, table


def _t(spark, sf, name):
    return table(spark, sf, name)


# ---- generic tests ------------------------------------------------------------------------------


@query("test_unique_combination", "select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1")
def q_unique_combination(spark, sf):
    return Q.unique_combination(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("test_unique", "select o_custkey as unique_field, count(*) as n_records from orders group by 1 having count(*) > 1")
def q_unique(spark, sf):
    return Q.unique(_t(spark, sf, "orders"), "o_custkey")


@query("test_accepted_values", "select event_type as value_field, count(*) as n_records from events where event_type not in ('view', 'click', 'purchase') group by 1")
def q_accepted_values(spark, sf):
    return Q.accepted_values(_t(spark, sf, "events"), "event_type", ["view", "click", "purchase"])


@query("test_accepted_range", "select o_orderkey, o_totalprice from orders where o_totalprice < 1000 or o_totalprice > 300000")
def q_accepted_range(spark, sf):
    return Q.accepted_range(_t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 1000, 300000)


@query("test_relationships", "select l_partkey + 5 as from_field from lineitem where l_partkey + 5 not in (select p_partkey from part)")
def q_relationships(spark, sf):
    li = _t(spark, sf, "lineitem").select((F.col("l_partkey") + 5).alias("k"))
    return Q.relationships(li, "k", _t(spark, sf, "part"), "p_partkey")


@query("test_relationships_where", "select o_custkey as id from orders where o_orderstatus <> 'F' and o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def q_relationships_where(spark, sf):
    return Q.relationships_where(_t(spark, sf, "orders"), "o_custkey", _t(spark, sf, "customer"), "c_custkey", "o_orderstatus <> 'F'", "c_acctbal > 0")


@query(
    "test_at_least_one",
    "select l_orderkey, count(case when l_linenumber = 4 then 1 end) as filler_column from lineitem group by 1 having count(case when l_linenumber = 4 then 1 end) = 0",
)
def q_at_least_one(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("v", F.when(F.col("l_linenumber") == 4, 1))
    return Q.at_least_one(li, "v", ["l_orderkey"])


@query(
    "test_cardinality_equality",
    """with a as (select c_nationkey as value, count(*) as num_rows from customer group by 1), b as (select s_nationkey as value, count(*) as num_rows from supplier group by 1)
    select 'a' as which_side, * from (select * from a except select * from b) union all select 'b', * from (select * from b except select * from a)""",
)
def q_cardinality(spark, sf):
    return Q.cardinality_equality(_t(spark, sf, "customer"), "c_nationkey", _t(spark, sf, "supplier"), "s_nationkey")


@query("test_equal_rowcount", "select (select count(*) from orders) as count_a, (select count(*) from lineitem) as count_b, (select count(*) from lineitem) - (select count(*) from orders) as diff_count")
def q_equal_rowcount(spark, sf):
    return Q.equal_rowcount(_t(spark, sf, "orders"), _t(spark, sf, "lineitem"))


@query(
    "test_fewer_rows_than",
    """select a.k as k_a, b.k as k_b, a.n as count_our_model, b.n as count_comparison_model, cast(case when a.n > b.n then a.n - b.n when a.n = b.n then 1 else 0 end as bigint) as row_count_delta
    from (select c_nationkey as k, count(*) as n from customer group by 1) a full join (select s_nationkey as k, count(*) as n from supplier group by 1) b on a.k = b.k""",
)
def q_fewer_rows(spark, sf):
    a = _t(spark, sf, "customer").withColumnRenamed("c_nationkey", "k")
    b = _t(spark, sf, "supplier").withColumnRenamed("s_nationkey", "k")
    return Q.fewer_rows_than(a, b, ["k"])


@query(
    "test_equality",
    """(select 'a' as which_side, k, s from (select o_custkey as k, o_orderstatus as s from orders except select o_custkey, 'F' from orders)) union all
      (select 'b', k, s from (select o_custkey as k, 'F' as s from orders except select o_custkey, o_orderstatus from orders))""",
)
def q_equality(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return Q.equality(o, o.withColumn("s", F.lit("F")))


@query("test_expression_is_true", "select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem where not (l_quantity * 1000 >= l_extendedprice)")
def q_expression(spark, sf):
    return Q.expression_is_true(_t(spark, sf, "lineitem"), "l_quantity * 1000 >= l_extendedprice").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "test_mutually_exclusive_ranges",
    """with r as (select o_custkey as partition_by_col, o_orderdate as lower_bound, o_orderdate + interval 40 day as upper_bound from orders),
    w as (select *, lead(lower_bound) over (partition by partition_by_col order by lower_bound, upper_bound) as next_lower_bound, row_number() over (partition by partition_by_col order by lower_bound, upper_bound) = count(*) over (partition by partition_by_col) as is_last_record from r)
    select partition_by_col, lower_bound, upper_bound, next_lower_bound, is_last_record from w where not (coalesce(lower_bound < upper_bound, false) and coalesce(upper_bound <= next_lower_bound, is_last_record, false))""",
)
def q_ranges(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).alias("b"))
    return Q.mutually_exclusive_ranges(o, "a", "b", "o_custkey", small_groups=True)


@query(
    "test_mutually_exclusive_ranges_global",
    """with r as (select l_shipdate + to_seconds(l_orderkey % 86400) as lower_bound, l_shipdate + to_seconds(l_orderkey % 86400 + l_linenumber) as upper_bound from lineitem),
    w as (select *, lead(lower_bound) over (order by lower_bound, upper_bound) as next_lower_bound, row_number() over (order by lower_bound, upper_bound) = count(*) over () as is_last_record from r)
    select lower_bound, upper_bound, next_lower_bound, is_last_record from w where not (coalesce(lower_bound < upper_bound, false) and coalesce(upper_bound <= next_lower_bound, is_last_record, false))""",
)
def q_ranges_global(spark, sf):
    """All lines are one group: its rows are spread over chunks of time."""
    at = lambda n: F.col("l_shipdate") + F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    second = F.col("l_orderkey") % 86400
    li = _t(spark, sf, "lineitem").select(at(second).alias("a"), at(second + F.col("l_linenumber")).alias("b"))
    return Q.mutually_exclusive_ranges(li, "a", "b")


@query("test_not_accepted_values", "select distinct o_orderpriority as value_field from orders where o_orderpriority in ('1-URGENT', '9-NONE')")
def q_not_accepted(spark, sf):
    return Q.not_accepted_values(_t(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "9-NONE"])


@query("test_not_constant", "select o_custkey, count(distinct o_orderstatus) as filler_column from orders group by 1 having count(distinct o_orderstatus) = 1")
def q_not_constant(spark, sf):
    return Q.not_constant(_t(spark, sf, "orders"), "o_orderstatus", ["o_custkey"])


@query("test_not_empty_string", "select doc_id, n_chars from documents where n_chars % 3 = 0 or n_chars % 3 = 1 and trim(text) = ''")
def q_not_empty(spark, sf):
    rows = _t(spark, sf, "documents").withColumn("t", F.when(F.col("n_chars") % 3 == 0, "   ").when(F.col("n_chars") % 3 == 1, F.col("text")))
    return Q.not_empty_string(rows, "t").select("doc_id", "n_chars")


@query(
    "test_not_null_proportion",
    "select l_suppkey, round(avg(case when l_linenumber = 3 then 0.0 else 1.0 end) + 1e-9, 4) as not_null_proportion from lineitem group by 1 having avg(case when l_linenumber = 3 then 0.0 else 1.0 end) < 0.85",
)
def q_not_null_proportion(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("v", F.nullif(F.col("l_linenumber"), F.lit(3)))
    return rounded(Q.not_null_proportion(li, "v", 0.85, group_by=["l_suppkey"]))


@query("test_recency", "select user_id, max(ts) as most_recent, timestamp '2024-01-31' as threshold from events group by 1 having max(ts) < timestamp '2024-01-31'")
def q_recency(spark, sf):
    out = Q.recency(_t(spark, sf, "events"), "ts", "day", 1, group_by=["user_id"], as_of="2024-02-01")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("most_recent", "threshold")})


@query(
    "test_sequential_values",
    "select o_custkey, o_orderkey, previous_o_orderkey from (select o_custkey, o_orderkey, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) as previous_o_orderkey from orders) where not (o_orderkey = previous_o_orderkey + 1)",
)
def q_sequential(spark, sf):
    return Q.sequential_values(_t(spark, sf, "orders"), "o_orderkey", group_by=["o_custkey"])


@query(
    "test_fused_row_tests",
    """select unnest(['not_null_l_shipdate', 'accepted_range_l_discount', 'accepted_values_l_returnflag', 'price']) as test_name, unnest([0, cast(sum(case when l_discount > 0.08 then 1 else 0 end) as bigint),
      cast(sum(case when l_returnflag not in ('A', 'R') then 1 else 0 end) as bigint), cast(sum(case when not (l_extendedprice > l_quantity * 900) then 1 else 0 end) as bigint)]) as failure_count, count(*) as rows_tested from lineitem""",
)
def q_fused(spark, sf):
    tests = [
        U.not_null_test("l_shipdate"), U.range_test("l_discount", 0, 0.08), U.values_test("l_returnflag", ["A", "R"]), U.expression_test("price", "l_extendedprice > l_quantity * 900"),
    ]
    return U.fused_row_tests(_t(spark, sf, "lineitem"), tests)


# ---- expectations -------------------------------------------------------------------------------


@query("expect_values_between", "select o_orderkey, o_totalprice from orders where o_totalprice < 2000 or o_totalprice > 250000")
def q_between(spark, sf):
    return E.values_between(_t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 2000, 250000)


@query(
    "expect_aggregates_between",
    """with g as (select o_custkey, max(o_totalprice) as mx, min(o_totalprice) as mn, avg(o_totalprice) as av, sum(o_totalprice) as sm, stddev_samp(o_totalprice) as sd, count(distinct o_orderpriority) as dc, count(*) as n from orders group by 1)
    select 'max' as what, o_custkey from g where mx > 300000 union all select 'min', o_custkey from g where mn < 2000 union all select 'mean', o_custkey from g where av < 60000 or av > 200000
    union all select 'sum', o_custkey from g where sm > 2500000 union all select 'stdev', o_custkey from g where sd > 100000 union all select 'distinct', o_custkey from g where dc < 4 union all select 'rows', o_custkey from g where n < 5""",
)
def q_aggregates(spark, sf):
    o, by = _t(spark, sf, "orders"), ["o_custkey"]
    found = {
        "max": E.max_between(o, "o_totalprice", max_value=300000, group_by=by),
        "min": E.min_between(o, "o_totalprice", min_value=2000, group_by=by),
        "mean": E.mean_between(o, "o_totalprice", 60000, 200000, group_by=by),
        "sum": E.sum_between(o, "o_totalprice", max_value=2500000, group_by=by),
        "stdev": E.stdev_between(o, "o_totalprice", max_value=100000, group_by=by),
        "distinct": E.unique_value_count_between(o, "o_orderpriority", min_value=4, group_by=by),
        "rows": E.row_count_between(o, min_value=5, group_by=by),
    }
    out = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("what"), "o_custkey")
        out = part if out is None else out.unionByName(part)
    return out


@query("expect_quantile_between", "select l_returnflag, round(quantile_cont(l_quantity, 0.25) + 1e-9, 4) as expression from lineitem group by 1 having quantile_cont(l_quantity, 0.25) > 5")
def q_expect_quantile(spark, sf):
    return rounded(E.quantile_between(_t(spark, sf, "lineitem"), "l_quantity", 0.25, max_value=5, group_by=["l_returnflag"]))


@query("expect_most_common_value", "select value_field from (select o_orderpriority as value_field, count(*) as n from orders group by 1 order by n desc, value_field limit 1) where value_field not in ('none')")
def q_most_common(spark, sf):
    return E.most_common_value_in_set(_t(spark, sf, "orders"), "o_orderpriority", ["none"], 1)


@query("expect_distinct_values_in_set", "select distinct event_type as value_field from events where event_type not in ('view', 'click')")
def q_in_set(spark, sf):
    return E.distinct_values_in_set(_t(spark, sf, "events"), "event_type", ["view", "click"])


@query("expect_distinct_values_equal_set", "select event_type as column_value, cast(null as varchar) as set_value from (select distinct event_type from events) where event_type not in ('view', 'click', 'refund') union all select null, 'refund'")
def q_equal_set(spark, sf):
    return E.distinct_values_equal_set(_t(spark, sf, "events"), "event_type", ["view", "click", "refund"])


@query(
    "expect_values_increasing",
    "select sort_column, user_id, value_field, value_field_lag from (select ts as sort_column, user_id, value as value_field, lag(value) over (partition by user_id order by ts) as value_field_lag from events) where value_field_lag is not null and not (value_field > value_field_lag)",
)
def q_increasing(spark, sf):
    return E.values_increasing(_t(spark, sf, "events"), "value", sort_column="ts", group_by=["user_id"])


@query(
    "expect_values_decreasing_overall",
    "select sort_column, value_field, value_field_lag from (select event_id as sort_column, ts as value_field, lag(ts) over (order by event_id) as value_field_lag from events) where value_field_lag is not null and not (value_field < value_field_lag)",
)
def q_decreasing(spark, sf):
    return E.values_decreasing(_t(spark, sf, "events"), "ts", sort_column="event_id")


@query(
    "expect_within_n_moving_stdevs",
    """with m as (select date_trunc('day', ts) as metric_period, event_type, sum(value) as agg from events group by 1, 2), d as (select *, ln(nullif(agg, 0)) - coalesce(ln(nullif(lag(agg, 1) over (partition by event_type order by metric_period), 0)), 0) as v from m),
    r as (select *, avg(v) over w as a, stddev_samp(v) over w as s from d window w as (partition by event_type order by metric_period rows between 7 preceding and 1 preceding)),
    z as (select *, (v - a) / nullif(s, 0) as sg from r)
    select metric_period, event_type, round(v + 1e-9, 4) as metric_test_value, round(sg + 1e-9, 4) as metric_test_sigma from z where metric_period >= timestamp '2024-01-17' and metric_period < timestamp '2024-01-31' and not (sg >= -1 and sg <= 1)""",
)
def q_moving_stdevs(spark, sf):
    out = E.within_n_moving_stdevs(_t(spark, sf, "events"), "value", "ts", group_by=["event_type"], sigma_threshold=1, as_of="2024-01-31")
    out = out.withColumn("metric_period", F.col("metric_period").cast("timestamp_ntz"))
    return rounded(out.select("metric_period", "event_type", "metric_test_value", "metric_test_sigma"))


@query(
    "expect_within_n_stdevs",
    """with s as (select o_custkey, sum(o_totalprice) as t from orders group by 1), z as (select *, (t - avg(t) over ()) / stddev_samp(t) over () as sg from s)
    select o_custkey, round(t + 1e-9, 4) as o_totalprice, round(sg + 1e-9, 4) as o_totalprice_sigma from z where abs(sg) > 2""",
)
def q_stdevs(spark, sf):
    out = E.within_n_stdevs(_t(spark, sf, "orders"), "o_totalprice", ["o_custkey"], 2)
    return rounded(out.select("o_custkey", "o_totalprice", "o_totalprice_sigma"))


@query(
    "expect_data_for_every_day",
    """with b as (select cast(min(cast(o_orderdate as date)) as timestamp) as a, cast(max(cast(o_orderdate as date)) as timestamp) as z from orders where o_orderpriority = '1-URGENT'),
    d as (select t.d as date_day from b, unnest(generate_series(a, z - interval 1 day, interval 1 day)) as t(d))
    select date_day, true as is_missing, 0 as row_cnt from d where date_day not in (select date_trunc('day', o_orderdate) from orders where o_orderpriority = '1-URGENT')""",
)
def q_every_day(spark, sf):
    out = E.data_for_every_n_datepart(_t(spark, sf, "orders"), "o_orderdate", "day", where="o_orderpriority = '1-URGENT'")
    return out.withColumn("date_day", F.col("date_day").cast("timestamp_ntz"))


@query("expect_compound_columns_unique", "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1")
def q_compound(spark, sf):
    return E.compound_columns_unique(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("expect_unique_within_record", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, 1 as column_values from lineitem where l_suppkey = l_partkey")
def q_within_record(spark, sf):
    out = E.select_values_unique_within_record(_t(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "column_values")


@query("expect_pair_a_greater", "select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem where not (l_partkey > l_suppkey)")
def q_pair(spark, sf):
    return E.pair_a_greater_than_b(_t(spark, sf, "lineitem"), "l_partkey", "l_suppkey").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("expect_pair_in_set", "select l_returnflag, l_linestatus, count(*) as n from lineitem where not ((l_returnflag = 'A' and l_linestatus = 'F') or (l_returnflag = 'N' and l_linestatus = 'O')) group by 1, 2")
def q_pair_set(spark, sf):
    return E.pair_in_set(_t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")]).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "expect_text_patterns",
    """select 'length' as what, doc_id from documents where length(text) < 40 or length(text) > 20000 union all select 'like', doc_id from documents where not (text like '%a%') union all
      select 'regex', doc_id from documents where not regexp_matches(text, '[A-Z]') union all select 'not_regex', doc_id from documents where regexp_matches(text, 'license', 'i') union all
      select 'any_like', doc_id from documents where not (text like '%the%' or text like '%der%')""",
)
def q_patterns(spark, sf):
    d = _t(spark, sf, "documents")
    found = {
        "length": E.value_lengths_between(d, "text", 40, 20000),
        "like": E.match_like(d, "text", "%a%"),
        "regex": E.match_regex(d, "text", "[A-Z]"),
        "not_regex": E.not_match_regex(d, "text", "license", "i"),
        "any_like": E.match_like_list(d, "text", ["%the%", "%der%"]),
    }
    out = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("what"), "doc_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "expect_aggregation_equal_other",
    """select coalesce(a.k, b.k) as col_1, a.n as expression, b.n as compare_expression, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) as expression_difference,
      round(abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / nullif(cast(a.n as double), 0) + 1e-9, 4) as expression_difference_percent
    from (select c_nationkey as k, count(*) as n from customer group by 1) a full join (select s_nationkey as k, count(*) as n from supplier group by 1) b on a.k = b.k where abs(coalesce(a.n, 0) - coalesce(b.n, 0)) > 50""",
)
def q_other_table(spark, sf):
    out = E.aggregation_equal_other_table(_t(spark, sf, "customer"), F.count(F.lit(1)), _t(spark, sf, "supplier"), group_by=["c_nationkey"], other_group_by=["s_nationkey"], tolerance=50)
    return rounded(out)


@query("expect_grouped_recent", "select 1::bigint as row_count, user_id, max(ts) as latest_timestamp_column from events where ts <= timestamp '2024-01-25' group by user_id having max(ts) < timestamp '2024-01-24 12:00:00'")
def q_grouped_recent(spark, sf):
    out = E.grouped_rows_recent(_t(spark, sf, "events"), ["user_id"], "ts", "hour", 12, as_of="2024-01-25")
    return out.withColumn("latest_timestamp_column", F.col("latest_timestamp_column").cast("timestamp_ntz"))


@query("expect_consistent_casing", "with d as (select distinct case when c_custkey % 9 = 0 then lower(c_mktsegment) else c_mktsegment end as v from customer) select lower(v) as inconsistent_columns, count(v) as set_count_case_insensitive from d group by 1 having count(v) > 1")
def q_casing(spark, sf):
    c = _t(spark, sf, "customer").withColumn("v", F.when(F.col("c_custkey") % 9 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")))
    return E.consistent_casing(c, "v", display=True)


@query(
    "expect_decimal_ranges",
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, 'l_tax' as column_name, l_tax as bad_value from lineitem where l_tax > 0.07 union all select l_orderkey, l_partkey, l_suppkey, l_linenumber, 'l_discount', l_discount from lineitem where l_discount < 0.01",
)
def q_decimal(spark, sf):
    return E.decimal_ranges(_t(spark, sf, "lineitem"), {"l_tax": (0, 0.07), "l_discount": (0.01, None)}, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@query(
    "expect_column_shapes",
    """select * from (values ('exists', 'O_MISSING', null), ('exists', 'o_custkey', '5'), ('count', '6', null), ('contain', 'O_GONE', null), ('not_contain', 'o_custkey', null),
      ('set', 'O_ORDERPRIORITY', null), ('set', null, 'C_NAME'), ('ordered', 'O_ORDERKEY', 'O_CUSTKEY'), ('ordered', 'O_CUSTKEY', 'O_ORDERKEY')) as v(check_name, found, wanted) where (select count(*) from orders) > 0""",
)
def q_shapes(spark, sf):
    """Every shape check with a table that fails it, and some that pass; what they report, as rows."""
    o = _t(spark, sf, "orders")
    without = [c for c in o.columns if c != "o_orderpriority"]
    swapped = ["o_custkey", "o_orderkey", *o.columns[2:]]
    failed = [
        ("exists", E.column_exists(o, "O_MISSING")), ("exists", E.column_exists(o, "o_custkey", 5)), ("exists", E.column_exists(o, "o_custkey", 2)), ("count", E.column_count_equal(o, 7)),
        ("count", E.column_count_equal(o, 6)), ("contain", E.columns_contain_set(o, ["o_orderkey", "O_GONE"])), ("not_contain", E.columns_not_contain_set(o, ["o_custkey", "c_custkey"])),
        ("set", E.columns_match_set(o, [*without, "c_name"])), ("set", E.columns_match_set(o, o.columns)), ("ordered", E.columns_match_ordered_list(o, swapped)), ("ordered", E.columns_match_ordered_list(o, o.columns)),
    ]
    out = None
    for name, rows in failed:
        cols = [c for c in rows.columns if c != "column_index"]
        last = F.col(cols[1]).cast("string") if len(cols) > 1 else F.lit(None).cast("string")
        part = rows.select(F.lit(name).alias("check_name"), F.col(cols[0]).cast("string").alias("found"), last.alias("wanted"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- comparisons --------------------------------------------------------------------------------


def _two_versions(spark, sf):
    a = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    b = a.where("c_custkey % 13 <> 0").withColumns(
        {"c_nationkey": F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")), "c_mktsegment": F.when(F.col("c_custkey") % 6 == 0, None).otherwise(F.col("c_mktsegment"))}
    )
    return a, b


_TWO = """a as (select c_custkey, c_name, c_nationkey, c_mktsegment from customer), b as (select c_custkey, c_name, case when c_custkey % 4 = 0 then c_nationkey + 1 else c_nationkey end as c_nationkey,
  case when c_custkey % 6 = 0 then null else c_mktsegment end as c_mktsegment from customer where c_custkey % 13 <> 0)"""


@query(
    "compare_queries",
    f"""with {_TWO}, u as (select max(x) as in_a, max(y) as in_b from (select *, true as x, false as y from a union all select *, false, true from b) group by c_custkey, c_name, c_nationkey, c_mktsegment),
    n as (select in_a, in_b, count(*) as count from u group by 1, 2) select *, cast(round(count * 100.0 / (select sum(count) from n), 2) as decimal(10,2)) as percent_of_total from n""",
)
def q_compare(spark, sf):
    return C.compare_queries(*_two_versions(spark, sf)).withColumn("percent_of_total", F.col("percent_of_total").cast("decimal(10,2)"))


def _column_sql(c: str) -> str:
    n = lambda cond, name: f"cast(sum(case when {cond} then 1 else 0 end) as bigint) as {name}"
    both = "a.c_custkey is not null and b.c_custkey is not null"
    return (
        f"select '{c}' as column_name, {n(f'{both} and a.{c} is not distinct from b.{c}', 'perfect_match')}, {n(f'a.c_custkey is not null and a.{c} is null', 'null_in_a')}, "
        f"{n(f'b.c_custkey is not null and b.{c} is null', 'null_in_b')}, {n('a.c_custkey is null', 'missing_from_a')}, {n('b.c_custkey is null', 'missing_from_b')}, "
        f"{n(f'{both} and a.{c} is distinct from b.{c}', 'conflicting_values')} from a full join b on a.c_custkey = b.c_custkey"
    )


@query("compare_all_columns", f"with {_TWO} " + " union all ".join(_column_sql(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")))
def q_compare_columns(spark, sf):
    return C.compare_all_columns(*_two_versions(spark, sf), ["c_custkey"])


@query(
    "compare_column_values",
    f"""with {_TWO}, s as (select case when a.c_custkey is null then 'missing from a' when b.c_custkey is null then 'missing from b' when a.c_mktsegment is null and b.c_mktsegment is null then 'both are null' when a.c_mktsegment is null then 'value is null in a only'
      when b.c_mktsegment is null then 'value is null in b only' when a.c_mktsegment = b.c_mktsegment then 'perfect match' else 'values do not match' end as match_status from a full join b on a.c_custkey = b.c_custkey)
    select 'c_mktsegment' as column_name, match_status, count(*) as count_records, cast(round(count(*) * 100.0 / sum(count(*)) over (), 2) as decimal(10,2)) as percent_of_total from s group by 2""",
)
def q_compare_column(spark, sf):
    return C.compare_column_values(*_two_versions(spark, sf), ["c_custkey"], "c_mktsegment").withColumn("percent_of_total", F.col("percent_of_total").cast("decimal(10,2)"))


@query("compare_row_counts", f"with {_TWO} select 'now' as relation_name, count(*) as total_records from a union all select 'before', count(*) from b")
def q_compare_counts(spark, sf):
    return C.compare_row_counts(*_two_versions(spark, sf), "now", "before")


@query("remediation_keep_first", "select l_orderkey, l_linenumber, min(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey) as row_id from lineitem group by 1, 2")
def q_keep_first(spark, sf):
    row_id = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", row_id.alias("row_id"))
    return C.without_duplicates(li, ["l_orderkey", "l_linenumber"], "row_id")


# ---- audits -------------------------------------------------------------------------------------


def _games_model(spark, sf):
    return {"fact_games": M.game_fact(spark, sf)}




@query(
    "audit_fact_games_keys",
    f"""with {M.FACT_GAMES_CTE} select game_pk, season, cast(year(d) * 100 + month(d) as bigint) as load_id, k as null_keys from (select game_pk, season, o_orderdate as d,
      case when home_team_key is null then 'home_team_key;' else '' end || case when away_team_key is null then 'away_team_key;' else '' end as k from fg join orders on o_orderkey = game_pk) where k <> ''""",
)
def q_audit_keys(spark, sf):
    return A.registry()["integrity_fact_games_dimension_keys"].failing(_games_model(spark, sf))


@query(
    "audit_stat_sanity",
    f"""with {M.LINES_CTE}, v as (select game_pk, player_id, player_name, case when batting_hits > batting_at_bats then 'hits_gt_at_bats;' else '' end ||
      case when batting_doubles + batting_triples + batting_home_runs > batting_hits then 'xbh_gt_hits;' else '' end || case when batting_home_runs > batting_runs then 'hr_gt_runs;' else '' end ||
      case when pitching_earned_runs > pitching_runs_allowed then 'er_gt_runs_allowed;' else '' end || case when fielding_chances <> fielding_putouts + fielding_assists + fielding_errors then 'chances_ne_po_a_e;' else '' end ||
      case when batting_at_bats < 0 or batting_hits < 0 or pitching_outs_recorded < 0 then 'negative_values;' else '' end as violations from ln) select * from v where violations <> ''""",
)
def q_audit_sanity(spark, sf):
    return A.registry()["business_logic_player_game_stat_sanity"].failing({"int_player_game_stats": M.player_lines(spark, sf)})


@query(
    "audit_standings_symmetry",
    f"""with {M.STANDINGS_CTE} select game_pk, count(*) as pairs from (select h.game_pk from st h join st a on a.game_pk = h.game_pk and a.is_home = 0 and a.team_id = h.opponent_team_id where h.is_home = 1
      and (h.is_win <> a.is_loss or h.is_loss <> a.is_win or h.is_tie <> a.is_tie or h.is_win + h.is_loss + h.is_tie <> 1 or (h.is_win = 1 and h.team_score <= h.opponent_score) or (a.is_win = 1 and a.team_score <= a.opponent_score)
        or h.team_score <> a.opponent_score or h.opponent_score <> a.team_score)) group by 1""",
)
def q_audit_symmetry(spark, sf):
    m = {"dim_team_standings": dims.dim_team_standings(M.results(spark, sf))}
    return A.registry()["business_logic_team_standings_symmetry"].failing(m).groupBy("game_pk").agg(F.count(F.lit(1)).alias("pairs"))


_VERSIONS = """select o_custkey as player_id, cast(o_orderdate as date) as effective_date, row_number() over w as version_number,
      lead(cast(o_orderdate as date)) over w as nxt, o_orderkey from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)"""


@query(
    "audit_player_history",
    f"""with v0 as ({_VERSIONS}), v as (select player_id, version_number, effective_date, coalesce(cast(nxt - 1 as date), date '9999-12-31') as end_date, case when nxt is null or o_orderkey % 97 = 0 then 1 else 0 end as is_current from v0),
    p as (select *, lag(end_date) over (partition by player_id order by version_number) as prev_end from v),
    g as (select player_id, cast(sum(is_current) as bigint) as current_rows, cast(sum(case when end_date < effective_date then 1 else 0 end) as bigint) as inverted_ranges,
      cast(sum(case when effective_date <= prev_end then 1 else 0 end) as bigint) as overlapping_ranges from p group by 1)
    select * from g where current_rows <> 1 or inverted_ranges > 0 or overlapping_ranges > 0""",
)
def q_audit_history(spark, sf):
    """Orders as versions of their customers: some have two current rows or two versions of one day."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    day = F.col("o_orderdate").cast("date")
    v = _t(spark, sf, "orders").withColumns({"effective_date": day, "version_number": F.row_number().over(w), "nxt": F.lead(day).over(w)})
    history = v.select(
        F.col("o_custkey").alias("player_id"), "version_number", "effective_date",
        F.coalesce(F.date_sub("nxt", 1), F.lit("9999-12-31").cast("date")).alias("end_date"),
        F.when(F.col("nxt").isNull() | (F.col("o_orderkey") % 97 == 0), 1).otherwise(0).alias("is_current"),
    )
    return A.registry()["uniqueness_dim_player_one_current_row"].failing({"dim_player": history})


@query(
    "audit_batted_ball_summary",
    f"""with {M.PITCHES_CTE}, {M.BATTED_CTE}, s as (select count(*) as n, sum(case when exit_velocity not between 0 and 125 or launch_angle not between -90 and 90 or hit_distance not between 0 and 550 or (is_barrel = 1 and is_hard_hit = 0) then 1 else 0 end) as f from batted)
    select 'range_fact_batted_balls_values' as test_name, cast(f as bigint) as failure_count, n as rows_compared, cast((n - f) * 100.0 / n as decimal(10,4)) as perfect_match_pct from s""",
)
def q_audit_summary(spark, sf):
    out = U.run_audits({"fact_batted_balls": facts.fact_batted_balls(fr.pitches(spark, sf))}, ["range_fact_batted_balls_values"], samples=False)
    return out.select("test_name", "failure_count", "rows_compared", F.col("perfect_match_pct").cast("decimal(10,4)").alias("perfect_match_pct"))


@query("audit_run_with_samples")
def q_audit_samples(spark, sf):
    """All runnable audits of the pitch models in one result, ordered samples included."""
    p = fr.pitches(spark, sf)
    m = {"fact_at_bats": facts.fact_at_bats(p), "fact_batted_balls": facts.fact_batted_balls(p)}
    return U.run_audits(m)
