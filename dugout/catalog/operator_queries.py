"""Operators and column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalar as S
from ..functions import web as U
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from ..operators.keys import keyed_join
from ..sources import loads as L
from ..sources import partitioned as P
from ..sources import tables as T
from ..streaming import incremental as I
from ..streaming import refresh as G
from .registry import query, rounded, table

# ---- column functions ---------------------------------------------------------------------------

_TAG = S.NULL_KEY_TEXT


@query(
    "scalar_surrogate_key",
    f"""select o_orderkey, md5(concat_ws('-', cast(o_orderkey as varchar), coalesce(nullif(o_orderstatus, 'P'), '{_TAG}'), coalesce(cast(nullif(o_custkey % 5, 0) as varchar), '{_TAG}'))) as order_hash,
      md5(concat_ws('-', coalesce(nullif(o_orderstatus, 'P'), ''), o_orderpriority)) as order_hash_empty from orders""",
)
def q_surrogate_key(spark, sf):
    status, mod = F.nullif(F.col("o_orderstatus"), F.lit("P")), F.nullif(F.col("o_custkey") % 5, F.lit(0))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        S.surrogate_key(["o_orderkey", status, mod]).alias("order_hash"),
        S.surrogate_key([status, "o_orderpriority"], null_as_empty=True).alias("order_hash_empty"),
    )


@query(
    "scalar_safe_arithmetic",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(a, 0) + coalesce(b, 0) + l_suppkey as total, coalesce(a, 0) - coalesce(b, 0) as difference,
      round(cast(l_partkey as double) / nullif(b, 0) + 1e-9, 4) as quotient, round(cast(a as double) / nullif(b, 0), 3) as ratio
    from (select *, nullif(l_linenumber, 3) as a, nullif(cast(l_quantity as int) % 5, 4) as b from lineitem)""",
)
def q_safe_arithmetic(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"a": F.nullif(F.col("l_linenumber"), F.lit(3)), "b": F.nullif(F.col("l_quantity").cast("int") % 5, F.lit(4))})
    out = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        S.safe_add(["a", "b", "l_suppkey"]).alias("total"),
        S.safe_subtract(["a", "b"]).alias("difference"),
        S.safe_divide("l_partkey", "b").alias("quotient"),
        S.rate("a", "b").alias("ratio"),
    )
    return rounded(out)


@query(
    "scalar_haversine",
    """with p as (select c_custkey, (c_acctbal - 4500) / 100 as lat, cast(c_custkey % 360 - 180 as double) as lon from customer)
    select c_custkey, round(2 * 3961 * asin(sqrt(pow(sin((radians(48.864716) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(48.864716)) * pow(sin((radians(2.349014) - radians(lon)) / 2), 2))) + 1e-9, 4) as miles,
      round(2 * 3961 * asin(sqrt(pow(sin((radians(48.864716) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(48.864716)) * pow(sin((radians(2.349014) - radians(lon)) / 2), 2))) * 1.60934 + 1e-9, 4) as km from p""",
)
def q_haversine(spark, sf):
    p = table(spark, sf, "customer").select("c_custkey", ((F.col("c_acctbal") - 4500) / 100).alias("lat"), (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"))
    far = [F.lit(48.864716), F.lit(2.349014)]
    return rounded(p.select("c_custkey", S.haversine("lat", "lon", *far).alias("miles"), S.haversine("lat", "lon", *far, unit="km").alias("km")))


@query(
    "scalar_url_parts",
    """with s as (select page_id, url, replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '') as r from pages)
    select page_id, split_part(split_part(r, '/', 1), '?', 1) as host,
      case when instr(r, '/') > 0 then nullif(split_part(substr(r, instr(r, '/') + 1), '?', 1), '') end as path,
      nullif(split_part(split_part(url, 'id=', 2), '&', 1), '') as id_parameter from s""",
)
def q_url_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.url_host("url").alias("host"), U.url_path("url").alias("path"), U.url_parameter("url", "id").alias("id_parameter")
    )


@query(
    "scalar_width_bucket",
    """select o_orderkey, cast(least(ceil((v - 1000) / 4900.0), 11) + case when v % 4900.0 = 0 then 1 else 0 end as int) as bucket
    from (select o_orderkey, floor(o_totalprice / 100) * 100 as v from orders)""",
)
def q_width_bucket(spark, sf):
    v = F.floor(F.col("o_totalprice") / 100) * 100
    return table(spark, sf, "orders").select("o_orderkey", S.width_bucket(v, 1000, 50000, 10).alias("bucket"))


@query(
    "scalar_number_texts",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_partkey // 3 || '.' || l_partkey % 3 as innings, cast(l_partkey as bigint) as outs,
      cast(l_extendedprice as decimal(18,2)) as money, case when l_linenumber = 7 then null else cast(l_linenumber as int) end as number,
      cast(l_linenumber * 60 + l_suppkey % 60 as int) as minutes, 1000 + l_partkey as grouped from lineitem""",
)
def q_number_texts(spark, sf):
    li = table(spark, sf, "lineitem")
    price = F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice"), 2))
    loose = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_linenumber").cast("string"))
    clock = F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), F.lpad((F.col("l_suppkey") % 60).cast("string"), 2, "0"))
    innings = S.outs_to_innings("l_partkey")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        innings.alias("innings"),
        S.innings_to_outs(innings).cast("long").alias("outs"),
        S.money(price).alias("money"),
        loose.try_cast("int").alias("number"),
        S.duration_minutes(clock).alias("minutes"),
        S.grouped_int(F.format_number(F.col("l_partkey") + 1000, 0)).cast("long").alias("grouped"),
    )


@query(
    "scalar_clean_text",
    """select conv_id, turn, coalesce(nullif(trim(case when turn % 3 = 0 then '   ' else '  ' || text || ' ' end), ''), 'Unknown') as cleaned,
      coalesce(nullif(case when turn % 4 = 0 then '' else role end, ''), 'unknown') as role_or_unknown, nullif(case when turn % 4 = 0 then '' else role end, '') as role_or_null from conversations""",
)
def q_clean_text(spark, sf):
    t = F.col("turn")
    padded = F.when(t % 3 == 0, "   ").otherwise(F.concat(F.lit("  "), F.col("text"), F.lit(" ")))
    role = F.when(t % 4 == 0, "").otherwise(F.col("role"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", S.clean_text(padded, "Unknown").alias("cleaned"), S.text_or(role, "unknown").alias("role_or_unknown"), S.blank_to_null(role).alias("role_or_null")
    )


@query(
    "scalar_regex_match",
    """select lang, source, count(*) as docs, cast(sum(case when regexp_matches(text, 'the [a-z]+ of', 'i') then 1 else 0 end) as bigint) as phrase_any_case,
      cast(sum(case when regexp_matches(text, '[0-9]{4}') then 1 else 0 end) as bigint) as with_digits,
      cast(sum(case when text like '%e%' then 1 else 0 end) as bigint) as like_e from documents group by lang, source""",
)
def q_regex(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(S.regex_match("text", "the [a-z]+ of", "i")).alias("phrase_any_case"),
        F.count_if(S.regex_match("text", "[0-9]{4}")).alias("with_digits"),
        F.count_if(F.col("text").like("%e%")).alias("like_e"),
    )


@query(
    "scalar_json_parts",
    """select event_type, count(*) as n, cast(sum(cast(json_extract_string(props, '$.k') as int)) as bigint) as k_total, max(json_extract_string(props, '$.k')) as k_max from events group by event_type""",
)
def q_json(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k.cast("int")).alias("k_total"), F.max(k).alias("k_max"))


@query(
    "scalar_epoch_times",
    """select event_id, cast(floor(epoch(ts)) as bigint) as epoch_seconds, date_trunc('day', ts + interval 12 hour) as nearest_midnight,
      cast(date_diff('day', ts, timestamp '2024-02-01') as int) as days_since, cast(date_diff('hour', ts, timestamp '2024-02-01') as bigint) as hours_since,
      cast(date_diff('month', ts, timestamp '2025-03-01') as int) as months_since from events""",
)
def q_epoch(spark, sf):
    to = F.lit("2024-02-01").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id",
        D.to_unixtimestamp("ts").alias("epoch_seconds"),
        D.round_timestamp("ts").cast("timestamp_ntz").alias("nearest_midnight"),
        D.periods_since("ts", "day", to).alias("days_since"),
        D.periods_since("ts", "hour", to).alias("hours_since"),
        D.periods_since("ts", "month", F.lit("2025-03-01").cast("timestamp_ntz")).alias("months_since"),
    )


# ---- projections --------------------------------------------------------------------------------


@query("project_star", "select o_orderkey as src_o_orderkey_x, o_custkey as src_o_custkey_x, o_orderstatus as src_o_orderstatus_x, o_orderdate as src_o_orderdate_x from orders")
def q_star(spark, sf):
    return R.star(table(spark, sf, "orders"), drop=["O_TOTALPRICE", "o_orderpriority"], prefix="src_", suffix="_x")


@query(
    "project_nullcheck",
    """select p_partkey, nullif(regexp_replace(p_name, '^[a-m].*$', ''), '') as p_name, nullif(case when p_size % 3 = 0 then '' else p_brand end, '') as p_brand, p_size from part""",
)
def q_nullcheck(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.regexp_replace("p_name", "^[a-m].*$", "").alias("p_name"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("p_brand"), "p_size")
    return R.nullcheck(p)


@query(
    "project_declared_types",
    """select o_orderkey, try_cast(case when o_orderkey % 7 = 0 then 'n/a' else cast(o_custkey as varchar) end as int) as customer, cast(o_orderdate as date) as day, cast(o_totalprice as decimal(12,1)) as price from orders""",
)
def q_typed(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("price"),
    )
    return R.typed(o, {"o_orderkey": "bigint", "customer": "int", "day": "date", "price": "decimal(12,1)"})


# ---- joins --------------------------------------------------------------------------------------


@query(
    "join_star_lookups",
    """select o_orderkey, c.c_name, c.c_mktsegment, n.n_name as nation, r.r_name as region from orders o left join customer c on c.c_custkey = o.o_custkey
      left join nation n on n.n_nationkey = c.c_nationkey left join region r on r.r_regionkey = n.n_regionkey""",
)
def q_star_lookups(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o = J.lookup(o, table(spark, sf, "customer"), {"c_custkey": "o_custkey"}, {"c_name": "c_name", "c_mktsegment": "c_mktsegment", "nk": "c_nationkey"})
    o = J.lookup(o, table(spark, sf, "nation"), {"n_nationkey": "nk"}, {"nation": "n_name", "rk": "n_regionkey"})
    return J.lookup(o, table(spark, sf, "region"), {"r_regionkey": "rk"}, {"region": "r_name"}).drop("o_custkey", "nk", "rk")


@query(
    "join_role_playing",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, sn.n_name as supplier_nation, cn.n_name as customer_nation from lineitem l join orders o on o.o_orderkey = l.l_orderkey
      left join supplier s on s.s_suppkey = l.l_suppkey left join nation sn on sn.n_nationkey = s.s_nationkey
      left join customer c on c.c_custkey = o.o_custkey left join nation cn on cn.n_nationkey = c.c_nationkey""",
)
def q_role_playing(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey")
    j = J.lookup(j, table(spark, sf, "supplier"), {"s_suppkey": "l_suppkey"}, {"sn": "s_nationkey"})
    j = J.lookup(j, table(spark, sf, "customer"), {"c_custkey": "o_custkey"}, {"cn": "c_nationkey"})
    nations = table(spark, sf, "nation")
    j = J.lookup(j, nations, {"n_nationkey": "sn"}, {"supplier_nation": "n_name"})
    return J.lookup(j, nations, {"n_nationkey": "cn"}, {"customer_nation": "n_name"}).drop("o_custkey", "sn", "cn")


@query(
    "join_conditional",
    """select o.o_orderkey, b.lines, b.o_orderkey is not null as matched from orders o left join
      (select l_orderkey as o_orderkey, count(*) as lines, max(l_shipdate) as last_ship from lineitem group by 1) b
      on b.o_orderkey = o.o_orderkey and (o.o_orderstatus = 'P' or b.last_ship > o.o_orderdate + interval 60 day)""",
)
def q_conditional(spark, sf):
    box = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_ship"))
    accept = (F.col("o_orderstatus") == "P") | (F.col("last_ship") > F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS"))
    return J.conditional_lookup(table(spark, sf, "orders"), box, ["o_orderkey"], accept).select("o_orderkey", "lines", F.col("_matched").alias("matched"))


@query(
    "join_dates_to_ranges",
    """with r as (select o_orderpriority as phase, cast(min(o_orderdate) as date) as d0, cast(min(o_orderdate) as date) + 200 as d1 from orders group by 1),
      f as (select phase, d0 + cast(row_number() over (order by phase) as int) * 210 as d0, d0 + cast(row_number() over (order by phase) as int) * 210 + 200 as d1 from r)
    select o_orderkey, phase from orders o left join f on cast(o.o_orderdate as date) between f.d0 and f.d1""",
)
def q_date_ranges(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    r = o.groupBy(F.col("o_orderpriority").alias("phase")).agg(F.min("day").alias("d0"))
    place = F.substring("phase", 1, 1).cast("int") * 210
    f = r.select("phase", F.date_add("d0", place).alias("d0"), F.date_add("d0", place + 200).alias("d1"))
    return J.date_in_range(o, "day", f, "d0", "d1", ["phase"]).select("o_orderkey", "phase")


@query(
    "join_asof_previous_purchase",
    """select e.event_id, p.event_id as purchase_id, p.value as purchase_value from events e asof left join
      (select * from events where event_type = 'purchase') p on e.user_id = p.user_id and e.ts > p.ts""",
)
def q_asof(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id")
    p = table(spark, sf, "events").where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), F.col("event_id").alias("pid"), "value")
    out = J.asof_join(e, p, ["user_id"], "ts", "bought", {"purchase_id": "pid", "purchase_value": "value"}, ["event_id"], strict=True, chunk=F.to_date("_time"))
    return out.select("event_id", "purchase_id", "purchase_value")


@query(
    "join_asof_window",
    """select e.event_id, (select max(p.ts) from events p where p.event_type = 'error' and p.user_id = e.user_id and p.ts <= e.ts and p.ts >= e.ts - interval 3 day) as last_error from events e""",
)
def q_asof_window(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id")
    p = table(spark, sf, "events").where("event_type = 'error'").select("user_id", F.col("ts").alias("err_ts"))
    since = F.col("ts") - F.expr("INTERVAL 3 DAYS")
    out = J.asof_join(e, p, ["user_id"], "ts", "err_ts", {"last_error": "err_ts"}, ["event_id"], not_before=since, chunk=F.to_date("_time"))
    return out.select("event_id", "last_error")


@query("join_not_in", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_custkey is not null)")
def q_not_in(spark, sf):
    urgent = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return J.not_in(table(spark, sf, "customer"), ["c_custkey"], urgent).select("c_custkey", "c_name")


@query("join_semi_touched", "select l_orderkey, count(*) as n from lineitem where l_orderkey in (select o_orderkey from orders where o_orderdate >= timestamp '2001-01-01') group by 1")
def q_semi(spark, sf):
    new = table(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").join(new, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_null_safe",
    """with a as (select nullif(o_orderstatus, 'P') as k, o_orderpriority as p, count(*) as n from orders group by 1, 2), b as (select nullif(o_orderstatus, 'P') as k, o_orderpriority as p, sum(o_custkey) as s from orders group by 1, 2)
    select a.k, a.p, a.n, cast(b.s as bigint) as s from a left join b on a.p = b.p and (a.k = b.k or (a.k is null and b.k is null))""",
)
def q_null_safe(spark, sf):
    o = table(spark, sf, "orders").withColumns({"k": F.nullif(F.col("o_orderstatus"), F.lit("P")), "p": F.col("o_orderpriority")})
    a = o.groupBy("k", "p").agg(F.count(F.lit(1)).alias("n"))
    b = o.groupBy("k", "p").agg(F.sum("o_custkey").alias("s"))
    return keyed_join(a, b, ["p", "k"], null_safe=["k"])


@query("join_members", "select distinct k as member from (select c_nationkey as k from customer union all select s_nationkey from supplier union all select n_regionkey from nation)")
def q_members(spark, sf):
    parts = [
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("a"), F.lit(None).cast("int").alias("b")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("a"), F.lit(None).cast("int").alias("b")),
        table(spark, sf, "nation").select(F.col("n_regionkey").alias("a"), F.lit(None).cast("int").alias("b")),
    ]
    return J.members_of(parts[0].union(parts[1]).union(parts[2]), ["a", "b"], "member")


@query(
    "join_full_counts",
    """select coalesce(a.k, b.k) as k, coalesce(a.n, 0) as customers, coalesce(b.n, 0) as suppliers from (select c_nationkey as k, count(*) as n from customer group by 1) a
      full join (select s_nationkey + 5 as k, count(*) as n from supplier group by 1) b on a.k = b.k""",
)
def q_full(spark, sf):
    a = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    b = table(spark, sf, "supplier").groupBy((F.col("s_nationkey") + 5).alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    return a.join(b, "k", "full").na.fill(0, ["customers", "suppliers"])


# ---- aggregates ---------------------------------------------------------------------------------


@query(
    "agg_conditional",
    """select l_returnflag, l_linestatus, count(*) as n, cast(sum(case when l_discount > 0.05 then l_linenumber end) as bigint) as null_if_none,
      cast(sum(case when l_discount > 0.5 then 1 else 0 end) as bigint) as zero_if_none, cast(sum(case when l_discount > 0.5 then 1 end) as bigint) as null_when_none,
      count(distinct l_orderkey) as orders, count(distinct concat(l_partkey, '-', l_suppkey)) as pairs, round(avg(l_quantity) + 1e-9, 4) as avg_qty,
      round(stddev_samp(l_quantity) + 1e-9, 4) as sd_qty, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by 1, 2""",
)
def q_conditional_agg(spark, sf):
    out = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_linenumber"))).alias("null_if_none"),
        F.sum(S.flag(F.col("l_discount") > 0.5)).alias("zero_if_none"),
        F.sum(F.when(F.col("l_discount") > 0.5, 1)).alias("null_when_none"),
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct(F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))).alias("pairs"),
        F.avg("l_quantity").alias("avg_qty"),
        F.stddev_samp("l_quantity").alias("sd_qty"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return rounded(out)


@query("agg_exact_quantile", "select l_returnflag, round(quantile_cont(l_extendedprice, 0.9) + 1e-9, 4) as p90 from lineitem group by 1")
def q_quantile(spark, sf):
    return rounded(W.exact_quantile(table(spark, sf, "lineitem"), "l_extendedprice", 0.9, ["l_returnflag"], "p90"))


@query("agg_global_median", "select round(median(o_totalprice) + 1e-9, 4) as median_price from orders")
def q_median(spark, sf):
    return rounded(W.exact_quantile(table(spark, sf, "orders"), "o_totalprice", 0.5, name="median_price"))


@query(
    "agg_argmax_per_group",
    """select o_custkey, last_priority, last_price, first_status from (select o_custkey, max_by(o_orderpriority, row(o_orderdate, o_orderkey)) as last_priority,
      max_by(o_totalprice, row(o_orderdate, o_orderkey)) as last_price, min_by(o_orderstatus, row(o_orderdate, o_orderkey)) as first_status from orders group by 1)""",
)
def q_first_last(spark, sf):
    first, last = W.first_last(["o_orderdate", "o_orderkey"], {"first_status": "o_orderstatus"}, {"last_priority": "o_orderpriority", "last_price": "o_totalprice"})
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(first, last)
    return g.select("o_custkey", "_last.*", "_first.*")


@query("agg_two_stage_argmax", "select s, f from (select l_suppkey as s, l_returnflag as f, row_number() over (partition by l_suppkey order by count(*) desc, l_returnflag) as rn from lineitem group by 1, 2) where rn = 1")
def q_two_stage(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return W.top_n(n, ["s"], [F.desc("n"), F.asc("f")], 1).select("s", "f")


@query("agg_having", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def q_having(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# ---- windows ------------------------------------------------------------------------------------


@query(
    "window_latest_per_key",
    "select * from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1",
)
def q_latest(spark, sf):
    return W.dedup_latest(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).withColumn("rn", F.lit(1))


@query("window_top_three", "select * from (select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as int) as place from orders) where place <= 3")
def q_top_three(spark, sf):
    return W.top_n(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "place").drop("o_totalprice")


@query(
    "window_latest_with_ties",
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber from (select *, rank() over (partition by l_suppkey order by l_shipdate desc) as rk from lineitem) where rk = 1",
)
def q_ties(spark, sf):
    return W.latest_with_ties(table(spark, sf, "lineitem"), ["l_suppkey"], [F.desc("l_shipdate")]).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "window_running_totals",
    """select o_orderkey, count(*) over w as orders_to_date, round(sum(o_totalprice) over w + 1e-9, 4) as spent_to_date, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) over w as bigint) as filled_to_date,
      max(o_totalprice) over w as highest_to_date from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)""",
)
def q_running(spark, sf):
    o = table(spark, sf, "orders")
    measures = {
        "orders_to_date": ("customer", "sum", F.lit(1).cast("long")),
        "spent_to_date": ("customer", "sum", F.col("o_totalprice")),
        "filled_to_date": ("customer", "sum", S.flag(F.col("o_orderstatus") == "F")),
        "highest_to_date": ("customer", "max", F.col("o_totalprice")),
    }
    out = W.running(o, {"customer": ["o_custkey"]}, ["o_orderdate", "o_orderkey"], measures, chunk=F.trunc("o_orderdate", "YEAR"))
    return rounded(out.select("o_orderkey", *measures))


@query(
    "window_running_global",
    "select event_id, count(*) over (order by ts, event_id rows unbounded preceding) as position, round(sum(value) over (order by ts, event_id rows unbounded preceding) + 1e-9, 4) as total from events",
)
def q_running_global(spark, sf):
    """A running total without any key: only the chunks spread it."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    out = W.running_sum(e, [], ["ts", "event_id"], {"position": F.lit(1).cast("long"), "total": "value"}, chunk=F.to_date("ts"))
    return rounded(out.select("event_id", "position", "total"))


@query(
    "window_sessions",
    """select event_id, cast(sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as session_id from events""",
)
def q_sessions(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    out = W.session_counter(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", "session_id", chunk=F.to_date("ts"))
    return out.select("event_id", "session_id")


@query(
    "window_change_detection",
    """select event_id, lag(event_type) over w as previous_type, lead(ts) over w as next_ts from events window w as (partition by user_id order by ts, event_id)""",
)
def q_changes(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    day = F.to_date("ts")
    back = W.neighbor(e, ["user_id"], ["ts", "event_id"], {"previous_type": "event_type"}, chunk=day)
    return W.neighbor(back, ["user_id"], ["ts", "event_id"], {"next_ts": "ts"}, lead=True, chunk=day).select("event_id", "previous_type", "next_ts")


@query(
    "window_share_of_total",
    """select s, f, n, round(cast(n as double) / sum(n) over (partition by s), 3) as share from (select l_suppkey as s, l_returnflag as f, count(*) as n from lineitem group by 1, 2)""",
)
def q_share(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return W.share_of_total(n, ["s"], "n", "share")


@query(
    "window_moving_stats",
    """with d as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2)
    select event_type, day, n, lag(n, 7) over w as week_before, round(avg(n) over (partition by event_type order by day rows between 7 preceding and 1 preceding) + 1e-9, 4) as n_moving_avg,
      round(stddev_samp(n) over (partition by event_type order by day rows between 7 preceding and 1 preceding) + 1e-9, 4) as n_moving_stddev from d window w as (partition by event_type order by day)""",
)
def q_moving(spark, sf):
    d = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    d = W.lag_periods(d, ["event_type"], ["day"], "n", 7, "week_before")
    return rounded(W.moving_stats(d, ["event_type"], ["day"], "n", 7))


@query("window_z_score", "select o_orderkey, round((o_totalprice - avg(o_totalprice) over ()) / stddev_samp(o_totalprice) over () + 1e-9, 4) as z from orders")
def q_z(spark, sf):
    return rounded(W.z_score(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "z").select("o_orderkey", "z"))


# ---- sorts and samples --------------------------------------------------------------------------


@query("sort_top_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def q_top(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("sort_by_rank", "select o_orderpriority, case o_orderpriority when '3-MEDIUM' then 1 when '1-URGENT' then 2 else 3 end as place, count(*) as n from orders group by 1, 2")
def q_case_rank(spark, sf):
    from ..plans.runs import layer_rank

    o = table(spark, sf, "orders").withColumn("place", layer_rank("o_orderpriority", ["3-MEDIUM", "1-URGENT"]))
    return o.groupBy("o_orderpriority", "place").agg(F.count(F.lit(1)).alias("n")).orderBy("place", "o_orderpriority")


# ---- reshaping ----------------------------------------------------------------------------------


@query(
    "reshape_pivot",
    """select l_suppkey, cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as "n_A_x", cast(sum(case when l_returnflag = 'N' then 1 else 0 end) as bigint) as "n_N_x",
      cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as "n_R_x" from lineitem group by 1""",
)
def q_pivot(spark, sf):
    return R.pivot(table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", ["A", "N", "R"], prefix="n_", suffix="_x")


@query(
    "reshape_pivot_threshold",
    """select l_returnflag, cast(sum(case when l_linenumber >= 2 then l_quantity else 0 end) as double) as from_2, cast(sum(case when l_linenumber >= 5 then l_quantity else 0 end) as double) as from_5 from lineitem group by 1""",
)
def q_pivot_cmp(spark, sf):
    return R.pivot(table(spark, sf, "lineitem"), ["l_returnflag"], "l_linenumber", [2, 5], cmp=">=", then_value="l_quantity", else_value=0.0, prefix="from_")


@query(
    "reshape_pivot_values",
    """select event_type, count(*) as n from events group by 1""",
)
def q_column_values(spark, sf):
    """Value list of a column as pivot columns, turned back into rows."""
    e = table(spark, sf, "events")
    values = R.column_values(e, "event_type")
    wide = R.pivot(e, [], "event_type", values)
    return R.unpivot(wide, "bigint", field_name="event_type", value_name="n")


@query(
    "reshape_unpivot",
    """select c_custkey, field, val from (select c_custkey, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment, cast(c_custkey % 2 = 0 as varchar) as is_even from customer)
      unpivot include nulls (val for field in (c_nationkey, c_mktsegment, is_even))""",
)
def q_unpivot(spark, sf):
    c = table(spark, sf, "customer").withColumn("is_even", F.col("c_custkey") % 2 == 0)
    return R.unpivot(c, exclude=["c_custkey"], remove=["c_name", "c_acctbal"], field_name="field", value_name="val")


@query(
    "reshape_sides_to_rows",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, 1 as is_part, l_partkey as me, l_suppkey as other from lineitem
      union all select l_orderkey, l_partkey, l_suppkey, l_linenumber, 0, l_suppkey, l_partkey from lineitem""",
)
def q_sides(spark, sf):
    sides = [
        {"is_part": F.lit(1), "me": "l_partkey", "other": "l_suppkey"},
        {"is_part": F.lit(0), "me": "l_suppkey", "other": "l_partkey"},
    ]
    return R.stacked_rows(table(spark, sf, "lineitem"), sides, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@query(
    "reshape_union_relations",
    """select 'customer' as origin, c_custkey as id, c_name as name, cast(c_nationkey as int) as nation, c_mktsegment as segment, null::bigint as size from customer where c_custkey > 0
      union all select 'supplier', s_suppkey, s_name, s_nationkey, null, null from supplier where s_suppkey > 0 union all select 'part', p_partkey, p_name, null, null, cast(p_size as bigint) from part where p_partkey > 0""",
)
def q_union(spark, sf):
    c = R.renamed(table(spark, sf, "customer"), {"id": "c_custkey", "name": "c_name", "nation": "c_nationkey", "segment": "c_mktsegment"})
    s = R.renamed(table(spark, sf, "supplier"), {"id": "s_suppkey", "name": "s_name", "nation": "s_nationkey", "balance": "s_acctbal"})
    p = R.renamed(table(spark, sf, "part"), {"id": "p_partkey", "name": "p_name", "size": "p_size"})
    return R.union_relations({"customer": c, "supplier": s, "part": p}, exclude=["balance"], column_override={"size": "bigint"}, source_column="origin", where="id > 0")


@query(
    "reshape_prioritized_union",
    """select k, v from (select *, row_number() over (partition by k order by pr) as rn from (select c_nationkey as k, 'customer' as v, 1 as pr from customer union all select s_nationkey + 10, 'supplier', 2 from supplier union all select n_nationkey, 'nation', 3 from nation)) where rn = 1""",
)
def q_priority(spark, sf):
    src = lambda t, k, v, add=0: table(spark, sf, t).select((F.col(k) + add).alias("k"), F.lit(v).alias("v"))
    every = R.by_priority([src("customer", "c_nationkey", "customer"), src("supplier", "s_nationkey", "supplier", 10), src("nation", "n_nationkey", "nation")])
    return R.deduplicate(every, ["k"], [F.asc("source_priority")]).drop("source_priority")


@query("reshape_id_union", "select c_custkey as id from customer union select o_custkey from orders union select s_suppkey from supplier")
def q_id_union(spark, sf):
    ids = [("customer", "c_custkey"), ("orders", "o_custkey"), ("supplier", "s_suppkey")]
    return R.id_union([table(spark, sf, t).select(F.col(k).alias("id")) for t, k in ids])


@query(
    "reshape_symmetric_difference",
    """(select 'a' as which_side, c_nationkey as k, c_mktsegment as m from (select c_nationkey, c_mktsegment from customer except select s_nationkey, 'BUILDING' from supplier))
      union all (select 'b', s_nationkey, m from (select s_nationkey, 'BUILDING' as m from supplier except select c_nationkey, c_mktsegment from customer))""",
)
def q_symmetric(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("m"))
    b = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("BUILDING").alias("m"))
    return R.symmetric_difference(a, b)


# ---- incremental --------------------------------------------------------------------------------

_CUT = "2000-06-01"


def _old_and_new(spark, sf):
    o = table(spark, sf, "orders").withColumn("load_id", F.date_format("o_orderdate", "yyyyMM"))
    cut = F.lit(_CUT).cast("timestamp_ntz")
    old = o.where(F.col("o_orderdate") < cut)
    # The second load brings the newer orders and repeats the urgent ones with a new price.
    again = old.where("o_orderpriority = '1-URGENT'").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "load_id": F.lit("200112")})
    return old, o.where(F.col("o_orderdate") >= cut).unionByName(again)


@query(
    "incremental_merge_upsert",
    f"""select o_orderkey, o_custkey, case when o_orderdate < timestamp '{_CUT}' and o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
      case when o_orderdate < timestamp '{_CUT}' and o_orderpriority = '1-URGENT' then '200112' else strftime(o_orderdate, '%Y%m') end as load_id from orders""",
)
def q_merge(spark, sf):
    old, new = _old_and_new(spark, sf)
    return T.merge_upsert(old, new, ["o_orderkey"], [F.desc("load_id")]).select("o_orderkey", "o_custkey", "o_totalprice", "load_id")


@query("incremental_insert_missing", f"select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '{_CUT}'")
def q_insert_missing(spark, sf):
    old, new = _old_and_new(spark, sf)
    return T.insert_missing(old, new, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "incremental_touched_groups",
    f"""with n as (select o_custkey from orders where o_orderdate >= timestamp '{_CUT}' union select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderdate < timestamp '{_CUT}'),
    m as (select o_custkey, case when o_orderdate < timestamp '{_CUT}' and o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as p from orders)
    select o_custkey, count(*) as orders, round(sum(p) + 1e-9, 4) as spent from m group by 1""",
)
def q_touched(spark, sf):
    """Only customers touched by the new load are re-aggregated; the result is that of a full rebuild."""
    old, new = _old_and_new(spark, sf)

    def totals(df):
        return df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("spent"), F.max("load_id").alias("load_id"))

    merged = T.merge_upsert(old, new, ["o_orderkey"], [F.desc("load_id")])
    mark = T.high_water(old, "load_id")
    touched = I.touched_groups(merged, ["o_custkey"], mark)
    refreshed = totals(merged.join(touched, "o_custkey", "left_semi"))
    return rounded(T.merge_upsert(totals(old), refreshed, ["o_custkey"]).drop("load_id"))


_LOWERED = f"case when o_orderdate < timestamp '{_CUT}' and o_orderpriority = '1-URGENT' then o_totalprice / 8 else o_totalprice end"


@query(
    "incremental_replaced_groups",
    f"select o_custkey, o_orderpriority, count(*) as orders, round(sum({_LOWERED}) + 1e-9, 4) as spent from orders group by 1, 2 having sum({_LOWERED}) > 150000",
)
def q_replaced_groups(spark, sf):
    """Groups rebuilt in place: rows that no longer reach the mark after the second load go, as in a full rebuild."""
    old, new = _old_and_new(spark, sf)
    older = F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")
    again = new.withColumn("o_totalprice", F.when(older, (F.col("o_totalprice") - 1) / 8).otherwise(F.col("o_totalprice")))

    def totals(df):
        sums = df.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("spent"))
        return sums.where("spent > 150000")

    merged = T.merge_upsert(old, again, ["o_orderkey"], [F.desc("load_id")])
    touched = again.select("o_custkey").distinct()
    rebuilt = totals(T.in_groups(merged, touched, ["o_custkey"]))
    return rounded(T.replace_groups(totals(old), touched, rebuilt, {"o_custkey": F.col("o_custkey")}))


@query(
    "incremental_moved_keys",
    f"select o_orderkey, cast(case when o_orderdate < timestamp '{_CUT}' and o_orderpriority = '1-URGENT' then 2001 else year(o_orderdate) end as int) as part from orders",
)
def q_moved_keys(spark, sf):
    """A key that an update moves to another partition is there once."""
    old, new = _old_and_new(spark, sf)
    part = F.year("o_orderdate").cast("int")
    moved = new.withColumn("part", F.when(F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz"), 2001).otherwise(part))
    return T.merge_upsert(old.withColumn("part", part), moved, ["o_orderkey"], [F.desc("load_id")]).select("o_orderkey", "part")


@query("incremental_drop_orphans", "select l_orderkey, count(*) as n from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1")
def q_orphans(spark, sf):
    parent = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return I.drop_orphans(table(spark, sf, "lineitem"), parent, "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("incremental_freshness_gate", "select max(o_orderdate) as latest_source, (select max(l_shipdate) from lineitem) as latest_target, max(o_orderdate) > (select max(l_shipdate) from lineitem) as refresh_needed from orders")
def q_gate(spark, sf):
    return I.refresh_needed(table(spark, sf, "orders"), "o_orderdate", table(spark, sf, "lineitem"), "l_shipdate")


# ---- datasets changed partition by partition ------------------------------------------------------

_MONTH = "strftime({}, '%Y%m')"
_RELOADED = "o_orderdate >= timestamp '1998-03-05' and o_orderdate < timestamp '1998-03-29'"
_MOVED = f"{_RELOADED} and o_orderpriority = '1-URGENT'"


@query(
    "incremental_changed_partitions",
    f"""select o_orderkey, case when {_MOVED} then '199712' else {_MONTH.format('o_orderdate')} end as month,
      case when {_RELOADED} then o_totalprice + 1 else o_totalprice end as o_totalprice,
      {_MONTH.format('o_orderdate')} = '199803' or {_MONTH.format('o_orderdate')} = '199712' as rewritten from orders""",
)
def q_changed_partitions(spark, sf):
    """About 1 % of the keys change, some of them their partition: two of all partitions are written anew."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("month"))
    path = P.work_folder(spark, "orders-by-month")
    P.write(orders, path, "month")
    name = F.col("_metadata.file_name").alias("file")
    before = P.written(P.read(spark, path, orders.schema).select(name).distinct(), "files-before")
    again = orders.where((F.col("o_orderdate") >= F.lit("1998-03-05").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-03-29").cast("timestamp_ntz")))
    moved = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("199712")).otherwise(F.col("month"))
    changed = again.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "month": moved})
    after = P.merge(path, changed, ["o_orderkey"], "month").select("o_orderkey", "month", "o_totalprice", name)
    old = before.withColumnRenamed("file", "_file").withColumn("old", F.lit(True))
    return after.join(old, F.col("file") == F.col("_file"), "left").select("o_orderkey", "month", "o_totalprice", F.col("old").isNull().alias("rewritten"))


@query(
    "incremental_late_loads",
    f"select o_orderkey, o_totalprice, {_MONTH.format('o_orderdate')} as load_id, {_MONTH.format('o_orderdate')} in ('199509', '199610', '200107', '200108') as was_late from orders",
)
def q_late_loads(spark, sf):
    """Loads that come late have smaller ids than the newest one seen; a ledger of loads finds them, a largest id would not."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("load_id"))
    late = F.col("load_id").isin("199509", "199610", "200107", "200108")
    seen = orders.where(~late).withColumn("was_late", F.lit(False))
    path = P.work_folder(spark, "orders-by-load")
    P.write(seen, path, "load_id")
    ledger = P.written(L.loads_of("orders", seen), "ledger")
    new = L.unseen("orders", orders, ledger).withColumn("was_late", F.lit(True))
    return P.merge(path, new, ["o_orderkey"], "load_id")


_EVENT_VALUE = "case when event_type = 'purchase' and extract('hour' from ts) < 12 then value + 1 else value end"
_EVENT_USER = "case when event_type = 'error' then user_id + 1 else user_id end"


def _event_slices(spark, sf):
    """Events as landed files in no order of time: a first delivery, and a second one that corrects or moves some of them."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    first = events.withColumn("delivery", F.lit(1))
    morning = (F.col("event_type") == "purchase") & (F.hour("ts") < 12)
    fixed = {"value": F.when(morning, F.col("value") + 1).otherwise(F.col("value")).cast("decimal(12,2)"), "user_id": F.when(F.col("event_type") == "error", F.col("user_id") + 1).otherwise(F.col("user_id"))}
    second = events.where(morning | (F.col("event_type") == "error")).withColumns(fixed).withColumn("delivery", F.lit(2))
    return first.unionByName(second)


def _user_months(rows):
    sums = [F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"), F.max("ts").alias("last_ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")]
    return rows.groupBy("user_id", "bucket").agg(*sums)


@query(
    "incremental_stream_groups",
    f"""with e as (select {_EVENT_USER} as user_id, event_id, ts, event_type, cast({_EVENT_VALUE} as decimal(12,2)) as value from events)
    select user_id, count(*) as events, round(cast(sum(value) as double), 4) as total, max(ts) as last_ts, arg_max(event_type, (ts, event_id)) as last_type from e group by user_id""",
)
def q_stream_groups(spark, sf):
    """Users rebuilt as files land out of order, micro-batch by micro-batch, and once more in a repeat of everything."""
    landing, base = P.work_folder(spark, "events-landed"), P.work_folder(spark, "events-by-user")
    slices = _event_slices(spark, sf)
    slices.repartition(6, F.xxhash64("event_id", "delivery") % 6).write.parquet(landing)
    schema = slices.schema

    def prepare(rows):
        return rows.withColumn("bucket", F.pmod("user_id", F.lit(16)).cast("int"))

    how = {"keys": ["event_id"], "group": ["user_id"], "by": "bucket", "newest": [F.desc("delivery")]}
    stream = G.stream_group_refresh(spark, landing, schema, prepare, f"{base}/history", f"{base}/users", _user_months, checkpoint=base, files_per_batch=2, file_format="parquet", **how)
    stream.awaitTermination()
    again = prepare(spark.read.schema(schema).parquet(landing).where("delivery = 1"))
    users = G.refresh_groups_by_partition(f"{base}/history", f"{base}/users", again, _user_months, **how)
    return rounded(users.select("user_id", "events", F.col("total").cast("double").alias("total"), "last_ts", "last_type"))


@query(
    "incremental_stored_totals",
    f"""with e as (select {_EVENT_USER} as user_id, event_type, cast({_EVENT_VALUE} as decimal(12,2)) as value from events)
    select user_id, count(*) as n_rows, round(cast(sum(value) as double), 4) as total, cast(count(*) filter (event_type = 'purchase') as bigint) as purchases from e group by user_id""",
)
def q_stored_totals(spark, sf):
    """Totals kept between loads: a second load corrects rows and moves some to another user, and comes twice."""
    base = P.work_folder(spark, "totals-by-user")
    rows = _event_slices(spark, sf).withColumn("bucket", F.pmod("user_id", F.lit(16)).cast("int"))
    measures = {"total": F.col("value"), "purchases": (F.col("event_type") == "purchase").cast("long")}
    for delivery in (1, 2, 2):
        out = G.update_totals(f"{base}/history", f"{base}/totals", rows.where(F.col("delivery") == delivery), ["event_id"], ["user_id"], measures, "bucket", [F.desc("delivery")])
    return rounded(out.select("user_id", "n_rows", F.col("total").cast("double").alias("total"), "purchases"))
