"""Calendars spanning the dates found in the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalar as S
from ..operators import calendars as C
from ..operators import reshape as R
from .registry import query, table


def _bounds(spark, sf, part: str = "day"):
    """First order day and the day after the last one."""
    o = table(spark, sf, "orders")
    return o.agg(F.date_trunc(part, F.min("o_orderdate")).cast("timestamp_ntz").alias("a"), (F.date_trunc("day", F.max("o_orderdate")) + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("b"))


def order_days(spark, sf):
    return R.bounds_spine(_bounds(spark, sf), "day", "a", "b", "date_day")


_DAYS = """b as (select date_trunc('day', min(o_orderdate)) as a, date_trunc('day', max(o_orderdate)) + interval 1 day as z from orders),
days as (select cast(t.d as date) as d from b, unnest(generate_series(a, z - interval 1 microsecond, interval 1 day)) as t(d))"""


@query("date_spine_days", f"with {_DAYS}, n as (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1) select days.d as date_day, coalesce(n, 0) as orders from days left join n using (d)")
def q_spine(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count(F.lit(1)).alias("orders"))
    days = order_days(spark, sf).select(F.col("date_day").cast("date").alias("date_day"))
    return days.join(n, "date_day", "left").na.fill(0, ["orders"])


@query(
    "date_spine_per_key",
    """with b as (select user_id, date_trunc('hour', min(ts)) as a, date_trunc('hour', max(ts)) as z from events group by 1)
    select user_id, count(*) as hours, min(t.h) as first_hour, max(t.h) as last_hour from b, unnest(generate_series(a, z - interval 1 microsecond, interval 1 hour)) as t(h) where a < z group by 1""",
)
def q_spine_per_key(spark, sf):
    b = table(spark, sf, "events").groupBy("user_id").agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("a"), F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("b"))
    hours = R.bounds_spine(b, "hour", "a", "b", "h", keep=["user_id"])
    return hours.groupBy("user_id").agg(F.count(F.lit(1)).alias("hours"), F.min("h").alias("first_hour"), F.max("h").alias("last_hour"))


_WEEK = "cast({0} - cast(dayofweek({0}) as int) as date)"
_ISO = "cast(date_trunc('week', {0}) as date)"
_PART_SQL = f"""with {_DAYS}, x as (select d as date_day, cast(d - interval 1 year as date) as py, cast(d - 364 as date) as pyy from days)
select date_day, cast(date_day - 1 as date) as prior_date_day, cast(date_day + 1 as date) as next_date_day, py as prior_year_date_day, pyy as prior_year_over_year_date_day,
  cast(dayofweek(date_day) + 1 as int) as day_of_week, cast(isodow(date_day) as int) as day_of_week_iso, dayname(date_day) as day_of_week_name, left(dayname(date_day), 3) as day_of_week_name_short,
  cast(day(date_day) as int) as day_of_month, cast(dayofyear(date_day) as int) as day_of_year, {_WEEK.format('date_day')} as week_start_date, cast({_WEEK.format('date_day')} + 6 as date) as week_end_date,
  {_WEEK.format('pyy')} as prior_year_week_start_date, cast({_WEEK.format('pyy')} + 6 as date) as prior_year_week_end_date, cast(ceil(dayofyear(date_day) / 7) as int) as week_of_year,
  {_ISO.format('date_day')} as iso_week_start_date, cast({_ISO.format('date_day')} + 6 as date) as iso_week_end_date, {_ISO.format('pyy')} as prior_year_iso_week_start_date,
  cast({_ISO.format('pyy')} + 6 as date) as prior_year_iso_week_end_date, cast(weekofyear(date_day) as int) as iso_week_of_year, cast(ceil(dayofyear(pyy) / 7) as int) as prior_year_week_of_year,
  cast(weekofyear(pyy) as int) as prior_year_iso_week_of_year, cast(month(date_day) as int) as month_of_year, monthname(date_day) as month_name, left(monthname(date_day), 3) as month_name_short,
  cast(date_trunc('month', date_day) as date) as month_start_date, last_day(date_day) as month_end_date, cast(date_trunc('month', py) as date) as prior_year_month_start_date,
  last_day(py) as prior_year_month_end_date, cast(quarter(date_day) as int) as quarter_of_year, cast(date_trunc('quarter', date_day) as date) as quarter_start_date,
  cast(date_trunc('quarter', date_day) + interval 3 month - interval 1 day as date) as quarter_end_date, cast(year(date_day) as int) as year_number,
  cast(date_trunc('year', date_day) as date) as year_start_date, cast(date_trunc('year', date_day) + interval 1 year - interval 1 day as date) as year_end_date from x"""


@query("calendar_dimension", _PART_SQL)
def q_calendar(spark, sf):
    return C.date_dimension(order_days(spark, sf))


_CAL = f"""{_DAYS}, cal as (select d as date_day, cast(dayofweek(d) + 1 as int) as dow, cast(month(d) as int) as m, cast(year(d) as int) as y, last_day(d) as month_end from days),
ye as (select distinct y - 1 as fy, month_end from cal where m = 1), wk as (select y, m, date_day as ws, cast(date_day + 6 as date) as we from cal where dow = 1),
yw as (select distinct y - 1 as fy, we from wk where m = 1), cl as (select yw.fy, we, rank() over (partition by yw.fy order by abs(date_diff('day', we, month_end))) as rk from yw join ye on yw.fy = ye.fy),
fr as (select fy, cast(lag(we) over (order by we) + 1 as date) as fs, we as fe from cl where rk = 1),
fd as (select date_day, fy, fs, fe, ws, we, cast(dense_rank() over (partition by fy order by ws) as int) as fw from cal join fr on date_day between fs and fe join wk on date_day between ws and we)"""


@query(
    "fiscal_year_dates",
    f"with {_CAL} select date_day, fy as fiscal_year_number, fs as fiscal_year_start_date, fe as fiscal_year_end_date, ws as week_start_date, we as week_end_date, fw as fiscal_week_of_year from fd",
)
def q_fiscal_years(spark, sf):
    return C.fiscal_year_dates(C.date_dimension(order_days(spark, sf)), year_end_month=1, week_start_day=1)


@query(
    "fiscal_periods",
    f"""with {_CAL}, q as (select *, cast(least(floor((fw - 1) / 13), 3) as int) as qn, case when fw = 53 then 3 when (fw - 1) % 13 <= 3 then 1 when (fw - 1) % 13 <= 8 then 2 else 3 end as pq from fd),
    p as (select *, cast(qn * 3 + pq as int) as fp from q)
    select date_day, fy as fiscal_year_number, ws as week_start_date, we as week_end_date, fw as fiscal_week_of_year, cast(dense_rank() over (partition by fp order by fw) as int) as fiscal_week_of_period,
      fp as fiscal_period_number, qn + 1 as fiscal_quarter_number, pq as fiscal_period_of_quarter from p""",
)
def q_fiscal_periods(spark, sf):
    return C.fiscal_periods(C.date_dimension(order_days(spark, sf)), year_end_month=1, week_start_day=1)


@query(
    "date_offsets",
    """with d as (select distinct cast(o_orderdate as date) as d from orders)
    select d, cast(d - 3 as date) as three_days_ago, cast(d + 3 as date) as three_days_away, cast(date_trunc('week', d - 14) as date) as two_weeks_ago, cast(date_trunc('week', d + 7) as date) as next_week,
      cast(date_trunc('month', d - interval 2 month) as date) as two_months_ago, cast(date_trunc('month', d + interval 1 month) as date) as next_month,
      cast(month(d - interval 1 month) as int) as last_month_number, left(monthname(d + interval 1 month), 3) as next_month_name,
      cast(strftime(d, '%Y%m%d') as int) as date_key, cast((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 as int) as us_week from d""",
)
def q_offsets(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.select(
        "d",
        D.n_days_ago(3, "d").alias("three_days_ago"),
        D.n_days_away(3, "d").alias("three_days_away"),
        D.n_weeks_ago(2, "d").alias("two_weeks_ago"),
        D.next_week("d").alias("next_week"),
        D.n_months_ago(2, "d").alias("two_months_ago"),
        D.next_month("d").alias("next_month"),
        D.last_month_number("d").alias("last_month_number"),
        D.next_month_name("d").alias("next_month_name"),
        D.date_key("d").alias("date_key"),
        D.us_week_of_year("d").alias("us_week"),
    )


@query(
    "numbered_series",
    "select l_suppkey, cast(g as bigint) as n from (select l_suppkey, count(*) as c from lineitem group by 1), unnest(generate_series(1, c)) as t(g)",
)
def q_series(spark, sf):
    """A number series joined to group sizes: every supplier's 1..count."""
    c = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("c"))
    return c.select("l_suppkey", F.explode(F.sequence(F.lit(1).cast("bigint"), "c")).alias("n"))


@query(
    "date_spine_minutes",
    """with b as (select min(o_orderdate) as a, max(o_orderdate) as z from orders), m as (select t.m as at from b, unnest(generate_series(a, z - interval 1 microsecond, interval 1 minute)) as t(m)),
    n as (select o_orderdate as at, count(*) as n from orders group by 1)
    select cast(date_trunc('month', m.at) as date) as month, count(*) as minutes, cast(coalesce(sum(n), 0) as bigint) as orders, max(m.at) as last_minute from m left join n on n.at = m.at group by 1""",
)
def q_spine_minutes(spark, sf):
    """Every minute between the first and the last order, dealt over tasks in blocks."""
    o = table(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    minutes = R.bounds_spine(bounds, "minute", "a", "z", "at", tasks=64)
    counts = o.groupBy(F.col("o_orderdate").alias("_at")).agg(F.count(F.lit(1)).alias("n"))
    joined = minutes.join(counts, F.col("at") == F.col("_at"), "left")
    return joined.groupBy(F.trunc("at", "month").alias("month")).agg(F.count(F.lit(1)).alias("minutes"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"), F.max("at").alias("last_minute"))


@query("series_of_numbers", "select cast(g as bigint) as quantity, count(l_orderkey) as lines from unnest(generate_series(1, 60)) as t(g) left join lineitem on l_quantity = g group by 1")
def q_series(spark, sf):
    """Every quantity from 1 to 60, those without lines too."""
    numbers = R.generate_series(spark, 60, "quantity")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("q")).agg(F.count_if(F.col("l_quantity") == F.col("l_quantity").cast("long")).alias("lines"))
    return numbers.join(lines, F.col("quantity") == F.col("q"), "left").select("quantity", F.coalesce("lines", F.lit(0)).alias("lines"))


@query(
    "date_spine_literal_bounds",
    """select cast(date_trunc('month', d) as date) as month, count(*) as days, cast(coalesce(sum(n), 0) as bigint) as orders from unnest(generate_series(timestamp '1994-12-31', timestamp '2001-09-14', interval 1 day)) as t(d)
    left join (select cast(o_orderdate as date) as o, count(*) as n from orders group by 1) on o = cast(d as date) group by 1""",
)
def q_spine_literal(spark, sf):
    days = R.date_spine(spark, "day", "1994-12-31", "2001-09-15")
    orders = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(orders, F.col("date_day") == F.col("o"), "left").groupBy(F.trunc("date_day", "month").alias("month")).agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


_ZONES = {"new_york": "America/New_York", "london": "Europe/London", "sydney": "Australia/Sydney"}
_AT = "o_orderdate + to_minutes(cast(o_orderkey % 1440 as int))"


def _utc(local: str, zone: str) -> str:
    """UTC of a clock time that counts as its first one."""
    late = f"(({local} at time zone '{zone}') at time zone 'UTC')"
    return f"case when (({late} - interval 1 hour) at time zone 'UTC') at time zone '{zone}' = {local} then {late} - interval 1 hour else {late} end"


@query(
    "date_time_zones",
    f"""with t as (select o_orderkey, {_AT} as clock from orders)
    select o_orderkey, clock, {", ".join(f"(clock at time zone 'UTC') at time zone '{z}' as {n}" for n, z in _ZONES.items())},
      {", ".join(f"{_utc('clock', z)} as from_{n}" for n, z in _ZONES.items())}, (clock at time zone 'America/New_York') at time zone 'UTC' as from_new_york_second,
      cast(hour((clock at time zone 'UTC') at time zone 'Australia/Sydney') as int) as sydney_hour, cast(dayofyear((clock at time zone 'UTC') at time zone 'Australia/Sydney') as int) as sydney_day
    from t""",
)
def q_time_zones(spark, sf):
    """Every order at a minute of its day, in three zones and from three zones, over some years of clock changes."""
    at = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    t = table(spark, sf, "orders").select("o_orderkey", at.alias("clock"))
    to = {n: D.convert_timezone("clock", z) for n, z in _ZONES.items()}
    back = {f"from_{n}": D.convert_timezone("clock", "UTC", z) for n, z in _ZONES.items()}
    out = t.withColumns(to | back | {"from_new_york_second": D.convert_timezone("clock", "UTC", "America/New_York", "second")})
    return out.withColumns({"sydney_hour": D.date_part("hour", "sydney"), "sydney_day": D.date_part("doy", "sydney")})


@query(
    "date_clock_changes",
    f"""with h as (select l_suppkey, timestamp '2000-04-01 20:00:00' + to_minutes(cast(l_orderkey % 1000 as int)) as spring, timestamp '2000-10-28 20:00:00' + to_minutes(cast(l_orderkey % 1000 as int)) as autumn from lineitem)
    select date_trunc('hour', spring) as spring_hour, count(*) as n, min({_utc('spring', 'America/New_York')}) as first_utc, max({_utc('spring', 'America/New_York')}) as last_utc,
      min({_utc('autumn', 'America/New_York')}) as first_autumn, max((autumn at time zone 'America/New_York') at time zone 'UTC') as last_autumn from h group by 1""",
)
def q_clock_changes(spark, sf):
    """Minutes around both changes of a year: skipped ones move ahead, repeated ones are told by first and second."""
    shift = F.make_dt_interval(mins=(F.col("l_orderkey") % 1000).cast("int"))
    start = lambda x: F.lit(x).cast("timestamp_ntz") + shift
    h = table(spark, sf, "lineitem").select(start("2000-04-01 20:00:00").alias("spring"), start("2000-10-28 20:00:00").alias("autumn"))
    utc = lambda c, twice="first": D.convert_timezone(c, "UTC", "America/New_York", twice)
    return h.groupBy(F.date_trunc("hour", "spring").cast("timestamp_ntz").alias("spring_hour")).agg(
        F.count(F.lit(1)).alias("n"), F.min(utc("spring")).alias("first_utc"), F.max(utc("spring")).alias("last_utc"), F.min(utc("autumn")).alias("first_autumn"), F.max(utc("autumn", "second")).alias("last_autumn")
    )


@query(
    "scalar_clock_texts",
    """select o_orderkey, case when o_orderkey % 17 = 0 then null else lpad(cast((o_orderkey % 12 + 12 * (o_orderkey // 12 % 2)) as varchar), 2, '0') || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0') end as clock,
      case when o_orderkey % 5 > 0 then ltrim(printf('%.3f', (o_orderkey % 1000) / 1000.0::double), '0') end as rate, make_timestamp(o_orderkey * 86400 * 1000000) as at_seconds, make_timestamp(o_orderkey * 1000000000) as at_millis from orders""",
)
def q_clock_texts(spark, sf):
    """AM/PM clocks, rates without the leading zero and epoch counts."""
    hour = F.col("o_orderkey") % 12
    text = F.when(F.col("o_orderkey") % 17 == 0, F.lit("noon")).otherwise(F.concat(F.when(hour == 0, 12).otherwise(hour).cast("string"), F.lit(":"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")))
    ampm = F.when(F.floor(F.col("o_orderkey") / 12) % 2 == 0, " am").otherwise("PM")
    rate = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 1000 / 1000.0)
    return table(spark, sf, "orders").select(
        "o_orderkey", S.clock_to_24h(text, ampm).alias("clock"), S.rate_text(rate).alias("rate"),
        D.from_unixtimestamp(F.col("o_orderkey") * 86400, "seconds").cast("timestamp_ntz").alias("at_seconds"), D.from_unixtimestamp(F.col("o_orderkey") * 1000000, "milliseconds").cast("timestamp_ntz").alias("at_millis"),
    )
