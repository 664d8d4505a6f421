"""Calendar and fiscal date dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from .reshape import bounds_spine


def base_dates(
    spark: SparkSession,
    start: str | None = None,
    end: str | None = None,
    n_parts: int | None = None,
    part: str = "day",
    as_of: Column | None = None,
) -> DataFrame:
    """Timestamps ``date_<part>`` from start to end (excluded), or the last n parts up to today."""
    if start and end:
        a, b = F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))
    elif n_parts:
        today = F.current_date() if as_of is None else as_of
        a = D.add_part(part, -n_parts, today.cast("timestamp"))
        b = F.date_add(today, 1).cast("timestamp")
    else:
        raise ValueError("give start and end, or n_parts")
    bounds = spark.range(1).select(a.alias("a"), b.alias("b"))
    return bounds_spine(bounds, part, "a", "b", f"date_{part}")


def date_dimension(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of each day (one row per input day)."""
    d = F.col("date_day")
    prior_year, prior_364 = F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    base = days.select(F.col(day).cast("date").alias("date_day")).withColumns(
        {"prior_year_date_day": F.add_months(d, -12), "prior_year_over_year_date_day": F.date_sub(d, 364)}
    )

    def quarter_end(c: Column) -> Column:
        return F.date_sub(F.add_months(F.trunc(c, "QUARTER"), 3), 1)

    def year_end(c: Column) -> Column:
        return F.date_sub(F.add_months(F.trunc(c, "YEAR"), 12), 1)

    return base.select(
        "date_day",
        D.yesterday(d).alias("prior_date_day"),
        D.tomorrow(d).alias("next_date_day"),
        prior_year,
        prior_364,
        D.day_of_week(d).alias("day_of_week"),
        D.day_of_week(d, iso=True).alias("day_of_week_iso"),
        D.day_name(d, short=False).alias("day_of_week_name"),
        D.day_name(d).alias("day_of_week_name_short"),
        D.day_of_month(d).alias("day_of_month"),
        D.day_of_year(d).alias("day_of_year"),
        D.week_start(d).alias("week_start_date"),
        D.week_end(d).alias("week_end_date"),
        D.week_start(prior_364).alias("prior_year_week_start_date"),
        D.week_end(prior_364).alias("prior_year_week_end_date"),
        D.week_of_year(d).alias("week_of_year"),
        D.iso_week_start(d).alias("iso_week_start_date"),
        D.iso_week_end(d).alias("iso_week_end_date"),
        D.iso_week_start(prior_364).alias("prior_year_iso_week_start_date"),
        D.iso_week_end(prior_364).alias("prior_year_iso_week_end_date"),
        D.iso_week_of_year(d).alias("iso_week_of_year"),
        D.week_of_year(prior_364).alias("prior_year_week_of_year"),
        D.iso_week_of_year(prior_364).alias("prior_year_iso_week_of_year"),
        F.month(d).alias("month_of_year"),
        D.month_name(d, short=False).alias("month_name"),
        D.month_name(d).alias("month_name_short"),
        F.trunc(d, "MONTH").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(prior_year, "MONTH").alias("prior_year_month_start_date"),
        F.last_day(prior_year).alias("prior_year_month_end_date"),
        F.quarter(d).alias("quarter_of_year"),
        F.trunc(d, "QUARTER").alias("quarter_start_date"),
        quarter_end(d).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        F.trunc(d, "YEAR").alias("year_start_date"),
        year_end(d).alias("year_end_date"),
    )


def fiscal_year_dates(calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """Days of each fiscal year; the year ends on the week end nearest the month end.

    The calendar has one row per day, so every window here is bounded by the calendar.
    The first year has no start and gives no rows. Ranges become days and weeks are
    found from the day itself, so both lookups are equi-joins.
    """
    fiscal_year = F.col("year_number") - shift_year
    in_month = F.col("month_of_year") == year_end_month
    month_ends = calendar.where(in_month).select(fiscal_year.alias("fiscal_year_number"), "month_end_date").distinct()
    weeks = calendar.where(F.col("day_of_week") == week_start_day).select(
        "year_number", "month_of_year", F.col("date_day").alias("week_start_date"), F.date_add("date_day", 6).alias("week_end_date")
    )
    ends = weeks.where(in_month).select(fiscal_year.alias("fiscal_year_number"), "week_end_date").distinct()
    gap = F.abs(F.datediff("week_end_date", "month_end_date"))
    nearest = Window.partitionBy("fiscal_year_number").orderBy(gap)
    closest = ends.join(month_ends, "fiscal_year_number").withColumn("_rk", F.rank().over(nearest)).where("_rk = 1")
    by_end = Window.partitionBy(F.lit(0)).orderBy("week_end_date")  # one row per year
    years = closest.select(
        "fiscal_year_number",
        F.date_add(F.lag("week_end_date").over(by_end), 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    ).where(F.col("fiscal_year_start_date").isNotNull())
    year_days = years.select("*", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date")).alias("date_day"))
    week_days = weeks.select("week_start_date", "week_end_date", F.explode(F.sequence("week_start_date", "week_end_date")).alias("date_day"))
    week_no = F.dense_rank().over(Window.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return (
        calendar.select("date_day")
        .join(year_days, "date_day")
        .join(week_days, "date_day")
        .select(
            "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date",
            "week_start_date", "week_end_date", week_no.alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """4-5-4 periods and quarters; week 53 belongs to the last period of its quarter."""
    week = F.col("fiscal_week_of_year")
    in_quarter = (week - 1) % 13
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    period = F.when(week == 53, 3).when(in_quarter <= 3, 1).when(in_quarter <= 8, 2).otherwise(3)
    days = fiscal_year_dates(calendar, year_end_month, week_start_day, shift_year).withColumns(
        {
            "fiscal_period_number": (quarter * 3 + period).cast("int"),
            "fiscal_quarter_number": quarter + 1,
            "fiscal_period_of_quarter": period,
        }
    )
    # Numbered over the distinct (period, week) pairs: at most 53 rows.
    pairs = days.select("fiscal_period_number", "fiscal_week_of_year").distinct()
    rank = F.dense_rank().over(Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year"))
    numbered = pairs.withColumn("fiscal_week_of_period", rank)
    return days.join(numbered, ["fiscal_period_number", "fiscal_week_of_year"]).select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        "fiscal_week_of_period", "fiscal_period_number", "fiscal_quarter_number", "fiscal_period_of_quarter",
    )
