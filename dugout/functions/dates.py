"""Calendar expressions. Functions relative to "now" take ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ColumnLike, as_col


def _as_of(as_of: ColumnLike | None) -> Column:
    return F.current_date() if as_of is None else as_col(as_of).cast("date")


def now(tz: str = "UTC") -> Column:
    """Current local time in ``tz``."""
    return convert_timezone(F.localtimestamp(), tz, F.current_timezone())


def today(tz: str = "UTC") -> Column:
    """Current date in ``tz``."""
    return now(tz).cast("date")


def convert_timezone(c: ColumnLike, target: str, source: ColumnLike | str = "UTC", twice: str = "first") -> Column:
    """Wall-clock time moved from the source zone to the target zone.

    Where clocks of the source zone are put ahead, a time that is skipped means as much
    later as they were moved. Where they are put back, a time comes ``twice``: its "first"
    one counts, or its "second". The session's own zone has no part in it.
    """
    if twice not in ("first", "second"):
        raise ValueError("twice must be first or second")
    src = F.lit(source) if isinstance(source, str) else source
    local = as_col(c).cast("timestamp_ntz")
    if twice == "first":
        return F.convert_timezone(src, F.lit(target), local)
    utc = F.convert_timezone(src, F.lit("UTC"), local)
    # The same clock time again, an hour or (in few zones) half an hour later.
    for minutes in (30, 60):
        later = utc + F.expr(f"INTERVAL {minutes} MINUTES")
        utc = F.when(F.convert_timezone(F.lit("UTC"), src, later) == local, later).otherwise(utc)
    return F.convert_timezone(F.lit("UTC"), F.lit(target), utc)


def date_part(part: str, c: ColumnLike) -> Column:
    """Numeric field of a date or timestamp."""
    return F.date_part(F.lit(part), as_col(c))


def date_key(c: ColumnLike) -> Column:
    """yyyymmdd as int."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def day_of_week(c: ColumnLike, iso: bool = False) -> Column:
    """1 = Sunday ... 7 = Saturday, or 1 = Monday ... 7 = Sunday with ``iso``."""
    return (F.weekday(as_col(c)) + 1) if iso else F.dayofweek(as_col(c))


def day_of_month(c: ColumnLike) -> Column:
    return F.dayofmonth(as_col(c))


def day_of_year(c: ColumnLike) -> Column:
    return F.dayofyear(as_col(c))


def week_of_year(c: ColumnLike) -> Column:
    """Seven-day blocks counted from January 1."""
    return F.ceil(F.dayofyear(as_col(c)) / 7).cast("int")


def us_week_of_year(c: ColumnLike) -> Column:
    """Week number with weeks starting on Sunday and week 1 holding January 1."""
    d = as_col(c)
    offset = F.dayofweek(F.trunc(d, "YEAR")) - 2
    return (F.floor((F.dayofyear(d) + offset) / 7) + 1).cast("int")


def iso_week_of_year(c: ColumnLike) -> Column:
    return F.weekofyear(as_col(c))


def week_start(c: ColumnLike) -> Column:
    """Sunday on or before the date."""
    d = as_col(c).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(c: ColumnLike) -> Column:
    """Saturday on or after the date."""
    return F.date_add(week_start(c), 6)


def iso_week_start(c: ColumnLike) -> Column:
    """Monday on or before the date."""
    return F.trunc(as_col(c).cast("date"), "WEEK")


def iso_week_end(c: ColumnLike) -> Column:
    return F.date_add(iso_week_start(c), 6)


def day_name(c: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_col(c), "EEE" if short else "EEEE")


def month_name(c: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_col(c), "MMM" if short else "MMMM")


def n_days_ago(n: int, as_of: ColumnLike | None = None) -> Column:
    return F.date_sub(_as_of(as_of), n)


def n_days_away(n: int, as_of: ColumnLike | None = None) -> Column:
    return n_days_ago(-n, as_of)


def n_weeks_ago(n: int, as_of: ColumnLike | None = None) -> Column:
    """Start of the week n weeks back."""
    return iso_week_start(F.date_sub(_as_of(as_of), 7 * n))


def n_weeks_away(n: int, as_of: ColumnLike | None = None) -> Column:
    return n_weeks_ago(-n, as_of)


def n_months_ago(n: int, as_of: ColumnLike | None = None) -> Column:
    """First day of the month n months back."""
    return F.trunc(F.add_months(_as_of(as_of), -n), "MONTH")


def n_months_away(n: int, as_of: ColumnLike | None = None) -> Column:
    return n_months_ago(-n, as_of)


def yesterday(as_of: ColumnLike | None = None) -> Column:
    return n_days_ago(1, as_of)


def tomorrow(as_of: ColumnLike | None = None) -> Column:
    return n_days_away(1, as_of)


def last_week(as_of: ColumnLike | None = None) -> Column:
    return n_weeks_ago(1, as_of)


def next_week(as_of: ColumnLike | None = None) -> Column:
    return n_weeks_away(1, as_of)


def last_month(as_of: ColumnLike | None = None) -> Column:
    return n_months_ago(1, as_of)


def next_month(as_of: ColumnLike | None = None) -> Column:
    return n_months_away(1, as_of)


def last_month_number(as_of: ColumnLike | None = None) -> Column:
    return F.month(last_month(as_of))


def next_month_number(as_of: ColumnLike | None = None) -> Column:
    return F.month(next_month(as_of))


def last_month_name(as_of: ColumnLike | None = None, short: bool = True) -> Column:
    return month_name(last_month(as_of), short)


def next_month_name(as_of: ColumnLike | None = None, short: bool = True) -> Column:
    return month_name(next_month(as_of), short)


def from_unixtimestamp(c: ColumnLike, unit: str = "seconds") -> Column:
    """Timestamp from an epoch count."""
    makers = {
        "seconds": F.timestamp_seconds,
        "milliseconds": F.timestamp_millis,
        "microseconds": F.timestamp_micros,
        "nanoseconds": lambda x: F.timestamp_micros(F.floor(x / 1000)),
    }
    if unit not in makers:
        raise ValueError(f"unsupported epoch unit: {unit}")
    return makers[unit](as_col(c))


def to_unixtimestamp(c: ColumnLike) -> Column:
    return F.unix_timestamp(as_col(c).cast("timestamp"))


def round_timestamp(c: ColumnLike) -> Column:
    """Nearest midnight."""
    return F.date_trunc("day", as_col(c) + F.expr("INTERVAL 12 HOURS"))


def add_part(part: str, n: int, c: ColumnLike) -> Column:
    """Date or timestamp plus n parts."""
    return as_col(c) + F.expr(f"INTERVAL {n} {part.upper()}")


def periods_since(c: ColumnLike, part: str = "day", as_of: ColumnLike | None = None) -> Column:
    """Period boundaries crossed from the value up to ``as_of``."""
    end = F.current_timestamp() if as_of is None else as_col(as_of)
    return parts_between(part, c, end)


def parts_between(part: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of ``part`` boundaries between two times (calendar difference)."""
    a, b = as_col(start), as_col(end)
    part = part.lower()
    if part == "day":
        return F.datediff(b, a)
    if part in ("month", "quarter", "year"):
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        if part == "month":
            return months
        if part == "quarter":
            return (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)
        return F.year(b) - F.year(a)
    if part == "week":
        return F.floor(F.datediff(iso_week_start(b), iso_week_start(a)) / 7).cast("int")
    seconds = {"hour": 3600, "minute": 60, "second": 1}[part]
    ta, tb = (F.unix_timestamp(F.date_trunc(part, x).cast("timestamp")) for x in (a, b))
    return ((tb - ta) / seconds).cast("long")
