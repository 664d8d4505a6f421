"""Keys, safe arithmetic, rates, text clean-up and sport-specific number formats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a hashed key. Keys are only
# comparable with existing warehouses when this text is the same.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    """Column from a name or a column."""
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(cols: Sequence[ColumnLike], null_as_empty: bool = False) -> Column:
    """md5 of the dash-joined text of ``cols``; NULL becomes a fixed marker text."""
    marker = "" if null_as_empty else NULL_KEY_TEXT
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(marker)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def safe_add(cols: Sequence[ColumnLike]) -> Column:
    """Sum with NULL counted as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c), F.lit(0)) for c in cols])


def safe_subtract(cols: Sequence[ColumnLike]) -> Column:
    """First column minus the others, NULL counted as zero."""
    return reduce(lambda a, b: a - b, [F.coalesce(as_col(c), F.lit(0)) for c in cols])


def safe_divide(num: ColumnLike, den: ColumnLike) -> Column:
    """Quotient, NULL when the denominator is zero or NULL."""
    return F.try_divide(as_col(num), as_col(den))


def rate(num: ColumnLike, den: ColumnLike, digits: int = 3) -> Column:
    """Rounded floating ratio, NULL on a zero or NULL denominator."""
    return F.round(F.try_divide(as_col(num).cast("double"), as_col(den).cast("double")), digits)


def haversine(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError("unit must be 'mi' or 'km'")
    a1, o1, a2, o2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), F.lit(2)) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), F.lit(2))
    miles = F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def width_bucket(x: ColumnLike, low: ColumnLike | float, high: ColumnLike | float, buckets: int) -> Column:
    """Equal-width bucket number; an exact multiple of the width moves one bucket up.

    Unlike the built-in function it is not clamped below zero, and an exact multiple
    above the upper bound gives ``buckets + 2``.
    """
    v = as_col(x).cast("double")
    lo = F.lit(low).cast("double") if isinstance(low, (int, float)) else as_col(low).cast("double")
    hi = F.lit(high).cast("double") if isinstance(high, (int, float)) else as_col(high).cast("double")
    width = (hi - lo) / F.lit(float(buckets))
    on_edge = F.when(F.pmod(v, width) == 0, 1).otherwise(0)
    return (F.least(F.ceil((v - lo) / width), F.lit(buckets + 1)) + on_edge).cast("int")


def blank_to_null(c: ColumnLike) -> Column:
    """Empty string becomes NULL."""
    return F.nullif(as_col(c), F.lit(""))


def clean_text(c: ColumnLike, default: str) -> Column:
    """Trimmed text, ``default`` for NULL or blank."""
    return F.coalesce(F.nullif(F.trim(as_col(c).cast("string")), F.lit("")), F.lit(default))


def text_or(c: ColumnLike, default: str) -> Column:
    """Text as is, ``default`` for NULL or empty (no trim)."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def flag(cond: Column) -> Column:
    """1 when the condition is true, 0 when false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def known_flag(known: Column, cond: Column) -> Column:
    """As :func:`flag`, but NULL where ``known`` does not hold."""
    return F.when(known, flag(cond))


def innings_to_outs(c: ColumnLike) -> Column:
    """Innings text ("6.1" is six and one third) to outs; blank gives NULL."""
    t = as_col(c).cast("string")
    whole = F.split_part(t, F.lit("."), F.lit(1)).try_cast("int")
    tail = F.substring(F.split_part(t, F.lit("."), F.lit(2)), 1, 1)
    thirds = F.when(F.instr(t, ".") == 0, F.lit(0)).when(tail == "", F.lit(0)).otherwise(tail.try_cast("int"))
    return F.when(F.trim(t) != "", whole * 3 + thirds)


def outs_to_innings(c: ColumnLike) -> Column:
    """Outs to innings text."""
    o = as_col(c).cast("long")
    return F.concat(F.floor(o / 3).cast("string"), F.lit("."), (o % 3).cast("string"))


def earned_run_average(earned_runs: ColumnLike, outs: ColumnLike, digits: int = 2) -> Column:
    """Nine-inning earned runs, NULL when no out was recorded."""
    return F.when(as_col(outs) > 0, F.round(as_col(earned_runs) * 9.0 / (as_col(outs) / 3.0), digits))


def fielding_percentage(putouts: ColumnLike, assists: ColumnLike, chances: ColumnLike) -> Column:
    """Successful chances over all chances, three digits."""
    return F.when(as_col(chances) > 0, rate(as_col(putouts) + as_col(assists), chances))


def on_base_rate(hits: ColumnLike, walks: ColumnLike, hit_by_pitch: ColumnLike, at_bats: ColumnLike, sac_flies: ColumnLike) -> Column:
    """On-base percentage."""
    reached = as_col(hits) + as_col(walks) + as_col(hit_by_pitch)
    return rate(reached, as_col(at_bats) + as_col(walks) + as_col(hit_by_pitch) + as_col(sac_flies))


def whip(walks: ColumnLike, hits: ColumnLike, outs: ColumnLike) -> Column:
    """Walks plus hits per inning, two digits."""
    return F.round(F.try_divide((as_col(walks) + as_col(hits)).cast("double"), as_col(outs) / 3.0), 2)


def per_nine(count: ColumnLike, outs: ColumnLike) -> Column:
    """Events per nine innings, two digits."""
    return F.round(F.try_divide((as_col(count) * 9).cast("double"), as_col(outs) / 3.0), 2)


def money(c: ColumnLike) -> Column:
    """Text such as ``$1,234.50`` to decimal(18,2), NULL when not a number."""
    return F.regexp_replace(as_col(c).cast("string"), "[$,]", "").try_cast("decimal(18,2)")


def start_hour(local_text: ColumnLike, ts: ColumnLike) -> Column:
    """Hour of a local "HH:mm" text, else of the timestamp."""
    from_text = F.hour(F.try_to_timestamp(as_col(local_text), F.lit("HH:mm")))
    return F.coalesce(from_text, F.hour(as_col(ts)))


def clock_to_24h(time_text: ColumnLike, ampm: ColumnLike | None = None) -> Column:
    """"7:05" + "PM" (or "7:05 PM") to "19:05"; NULL when it cannot be read."""
    t = as_col(time_text)
    full = F.upper(F.trim(t if ampm is None else F.concat_ws(" ", F.trim(t), F.trim(as_col(ampm)))))
    return F.date_format(F.try_to_timestamp(full, F.lit("h:mm a")), "HH:mm")


def duration_minutes(c: ColumnLike) -> Column:
    """"3:22" to minutes; text after a blank ("3:22 (0:15 delay)") is ignored."""
    t = F.split_part(F.trim(as_col(c)), F.lit(" "), F.lit(1))
    t = F.regexp_replace(t, r"\.$", "")
    hours = F.split_part(t, F.lit(":"), F.lit(1)).try_cast("int")
    minutes = F.split_part(t, F.lit(":"), F.lit(2)).try_cast("int")
    return hours * 60 + minutes


def grouped_int(c: ColumnLike) -> Column:
    """"44,392." to 44392."""
    return F.regexp_replace(as_col(c), r"[,.\s]", "").try_cast("int")


def rate_text(c: ColumnLike) -> Column:
    """Three digits without the leading zero: ``.333``."""
    return F.call_function("format_number", as_col(c), F.lit("#.000"))


def joined(*cols: Column) -> Column:
    """Text concatenation that skips NULL parts."""
    return F.concat_ws("", *cols)


def violations(checks: dict[str, Column]) -> Column:
    """Labels of the checks that hold, as one text; '' when none does."""
    return F.concat_ws("", *[F.when(cond, F.lit(label + ";")) for label, cond in checks.items()])


def code_label(c: ColumnLike, labels: dict[str, str], default: str | None = None) -> Column:
    """Code to label through a literal map."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    looked_up = F.try_element_at(F.create_map(*pairs), as_col(c))
    return looked_up if default is None else F.coalesce(looked_up, F.lit(default))


def regex_match(c: ColumnLike, pattern: str, flags: str = "") -> Column:
    """True when the pattern is found; ``flags`` are inline letters such as ``i``."""
    return as_col(c).rlike(f"(?{flags}){pattern}" if flags else pattern)


def regex_position(c: ColumnLike, pattern: str, flags: str = "") -> Column:
    """1-based position of the first match, 0 when there is none."""
    return F.regexp_instr(as_col(c), F.lit(f"(?{flags}){pattern}" if flags else pattern))
