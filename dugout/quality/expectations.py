"""Expectations on columns, rows and table shape (failing rows; empty = met)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.scalar import as_col, regex_match
from ..operators.reshape import bounds_spine
from ..operators.windows import exact_quantile, lag_periods, moving_stats, neighbor, value_chunk
from .generic import Condition, moment, out_of_range, rows_where

# ---- base forms --------------------------------------------------------------------------------


def expression_is_true(df: DataFrame, expression: Column | str, group_by: Sequence[str] | None = None, where: Condition = None) -> DataFrame:
    """Rows (or groups, for an aggregate) whose boolean expression is false; NULL passes.

    ``group_by`` None tests rows; a list, even an empty one, tests aggregates.
    """
    e = F.expr(expression) if isinstance(expression, str) else expression
    rows = rows_where(df, where)
    if group_by is None:
        return rows.where(~e)
    return rows.groupBy(*group_by).agg(e.alias("expression")).where(~F.col("expression"))


def expression_between(
    df: DataFrame,
    expression: Column | str,
    min_value: object = None,
    max_value: object = None,
    strictly: bool = False,
    group_by: Sequence[str] | None = None,
    where: Condition = None,
) -> DataFrame:
    """As :func:`expression_is_true` for a value inside limits."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    e = F.expr(expression) if isinstance(expression, str) else expression
    rows = rows_where(df, where)
    if group_by is None:
        return rows.where(out_of_range(e, min_value, max_value, not strictly))
    tested = rows.groupBy(*group_by).agg(e.alias("expression"))
    return tested.where(out_of_range("expression", min_value, max_value, not strictly))


def equal_expression(
    df: DataFrame,
    expression: Column | str,
    other: DataFrame | None = None,
    other_expression: Column | str | None = None,
    group_by: Sequence[str] = (),
    other_group_by: Sequence[str] | None = None,
    where: Condition = None,
    other_where: Condition = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    """Aggregates of two tables that differ by more than a tolerance, per group."""

    def side(d: DataFrame, e: Column | str, keys: Sequence[str], cond: Condition, name: str, mark: str) -> DataFrame:
        col = F.expr(e) if isinstance(e, str) else e
        cols = [F.col(k).alias(f"{mark}{i}") for i, k in enumerate(keys)]
        return rows_where(d, cond).groupBy(*cols).agg(col.alias(name)).withColumn(mark, F.lit(1))

    a = side(df, expression, group_by, where, "expression", "_a")
    b = side(
        other if other is not None else df,
        other_expression if other_expression is not None else expression,
        other_group_by or group_by,
        other_where if other_where is not None else where,
        "compare_expression",
        "_b",
    )
    cond = F.col("_a") == F.col("_b")
    for i in range(len(group_by)):
        cond = cond & (F.col(f"_a{i}") == F.col(f"_b{i}"))
    zero = F.lit(0)
    diff = F.abs(F.coalesce("expression", zero) - F.coalesce("compare_expression", zero))
    out = a.join(b, cond, "full").select(
        *[F.coalesce(f"_a{i}", f"_b{i}").alias(f"col_{i + 1}") for i in range(len(group_by))],
        "expression",
        "compare_expression",
        diff.alias("expression_difference"),
        F.try_divide(diff.cast("double"), F.col("expression").cast("double")).alias("expression_difference_percent"),
    )
    if tolerance_percent:
        return out.where(F.col("expression_difference_percent") > tolerance_percent)
    return out.where(F.col("expression_difference") > tolerance)


def considered(columns: Sequence[str], ignore_row_if: str) -> Column:
    """Rows kept under a missing-value rule."""
    nulls = [F.col(c).isNull() for c in columns]
    if ignore_row_if == "all_values_are_missing":
        test = nulls[0]
        for n in nulls[1:]:
            test = test & n
    elif ignore_row_if == "any_value_is_missing":
        test = nulls[0]
        for n in nulls[1:]:
            test = test | n
    else:
        raise ValueError("ignore_row_if must be all_values_are_missing or any_value_is_missing")
    return ~test


# ---- aggregates ---------------------------------------------------------------------------------


def distinct_count_greater_than(df, column, value, group_by=(), where=None):
    return expression_is_true(df, F.count_distinct(column) > value, group_by, where)


def distinct_count_less_than(df, column, value, group_by=(), where=None):
    return expression_is_true(df, F.count_distinct(column) < value, group_by, where)


def distinct_count_equal(df, column, value, group_by=(), where=None):
    return expression_is_true(df, F.count_distinct(column) == value, group_by, where)


def distinct_count_equal_other_table(df, column, other, other_column=None, where=None, other_where=None):
    return equal_expression(df, F.count_distinct(column), other, F.count_distinct(other_column or column), where=where, other_where=other_where)


def _value_set(spark: SparkSession, df: DataFrame, column: str, values: Sequence) -> DataFrame:
    kind = df.schema[column].dataType
    rows = [(str(v),) for v in dict.fromkeys(values)]
    return spark.createDataFrame(rows, "value_field string").select(F.col("value_field").cast(kind).alias("value_field"))


def distinct_values_in_set(df, column, values, where=None):
    """Distinct values outside the set; NULL is reported too."""
    c = F.col(column)
    return rows_where(df, where).where(c.isNull() | ~c.isin(*values)).select(c.alias("value_field")).distinct()


def distinct_values_contain_set(df, column, values, where=None):
    """Set members the column never takes."""
    have = rows_where(df, where).where(F.col(column).isin(*values)).select(F.col(column).alias("value_field")).distinct()
    return _value_set(df.sparkSession, df, column, values).join(have, "value_field", "left_anti")


def distinct_values_equal_set(df, column, values, where=None):
    """Values on one side only; NULL in the column is reported."""
    extra = distinct_values_in_set(df, column, values, where).select(F.col("value_field").alias("column_value"), F.lit(None).cast(df.schema[column].dataType).alias("set_value"))
    missing = distinct_values_contain_set(df, column, values, where)
    return extra.unionByName(missing.select(F.lit(None).cast(df.schema[column].dataType).alias("column_value"), F.col("value_field").alias("set_value")))


def max_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.max(column), min_value, max_value, strictly, group_by, where)


def min_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.min(column), min_value, max_value, strictly, group_by, where)


def mean_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.avg(column), min_value, max_value, strictly, group_by, where)


def sum_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.sum(column), min_value, max_value, strictly, group_by, where)


def stdev_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.stddev_samp(column), min_value, max_value, strictly, group_by, where)


def unique_value_count_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return expression_between(df, F.count_distinct(column), min_value, max_value, strictly, group_by, where)


def proportion_of_unique_values_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    share = F.try_divide(F.count_distinct(column).cast("double"), F.count(column).cast("double"))
    return expression_between(df, share, min_value, max_value, strictly, group_by, where)


def quantile_between(df, column, quantile, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    """Exact interpolated quantile inside limits."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    q = exact_quantile(rows_where(df, where), column, quantile, group_by, "expression")
    return q.where(out_of_range("expression", min_value, max_value, not strictly))


def median_between(df, column, min_value=None, max_value=None, strictly=False, group_by=(), where=None):
    return quantile_between(df, column, 0.5, min_value, max_value, strictly, group_by, where)


def nth_most_common_value(df: DataFrame, column: str, n: int, where: Condition = None) -> DataFrame:
    """The value with the n-th highest count; the smaller value goes first on a tie, none with fewer values."""
    counts = rows_where(df, where).groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    return counts.orderBy(F.desc("value_count"), F.asc("value_field")).offset(n - 1).limit(1)


def most_common_value_in_set(df, column, values, top_n=1, where=None):
    """The n-th most common value when it is not in the set; without an n-th one the test passes."""
    nth = nth_most_common_value(df, column, top_n, where)
    return nth.where(~F.col("value_field").isin(*values)).select("value_field")


# ---- column values ------------------------------------------------------------------------------


def values_between(df, column, min_value=None, max_value=None, strictly=False, where=None):
    return expression_between(df, as_col(column), min_value, max_value, strictly, None, where)


def _ordered(df, column, sort_column, fine: Callable[[Column, Column], Column], group_by, where):
    sort = sort_column or column
    rows = rows_where(df, where).select(F.col(sort).alias("sort_column"), *group_by, F.col(column).alias("value_field"))
    near = neighbor(rows, list(group_by), ["sort_column"], {"value_field_lag": F.col("value_field")}, chunk=value_chunk(rows, "sort_column"))
    return near.where(F.col("value_field_lag").isNotNull() & ~fine(F.col("value_field"), F.col("value_field_lag")))


def values_increasing(df, column, sort_column=None, strictly=True, group_by=(), where=None):
    """Rows not above their predecessor in sort order."""
    return _ordered(df, column, sort_column, (lambda a, b: a > b) if strictly else (lambda a, b: a >= b), group_by, where)


def values_decreasing(df, column, sort_column=None, strictly=True, group_by=(), where=None):
    """Rows not below their predecessor in sort order."""
    return _ordered(df, column, sort_column, (lambda a, b: a < b) if strictly else (lambda a, b: a <= b), group_by, where)


def values_in_set(df, column, values, where=None):
    """Rows outside the set; NULL fails."""
    c = F.col(column)
    return rows_where(df, where).where(c.isNull() | ~c.isin(*values)).select(c.alias("value_field"))


def values_not_in_set(df, column, values, where=None):
    """Rows inside the forbidden set; NULL passes."""
    return rows_where(df, where).where(F.col(column).isin(*values)).select(F.col(column).alias("value_field"))


def _verdict(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), schema)


def values_in_type_list(df, column, types):
    """One row naming the column's type when it is not among the listed ones."""
    kind = df.schema[column].dataType.simpleString()
    bad = [] if kind in {t.lower() for t in types} else [(column, kind)]
    return _verdict(df, bad, "relation_column string, relation_column_type string")


def values_of_type(df, column, kind):
    return values_in_type_list(df, column, [kind])


def values_null(df, column, where=None):
    return rows_where(df, where).where(F.col(column).isNotNull())


def values_not_null(df, column, where=None):
    return rows_where(df, where).where(F.col(column).isNull())


def compound_columns_unique(df, columns, ignore_row_if="all_values_are_missing", where=None):
    """Repeated combinations with their record counts."""
    rows = rows_where(df, where).where(considered(columns, ignore_row_if))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def values_unique(df, column, where=None):
    return compound_columns_unique(df, [column], where=where)


def consistent_casing(df, column, display=False):
    """Values that differ by case only: a summary row, or the list with ``display``."""
    per = df.select(column).distinct().groupBy(F.lower(column).alias("inconsistent_columns")).agg(F.count(column).alias("set_count_case_insensitive"))
    if display:
        return per.where("set_count_case_insensitive > 1")
    # Counts over the distinct values: NULL is one value of the first count only.
    totals = df.select(column).distinct().agg(F.count(F.lit(1)).alias("set_count"), F.count_distinct(F.lower(column)).alias("set_count_case_insensitive"))
    return totals.where("set_count <> set_count_case_insensitive")


# ---- distributions ------------------------------------------------------------------------------


def within_n_moving_stdevs(
    df: DataFrame,
    column: str,
    date_column: str,
    group_by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    as_of: object | None = None,
) -> DataFrame:
    """Periods whose (log, differenced) sum leaves the band of the periods before it.

    Rows are summed per period first, so a group's windows are bounded by the periods.
    """
    upper = sigma_threshold_upper or sigma_threshold
    lower = sigma_threshold_lower or -1 * sigma_threshold
    keys = list(group_by)

    def metric(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.coalesce(F.ln(F.nullif(v, F.lit(0.0))), F.lit(0.0)) if take_logs else F.coalesce(v, F.lit(0.0))

    m = df.groupBy(F.date_trunc(period, date_column).alias("metric_period"), *keys).agg(F.sum(column).alias("agg_metric_value"))
    if take_diffs:
        m = lag_periods(m, keys, ["metric_period"], "agg_metric_value", lookback_periods, "prior_agg_metric_value")
        m = m.withColumn("metric_test_value", metric("agg_metric_value") - metric("prior_agg_metric_value"))
    else:
        m = m.withColumn("metric_test_value", metric("agg_metric_value"))
    m = moving_stats(m, keys, ["metric_period"], "metric_test_value", trend_periods).withColumnsRenamed(
        {"metric_test_value_moving_avg": "metric_test_rolling_average", "metric_test_value_moving_stddev": "metric_test_rolling_stddev"}
    )
    delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
    m = m.withColumns({"metric_test_delta": delta, "metric_test_sigma": F.try_divide(delta, F.col("metric_test_rolling_stddev"))})
    end = F.date_trunc(period, moment(as_of))
    sigma = F.col("metric_test_sigma")
    return m.where(
        (F.col("metric_period") >= D.add_part(period, -test_periods, end)) & (F.col("metric_period") < end) & ~((sigma >= lower) & (sigma <= upper))
    )


def within_n_stdevs(df: DataFrame, column: str, group_by: Sequence[str] = (), sigma_threshold: float = 3) -> DataFrame:
    """Groups whose sum is more than n sample deviations from the mean of the sums."""
    sums = df.groupBy(*group_by).agg(F.sum(column).alias(column))
    stats = sums.agg(F.avg(column).alias("a"), F.stddev_samp(column).alias("s"))
    out = sums.withColumns({f"{column}_average": stats.select("a").scalar(), f"{column}_stddev": stats.select("s").scalar()})
    out = out.withColumn(f"{column}_sigma", F.try_divide((F.col(column) - F.col(f"{column}_average")).cast("double"), F.col(f"{column}_stddev")))
    return out.where(F.abs(F.col(f"{column}_sigma")) > sigma_threshold)


def data_for_every_n_datepart(
    df: DataFrame,
    date_column: str,
    part: str = "day",
    interval: int | None = None,
    where: Condition = None,
    exclusion: Column | str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Spine periods without rows. The end is excluded, as in every spine."""
    rows = rows_where(df, where)
    spark = df.sparkSession
    if start and end:
        bounds = spark.range(1).select(F.to_timestamp(F.lit(start)).alias("a"), F.to_timestamp(F.lit(end)).alias("b"))
    else:
        lo = F.to_timestamp(F.lit(start)) if start else F.min(F.col(date_column).cast("date")).cast("timestamp")
        hi = F.to_timestamp(F.lit(end)) if end else F.max(F.col(date_column).cast("date")).cast("timestamp")
        bounds = rows.agg(F.max(F.lit(1)).alias("_"), *[c.alias(n) for c, n in ((lo, "a"), (hi, "b"))]).drop("_")
    name = f"date_{part}"
    spine = bounds_spine(bounds, part, "a", "b", name, keep=["a"])
    period = F.date_trunc(part, F.col(date_column).cast("timestamp"))
    if interval:
        spine = spine.where(D.parts_between(part, F.col("a"), F.col(name)) % interval == 0)
        first = bounds.select("a").scalar()
        off = D.parts_between(part, first, F.col(date_column)) % interval
        unit = F.make_interval(**{f"{part}s": off}) if part in ("day", "week", "month", "year", "hour") else None
        if unit is None:
            raise ValueError(f"interval is not supported for {part}")
        period = period - unit
    counts = rows.select(period.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("row_cnt"))
    gaps = spine.drop("a").join(counts, name, "left_anti").select(name, F.lit(True).alias("is_missing"), F.lit(0).alias("row_cnt"))
    return gaps if exclusion is None else gaps.where(exclusion)


# ---- several columns ----------------------------------------------------------------------------


def pair_a_greater_than_b(df, a, b, or_equal=False, where=None):
    x, y = F.col(a), F.col(b)
    return expression_is_true(df, x >= y if or_equal else x > y, None, where)


def pair_equal(df, a, b, where=None):
    return expression_is_true(df, F.col(a) == F.col(b), None, where)


def pair_in_set(df, a, b, pairs, where=None):
    """Rows whose (a, b) is not one of the listed pairs."""
    ok = F.lit(False)
    for x, y in pairs:
        ok = ok | ((F.col(a) == F.lit(x)) & (F.col(b) == F.lit(y)))
    return expression_is_true(df, ok, None, where)


def multicolumn_sum_equal(df, columns, total, group_by=(), where=None):
    """Sum of column sums against a number or another column's sum."""
    parts = [F.sum(F.lit(c) if isinstance(c, (int, float)) else F.col(c)) for c in columns]
    left = parts[0]
    for p in parts[1:]:
        left = left + p
    return expression_is_true(df, left == (F.lit(total) if isinstance(total, (int, float)) else F.sum(total)), group_by, where)


def select_values_unique_within_record(df, columns, ignore_row_if="all_values_are_missing", where=None):
    """Rows in which the columns hold fewer distinct values than there are columns."""
    values = F.array(*[F.col(c).cast("string") for c in columns])
    distinct = F.size(F.array_distinct(F.array_compact(values)))
    return rows_where(df, where).where(considered(columns, ignore_row_if)).withColumn("column_values", distinct).where(distinct < len(columns))


# ---- text ---------------------------------------------------------------------------------------


def value_lengths_between(df, column, min_value=None, max_value=None, strictly=False, where=None):
    return expression_between(df, F.length(column), min_value, max_value, strictly, None, where)


def value_lengths_equal(df, column, value, where=None):
    return expression_is_true(df, F.length(column) == value, None, where)


def _fold(tests: Sequence[Column], match_on: str) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be any or all")
    out = tests[0]
    for t in tests[1:]:
        out = (out | t) if match_on == "any" else (out & t)
    return out


def match_like(df, column, pattern, where=None):
    return expression_is_true(df, F.col(column).like(pattern), None, where)


def not_match_like(df, column, pattern, where=None):
    return expression_is_true(df, ~F.col(column).like(pattern), None, where)


def match_like_list(df, column, patterns, match_on="any", where=None):
    return expression_is_true(df, _fold([F.col(column).like(p) for p in patterns], match_on), None, where)


def not_match_like_list(df, column, patterns, match_on="any", where=None):
    return expression_is_true(df, _fold([~F.col(column).like(p) for p in patterns], match_on), None, where)


def match_regex(df, column, pattern, flags="", where=None):
    return expression_is_true(df, regex_match(column, pattern, flags), None, where)


def not_match_regex(df, column, pattern, flags="", where=None):
    return expression_is_true(df, ~regex_match(column, pattern, flags), None, where)


def match_regex_list(df, column, patterns, match_on="any", flags="", where=None):
    return expression_is_true(df, _fold([regex_match(column, p, flags) for p in patterns], match_on), None, where)


def not_match_regex_list(df, column, patterns, match_on="any", flags="", where=None):
    return expression_is_true(df, _fold([~regex_match(column, p, flags) for p in patterns], match_on), None, where)


# ---- table shape --------------------------------------------------------------------------------


def column_exists(df, column, index=None, transform=str.upper):
    """One row when the column is missing (or not at the 1-based place)."""
    names = [transform(c) for c in df.columns]
    wanted = transform(column)
    fine = wanted in names and (index is None or names.index(wanted) + 1 == index)
    return _verdict(df, [] if fine else [(column, index)], "missing_column string, expected_index int")


def rows_recent(df, column, part, interval, as_of=None, where=None):
    """One row when the newest value is too old; an empty table counts as 1970-01-01."""
    newest = F.coalesce(F.max(F.col(column).cast("timestamp")), F.lit("1970-01-01").cast("timestamp"))
    now = moment(as_of)
    past = rows_where(df, where).where(F.col(column).cast("timestamp") <= now)
    return past.agg(newest.alias("max_timestamp")).where(F.col("max_timestamp") < D.add_part(part, -interval, now))


def grouped_rows_recent(df, group_by, column, part, interval, as_of=None, where=None):
    """Groups whose newest past value is too old."""
    now = moment(as_of)
    stamp = F.col(column).cast("timestamp")
    newest = rows_where(df, where).where(stamp <= now).groupBy(*group_by).agg(F.max(stamp).alias("latest_timestamp_column"))
    old = newest.where(F.col("latest_timestamp_column") < D.add_part(part, -interval, now))
    return old.select(F.lit(1).cast("long").alias("row_count"), *group_by, "latest_timestamp_column")


def aggregation_equal_other_table(df, expression, other, other_expression=None, group_by=(), other_group_by=None, where=None, other_where=None, tolerance=0.0, tolerance_percent=None):
    return equal_expression(df, expression, other, other_expression, group_by, other_group_by, where, other_where, tolerance, tolerance_percent)


def column_count_between(df, min_value=None, max_value=None):
    n = len(df.columns)
    fine = (min_value is None or n >= min_value) and (max_value is None or n <= max_value)
    return _verdict(df, [] if fine else [(n,)], "number_columns int")


def column_count_equal(df, value):
    return column_count_between(df, value, value)


def column_count_equal_other_table(df, other):
    return column_count_equal(df, len(other.columns))


def columns_contain_set(df, columns, transform=str.upper):
    """Wanted columns the table lacks."""
    have = {transform(c) for c in df.columns}
    return _verdict(df, [(c,) for c in columns if transform(c) not in have], "missing_column string")


def columns_match_ordered_list(df, columns, transform=str.upper):
    """Places at which table and list differ."""
    have, want = [transform(c) for c in df.columns], [transform(c) for c in columns]
    n = max(len(have), len(want))
    pad = lambda xs: xs + [None] * (n - len(xs))
    rows = [(i + 1, a, b) for i, (a, b) in enumerate(zip(pad(have), pad(want))) if a != b]
    return _verdict(df, rows, "column_index int, relation_column string, listed_column string")


def columns_match_set(df, columns, transform=str.upper):
    """Columns on one side only."""
    have, want = {transform(c) for c in df.columns}, {transform(c) for c in columns}
    rows = [(c, None) for c in sorted(have - want)] + [(None, c) for c in sorted(want - have)]
    return _verdict(df, rows, "relation_column string, listed_column string")


def columns_not_contain_set(df, columns, transform=str.upper):
    """Forbidden columns the table has."""
    have = {transform(c) for c in df.columns}
    return _verdict(df, [(c,) for c in columns if transform(c) in have], "matching_column string")


def row_count_between(df, min_value=None, max_value=None, group_by=(), strictly=False, where=None):
    return expression_between(df, F.count(F.lit(1)), min_value, max_value, strictly, group_by, where)


def row_count_equal(df, value, group_by=(), where=None):
    return expression_is_true(df, F.count(F.lit(1)) == value, group_by, where)


def row_count_equal_other_table(df, other, group_by=(), other_group_by=None, factor=1, where=None, other_where=None):
    n = F.count(F.lit(1))
    return equal_expression(df, n, other, n * factor, group_by, other_group_by, where, other_where)


# ---- singular tests -----------------------------------------------------------------------------

# Season statistics and their allowed ranges (None is open).
DECIMAL_RANGES = {"era": (0, None), "hits_per9_inn": (0, None), "whip": (0, None), "fielding_percentage": (0, 1)}


def decimal_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per value outside its range, in a single scan."""
    checks = [
        F.when(out_of_range(c, lo, hi, True), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("bad_value")))
        for c, (lo, hi) in (ranges or DECIMAL_RANGES).items()
    ]
    return df.select(*keep, F.inline(F.array_compact(F.array(*checks))))


def history_gaps(df: DataFrame, key: str = "player_id", start: str = "effective_date", end: str = "end_date") -> DataFrame:
    """Versions whose successor does not start the day after they end.

    A key has at most one version per season, which bounds the window.
    """
    near = neighbor(df.select(key, start, end), [key], [start], {"next_start": F.col(start)}, lead=True)
    return near.where(F.date_add(end, 1) != F.col("next_start"))


def history_overlaps(df: DataFrame, key: str = "player_id", start: str = "effective_date", end: str = "end_date") -> DataFrame:
    """Versions that reach into their successor."""
    near = neighbor(df.select(key, start, end), [key], [start, end], {"next_start": F.col(start)}, lead=True)
    return near.where(F.col("next_start") <= F.col(end))


def history_one_current(df: DataFrame, key: str = "player_id", current: str = "is_current") -> DataFrame:
    """Keys without exactly one current version."""
    return df.groupBy(key).agg(F.sum(F.col(current).cast("int")).alias("current_rows")).where("current_rows <> 1")
