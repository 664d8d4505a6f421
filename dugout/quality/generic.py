"""Generic table tests (failing rows; unknown predicates pass unless stated).

Most tests take ``where``, a filter applied before testing. Tests over neighbouring rows
cut every group (a missing group is one group) into order chunks by the type of the
ordered column, so that none lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.scalar import ColumnLike, as_col
from ..operators.reshape import symmetric_difference
from ..operators.windows import neighbor, value_chunk

Condition = Column | str | None


def rows_where(df: DataFrame, where: Condition) -> DataFrame:
    """Rows under an optional condition."""
    return df if where is None else df.where(where)


def moment(as_of: object | None) -> Column:
    """Reference time: a column, a literal, or now."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def not_null(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    return rows_where(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """Values that occur more than once; NULL is ignored."""
    rows = rows_where(df, where).where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence, where: Condition = None) -> DataFrame:
    """Values outside a list, with their counts; NULL passes."""
    rows = rows_where(df, where).where(~F.col(column).isin(*values))
    return rows.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(df: DataFrame, column: str, to: DataFrame, field: str, where: Condition = None) -> DataFrame:
    """Non-NULL values without a parent."""
    child = rows_where(df, where).where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    parent = to.select(F.col(field).alias("to_field")).where(F.col("to_field").isNotNull())
    return child.join(parent, F.col("from_field") == F.col("to_field"), "left_anti")


def accepted_range(
    df: DataFrame, column: ColumnLike, min_value: object = None, max_value: object = None, inclusive: bool = True, where: Condition = None
) -> DataFrame:
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    return rows_where(df, where).where(out_of_range(column, min_value, max_value, inclusive))


def out_of_range(column: ColumnLike, min_value: object, max_value: object, inclusive: bool) -> Column:
    """Predicate that a value leaves a range."""
    c, bad = as_col(column), F.lit(False)
    lo = min_value if isinstance(min_value, Column) else F.lit(min_value)
    hi = max_value if isinstance(max_value, Column) else F.lit(max_value)
    if min_value is not None:
        bad = bad | (c < lo if inclusive else c <= lo)
    if max_value is not None:
        bad = bad | (c > hi if inclusive else c >= hi)
    return bad


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = (), where: Condition = None, compat: bool = False) -> DataFrame:
    """Groups (or the table) without a single non-NULL value.

    ``compat`` keeps the older behaviour in which a grouped test never fails.
    """
    rows = rows_where(df, where)
    if compat and group_by:
        rows = rows.where(F.col(column).isNotNull())
    return rows.groupBy(*group_by).agg(F.count(column).alias("filler_column")).where("filler_column = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str, where: Condition = None) -> DataFrame:
    """(value, count) pairs present on one side only."""
    a = rows_where(df, where).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return symmetric_difference(a, b)


def _two_counts(df: DataFrame, other: DataFrame, group_by: Sequence[str], left: str, right: str) -> DataFrame:
    """Row counts per group on both sides, kept together by a full join (one row when ungrouped)."""
    a = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(left))
    b = other.groupBy(*group_by).agg(F.count(F.lit(1)).alias(right))
    keys_a = [F.col(g).alias(f"{g}_a") for g in group_by]
    keys_b = [F.col(g).alias(f"{g}_b") for g in group_by]
    a, b = a.select(*keys_a, F.lit(1).alias("_ja"), left), b.select(*keys_b, F.lit(1).alias("_jb"), right)
    cond = F.col("_ja") == F.col("_jb")
    for g in group_by:
        cond = cond & (F.col(f"{g}_a") == F.col(f"{g}_b"))
    return a.join(b, cond, "full").drop("_ja", "_jb")


def equal_rowcount(df: DataFrame, other: DataFrame, group_by: Sequence[str] = (), where: Condition = None) -> DataFrame:
    """Counts side by side; ``sum(diff_count)`` is the number of failures."""
    both = _two_counts(rows_where(df, where), other, group_by, "count_a", "count_b")
    return both.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: Sequence[str] = (), where: Condition = None) -> DataFrame:
    """Counts side by side; ``sum(row_count_delta)`` is the number of failures (equal counts as one)."""
    both = _two_counts(rows_where(df, where), other, group_by, "count_our_model", "count_comparison_model")
    a, b = F.col("count_our_model"), F.col("count_comparison_model")
    return both.withColumn("row_count_delta", F.when(a > b, a - b).when(a == b, 1).otherwise(0))


def equality(df: DataFrame, other: DataFrame, columns: Sequence[str] | None = None, multiset: bool = False) -> DataFrame:
    """Rows that only one side has."""
    cols = list(columns or df.columns)
    return symmetric_difference(df.select(*cols), other.select(*cols), multiset)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None, where: Condition = None) -> DataFrame:
    """Rows for which an SQL predicate is false; with ``column`` it completes ``<column> <expression>``."""
    text = f"`{column}` {expression}" if column else expression
    return rows_where(df, where).where(~F.expr(text))


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length: bool = False,
    where: Condition = None,
    small_groups: bool = False,
) -> DataFrame:
    """Ranges that are inverted, overlap their successor, or break the rule on gaps.

    Rows are cut into chunks of their lower bound, so that one group may hold most of them.
    ``small_groups`` says that the grain bounds a group (the versions of a player, the
    orders of a customer): then one plain window does.
    """
    rules = {"not_allowed": lambda a, b: a == b, "allowed": lambda a, b: a <= b, "required": lambda a, b: a < b}
    if gaps not in rules:
        raise ValueError("gaps must be not_allowed, allowed or required")
    keys = [F.col(partition_by).alias("partition_by_col")] if partition_by else []
    rows = rows_where(df, where).select(*keys, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    names = ["partition_by_col"] if partition_by else []
    marks = {"_has_next": F.lit(True), "next_lower_bound": F.col("lower_bound")}
    near = neighbor(rows, names, ["lower_bound", "upper_bound"], marks, lead=True, chunk=None if small_groups and partition_by else value_chunk(rows, "lower_bound"))
    lo, hi, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    fine = F.coalesce(lo <= hi if zero_length else lo < hi, F.lit(False)) & F.coalesce(rules[gaps](hi, nxt), F.col("_has_next").isNull(), F.lit(False))
    return near.where(~fine).withColumn("is_last_record", F.col("_has_next").isNull()).drop("_has_next")


def not_accepted_values(df: DataFrame, column: str, values: Sequence, where: Condition = None) -> DataFrame:
    """Distinct values that are on the forbidden list."""
    return rows_where(df, where).where(F.col(column).isin(*values)).select(F.col(column).alias("value_field")).distinct()


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = (), where: Condition = None) -> DataFrame:
    """Groups (or the table) with exactly one distinct value."""
    return rows_where(df, where).groupBy(*group_by).agg(F.count_distinct(column).alias("filler_column")).where("filler_column = 1")


def not_empty_string(df: DataFrame, column: str, trim: bool = True, where: Condition = None) -> DataFrame:
    c = F.trim(column) if trim else F.col(column)
    return rows_where(df, where).where(c == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = (), where: Condition = None
) -> DataFrame:
    """Groups whose share of non-NULL values leaves the limits."""
    share = F.avg(F.when(F.col(column).isNull(), 0.0).otherwise(1.0)).alias("not_null_proportion")
    out = rows_where(df, where).groupBy(*group_by).agg(share)
    return out.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    part: str,
    interval: int,
    ignore_time: bool = False,
    group_by: Sequence[str] = (),
    as_of: object | None = None,
    where: Condition = None,
) -> DataFrame:
    """Groups whose newest value is older than the interval."""
    kind = "date" if ignore_time else "timestamp"
    threshold = D.add_part(part, -interval, moment(as_of)).cast(kind)
    newest = rows_where(df, where).groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold).where(F.col("most_recent") < F.col("threshold"))


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "1 = 1", to_condition: str = "1 = 1"
) -> DataFrame:
    """Child values without a parent, under conditions on both sides."""
    child = df.where(F.col(column).isNotNull()).where(from_condition).select(F.col(column).alias("id"))
    parent = to.where(F.col(field).isNotNull()).where(to_condition).select(F.col(field).alias("id"))
    return child.join(parent, "id", "left_anti")


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    part: str | None = None,
    group_by: Sequence[str] = (),
    where: Condition = None,
) -> DataFrame:
    """Values that do not follow their predecessor by exactly one interval."""
    rows = rows_where(df, where).select(*group_by, column)
    prev = f"previous_{column}"
    near = neighbor(rows, list(group_by), [column], {prev: F.col(column)}, chunk=value_chunk(rows, column))
    if part:
        expected = D.add_part(part, interval, F.col(prev).cast("timestamp"))
        return near.where(~(F.col(column).cast("timestamp") == expected))
    return near.where(~(F.col(column) == F.col(prev) + interval))


def unique_combination(df: DataFrame, columns: Sequence[str], where: Condition = None) -> DataFrame:
    """Key combinations that occur more than once; NULLs group together."""
    return rows_where(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1").select(*columns)
