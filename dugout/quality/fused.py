"""Many expectations of one table from a single scan.

An expectation observes one aggregate and says whether its value is fine. All of them go
into one aggregation: row checks are counts of failing rows, distinct counts are exact and
share one expansion of the rows (the engine's grouping sets), whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .generic import Condition, out_of_range, rows_where


@dataclass
class Expectation:
    """``observed`` is an aggregate; ``fine`` tells whether its value (a double column) is; unknown values are."""

    name: str
    observed: Column
    fine: Callable[[Column], Column]


def between(low: float | None = None, high: float | None = None) -> Callable[[Column], Column]:
    return lambda v: ~out_of_range(v, low, high, True)


def none(v: Column) -> Column:
    return v == 0


def distinct_count(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    return Expectation(f"distinct_count({column})", F.count_distinct(column), between(low, high))


def unique_share(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    share = F.try_divide(F.count_distinct(column).cast("double"), F.count(column).cast("double"))
    return Expectation(f"unique_share({column})", share, between(low, high))


def unique(columns: Sequence[str]) -> Expectation:
    """Rows beyond the first of each combination, rows with a NULL among them left aside."""
    known = F.count_if(~F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in columns], F.lit(False)))
    return Expectation(f"repeated({','.join(columns)})", known - F.count_distinct(*columns), none)


def in_set(column: str, values: Sequence) -> Expectation:
    """NULL fails."""
    c = F.col(column)
    return Expectation(f"not_in_set({column})", F.count_if(c.isNull() | ~c.isin(*values)), none)


def not_in_set(column: str, values: Sequence) -> Expectation:
    """NULL passes."""
    return Expectation(f"in_forbidden_set({column})", F.count_if(F.coalesce(F.col(column).isin(*values), F.lit(False))), none)


def null(column: str) -> Expectation:
    return Expectation(f"not_null({column})", F.count(column), none)


def not_null(column: str) -> Expectation:
    return Expectation(f"null({column})", F.count_if(F.col(column).isNull()), none)


def lengths(column: str, low: int | None = None, high: int | None = None) -> Expectation:
    """NULL passes."""
    bad = out_of_range(F.length(column), low, high, True)
    return Expectation(f"length({column})", F.count_if(F.coalesce(bad, F.lit(False))), none)


def column_sum(columns: Sequence[str], total: str) -> Expectation:
    """Sum of the columns' sums less the sum of another column."""
    parts = F.sum(columns[0])
    for c in columns[1:]:
        parts = parts + F.sum(c)
    return Expectation(f"sum({'+'.join(columns)}-{total})", parts - F.sum(total), none)


def row_count(low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("row_count", F.count(F.lit(1)), between(low, high))


def observed(df: DataFrame, expectations: Sequence[Expectation], group_by: Sequence[str] = (), where: Condition = None) -> DataFrame:
    """A row for each group and expectation: group columns, expectation, observed (double), fine."""
    names = [f"_e{i}" for i in range(len(expectations))]
    wide = rows_where(df, where).groupBy(*group_by).agg(*[e.observed.cast("double").alias(n) for n, e in zip(names, expectations)])
    items = [F.struct(F.lit(e.name).alias("expectation"), F.col(n).alias("observed"), F.coalesce(e.fine(F.col(n)), F.lit(True)).alias("fine")) for n, e in zip(names, expectations)]
    return wide.select(*group_by, F.inline(F.array(*items)))


def failed(df: DataFrame, expectations: Sequence[Expectation], group_by: Sequence[str] = (), where: Condition = None) -> DataFrame:
    """Groups and expectations that do not hold, with the value observed."""
    return observed(df, expectations, group_by, where).where(~F.col("fine")).drop("fine")
