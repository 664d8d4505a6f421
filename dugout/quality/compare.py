"""Comparison of two datasets, clean-up of failing rows and failure reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import dedup_latest


def compare_queries(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows by the sides that have them: in_a, in_b, count, percent_of_total.

    One aggregation over the tagged union; NULL equals NULL.
    """
    cols = a.columns
    both = a.select(*cols, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(
        b.select(*cols, F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    rows = both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    counts = rows.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.withColumn("percent_of_total", F.round(F.col("count") * 100.0 / total, 2))


def audit_row(compared: DataFrame, model: str, baseline: str, columns_compared: int = 1) -> DataFrame:
    """One audit-log row out of a :func:`compare_queries` result."""
    n = F.col("count")

    def total(a: bool, b: bool) -> Column:
        return F.coalesce(F.sum(F.when((F.col("in_a") == a) & (F.col("in_b") == b), n)), F.lit(0))

    sums = compared.agg(total(True, True).alias("m"), total(False, True).alias("missing_from_a"), total(True, False).alias("missing_from_b"))
    rows = F.col("m") + F.col("missing_from_a") + F.col("missing_from_b")
    return sums.select(
        F.lit(model).alias("model_name"),
        F.lit(baseline).alias("baseline_description"),
        rows.alias("rows_compared"),
        F.lit(columns_compared).alias("columns_compared"),
        F.try_divide(F.col("m") * 100.0, rows).alias("perfect_match_pct"),
        F.lit(0).cast("long").alias("conflicting_values"),
        "missing_from_a",
        "missing_from_b",
    )


def _side_by_side(a: DataFrame, b: DataFrame, pk: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Full join on the key with each side's columns packed."""

    def packed(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"{side}_{i}") for i, k in enumerate(pk)], F.struct(*[F.col(f"`{c}`") for c in cols]).alias(side)
        )

    left, right = packed(a, "a"), packed(b, "b")
    cond = F.lit(True)
    for i in range(len(pk)):
        c = F.col(f"a_{i}") == F.col(f"b_{i}")
        cond = c if i == 0 else cond & c
    return left.join(right, cond, "full")


def compare_all_columns(a: DataFrame, b: DataFrame, pk: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Match counts for every column from one join and one aggregation."""
    cols = [c for c in a.columns if c not in set(exclude)]
    in_a, in_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    both = in_a & in_b

    def n(cond: Column, name: str) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).alias(name)

    per = []
    for c in cols:
        x, y = F.col(f"a.`{c}`"), F.col(f"b.`{c}`")
        per.append(
            F.struct(
                F.lit(c).alias("column_name"),
                n(both & x.eqNullSafe(y), "perfect_match"),
                n(in_a & x.isNull(), "null_in_a"),
                n(in_b & y.isNull(), "null_in_b"),
                n(~in_a, "missing_from_a"),
                n(~in_b, "missing_from_b"),
                n(both & ~x.eqNullSafe(y), "conflicting_values"),
            )
        )
    return _side_by_side(a, b, pk, cols).agg(F.array(*per).alias("per")).select(F.inline("per"))


def compare_column_values(a: DataFrame, b: DataFrame, pk: Sequence[str], column: str) -> DataFrame:
    """Rows per match status of one column, with percentages."""
    x, y = F.col("a.v"), F.col("b.v")
    left, right = a.select(*pk, F.col(column).alias("v")), b.select(*pk, F.col(column).alias("v"))
    status = (
        F.when(F.col("a").isNull(), "missing from a")
        .when(F.col("b").isNull(), "missing from b")
        .when(x.isNull() & y.isNull(), "both are null")
        .when(x.isNull(), "value is null in a only")
        .when(y.isNull(), "value is null in b only")
        .when(x == y, "perfect match")
        .otherwise("values do not match")
    )
    counts = _side_by_side(left, right, pk, ["v"]).groupBy(status.alias("match_status")).agg(F.count(F.lit(1)).alias("count_records"))
    total = counts.agg(F.sum("count_records").alias("t")).scalar()
    return counts.select(F.lit(column).alias("column_name"), "match_status", "count_records", F.round(F.col("count_records") * 100.0 / total, 2).alias("percent_of_total"))


def compare_row_counts(a: DataFrame, b: DataFrame, a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Row counts of both sides."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("total_records")).select(F.lit(name).alias("relation_name"), "total_records")
    return one(a, a_name).union(one(b, b_name))


def without_rows(df: DataFrame, failing: DataFrame, row_id: str) -> DataFrame:
    """The table without the failing rows, by row id. Nothing is deleted in place."""
    return df.join(failing.select(row_id).where(F.col(row_id).isNotNull()).distinct(), row_id, "left_anti")


def without_duplicates(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """The table with the smallest row id kept per key."""
    return dedup_latest(df, keys, [F.col(row_id).asc()])


def rows_to_remove(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Row ids a uniqueness clean-up would remove: all but the smallest per key."""
    kept = without_duplicates(df, keys, row_id).select(row_id)
    return df.select(row_id).join(kept, row_id, "left_anti")


# Test name prefixes, longest first.
TEST_TYPES = ("unique_combination_of_columns", "accepted_values", "accepted_range", "relationships", "not_null", "unique")


def failure_report(failures: dict[str, DataFrame], sample_rows: int = 50) -> DataFrame:
    """Per stored failure table: count and rows as JSON, with type and model from its name.

    ``sample_rows`` bounds the rows that are packed into one text; they are the first in order.
    """
    out = None
    kinds = "|".join(TEST_TYPES)
    for name, df in failures.items():
        total = df.agg(F.count(F.lit(1)).alias("n"))
        first = df.select(F.struct("*").alias("r")).orderBy("r").limit(sample_rows)
        packed = first.agg(F.to_json(F.sort_array(F.collect_list("r"))).alias("j"))
        one = total.select(F.lit(name).alias("test_name"), F.col("n").alias("failure_count"), packed.scalar().alias("rows_json"))
        out = one if out is None else out.unionByName(one)
    rx = f"^(?:[a-z]+_utils_)?({kinds})_(.*)$"
    return out.select(
        "test_name",
        F.nullif(F.regexp_extract("test_name", rx, 1), F.lit("")).alias("test_type"),
        F.nullif(F.regexp_extract("test_name", rx, 2), F.lit("")).alias("tested"),
        "failure_count",
        "rows_json",
    )
