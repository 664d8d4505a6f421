"""Projection helpers, pivots, unions, spines and set comparison."""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ColumnLike, as_col, blank_to_null
from .windows import dedup_latest


def columns_except(df: DataFrame, drop: Iterable[str] = ()) -> list[str]:
    """Column names without the given ones (any case)."""
    out = {c.lower() for c in drop}
    return [c for c in df.columns if c.lower() not in out]


def star(df: DataFrame, drop: Iterable[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but the given ones, renamed with prefix and suffix."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in columns_except(df, drop)])


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Projection by a {new: old} mapping."""
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()])


def nullcheck(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty strings to NULL on the text columns (all, or the given ones)."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    wanted = text if cols is None else text & set(cols)
    return df.withColumns({c: blank_to_null(c) for c in df.columns if c in wanted}) if wanted else df


def typed(df: DataFrame, types: dict[str, str], lenient: bool = True) -> DataFrame:
    """Projection to declared types; with ``lenient`` a failed cast gives NULL."""
    return df.select(*[(F.col(c).try_cast(t) if lenient else F.col(c).cast(t)).alias(c) for c, t in types.items()])


def slug(text: str) -> str:
    """Lower-case identifier: blanks and dashes to underscores, other signs dropped."""
    s = re.sub(r"[ -]+", "_", text.lower())
    s = re.sub(r"[^a-z0-9_]+", "", s)
    return f"_{s}" if re.match(r"^[0-9]", s) else s


def column_values(
    df: DataFrame,
    column: str,
    where: Column | str | None = None,
    order: str = "count",
    max_values: int | None = None,
    default: list | None = None,
) -> list:
    """Distinct values of a column, most frequent first, for use as pivot columns.

    All of them, unless the caller asks for the first ``max_values``.
    """
    src = df if where is None else df.where(where)
    counts = src.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    by = [F.desc("n"), F.asc("v")] if order == "count" else [F.asc("v")]
    ordered = counts.orderBy(*by)
    if max_values:
        ordered = ordered.limit(max_values)
    return [r["v"] for r in ordered.collect()] or list(default or [])


_COMPARE = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def pivot(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    then_value: ColumnLike | float = 1,
    else_value: float | None = 0,
    prefix: str = "",
    suffix: str = "",
    distinct: bool = False,
    quote_names: bool = True,
    alias: bool = True,
) -> DataFrame:
    """One aggregated column per value, in a single pass over the rows."""
    aggs = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}
    then = F.lit(then_value) if isinstance(then_value, (int, float)) else as_col(then_value)
    outs = []
    for v in values:
        picked = F.when(_COMPARE[cmp](F.col(column), F.lit(v)), then)
        if else_value is not None:
            picked = picked.otherwise(F.lit(else_value))
        if distinct:
            measure = {"sum": F.sum_distinct, "count": F.count_distinct}[agg](picked)
        else:
            measure = aggs[agg](picked)
        name = f"{prefix}{v}{suffix}"
        if alias:
            measure = measure.alias(name if quote_names else slug(name))
        outs.append(measure)
    return df.groupBy(*group).agg(*outs)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to (field, value) rows; ``exclude`` stay as ids, ``remove`` disappear."""
    ids = [c for c in df.columns if c.lower() in {x.lower() for x in exclude}]
    wide = columns_except(df, [*exclude, *remove])
    cast = df.select(*ids, *[F.col(c).cast(cast_to).alias(c) for c in wide])
    return cast.unpivot(ids, wide, field_name, value_name)


def union_relations(
    relations: dict[str, DataFrame],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    column_override: dict[str, str] | None = None,
    source_column: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union by name over the superset of columns, tagged with the relation's name."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    keep = {c.lower() for c in include} if include else None
    drop = {c.lower() for c in exclude or ()}
    types: dict[str, T.DataType] = {}
    for df in relations.values():
        for f in df.schema.fields:
            name = f.name.lower()
            if (keep is None or name in keep) and name not in drop:
                if f.name not in types or isinstance(f.dataType, T.StringType):
                    types[f.name] = f.dataType
    override = column_override or {}
    out = None
    for name, df in relations.items():
        rows = df if where is None else df.where(where)
        have = set(df.columns)
        cols = [F.col(c) if c in have else F.lit(None) for c in types]
        part = rows.select(*[c.cast(override.get(n, t)).alias(n) for c, (n, t) in zip(cols, types.items())])
        if source_column:
            part = part.select(F.lit(name).alias(source_column), "*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no relations given")
    return out


def stacked_rows(df: DataFrame, alternatives: Sequence[dict[str, ColumnLike]], keep: Sequence[str]) -> DataFrame:
    """Several rows out of each input row in one scan (one per alternative)."""
    structs = [F.struct(*[as_col(c).alias(n) for n, c in alt.items()]) for alt in alternatives]
    return df.select(*keep, F.inline(F.array(*structs)))


def by_priority(sources: Sequence[DataFrame], name: str = "source_priority") -> DataFrame:
    """Union of sources tagged 1, 2, 3 ... in the given order."""
    out = None
    for i, df in enumerate(sources, 1):
        part = df.withColumn(name, F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return dedup_latest(df, partition_by, order_by)


def id_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct union of id sets."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def symmetric_difference(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """Rows in one side only, tagged; sets by default, with counts if ``multiset``."""
    cols = a.columns
    tagged = a.withColumn("_side", F.lit(1)).unionByName(b.select(*cols).withColumn("_side", F.lit(-1)))
    if multiset:
        more = tagged.groupBy(*cols).agg(F.sum("_side").alias("_more")).where("_more <> 0")
        rows = more.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_more")))).drop("_copy")
        return rows.withColumn("which_side", F.when(F.col("_more") > 0, "a").otherwise("b")).drop("_more")
    sides = tagged.groupBy(*cols).agg(F.max("_side").alias("_hi"), F.min("_side").alias("_lo")).where("_hi = _lo")
    return sides.withColumn("which_side", F.when(F.col("_hi") > 0, "a").otherwise("b")).drop("_hi", "_lo")


def generate_series(spark: SparkSession, n: int, name: str = "generated_number") -> DataFrame:
    """Numbers 1..n as a distributed range."""
    if n < 1:
        raise ValueError("n must be positive")
    return spark.range(1, n + 1).withColumnRenamed("id", name)


#: Steps of a spine that stand in one array.
SPINE_BLOCK = 4096
# The least seconds of a step, from which the number of steps is bounded.
_LEAST_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800, "month": 28 * 86_400, "quarter": 89 * 86_400, "year": 365 * 86_400}


def _step(part: str, i: Column, start: Column) -> Column:
    return F.timestamp_add(part.upper(), i, start)


def bounds_spine(bounds: DataFrame, part: str, start: str, end: str, name: str, keep: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """Times from start (inclusive) to end (exclusive) in steps of one part, per bounds row.

    A row becomes blocks of at most ``SPINE_BLOCK`` steps, so no array grows with the span;
    ``tasks`` deals the blocks over that many tasks.
    """
    a, b = F.col(start), F.col(end)
    # Whole steps between, and one more where a month is shorter than the day of the start.
    last = F.when(a < b, F.timestamp_diff(part.upper(), a, b) + 1)
    blocks = bounds.withColumn("_last", last).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / SPINE_BLOCK))))
    if tasks:
        blocks = blocks.repartition(tasks, *keep, "_block")
    low = F.col("_block") * SPINE_BLOCK
    steps = blocks.withColumn("_i", F.explode(F.sequence(low, F.least(F.col("_last"), low + SPINE_BLOCK - 1))))
    return steps.withColumn("_at", _step(part, F.col("_i"), a)).where(F.col("_at") < b).select(*keep, F.col("_at").alias(name))


def date_spine(spark: SparkSession, part: str, start: str, end: str) -> DataFrame:
    """Spine ``date_<part>`` over literal bounds, the end excluded: a distributed range of steps."""
    first, last = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end)
    most = max(1, math.ceil((last - first).total_seconds() / _LEAST_SECONDS[part]) + 1)
    name = f"date_{part}"
    at = _step(part, F.col("i") - 1, F.to_timestamp(F.lit(start)))
    out = generate_series(spark, most, "i").select(at.alias(name)).where(F.col(name) < F.to_timestamp(F.lit(end)))
    return out.withColumn(name, F.col(name).cast("date")) if part in ("day", "week", "month", "quarter", "year") else out
