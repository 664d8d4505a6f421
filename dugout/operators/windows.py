"""Ordered computations that stay spread out when one key holds most rows.

A plain window puts every row of a key into one task. Where the caller states a ``chunk``
(a non-decreasing function of the leading order column, such as the day of a timestamp),
each key's ordered rows are cut into chunks, each chunk is aggregated map-side, the prefix
of the small per-chunk totals is carried forward and added to the rows as one extra "carry"
row per (key, chunk). Rows are shuffled once, on (key, chunk). The plan is the same for
every size and making it runs no job. Without a chunk the plan is the plain window, for
groups whose size their grain bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ColumnLike, as_col
from .keys import keyed_join

CHUNK = "_chunk"
SET_ID = "_set_id"
#: Least number of tasks that share the rows of many splits.
SPREAD_TASKS = 200

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def value_chunk(df: DataFrame, order: str, steps: int = 256) -> Column:
    """Chunk of an order column by its type: never decreasing in the value, NULL first, NaN after infinity.

    Numbers: ``steps`` chunks a doubling, so the grain follows the magnitude. Timestamps:
    the minute. Dates: the day. Texts: the first four characters. A finer grain is the
    caller's to state.
    """
    c, kind = F.col(order), df.schema[order].dataType
    if isinstance(kind, T.NumericType):
        v = c.cast("double")
        grown = F.floor(F.signum(v) * F.log2(1 + F.abs(v)) * steps)
        endless = F.when(F.isnan(v), F.lit(2**63 - 1)).when(v == float("inf"), F.lit(2**63 - 2))
        chunk = endless.otherwise(grown.cast("long"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        chunk = F.date_trunc("MINUTE", c)
    elif isinstance(kind, T.StringType):
        chunk = F.substring(c, 1, 4)
    else:
        chunk = c
    return chunk


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each
    task sends at most one row per key and a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_name: str | None = None) -> DataFrame:
    """First n rows per key (also limited before the shuffle)."""
    name = rank_name or "_rn"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank_name else out.drop(name)


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows that share the first place of their key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1).drop("_rk")


def first_last(order: Sequence[ColumnLike], firsts: dict[str, ColumnLike], lasts: dict[str, ColumnLike]) -> tuple[Column, Column]:
    """Aggregates holding the first and the last values of a group as structs ``_first``/``_last``.

    NULL values are kept, because the whole struct is picked by the order.
    """
    by = F.struct(*[as_col(c) for c in order])
    first = F.min_by(F.struct(*[as_col(c).alias(n) for n, c in firsts.items()]), by).alias("_first")
    last = F.max_by(F.struct(*[as_col(c).alias(n) for n, c in lasts.items()]), by).alias("_last")
    return first, last


def running(
    df: DataFrame,
    splits: dict[str, Sequence[str]],
    order: Sequence[str],
    measures: dict[str, tuple[str, str, Column]],
    chunk: Column | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Running aggregates from the start of each group up to the row.

    splits: name -> key columns. measures: output -> (split, "sum"|"max"|"min", value).
    order: ascending columns, unique within each group. chunk: non-decreasing function
    of the leading order column; None keeps each group in one task (for groups whose size
    is bounded by their grain). spread: keys common to all splits; one exchange on them
    (and the chunk) then serves every split's window.
    """
    order = list(order)
    bases: dict[str, tuple[str, Column]] = {}
    base_of: dict[str, str] = {}
    seen: dict[tuple[str, int], str] = {}
    for name, (_, how, value) in measures.items():
        b = seen.setdefault((how, id(value)), f"_v{len(seen)}")
        bases[b], base_of[name] = (how, value), b
    rows = df.withColumns({b: value for b, (_, value) in bases.items()})

    if chunk is None:
        if spread:
            # Every split sorts a task's rows once more, so tasks stay small: their number is stated, and they are not put together.
            tasks = max(SPREAD_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            rows = rows.repartition(tasks, *spread)
        out = {}
        for name, (split, how, _) in measures.items():
            w = Window.partitionBy(*splits[split]).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            out[name] = _AGGREGATES[how](base_of[name]).over(w)
        return rows.withColumns(out).drop(*bases)

    rows = rows.withColumn(CHUNK, chunk)
    keys = list(dict.fromkeys(k for ks in splits.values() for k in ks))
    cols = [*keys, CHUNK]
    set_id = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c != CHUNK and c not in ks) for s, ks in splits.items()}
    aggs = [_AGGREGATES[how](b).alias(b) for b, (how, _) in bases.items()]
    if len(splits) == 1:
        totals = rows.groupBy(*cols).agg(*aggs).withColumn(SET_ID, F.lit(0).cast("long"))
    else:
        sets = [[F.col(c) for c in cols if c == CHUNK or c in ks] for ks in splits.values()]
        totals = rows.groupingSets(sets, *cols).agg(F.grouping_id().cast("long").alias(SET_ID), *aggs)
    before = Window.partitionBy(SET_ID, *keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.withColumn("_earlier", F.count(F.lit(1)).over(before))
        .select(*cols, SET_ID, "_earlier", *[_AGGREGATES[how](b).over(before).alias(b) for b, (how, _) in bases.items()])
        .where("_earlier > 0")
        .drop("_earlier")
    )
    both = rows.withColumn(SET_ID, F.lit(None).cast("long")).unionByName(carry, allowMissingColumns=True)
    if spread:
        both = both.repartition(*spread, CHUNK)
    is_row = F.col(SET_ID).isNull()
    out = {}
    for name, (split, how, _) in measures.items():
        w = Window.partitionBy(*splits[split], CHUNK).orderBy(is_row, *order).rowsBetween(Window.unboundedPreceding, 0)
        mine = is_row | (F.col(SET_ID) == set_id[split])
        out[name] = _AGGREGATES[how](F.when(mine, F.col(base_of[name]))).over(w)
    return both.withColumns(out).where(is_row).drop(SET_ID, CHUNK, *bases)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: dict[str, ColumnLike], chunk: Column | None = None
) -> DataFrame:
    """Running sums of several measures over one partitioning."""
    return running(df, {"all": keys}, order, {n: ("all", "sum", as_col(c)) for n, c in measures.items()}, chunk)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: dict[str, ColumnLike], chunk: Column | None = None
) -> DataFrame:
    """Running maxima of several measures over one partitioning."""
    return running(df, {"all": keys}, order, {n: ("all", "max", as_col(c)) for n, c in measures.items()}, chunk)


def neighbor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, ColumnLike],
    lead: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Value of the previous (or next) row of the key in ascending order, NULL at the end."""
    keys, order = list(keys), list(order)
    move = F.lead if lead else F.lag
    packed = F.struct(*[as_col(c).alias(n) for n, c in values.items()])
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        moved = df.withColumn("_near", move(packed).over(w))
    else:
        rows = df.withColumns({CHUNK: chunk, "_packed": packed})
        by = F.struct(*order)
        edge = F.min_by("_packed", by) if lead else F.max_by("_packed", by)
        ends = rows.groupBy(*keys, CHUNK).agg(edge.alias("_packed"))
        w = Window.partitionBy(*keys).orderBy(CHUNK)
        carry = ends.withColumn("_packed", move("_packed").over(w)).where(F.col("_packed").isNotNull())
        both = rows.withColumn("_is_row", F.lit(True)).unionByName(
            carry.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
        )
        place = F.col("_is_row").desc() if lead else F.col("_is_row").asc()
        w = Window.partitionBy(*keys, CHUNK).orderBy(place, *order)
        moved = both.withColumn("_near", move("_packed").over(w)).where("_is_row").drop(CHUNK, "_packed", "_is_row")
    return moved.withColumns({n: F.col(f"_near.{n}") for n in values}).drop("_near")


def session_counter(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str, chunk: Column | None = None
) -> DataFrame:
    """Number of start rows seen so far: an id for each run between starts."""
    return running_sum(df, keys, order, {name: F.when(starts, 1).otherwise(0)}, chunk)


def share_of_total(df: DataFrame, keys: Sequence[str], measure: str, name: str, digits: int = 3) -> DataFrame:
    """Row measure over the key's total, in one pass.

    Meant for a finished aggregate, where the grain bounds the rows of a key.
    """
    total = F.sum(measure).over(Window.partitionBy(*keys))
    return df.withColumn(name, F.round(F.try_divide(F.col(measure).cast("double"), total.cast("double")), digits))


def moving_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, periods: int) -> DataFrame:
    """Mean and sample deviation of the ``periods`` rows before each row.

    Meant for one row per key and period, so a key's rows are bounded by the periods.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-periods, -1)
    return df.withColumns({f"{value}_moving_avg": F.avg(value).over(w), f"{value}_moving_stddev": F.stddev_samp(value).over(w)})


def lag_periods(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: ColumnLike, n: int, name: str) -> DataFrame:
    """Value n rows back; one row per key and period, as in :func:`moving_stats`."""
    return df.withColumn(name, F.lag(as_col(value), n).over(Window.partitionBy(*keys).orderBy(*order)))


def z_score(df: DataFrame, value: str, name: str) -> DataFrame:
    """Distance from the global mean in sample deviations; no single-task window."""
    stats = df.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))
    mean, dev = stats.select("m").scalar(), stats.select("s").scalar()
    return df.withColumn(name, F.try_divide(F.col(value) - mean, dev))


def exact_quantile(df: DataFrame, value: str, q: float, keys: Sequence[str] = (), name: str = "quantile", chunk: Column | None = None) -> DataFrame:
    """Exact interpolated quantile per key without holding a group in one task.

    Counts per value are summed up along the value order in chunks (``chunk``, by default
    by the type of the value); the two values around the wanted position are then picked by
    their cumulative counts.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_sum(counts, keys, [value], {"_upto": "_n"}, value_chunk(df, value) if chunk is None else chunk)
    totals = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    if keys:
        placed = keyed_join(upto, totals, keys, "inner", null_safe=keys)
    else:
        placed = upto.withColumn("_total", totals.scalar())
    at = (F.col("_total") - 1) * F.lit(float(q))
    lo, hi = F.floor(at), F.ceil(at)

    def covers(i: Column) -> Column:
        return (F.col("_upto") > i) & (F.col("_upto") - F.col("_n") <= i)

    v = F.col(value).cast("double")
    picked = placed.where(covers(lo) | covers(hi)).groupBy(*keys).agg(
        F.max(F.when(covers(lo), v)).alias("_lo"), F.max(F.when(covers(hi), v)).alias("_hi"), F.max(at - lo).alias("_w")
    )
    # Differences of infinite values are no numbers: a value that is met needs none.
    met = (F.col("_lo") == F.col("_hi")) | (F.col("_w") == 0)
    return picked.select(*keys, F.when(met, F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias(name))
