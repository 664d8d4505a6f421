"""Join shapes. No side is force-broadcast; sides that grow with the data are never broadcast."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ColumnLike, as_col
from .windows import running


def growing(df: DataFrame) -> DataFrame:
    """A join side with a row per game, team, player or pick: joined by sort and merge, never broadcast.

    Sizes of files and shuffles are those of compressed, unexploded rows; a table that looks small
    by them fills the driver and every task when it is broadcast as a hash table.
    """
    return df.hint("merge")


def lookup(
    fact: DataFrame, dim: DataFrame, on: dict[str, ColumnLike], take: dict[str, str], where: Column | None = None, grows: bool = False
) -> DataFrame:
    """Left lookup of a dimension in one of its roles.

    on: dimension column -> fact expression; take: output column -> dimension column;
    grows: the dimension grows with the data (see :func:`growing`).
    """
    dim_keys = {f"_k{i}": d for i, d in enumerate(on)}
    right = dim if where is None else dim.where(where)
    right = right.select(*[F.col(d).alias(k) for k, d in dim_keys.items()], *[F.col(c).alias(o) for o, c in take.items()])
    cond = F.lit(True)
    for i, (k, d) in enumerate(dim_keys.items()):
        c = as_col(on[d]) == F.col(k)
        cond = c if i == 0 else cond & c
    return fact.join(growing(right) if grows else right, cond, "left").drop(*dim_keys)


def conditional_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], accept: Column) -> DataFrame:
    """Left join whose match counts only when a predicate over both sides holds.

    ``accept`` refers to both sides' columns by name (they must not clash except keys); both
    sides grow with the data (see :func:`growing`).
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = accept
    for k in keys:
        cond = (F.col(k) == F.col(f"_r_{k}")) & cond
    return left.join(growing(renamed), cond, "left").withColumn("_matched", F.col(f"_r_{keys[0]}").isNotNull()).drop(*[f"_r_{k}" for k in keys])


def date_in_range(df: DataFrame, date_col: str, ranges: DataFrame, start: str, end: str, take: Sequence[str]) -> DataFrame:
    """Left join of dates to date ranges: an equi-join on the months a range touches, then the exact test."""
    month = lambda d: F.year(d) * 12 + F.month(d)
    spread = ranges.where(F.col(end) >= F.col(start)).select(F.col(start).alias("_from"), F.col(end).alias("_to"), *take)
    spread = spread.withColumn("_month", F.explode(F.sequence(month("_from"), month("_to"))))
    inside = (month(df[date_col]) == F.col("_month")) & df[date_col].between(F.col("_from"), F.col("_to"))
    return df.join(spread, inside, "left").drop("_month", "_from", "_to")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    take: dict[str, str],
    left_id: Sequence[str],
    strict: bool = False,
    not_before: Column | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Latest right row of the key at (or, ``strict``, before) the left time; NULLs when none.

    Both sides go into one stream ordered by time; the running maximum of
    (right time, values) is the as-of row. No pairs are formed. ``left_id`` makes the
    order unique; ``not_before`` drops matches older than an expression over the left
    row; ``chunk`` is an expression over ``_time`` that cuts each key's rows.
    """
    keys = list(keys)
    payload = F.struct(F.col(right_time).alias("_rt"), *[F.col(c).alias(o) for o, c in take.items()])
    r = right.where(F.col(right_time).isNotNull()).select(*keys, F.col(right_time).alias("_time"), F.lit(1 if strict else 0).alias("_side"), payload.alias("_pay"))
    lft = left.withColumns({"_time": F.col(left_time), "_side": F.lit(0 if strict else 1)})
    both = lft.unionByName(r, allowMissingColumns=True)
    out = running(both, {"k": keys}, ["_time", "_side", *left_id], {"_asof": ("k", "max", F.col("_pay"))}, chunk)
    out = out.where(F.col("_side") == (0 if strict else 1))
    ok = F.lit(True) if not_before is None else F.col("_asof._rt") >= not_before
    return out.withColumns({o: F.when(ok, F.col(f"_asof.{o}")) for o in take}).drop("_time", "_side", "_pay", "_asof")


def version_at(
    fact: DataFrame,
    versions: DataFrame,
    on: dict[str, ColumnLike],
    at: str,
    valid: tuple[str, str],
    take: dict[str, str],
    row_id: Sequence[str],
    clean: Callable[[Column], Column] = lambda c: c,
    chunk: Column | None = None,
) -> DataFrame:
    """Left lookup of the dimension version that is valid at the day of a fact row.

    on: version column -> fact expression, both passed through ``clean`` before they are
    compared; ``valid``: first and last day of a version (an unknown last day is open);
    take: output column -> version column. Versions of a key do not overlap, so the latest
    one begun is the only candidate: one ordered stream of both sides finds it, without
    pairs. ``chunk`` (an expression over ``_time``, such as the year) cuts the rows of a
    hot key; ``row_id`` tells fact rows apart.
    """
    keys = {f"_version_key{i}": (v, f) for i, (v, f) in enumerate(on.items())}
    first, last = valid
    known = versions.select(*[clean(F.col(v)).alias(k) for k, (v, _) in keys.items()], F.col(first).alias("_first"), F.struct(F.col(last).alias("end"), F.struct(*[F.col(c).alias(o) for o, c in take.items()]).alias("take")).alias("_version"))
    rows = fact.withColumns({k: clean(as_col(f)) for k, (_, f) in keys.items()})
    found = asof_join(rows, known, list(keys), at, "_first", {"_version": "_version"}, row_id, chunk=chunk)
    open_ = F.col("_version.end").isNull() | (F.col("_version.end") >= F.col(at))
    return found.withColumns({o: F.when(open_, F.col(f"_version.take.{o}")) for o in take}).drop("_version", "_first", *keys)


def not_in(df: DataFrame, keys: Sequence[str], other: DataFrame) -> DataFrame:
    """Rows whose keys do not occur in the other relation (NULL keys there are ignored)."""
    return df.join(other.select(*keys).na.drop(), list(keys), "left_anti")


def members_of(df: DataFrame, candidates: Sequence[str], member: str) -> DataFrame:
    """Distinct values that occur in any of several columns, without an OR join."""
    return df.select(F.explode(F.array(*candidates)).alias(member)).where(F.col(member).isNotNull()).distinct()
