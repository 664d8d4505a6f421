"""Refreshes that follow late and repeated loads: groups of a stream and stored totals.

All of them work on partitioned datasets (:mod:`..sources.partitioned`) and rewrite only
the partitions they touch. Each step may be repeated: history is merged by key, the row that
is newest by the caller's order stays whenever it arrives, groups are rebuilt from history,
and totals change by the difference between the history before and after a batch, which a
repeat finds to be nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import partitioned
from ..sources.tables import in_groups
from .incremental import checkpoint_root

# ---- groups -------------------------------------------------------------------------------------


def refresh_groups_by_partition(
    history_path: str,
    target_path: str,
    batch: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    group: Sequence[str],
    by: str,
    newest: Sequence[Column],
) -> DataFrame:
    """Merges a batch into the history and rebuilds the groups it touches; returns the target.

    ``by`` is the partition column of both datasets and a function of the group. A row that
    a batch moves from one group to another touches both. ``build`` makes target rows from
    history rows of whole groups and keeps the columns ``group`` and ``by``. The target is
    written after the history, from the history alone: a batch that broke off between the
    two is repeated whole, and finds its groups by its keys again.
    """
    spark = batch.sparkSession
    rows = partitioned.written(batch, "refresh-batch")
    places = list(dict.fromkeys([*group, by]))
    touched = rows.select(*places)
    old = partitioned.read(spark, history_path, rows.schema)
    if old is not None:
        touched = touched.unionByName(in_groups(old, rows, keys).select(*places))
    touched = partitioned.written(touched.distinct(), "refresh-groups")
    history = partitioned.merge(history_path, rows, keys, by, newest)
    values = [r[by] for r in touched.select(by).distinct().collect()]
    rebuilt = build(in_groups(partitioned.in_partitions(history, by, values), touched, places))
    return partitioned.replace_in_partitions(target_path, touched, rebuilt, places, by)


def stream_group_refresh(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    prepare: Callable[[DataFrame], DataFrame],
    history_path: str,
    target_path: str,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    group: Sequence[str],
    by: str,
    newest: Sequence[Column],
    checkpoint: str | None = None,
    files_per_batch: int = 1000,
    file_format: str = "json",
):
    """Refreshes groups from landed files, micro-batch by micro-batch, until none is left.

    Files may come in any order, batches may be repeated and the query may be restarted:
    the target is what a rebuild from all files gives.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        refresh_groups_by_partition(history_path, target_path, prepare(batch), build, keys, group, by, newest)

    owner = hashlib.md5(f"{landing}|{history_path}|{target_path}".encode()).hexdigest()
    folder = f"{checkpoint_root(spark, checkpoint)}/streams/{owner}"
    source = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(landing)
    return source.writeStream.foreachBatch(refresh).option("checkpointLocation", folder).trigger(availableNow=True).start()


# ---- stored totals ------------------------------------------------------------------------------


def contributions(rows: DataFrame, group: Sequence[str], measures: dict[str, Column], sign: int = 1) -> DataFrame:
    """Totals per group, counted ``sign`` times, with the number of rows as ``n_rows``."""
    sums = [(F.sum(m) * sign).alias(n) for n, m in measures.items()]
    return rows.groupBy(*group).agg(*sums, (F.count(F.lit(1)) * sign).alias("n_rows"))


def added(totals: DataFrame, changes: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Totals after the changes; groups without rows go."""
    types = {f.name: f.dataType for f in totals.schema}
    sums = [F.sum(n).cast(types[n]).alias(n) for n in measures]
    return totals.unionByName(changes).groupBy(*group).agg(*sums).where("n_rows > 0")


def update_totals(
    history_path: str,
    totals_path: str,
    batch: DataFrame,
    keys: Sequence[str],
    group: Sequence[str],
    measures: dict[str, Column],
    by: str,
    newest: Sequence[Column],
) -> DataFrame:
    """Merges a batch into the history and adds to the stored totals what it changes; returns the totals.

    For each key of the batch its stored row is taken from its group's total and the row
    that stays is added, so a load that corrects earlier rows, moves them to another group
    or comes twice leaves the totals of a rebuild, and no group's other rows are read.
    Totals are written before the history, each with the mark of the batch it holds: where a
    batch broke off in between, its repeat leaves the groups that have it already. Measures
    are whole numbers or decimals, whose sums do not depend on the order.
    """
    spark = batch.sparkSession
    rows = partitioned.written(batch, "totals-batch")
    places, names = list(dict.fromkeys([*group, by])), [*measures, "n_rows"]
    stored = partitioned.read(spark, history_path, rows.schema)
    old = partitioned.written(rows.limit(0) if stored is None else in_groups(stored, rows, keys), "totals-before")
    stays = partitioned.first_rows(old.unionByName(rows, allowMissingColumns=True), keys, newest)
    signed = contributions(stays, places, measures).unionByName(contributions(old, places, measures, -1))
    change = signed.groupBy(*places).agg(*[F.sum(n).alias(n) for n in names])
    change = partitioned.written(change.where(" or ".join(f"{n} <> 0" for n in names)), "totals-change")
    mark = F.lit(batch_mark(rows))
    totals = partitioned.read(spark, totals_path, T.StructType([*change.schema, T.StructField("batch", T.StringType())]))
    if totals is None:
        partitioned.write(change.where("n_rows > 0").withColumn("batch", mark), totals_path, by)
    else:
        touched = [r[by] for r in change.select(by).distinct().collect()]
        held = in_groups(partitioned.in_partitions(totals, by, touched), change, places)
        has = held.where(F.col("batch") == mark).select(*[F.col(p).alias(f"_{p}") for p in places])
        open_ = change.join(has, partitioned.same([F.col(p) for p in places], [F.col(f"_{p}") for p in places]), "left_anti")
        new = added(held.drop("batch"), open_, places, names)
        partitioned.replace_in_partitions(totals_path, open_, in_groups(new, open_, places).withColumn("batch", mark), places, by)
    partitioned.merge(history_path, rows, keys, by, newest)
    return partitioned.read(spark, totals_path, change.schema)


def batch_mark(rows: DataFrame) -> str:
    """A text that tells batches of different rows apart, whatever the order of their rows."""
    h = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    n, total = rows.agg(F.count(F.lit(1)), F.sum(h)).first()
    return f"{n}:{total}"
