"""Parquet datasets laid out by one column and changed partition by partition.

A dataset is a folder as Spark's partitioned writer leaves it. A change finds the
partitions that hold old rows of the keys and those that new rows go to, by a scan of the
key columns; only those partitions are read whole, and dynamic partition overwrite writes
them anew. What is written is stored under the checkpoint folder first, so a change that
breaks off is repeated from its inputs and gives the same dataset: keys that moved are found
in both their places again.

The list of touched partitions is all that the driver holds; it grows with the layout, not
with the rows. Readers that need a stable view read between changes.
"""

from __future__ import annotations

import functools
import operator
import tempfile
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import dedup_latest
from .tables import in_groups, merge_upsert, replace_groups, unique_updates

_FOLDER = "_folder"
_LOCAL: dict[str, str] = {}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that ``spark.checkpoint.dir`` names; on a plain local master without it, under a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="work-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in a new work folder."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, path: str, like: T.StructType | None = None) -> DataFrame | None:
    """The dataset, or None where there is none yet.

    ``like`` gives the types (a partition column of digits stays text) and further columns,
    which older files do not have and give as NULL.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if like is None:
        return found
    wanted = {f.name: f for f in like}
    fields = [wanted.pop(f.name, f) for f in found.schema]
    nullable = [T.StructField(f.name, f.dataType, True) for f in [*fields, *wanted.values()]]
    return spark.read.schema(T.StructType(nullable)).parquet(path)


def write(df: DataFrame, path: str, by: str) -> None:
    """A new dataset; adaptive execution sets the files of a partition by its size."""
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def in_partitions(df: DataFrame, by: str, values: Sequence) -> DataFrame:
    """Rows of some partitions, by literals that prune the file scan."""
    some = [v for v in values if v is not None]
    found = F.col(by).isin(some) if some else F.lit(False)
    return df.where(found | F.col(by).isNull() if len(some) < len(values) else found)


def _places(df: DataFrame, by: str, keys: Sequence[str]) -> DataFrame:
    """Keys, partition value and partition folder (an encoded URI) of the rows of a dataset."""
    return df.select(*dict.fromkeys([*keys, by]), F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias(_FOLDER))


def overwrite_partitions(rows: DataFrame, path: str, by: str, before: dict) -> None:
    """Puts ``rows`` (stored) in place of all rows of their partitions, and of those of ``before`` (value -> folder's URI).

    A partition without rows left keeps its folder and one empty file.
    """
    rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    left = {r[0] for r in rows.select(by).distinct().collect()}
    for value, folder in before.items():
        if value not in left:
            rows.where(F.lit(False)).drop(by).coalesce(1).write.mode("overwrite").parquet(unquote(folder))


def _touched(target: DataFrame, ups: DataFrame, keys: Sequence[str], by: str) -> tuple[list, dict]:
    """Values of the partitions a change touches, and the folders of those that hold old rows of its keys."""
    was = in_groups(_places(target, by, keys), ups, keys).select(by, _FOLDER).distinct().collect()
    before = {r[by]: r[_FOLDER] for r in was}
    now = [r[by] for r in ups.select(by).distinct().collect()]
    return list(dict.fromkeys([*before, *now])), before


def merge(path: str, updates: DataFrame, keys: Sequence[str], by: str, newest: Sequence[Column] | None = None) -> DataFrame:
    """Upserts by key, rewriting only the partitions that had or get rows of the updated keys.

    With ``newest`` the first row in that order stays, stored rows included, so an update
    that arrives late does not undo a newer one; without it updates win and have to be one a
    key. NULL keys equal each other.
    """
    spark = updates.sparkSession
    ups = written(first_rows(updates, keys, newest) if newest else unique_updates(updates, keys), "merge-updates")
    target = read(spark, path, ups.schema)
    if target is None:
        write(ups, path, by)
        return read(spark, path, ups.schema)
    values, before = _touched(target, ups, keys, by)
    affected = in_partitions(target, by, values)
    merged = first_rows(affected.unionByName(ups, allowMissingColumns=True), keys, newest) if newest else merge_upsert(affected, ups, keys)
    overwrite_partitions(written(merged, "merge-rows"), path, by, before)
    return read(spark, path, ups.schema)


def first_rows(rows: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """The first row of each key; rows that are equal in that order are told apart by their content."""
    return dedup_latest(rows, list(keys), [*newest, F.xxhash64(*rows.columns)])


def replace_in_partitions(path: str, touched: DataFrame, rebuilt: DataFrame, group: Sequence[str], by: str) -> DataFrame:
    """Puts the rebuilt rows of the touched groups in place of their old ones; other partitions stay as they are.

    ``touched`` has the columns ``group`` and ``by``: a group lies in one partition. Groups
    without rebuilt rows go.
    """
    spark = rebuilt.sparkSession
    target = read(spark, path, rebuilt.schema)
    if target is None:
        write(rebuilt, path, by)
        return read(spark, path, rebuilt.schema)
    values = [r[by] for r in touched.select(by).distinct().collect()]
    old = in_partitions(target, by, values)
    before = {r[by]: r[_FOLDER] for r in _places(old, by, []).distinct().collect()}
    rows = replace_groups(old, touched, rebuilt, {g: F.col(g) for g in group})
    overwrite_partitions(written(rows, "replace-rows"), path, by, before)
    return read(spark, path, rebuilt.schema)


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of all pairs."""
    return functools.reduce(operator.and_, [a.eqNullSafe(b) for a, b in zip(left, right)])
