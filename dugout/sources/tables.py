"""Stored tables, merge by key, logs, seeds and catalog scans.

A table is a folder of parquet versions; the newest version with a success marker is
current, so a reader never sees a half-written one and a lost executor or driver
leaves the old version in place. Merges write a whole new version. Appends write a
folder of their own per batch beside the version they belong to.
"""

from __future__ import annotations

import fnmatch
import functools
import operator
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import dedup_latest


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], newest: Sequence[Column] | None = None) -> DataFrame:
    """Target rows whose key is not updated, plus the updates (one per key).

    Columns new in the updates are added to the target as NULL and the other way round.
    ``newest`` orders updates of one key; without it a key that is updated twice with
    different rows fails, and equal rows count once.
    """
    ups = dedup_latest(updates, list(keys), list(newest)) if newest else unique_updates(updates, keys)
    ids = ups.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_u_{k}"))
        cond = c if i == 0 else cond & c
    kept = target.join(ids, cond, "left_anti")
    return kept.unionByName(ups, allowMissingColumns=True)


def unique_updates(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct updates; raises where one key has different rows, which only an order could decide."""
    rest = [c for c in updates.columns if c not in keys]
    one = F.when(F.count_distinct(F.xxhash64(*rest)) > 1, F.raise_error(F.lit("several different updates of one key: give their order"))) if rest else F.lit(None)
    first = [F.first(F.struct(*rest)).alias("_row")] if rest else []
    out = updates.groupBy(*keys).agg(*first, one.isNull().alias("_one")).where("_one")
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in updates.columns])


def insert_missing(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key the target does not have; nothing is overwritten."""
    return candidates.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def sync_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Projection of ``df`` to the columns and types of ``like``; missing ones are NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def high_water(df: DataFrame, column: str) -> object:
    """Largest value of a column as a driver-side literal, so that filters on it push down."""
    return df.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark: object, strict_empty: bool = False) -> DataFrame:
    """Rows past a high-water mark. With no mark everything is new, unless
    ``strict_empty`` asks for the comparison with NULL, which selects nothing."""
    if mark is None:
        return df.where(F.lit(False)) if strict_empty else df
    return df.where(F.col(column) > F.lit(mark))


def replace_groups(target: DataFrame, touched: DataFrame, rebuilt: DataFrame, in_target: dict[str, Column]) -> DataFrame:
    """Target without the rows of touched groups, plus the rebuilt ones.

    ``in_target``: group column -> its value in a target row. Rows that no longer qualify
    go with their group; NULL group values match each other.
    """
    marks = {f"_g_{i}": g for i, g in enumerate(in_target)}
    groups = touched.select(*[F.col(g).alias(m) for m, g in marks.items()]).distinct()
    same = [in_target[g].eqNullSafe(F.col(m)) for m, g in marks.items()]
    kept = target.join(groups, functools.reduce(operator.and_, same), "left_anti")
    return kept.unionByName(rebuilt, allowMissingColumns=True)


def in_groups(source: DataFrame, touched: DataFrame, group: Sequence[str]) -> DataFrame:
    """Source rows of the touched groups, NULL group values included."""
    groups = touched.select(*[F.col(g).alias(f"_g_{i}") for i, g in enumerate(group)]).distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_g_{i}")) for i, g in enumerate(group)]
    return source.join(groups, functools.reduce(operator.and_, same), "left_semi")


class TableStore:
    """Named parquet tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _list(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _versions(self, name: str) -> list[int]:
        found = [int(m.group(1)) for n in self._list(f"{self.root}/{name}") if (m := re.fullmatch(r"v(\d+)", n))]
        return sorted(v for v in found if "_SUCCESS" in self._list(f"{self.root}/{name}/v{v:06d}"))

    def tables(self) -> list[str]:
        return sorted(n for n in self._list(self.root) if not n.startswith(("_", ".")) and self._versions(n))

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def path(self, name: str) -> str:
        versions = self._versions(name)
        if not versions:
            raise KeyError(f"no table {name!r} under {self.root}")
        return f"{self.root}/{name}/v{versions[-1]:06d}"

    def read(self, name: str) -> DataFrame:
        """The current version and the finished batches appended to it."""
        version = self.path(name)
        label = version.rpartition("/")[2]
        batches = [n for n in self._list(f"{self.root}/{name}") if n.startswith(f"{label}_") and "_SUCCESS" in self._list(f"{self.root}/{name}/{n}")]
        df = self.spark.read.parquet(version)
        for n in sorted(batches):
            df = df.unionByName(self.spark.read.parquet(f"{self.root}/{name}/{n}"), allowMissingColumns=True)
        return df

    def _next(self, name: str) -> str:
        taken = [int(m.group(1)) for n in self._list(f"{self.root}/{name}") if (m := re.match(r"v(\d+)", n))]
        return f"{self.root}/{name}/v{max(taken, default=0) + 1:06d}"

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Full rebuild as a new version."""
        w = df.write.mode("error")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(self._next(name))
        return self.read(name)

    def append(self, name: str, df: DataFrame, batch: str | None = None) -> DataFrame:
        """Adds rows in a folder of their own; a batch that comes again replaces itself."""
        if not self.exists(name):
            self.overwrite(name, df.limit(0))
        df.write.mode("overwrite").parquet(f"{self.path(name)}_{batch or uuid.uuid4().hex}")
        return self.read(name)

    def merge(
        self,
        name: str,
        updates: DataFrame,
        keys: Sequence[str],
        newest: Sequence[Column] | None = None,
        partition_by: str | None = None,
        full_refresh: bool = False,
    ) -> DataFrame:
        """Upsert by key into a new version, laid out by ``partition_by``."""
        parts = [partition_by] if partition_by else []
        if full_refresh or not self.exists(name):
            ups = dedup_latest(updates, list(keys), list(newest)) if newest else unique_updates(updates, keys)
            return self.overwrite(name, ups, parts)
        return self.overwrite(name, merge_upsert(self.read(name), updates, keys, newest), parts)

    def keep_children(self, name: str, parent: DataFrame, key: str) -> DataFrame:
        """Rewrites a child table without rows whose parent key is gone."""
        return self.overwrite(name, self.read(name).join(parent.select(key).distinct(), key, "left_semi"))

    def quarantine(self, test: str, failing: DataFrame) -> DataFrame:
        """Stores a test's failing rows under ``failures__<test>``."""
        return self.overwrite(f"failures__{test}", failing)

    def log(self, name: str, rows: DataFrame) -> DataFrame:
        """Appends to a log table (runs, tests, audits, events)."""
        return self.append(name, rows.withColumn("logged_at", F.current_timestamp()))

    def counted_step(self, step: str, name: str, write) -> DataFrame:
        """Runs a write and logs row counts before and after and the rows added."""
        before = self.read(name).count() if self.exists(name) else 0
        self.log("event_log", self.spark.createDataFrame([(step, name, "start")], "step string, table_name string, event string"))
        write()
        after = self.read(name).count()
        self.log("event_log", self.spark.createDataFrame([(step, name, "end")], "step string, table_name string, event string"))
        row = self.spark.createDataFrame(
            [(step, name, before, after, after - before)],
            "step string, table_name string, row_count_start long, row_count_end long, records_added long",
        )
        self.log("row_counts", row)
        return row


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV seed with a header and an explicit schema."""
    return spark.read.schema(schema).csv(path, header=True)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small literal relation. As VALUES its size is known to the planner, unlike rows
    handed over from Python, so joins with it are broadcast without a hint."""
    fields = [f.strip().split() for f in schema.split(",")]

    def text(v: object) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
    names = ", ".join(n for n, _ in fields)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def _like(pattern: str):
    rx = re.compile(fnmatch.translate(pattern.replace("%", "*").replace("_", "?")), re.IGNORECASE)
    return rx.match


def tables_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "") -> list[str]:
    """Catalog tables whose schema and name match LIKE patterns (any case)."""
    in_schema, in_table = _like(schema_pattern), _like(table_pattern)
    left_out = _like(exclude) if exclude else (lambda _: None)
    out = []
    for db in spark.catalog.listDatabases():
        if in_schema(db.name):
            for t in spark.catalog.listTables(db.name):
                if not t.isTemporary and in_table(t.name) and not left_out(t.name):
                    out.append(f"{db.name}.{t.name}")
    return sorted(out)


def tables_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    """Catalog tables of a schema whose name starts with a prefix."""
    return tables_by_pattern(spark, schema, prefix + "%", exclude)


def relations(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    """DataFrames of catalog tables, ready for a union."""
    return {n: spark.table(n) for n in names}
