"""Keyed incremental maintenance by load.

Three forms cover the models: rows of new loads are built and merged by key; groups
touched by new loads are rebuilt whole and replaced; landed files are upserted per
micro-batch. A group is never updated from its new rows alone, so a refresh gives what
a full rebuild gives, also after out-of-order back-fills.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import not_in
from ..operators.keys import keyed_join
from ..operators.windows import dedup_latest, session_counter
from ..plans.intermediate import RECORD_SPLITS, SEASON_RECORDS, int_team_game_results_to_date
from ..sources.landing import LOAD_ID
from ..sources.tables import TableStore, high_water, in_groups, newer_than, replace_groups, unique_updates


def refresh_rows(
    store: TableStore,
    name: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    load_column: str = LOAD_ID,
    target_load: str = "load_id",
    partition_by: str | None = None,
    full_refresh: bool = False,
    strict_empty: bool = False,
) -> DataFrame:
    """Builds from loads past the target's high-water mark and merges by key.

    The mark is read first and used as a literal, so the filter reaches the file scan.
    """
    fresh = full_refresh or not store.exists(name)
    if not fresh:
        source = newer_than(source, load_column, high_water(store.read(name), target_load), strict_empty)
    return store.merge(name, build(source), keys, [F.col(target_load).desc()], partition_by, fresh)


def touched_groups(source: DataFrame, keys: Sequence[str], mark: object, load_column: str = "load_id") -> DataFrame:
    """Distinct groups with rows in newer loads."""
    return newer_than(source, load_column, mark).select(*keys).distinct()


def refresh_groups(
    store: TableStore,
    name: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    group: Sequence[str],
    keys: Sequence[str],
    load_column: str = "load_id",
    target_load: str | None = "load_id",
    partition_by: str | None = None,
    full_refresh: bool = False,
    touched: DataFrame | None = None,
    in_target: dict[str, Column] | None = None,
) -> DataFrame:
    """Rebuilds every group touched by newer loads from all of its rows and puts them in place of the old ones.

    A target without a load column (``target_load=None``) needs the ``touched`` groups
    from the caller: for team results the (home, away) pairs of new games, for running
    records the teams of new results. ``in_target`` tells a target row's group where the
    target does not have the group's columns.
    """
    order = [F.col(target_load).desc()] if target_load else None
    if full_refresh or not store.exists(name):
        return store.merge(name, build(source), keys, order, partition_by, True)
    target = store.read(name)
    if touched is None:
        touched = touched_groups(source, group, high_water(target, target_load), load_column)
    missing = [g for g in group if g not in target.columns and g not in (in_target or {})]
    if missing:
        raise ValueError(f"in_target has to tell {missing} of a target row")
    rebuilt = build(in_groups(source, touched, group))
    rebuilt = dedup_latest(rebuilt, list(keys), order) if order else unique_updates(rebuilt, keys)
    places = {g: (in_target or {}).get(g, F.col(g)) for g in group}
    return store.overwrite(name, replace_groups(target, touched, rebuilt, places), [partition_by] if partition_by else [])


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have (NULL keys count as new)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def not_yet_loaded(wanted: DataFrame, loaded: DataFrame | None, key: str) -> DataFrame:
    """Wanted ids that a raw table lacks: skip-if-loaded."""
    return wanted if loaded is None else not_in(wanted, [key], loaded)


def drop_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Children whose parent still exists."""
    return child.join(parent.select(key).distinct(), key, "left_semi")


def retry_rejected(source: DataFrame, target: DataFrame, keys: Sequence[str], fresh: DataFrame) -> DataFrame:
    """Rows of newer loads plus older rows that an inner join rejected earlier.

    A documented extra: a line whose game arrived late is picked up again.
    """
    return fresh.unionByName(new_rows(source, target, keys)).dropDuplicates(list(keys))


# ---- prior totals plus batch -------------------------------------------------------------------


def records_with_prior(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Running records of new games on top of the totals already stored.

    Kept for parity: it assumes every new game follows the stored ones. One small total
    per split is joined, NULL start hours included.
    """
    new = new_rows(batch, existing, ["game_pk", "team_id"])
    out = int_team_game_results_to_date(new)
    for split, keys in RECORD_SPLITS.items():
        sums = {}
        if split == "season":
            for name, (col, val) in SEASON_RECORDS.items():
                for word, r in (("wins", "W"), ("losses", "L")):
                    sums[f"{word}_to_date_{name}"] = (F.col(col) == val) & (F.col("result") == r)
        else:
            sums = {f"{w}_to_date_{split}": F.col("result") == r for w, r in (("wins", "W"), ("losses", "L"))}
        prior = existing.groupBy(*keys).agg(*[F.count_if(cond).alias(f"_p_{n}") for n, cond in sums.items()])
        joined = keyed_join(out, prior, keys, null_safe=("start_hour",))
        joined = joined.withColumns({n: F.col(n) + F.coalesce(f"_p_{n}", F.lit(0)) for n in sums})
        out = joined.drop(*[f"_p_{n}" for n in sums])
    return out


def series_with_prior(existing: DataFrame, batch: DataFrame, days: int = 14) -> DataFrame:
    """Series ids of a batch continued from the stored maximum of each (home, away) pair.

    Kept for parity with look-back loading: only stored games before the look-back window
    count as prior, so a rescanned game keeps its number.
    """
    start = existing.agg(F.date_sub(F.max("game_date"), days).alias("d")).scalar()
    prior = (
        existing.where((F.col("is_home") == 1) & (F.col("game_date") < start))
        .groupBy(F.col("team_id").alias("home_team_id"), F.col("opponent_team_id").alias("away_team_id"))
        .agg(F.max("series_id").alias("_prior"))
    )
    rows = batch.where(F.col("game_date") >= start)
    counted = session_counter(
        rows, ["home_team_id", "away_team_id"], ["game_date", "game_datetime", "game_pk"], F.col("series_game_number") == 1, "series_id"
    )
    joined = counted.join(prior, ["home_team_id", "away_team_id"], "left")
    return joined.withColumn("series_id", F.col("series_id") + F.coalesce("_prior", F.lit(0))).drop("_prior")


# ---- gates --------------------------------------------------------------------------------------


def yearly_due(table: DataFrame | None, year_column: str, today: dt.date | None = None) -> bool:
    """True when the newest year stored is before the current one (or nothing is stored)."""
    this_year = (today or dt.date.today()).year
    newest = None if table is None else table.agg(F.max(F.col(year_column).cast("string").try_cast("int"))).first()[0]
    return newest is None or newest < this_year


def refresh_needed(source: DataFrame, source_time: str, target: DataFrame, target_time: str) -> DataFrame:
    """One row: newest times of both sides and whether the source is ahead."""
    new = source.agg(F.max(source_time).alias("latest_source"))
    out = new.withColumn("latest_target", target.agg(F.max(target_time).alias("t")).scalar())
    ahead = F.col("latest_source").isNotNull() & (F.col("latest_target").isNull() | (F.col("latest_source") > F.col("latest_target")))
    return out.withColumn("refresh_needed", ahead)


# ---- micro-batches ------------------------------------------------------------------------------


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder named by the session for checkpoints; ``fallback`` only where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if fallback is None:
        raise ValueError("set spark.checkpoint.dir or pass a folder")
    return fallback


def _checkpoint_folder(spark: SparkSession, store: TableStore, landing_dir: str, name: str, fallback: str | None) -> str:
    """Folder of one (store, landing folder, table): the shared root may serve many."""
    owner = hashlib.md5(f"{store.root}|{landing_dir}".encode()).hexdigest()
    return f"{checkpoint_root(spark, fallback)}/streams/{owner}/{name}"


def stream_upsert(
    spark: SparkSession,
    landing_dir: str,
    schema: str,
    flatten: Callable[[DataFrame], DataFrame],
    store: TableStore,
    name: str,
    keys: Sequence[str],
    checkpoint: str | None = None,
    newest: Sequence[Column] | None = None,
    partition_by: str | None = None,
    files_per_batch: int = 1000,
):
    """Upserts landed JSON files into a table, one merge per micro-batch, until none is left.

    A batch that is repeated after a failure merges the same keys again, so the table
    does not change twice. Load ids go on from the target's, also with a new checkpoint.
    """
    base = _next_load(store, name)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing_dir)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = flatten(batch).withColumn(LOAD_ID, F.lit(f"{base + batch_id:012d}"))
        store.merge(name, rows, keys, newest or [F.col(LOAD_ID).desc()], partition_by)

    folder = _checkpoint_folder(spark, store, landing_dir, name, checkpoint)
    return source.writeStream.foreachBatch(upsert).option("checkpointLocation", folder).trigger(availableNow=True).start()


def _next_load(store: TableStore, name: str) -> int:
    """The load id after the target's newest numeric one."""
    if not store.exists(name) or LOAD_ID not in store.read(name).columns:
        return 0
    newest = store.read(name).agg(F.max(F.col(LOAD_ID).try_cast("long"))).first()[0]
    return 0 if newest is None else newest + 1


def append_batch(store: TableStore, name: str, rows: DataFrame, stream: str, batch_id: int, base: int) -> DataFrame:
    """Writes one batch of a stream to its own folder; a repeat replaces what a broken write left."""
    return store.append(name, rows.withColumn(LOAD_ID, F.lit(f"{base + batch_id:012d}")), f"{stream}_{batch_id:012d}")


def stream_append(spark: SparkSession, landing_dir: str, schema: str, flatten: Callable[[DataFrame], DataFrame], store: TableStore, name: str, checkpoint: str | None = None):
    """Appends landed files to an append-only table, each micro-batch in a folder of its own."""
    folder = _checkpoint_folder(spark, store, landing_dir, name, checkpoint)
    stream, base = hashlib.md5(folder.encode()).hexdigest()[:12], _next_load(store, name)
    source = spark.readStream.schema(schema).json(landing_dir)

    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(store, name, flatten(batch), stream, batch_id, base)

    return source.writeStream.foreachBatch(add).option("checkpointLocation", folder).trigger(availableNow=True).start()
