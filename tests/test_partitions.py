"""Datasets changed partition by partition, ledgers of loads, groups of a stream, stored totals."""

from __future__ import annotations

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dugout.operators import windows
from dugout.sources import loads, partitioned
from dugout.streaming import refresh


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def folders(paths):
    return {p.split("/")[0] for p in paths}


def test_merge_rewrites_touched_partitions_only(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "id int, part string, v int"
    first = [(i, f"0{i % 4}", i) for i in range(40)]
    assert partitioned.read(spark, path) is None
    partitioned.merge(path, spark.createDataFrame(first, schema), ["id"], "part")
    before = files(path)
    got = partitioned.merge(path, spark.createDataFrame([(1, "01", 100), (2, "07", 200), (99, "08", 300)], schema), ["id"], "part")
    want = [r for r in first if r[0] not in (1, 2)] + [(1, "01", 100), (2, "07", 200), (99, "08", 300)]
    assert rows(got, "id", "part", "v") == sorted(want)
    # Partition 02 lost a key, 01 changed one; 00 and 03 keep their files.
    assert folders(before - files(path)) == {"part=01", "part=02"}
    assert folders(files(path) - before) == {"part=01", "part=02", "part=07", "part=08"}


def test_merge_empties_a_partition_and_adds_columns(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    partitioned.merge(path, spark.createDataFrame([(1, "a/b c"), (2, None), (3, "x")], "id int, part string"), ["id"], "part")
    moved = spark.createDataFrame([(1, "x", 7), (2, "x", 8)], "id int, part string, more int")
    for _ in range(2):  # a repeat changes nothing
        got = partitioned.merge(path, moved, ["id"], "part")
        assert rows(got, "id", "part", "more") == [(1, "x", 7), (2, "x", 8), (3, "x", None)]
    back = partitioned.merge(path, spark.createDataFrame([(2, None, 9), (None, "y", 1)], "id int, part string, more int"), ["id"], "part")
    assert rows(back, "id", "part", "more") == [(None, "y", 1), (1, "x", 7), (2, None, 9), (3, "x", None)]
    again = partitioned.merge(path, spark.createDataFrame([(None, "z", 2)], "id int, part string, more int"), ["id"], "part")
    assert rows(again.where("id is null"), "part", "more") == [("z", 2)]


def test_merge_after_a_break(spark, tmp_path, rows, monkeypatch):
    """A merge that broke after writing the new place of a key and before emptying the old one."""
    path, schema = str(tmp_path / "t"), "id int, part string"
    partitioned.merge(path, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["id"], "part")
    ups = spark.createDataFrame([(1, "b")], schema)
    whole = partitioned.overwrite_partitions
    monkeypatch.setattr(partitioned, "overwrite_partitions", lambda rows, path, by, before: whole(rows, path, by, {}))
    assert partitioned.merge(path, ups, ["id"], "part").count() == 3
    monkeypatch.undo()
    assert rows(partitioned.merge(path, ups, ["id"], "part"), "id", "part") == [(1, "b"), (2, "b")]


def test_merge_keeps_the_newest_whenever_it_comes(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "id int, part string, at int"
    for batch in ([(1, "a", 5), (2, "a", 1)], [(1, "b", 3), (2, "b", 2)], [(1, "c", 4), (1, "d", 6)], [(1, "a", 5)]):
        got = partitioned.merge(path, spark.createDataFrame(batch, schema), ["id"], "part", [F.desc("at")])
    assert rows(got, "id", "part", "at") == [(1, "d", 6), (2, "b", 2)]
    with pytest.raises(Exception, match="give their order"):
        partitioned.merge(path, spark.createDataFrame([(1, "a", 5), (1, "b", 6)], schema), ["id"], "part")


def test_merge_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    partitioned.write(spark.range(100).select("id", (F.col("id") % 10).cast("string").alias("part")), path, "part")
    plan = partitioned.in_partitions(partitioned.read(spark, path), "part", ["3", None])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and "part" in plan.split("PartitionFilters")[1]
    assert partitioned.in_partitions(partitioned.read(spark, path), "part", []).count() == 0


def test_ledger(spark, rows):
    table = spark.createDataFrame([(1, "9"), (2, "10"), (3, None)], "id int, load_id string")
    seen = loads.ledger({"a": table.where("load_id = '10'"), "b": table, "c": table.select("id")})
    assert rows(loads.unseen("a", table, seen), "id") == [(1,), (3,)]
    assert loads.unseen("b", table, seen).count() == 0 and loads.unseen("new", table, seen).count() == 3
    assert rows(seen.where("load = ''"), "source") == [("a",), ("b",), ("c",)]


def totals(df):
    return df.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


def test_stream_of_groups_equals_rebuild(spark, tmp_path, rows):
    """Files out of order, a repeated batch, a restart with and without its checkpoint."""
    land, schema = tmp_path / "land", "id int, k string, v int, at int"
    land.mkdir()
    rng, all_rows = random.Random(3), []

    def drop(name, n):
        some = [(rng.randrange(30), rng.choice("abcde"), rng.randrange(9), rng.randrange(10**6)) for _ in range(n)]
        all_rows.extend(some)
        spark.createDataFrame(some, schema).coalesce(1).write.json(str(land / name))
        for f in (land / name).glob("part-*"):
            f.rename(land / f"{name}.json")

    prepare = lambda d: d.withColumn("part", F.when(F.col("k") < "c", "low").otherwise("high"))
    newest = [F.desc("at")]

    def go(checkpoint):
        q = refresh.stream_group_refresh(
            spark, str(land / "*.json"), spark.createDataFrame([], schema).schema, prepare, str(tmp_path / "h"), str(tmp_path / "t"), totals,
            ["id"], ["k"], "part", newest, str(tmp_path / checkpoint), files_per_batch=1,
        )
        assert q.awaitTermination(300)
        return partitioned.read(spark, str(tmp_path / "t"))

    def want():
        rows_ = partitioned.first_rows(prepare(spark.createDataFrame(all_rows, schema)), ["id"], newest)
        return rows(totals(rows_), "k", "part", "n", "v")

    drop("z", 12)
    drop("a", 12)
    assert rows(go("one"), "k", "part", "n", "v") == want()
    drop("m", 8)
    assert rows(go("one"), "k", "part", "n", "v") == want()  # goes on after the last batch
    assert rows(go("two"), "k", "part", "n", "v") == want()  # everything once more


def test_totals_follow_corrections(spark, tmp_path, rows, monkeypatch):
    path, schema = (str(tmp_path / "h"), str(tmp_path / "t")), "id int, k string, v decimal(10,2), part int, at int"
    measures = {"v": F.col("v"), "big": (F.col("v") > 5).cast("long")}

    def batch(*some):
        return spark.createDataFrame([(i, k, Decimal(v), p, at) for i, k, v, p, at in some], schema)

    def update(df):
        return rows(refresh.update_totals(*path, df, ["id"], ["k"], measures, "part", [F.desc("at")]), "k", "v", "big", "n_rows")

    d = Decimal
    assert update(batch((1, "a", "1.50", 0, 1), (2, "a", "7.00", 0, 1), (3, "b", "9.00", 1, 1), (4, None, "1.00", 1, 1))) == [(None, d("1.00"), 0, 1), ("a", d("8.50"), 1, 2), ("b", d("9.00"), 1, 1)]
    second = batch((2, "a", "2.00", 0, 2), (3, "a", "6.00", 0, 2), (5, "c", "3.00", 1, 2), (1, "a", "99.00", 0, 0))
    want = [(None, d("1.00"), 0, 1), ("a", d("9.50"), 1, 3), ("c", d("3.00"), 0, 1)]
    # The batch breaks off after the totals and before the history, then comes twice.
    with monkeypatch.context() as m:
        m.setattr(partitioned, "merge", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            update(second)
    assert update(second) == want
    assert update(second) == want
    assert update(batch((5, "c", "1.00", 1, 1))) == want  # older than what is stored


@pytest.mark.parametrize("q, want", [(0.0, 1.0), (0.5, float("inf"))])
def test_infinity_sorts_before_nan(spark, q, want):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),)], "v double")
    assert windows.exact_quantile(df, "v", q).first()[0] == want


def test_value_chunk_never_decreases(spark):
    inf, nan = float("inf"), float("nan")
    values = [None, -inf, -1e308, -3.5, -0.0, 0.0, 1e-9, 2.0, 1e308, inf, nan]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[1] for r in df.select("i", windows.value_chunk(df, "v")).sort("i").collect()]
    assert got[0] is None and got[1:] == sorted(got[1:]) and len(set(got[-3:])) == 3
