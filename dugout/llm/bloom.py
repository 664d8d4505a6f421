"""Filters of a fixed size over 64-bit keys, built by all tasks and sent to all tasks.

Each key has two slots. A plain filter holds the slots that any key has; a repeat filter
those that got two or more keys. Neither ever misses: a key that was added (or was added
twice) is always reported. Errors go one way only, so whoever uses a filter settles the
reported rows exactly.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, mapped

#: Slots of one row of the merge: 4 KiB of bits.
BLOCK = 1 << 15
#: Upper bound of a filter: 2^26 slots are 8 MiB when sent out, 128 MiB while a task builds one.
MAX_SLOTS = 1 << 26
PARTS = "block int, once binary, more binary"


def slots_for(keys: int, max_slots: int = MAX_SLOTS) -> int:
    """A power of two of at least eight slots a key, within the bound; beyond it more rows are reported."""
    return min(max_slots, 1 << max(16, math.ceil(math.log2(max(1, keys) * 8))))


def _slots(keys: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    k = keys.view(np.uint64)
    return (k & np.uint64(slots - 1)).astype(np.int64), ((k >> np.uint64(32)) & np.uint64(slots - 1)).astype(np.int64)


def _bits(column: pa.Array) -> np.ndarray:
    return column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)


def _partial(slots: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = more = None
        for batch in batches:
            keys = _bits(batch.column(0))
            if not len(keys):
                continue
            if once is None:
                once, more = np.zeros(slots, bool), np.zeros(slots, bool)
            slot, n = np.unique(np.concatenate(_slots(keys, slots)), return_counts=True)
            more[slot] |= once[slot] | (n > 1)
            once[slot] = True
        if once is None:
            return
        for b in range(slots // BLOCK):
            part = once[b * BLOCK : (b + 1) * BLOCK]
            if part.any():
                row = [b], [np.packbits(part).tobytes()], [np.packbits(more[b * BLOCK : (b + 1) * BLOCK]).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], ["block", "once", "more"])

    return build


def _merged(group: pa.Table) -> pa.Table:
    once, more = np.zeros(BLOCK // 8, np.uint8), np.zeros(BLOCK // 8, np.uint8)
    for o, m in zip(group["once"].to_pylist(), group["more"].to_pylist()):
        o, m = np.frombuffer(o, np.uint8), np.frombuffer(m, np.uint8)
        more |= m | (once & o)
        once |= o
    return pa.table({"block": group["block"].slice(0, 1), "once": pa.array([once.tobytes()], pa.binary()), "more": pa.array([more.tobytes()], pa.binary())})


def build(keys: DataFrame, slots: int, repeats: bool):
    """Broadcast bits of the filter over the one bigint column of ``keys``.

    Every task makes its own filter; the merge shuffles blocks of bits, never keys.
    """
    parts = mapped(keys, _partial(slots), PARTS).groupBy("block").applyInArrow(_merged, PARTS)
    bits = bytearray(slots // 8)
    for row in parts.select("block", F.col("more" if repeats else "once").alias("bits")).toLocalIterator():
        bits[row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


def lookup(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter reports."""
    a, b = _slots(np.ascontiguousarray(keys, np.int64), len(bits) * 8)
    hit = lambda s: (bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1
    return (hit(a) & hit(b)).astype(bool)


def found(sent, keys: pa.Array) -> np.ndarray:
    """Which of a column of keys the sent filter reports; no null is."""
    known = keys.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros(len(keys), bool)
    out[known] = lookup(np.frombuffer(sent.value, np.uint8), _bits(keys))
    return out


def reported(key: Column, sent) -> Column:
    """True where the filter reports the bigint key; false for a null key."""

    @F.arrow_udf("boolean")
    def test(keys: pa.Array) -> pa.Array:
        return pa.array(found(sent, keys))

    return test(key)


def without(rows: DataFrame, key: list[Column], dropped: DataFrame) -> DataFrame:
    """``rows`` whose key is not among those of ``dropped``, which has one column for each part; all columns stay.

    Keys are compared null-safely. Rows the filter does not report pass straight through;
    only the others are shuffled for the exact anti-join.
    """
    own = [fresh(rows, f"dropped_{i}") for i in range(len(key))]
    dropped = dropped.toDF(*own)
    sent = build(dropped.select(F.xxhash64(*own).alias("k")), slots_for(dropped.count()), repeats=False)
    mark = fresh(rows, "reported")
    marked = rows.withColumn(mark, reported(F.xxhash64(*key), sent))
    same = [k.eqNullSafe(F.col(o)) for k, o in zip(key, own)]
    rest = marked.where(F.col(mark)).join(dropped, functools.reduce(operator.and_, same), "left_anti")
    return marked.where(~F.col(mark)).unionByName(rest).drop(mark)
