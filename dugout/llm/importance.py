"""Importance resampling towards a target distribution, over hashed word n-grams.

Features of a text are its runs of one to three words. A feature's bucket is the CRC-32 of
its bytes modulo ``buckets``. Counts of all documents and of all target texts give each
bucket a gain; a document's weight is the sum over its features, and documents are drawn
by the largest weights plus Gumbel noise, which is drawing without replacement.

CRC-32 is linear: the CRC of a string is the exclusive or of one contribution a byte, which
depends on the byte and its distance from the end only, and of a constant for the length.
Contributions stand in a table of ``DISTANCE`` by 256. For every byte of a block of words
they are taken for the ends of its own, the next and the next but one word;
``bitwise_xor.reduceat`` over the words gives three numbers a word, whose combinations are
all features of the block. Features longer than the table are folded in blocks of its
length. A long text is cut into blocks that share two words, and never held as features.

Counting pre-aggregates in the tasks, so only bucket counts are shuffled; gains are one
number a bucket, a bound that does not depend on the data. The rank sorts narrow rows over
all tasks and adds up the counts of the sort's partitions.

Defined cases: a null text has no words, no features and the weight 0; rows that repeat are
drawn each on its own, equal ids with equal noise; a null id has the noise of an empty id
and comes last among ties; empty tables give no rows or gains from counts of nought;
further columns are ignored by ``scores`` and kept by ``resampled``.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, mapped, slices, stored
from .words import SPACE, joined

#: Rows of the contribution table: longest feature that needs no folding.
DISTANCE = 512
#: Bytes of words hashed at a time, and of texts turned into Python objects at a time.
BLOCK_BYTES, STEP_BYTES = 1 << 17, 1 << 23


@functools.lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Contribution of a byte by its distance from the end, and the constant of each length."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    rows = [one]
    for _ in range(DISTANCE - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ one[rows[-1] & np.uint32(255)])
    return np.concatenate(rows), np.array([zlib.crc32(bytes(n)) for n in range(DISTANCE + 1)], np.uint32)


def _moved(register: int, by: int) -> int:
    """A register after ``by`` further zero bytes, at most the table's length."""
    table, _ = tables()
    out = 0
    for j in range(4):
        byte = register >> (8 * j) & 255
        out ^= int(table[(by - 1 - j) * 256 + byte]) if j < by else byte << (8 * (j - by))
    return out


def folded(data: bytes) -> int:
    """CRC-32 of a long string, block by block of the table's length."""
    table, _ = tables()
    register, at, size = 0xFFFFFFFF, 0, len(data) % DISTANCE or DISTANCE
    while at < len(data):
        block = np.frombuffer(data[at : at + size], np.uint8)
        register = _moved(register, size) ^ int(np.bitwise_xor.reduce(table[np.arange(size - 1, -1, -1) * 256 + block]))
        at, size = at + size, DISTANCE
    return register ^ 0xFFFFFFFF


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """``x`` moved ``by`` words ahead; the last ones are repeated, for features that do not exist."""
    return np.concatenate([x[by:], np.repeat(x[-1:], min(by, len(x)))])


class Block:
    """Consecutive words of some rows; features start at the first ``own`` words of each part."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.rows: list[int] = []
        self.own: list[int] = []
        self.size = 0

    def add(self, row: int, words: bytes, own: int) -> None:
        self.parts.append(words)
        self.rows.append(row)
        self.own.append(own)
        self.size += len(words) + 1

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """CRC-32 of every feature, and the place in ``rows`` it belongs to; three rows of arrays."""
        table, constant = tables()
        data = b" ".join(self.parts)
        b = np.frombuffer(data, np.uint8)
        gap = np.flatnonzero(b == SPACE)
        first, end = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(b)]])
        length = end - first
        word = np.repeat(np.arange(len(first)), np.diff(first, append=len(b) + 1))[: len(b)]
        place, code = np.arange(len(b)) + 1, b.astype(np.int64)
        made = []
        for ahead in range(3):
            distance = np.minimum(_shifted(end, ahead)[word] - place, DISTANCE - 1)
            given = table[np.maximum(distance, 0) * 256 + code]
            if not ahead:
                given[gap] = 0  # the space after a word is not part of it
            made.append(np.bitwise_xor.reduceat(given, first))
        one, two, three = made
        spans = np.stack([length, length + 1 + _shifted(length, 1), length + 2 + _shifted(length, 1) + _shifted(length, 2)])
        crc = np.stack([one, two ^ _shifted(one, 1), three ^ _shifted(two, 1) ^ _shifted(one, 2)]) ^ constant[np.minimum(spans, DISTANCE)]
        count = np.array([p.count(b" ") + 1 for p in self.parts])
        part = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
        exists = nth + np.arange(3)[:, None] < count[part]
        exists &= nth < np.array(self.own)[part]
        for k, i in np.argwhere(exists & (spans > DISTANCE)).tolist():
            crc[k, i] = folded(data[first[i] : first[i] + spans[k, i]])
        return crc[exists], np.broadcast_to(part, exists.shape)[exists]


def _blocks(texts: Iterator[str | None]) -> Iterator[Block]:
    """Blocks of about ``BLOCK_BYTES``; rows are numbered as they come."""
    block = Block()
    for row, text in enumerate(texts):
        words, at = joined(text), 0
        while at < len(words):
            cut = words.find(b" ", at + BLOCK_BYTES)
            if cut < 0:
                part = words[at:]
                block.add(row, part, part.count(b" ") + 1)
                at = len(words)
            else:
                shared = cut
                for _ in range(2):
                    shared = words.find(b" ", shared + 1) if shared < len(words) else shared
                    shared = len(words) if shared < 0 else shared
                block.add(row, words[at:shared], words.count(b" ", at, cut) + 1)
                at = cut + 1
            if block.size >= BLOCK_BYTES:
                yield block
                block = Block()
    if block.parts:
        yield block


def _counted(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0, STEP_BYTES):
                for block in _blocks(iter(part.column(0).to_pylist())):
                    crc, _ = block.features()
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all features of the one text column."""
    return mapped(texts, _counted(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int, scale: int = 1000) -> np.ndarray:
    """Gain of each bucket: floor of ``scale`` times the logarithm of the smoothed ratio of target to documents."""
    counts = [np.zeros(buckets, np.int64) for _ in range(2)]
    for have, df in zip(counts, (docs, target)):
        for bucket, n in bucket_counts(df, buckets).collect():  # one row a bucket
            have[bucket] = n
    s, t = (c.tolist() for c in counts)
    big_s, big_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(scale * math.log((t[i] + 1.0) * big_s / ((s[i] + 1.0) * big_t))) for i in range(buckets)], np.int64)


def _weighed(gain: bytes):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.frombuffer(gain, np.int64)
        for batch in batches:
            for part in slices(batch, 2, STEP_BYTES):
                words, n, weight = np.zeros((3, part.num_rows), np.int64)
                for block in _blocks(iter(part.column(2).to_pylist())):
                    crc, place = block.features()
                    rows = np.array(block.rows)
                    np.add.at(words, rows, block.own)
                    np.add.at(n, rows, np.bincount(place, minlength=len(rows)))
                    # Sums of whole numbers below 2^53 are exact as doubles.
                    np.add.at(weight, rows, np.bincount(place, of[crc % np.uint32(len(of))], len(rows)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(words), pa.array(n), pa.array(weight)], ["row", "doc_id", "n_words", "n_features", "weight"])

    return weigh


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """``rows`` (stored) with their rank by score, ties to the smaller id; null beyond ``drawn``."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = stored(rows.sort(*order).withColumn("at", F.monotonically_increasing_id()), "drawn-order")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row a partition of the sort.
    before = sizes.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(before, part == F.col("p")).withColumn("rank", F.when(place <= drawn, place)).drop("at", "p", "before")


def _scored(rows: DataFrame, target: DataFrame, buckets: int, percent: int, least_words: int, seed: int) -> DataFrame:
    """Rows of ``scores`` for rows (row, doc_id, text), with their ``row``."""
    gain = gains(rows.select("text"), target.select(F.col("text").cast("string")), buckets)
    weighed = mapped(rows, _weighed(gain.tobytes()), "row long, doc_id long, n_words long, n_features long, weight long")
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel), "drawn-scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return _ranked(scored.where(enough), drawn).unionByName(rest)


def _rows(docs: DataFrame, row: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank (1 is drawn first; null: not drawn), n_words.

    ``target`` has the column ``text``. Of the rows with ``least_words`` and more,
    ``percent`` of a hundred are drawn.
    """
    rows = _rows(docs, F.monotonically_increasing_id(), id_col, text_col)
    return _scored(rows, target, buckets, percent, least_words, seed).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    row = fresh(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "drawn-rows")
    drawn = _scored(_rows(numbered, F.col(row), id_col, text_col), target, buckets, percent, least_words, seed).where("rank is not null")
    return numbered.join(drawn.select(F.col("row").alias(row)), row, "left_semi").drop(row)
