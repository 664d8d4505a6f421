"""Exact de-duplication in two passes over a Bloom filter.

Pass one hashes every whole text and builds a filter of hashes seen twice. Pass two sends
on the rows whose hash is certainly unique as they are; only possibly repeated rows are
shuffled and grouped by their SHA-256. Groups are pre-aggregated in the map tasks, and the
join back is one that adaptive execution splits, so a text held by a third of all rows is
no obstacle.

Defined cases: a null text is empty; texts are equal when identical after each run of
ASCII white space became one space; rows that repeat both id and text share one decision;
a null id is larger than any other and stays only where its whole group has none (of such
rows ``kept_rows`` keeps one). Further columns are ignored by ``decisions`` and kept by ``kept_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import fresh, squeezed, stored


def text_sha256(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(squeezed(text).cast("binary"), 256)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_slots: int = bloom.MAX_SLOTS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    ``max_slots`` bounds the filter that is sent to every task; a smaller one only lets
    more rows take the shuffled way.
    """
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(text_sha256(F.col(text_col))).alias("sha")), "exact-hashes")
    key = F.xxhash64("sha")
    sent = bloom.build(rows.select(key.alias("k")), bloom.slots_for(rows.count(), max_slots), repeats=True)
    marked = rows.withColumn("maybe", bloom.reported(key, sent))
    again = marked.where("maybe").drop("maybe")
    groups = stored(again.groupBy(F.col("sha").alias("group_sha")).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    settled = again.join(groups, F.col("sha") == F.col("group_sha")).select("doc_id", "sha", "keep_id", "group_size")
    alone = marked.where("not maybe").select("doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return alone.unionByName(settled).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat id and text, one."""
    found = stored(decisions(docs, id_col, text_col), "exact-decisions")
    ids = F.col(id_col).cast("long")
    rows = bloom.without(docs, [ids, text_sha256(F.col(text_col))], found.where("not kept").select("doc_id", "text_sha256").distinct())
    twice, sha = fresh(docs, "repeated"), fresh(docs, "sha")
    repeated = found.where("kept and group_size > 1").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(twice))
    if repeated.isEmpty():
        return rows
    same = ids.eqNullSafe(F.col(twice))
    again = rows.join(repeated, same, "left_semi").withColumn(sha, text_sha256(F.col(text_col)))
    return rows.join(repeated, same, "left_anti").unionByName(again.dropDuplicates([id_col, sha]).drop(sha))
