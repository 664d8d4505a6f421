"""The corpus pipeline: language, exact copies, near copies, packing.

Each stage works on all rows that its predecessor kept. ``run`` writes every stage as
Parquet in the shared work folder and reads it back, so a lost executor costs one task.

Defined cases: a null or empty text, or one without a letter, goes with the language stage;
of repeated rows one stays; a row with a null id takes part and stays only where no row of
its group has an id; ties go to the smallest id; with no labelled language every text with
a letter stays; an empty table gives no pieces. Further columns, whatever their names, pass
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dugout.llm import exact_dedup, hyperminhash, language_hd, packing
from dugout.llm.common import stored, table

#: Learned prototypes, sketches and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: texts without a letter, and those unlike all labelled texts of their length."""
    return language_hd.kept_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the row with the smallest id."""
    return exact_dedup.kept_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at 0.8 or more."""
    return hyperminhash.kept_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the pieces of packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
