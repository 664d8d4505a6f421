"""What several operators of this package need: work tables, text normalisation, row access."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once an application; their workers import it by name."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"{os.path.basename(package)}_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top in (package, os.path.dirname(os.path.abspath(__file__))):
            for name in sorted(os.listdir(top)):
                if name.endswith(".py"):
                    z.write(os.path.join(top, name), os.path.relpath(os.path.join(top, name), os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_root(spark: SparkSession) -> str:
    """Folder for work tables: the one that ``spark.checkpoint.dir`` names.

    Where it is unset, a plain local master gets a temporary folder and any other
    master the warehouse, which its executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_work"
    return _LOCAL.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="llm-work-"))


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name; whoever owns the checkpoint folder clears it, as for checkpoints."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet and read back: cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def squeezed(text: Column) -> Column:
    """Text with every run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few hundred turned into Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))


def slices(batch: pa.RecordBatch, column: int, most_bytes: int, most_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in ``column`` have at most ``most_bytes`` together; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right"))), at + most_rows)
        yield batch.slice(at, end - at)
        at = end
