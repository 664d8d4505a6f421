"""Name -> query and name -> reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` is its equivalent over the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4, prefix: str = "") -> DataFrame:
    """Doubles (those whose name starts with ``prefix``) rounded, so that summation order does not show.

    The tiny shift moves exact halves, which engines round differently.
    """
    real = (T.DoubleType, T.FloatType)
    wanted = {f.name for f in df.schema.fields if isinstance(f.dataType, real) and f.name.startswith(prefix)}
    return df.withColumns({n: F.round(F.col(n) + 1e-9, digits) for n in wanted}) if wanted else df
