"""Ledger of the loads that were seen: a row for each load of each table.

A load is new if the ledger does not have it, whatever its id: loads may come late, and ids
need no order.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Load of the row that says a table was seen at all.
TABLE = ""


def loads_of(source: str, rows: DataFrame, load_column: str = "load_id") -> DataFrame:
    """Ledger rows (source, load): one for each load of a table, and one for the table."""
    own = [F.lit(source).alias("source"), F.col(load_column).cast("string").alias("load")]
    table = rows.sparkSession.range(1).select(F.lit(source).alias("source"), F.lit(TABLE).alias("load"))
    return (rows.select(*own).distinct() if load_column in rows.columns else table.where("false")).unionByName(table)


def ledger(tables: dict[str, DataFrame], load_column: str = "load_id") -> DataFrame:
    """The ledger of several tables."""
    return functools.reduce(DataFrame.unionByName, [loads_of(n, df, load_column) for n, df in tables.items()])


def unseen(source: str, rows: DataFrame, ledger: DataFrame, load_column: str = "load_id") -> DataFrame:
    """Rows of loads that the ledger does not have for this table; rows without a load are a load of their own."""
    seen = ledger.where((F.col("source") == source) & ~F.col("load").eqNullSafe(F.lit(TABLE))).select(F.col("load").alias("_load")).distinct()
    return rows.join(seen, F.col(load_column).cast("string").eqNullSafe(F.col("_load")), "left_anti")
