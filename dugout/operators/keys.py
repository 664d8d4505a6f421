"""Equi-joins on same-named keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", null_safe: Sequence[str] = ()) -> DataFrame:
    """Join that keeps the left keys; NULL equals NULL on the ``null_safe`` ones.

    The right keys are renamed first, so both sides may come from the same frame.
    """
    names = {k: f"_key_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    cond: Column | None = None
    for k, o in names.items():
        c = F.col(k).eqNullSafe(F.col(o)) if k in null_safe else F.col(k) == F.col(o)
        cond = c if cond is None else cond & c
    return left.join(other, cond, how).drop(*names.values())
