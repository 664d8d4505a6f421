"""URL parts by text rules, so that addresses without a scheme work too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ColumnLike, as_col


def _without_scheme(url: ColumnLike) -> Column:
    c = as_col(url)
    for scheme in ("android-app://", "http://", "https://"):
        c = F.replace(c, F.lit(scheme), F.lit(""))
    return c


def url_host(url: ColumnLike) -> Column:
    """Host name: text before the first slash or question mark."""
    return F.split_part(F.split_part(_without_scheme(url), F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url: ColumnLike) -> Column:
    """Path without its leading slash and without the query; NULL when there is none."""
    rest = _without_scheme(url)
    slash = F.instr(rest, "/")
    after = F.when(slash > 0, F.substr(rest, slash + 1))
    return F.nullif(F.split_part(after, F.lit("?"), F.lit(1)), F.lit(""))


def url_parameter(url: ColumnLike, name: str) -> Column:
    """Value of a query parameter; NULL when it is absent or empty."""
    tail = F.split_part(as_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(tail, F.lit("&"), F.lit(1)), F.lit(""))
