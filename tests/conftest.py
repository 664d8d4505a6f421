from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dugout.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted rows as tuples, over the given columns."""

    def get(df, *cols):
        out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(out, key=lambda r: tuple((x is not None, str(type(x)) if isinstance(x, dict) else x) if x is not None else (False, 0) for x in r))

    return get
