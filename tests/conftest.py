import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from parcelflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF001


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-insensitive checks."""
    data = [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((x is not None, str(x)) for x in t))
