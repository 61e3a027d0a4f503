import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8, app="kestrel-tests")
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
