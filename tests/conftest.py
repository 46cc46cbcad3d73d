import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ordersmith.session import get_session

    s = get_session("local[4]", app="ordersmith-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small result as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
