import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickflow.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given (or all) columns."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
