import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from storeloom.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="storeloom-tests")
    yield s


def rows(df, *cols):
    """Collected rows as tuples (small literal fixtures only)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
