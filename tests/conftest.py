import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickflow.config import local_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="clickflow-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
