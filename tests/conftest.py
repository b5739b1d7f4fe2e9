import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pkgsift.session import local_session
    s = local_session("*", shuffle_partitions=8, app="pkgsift-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), in order."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
