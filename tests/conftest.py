import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from runlens.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, app="runlens-tests")
    shared_dir(s)
    yield s


def rows_of(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
