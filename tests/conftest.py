import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickfold.session import drop_tables, local_session
    s = local_session("*", 8, app="clickfold-tests")
    yield s
    drop_tables(s)
    s.stop()


def rows(df, *cols):
    """Rows as tuples of the given columns, sorted (order-insensitive compare)."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, 0 if x is None else x) for x in t))
