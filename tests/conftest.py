import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from smeltery.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, app="tests")


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as a sorted list of tuples, nulls first."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def plan(df):
    """Text of the physical plan."""
    return df._jdf.queryExecution().toString()
