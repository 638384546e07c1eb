import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from foghorn.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", 4)


@pytest.fixture()
def rows_of():
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
