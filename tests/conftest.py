from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from trolley.session import local_session

    s = local_session(4, shuffle_partitions=8, app="trolley-tests")
    yield s
    s.stop()


@pytest.fixture
def tiny(spark):
    """A hand-made clean basket data set (FIXTURES section 4)."""
    from tests.frames import clean_raw

    return clean_raw(spark)
