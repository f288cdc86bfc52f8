from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from linefeed.session import build_session, clean_staging
    session = build_session(master="local[*]", shuffle_partitions=8)
    yield session
    clean_staging(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
