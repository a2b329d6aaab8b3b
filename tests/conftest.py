from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pageloom.plans.session import local_session
from pageloom.plans.staging import drop_staged


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def rows():
    def as_set(df, *cols):
        chosen = cols or tuple(df.columns)
        return {tuple(r[c] for c in chosen) for r in df.collect()}

    return as_set
