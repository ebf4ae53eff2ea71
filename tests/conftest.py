from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import BRONZE  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(4, shuffle_partitions=4, app="tidemark-tests")
    yield s
    s.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def bronze_rows(spark, rows):
    """Bronze frame from tuples in BRONZE column order (strings for times)."""
    fixed = []
    for r in rows:
        r = list(r)
        for i in (6, 9):
            if isinstance(r[i], str):
                r[i] = ts(r[i])
        fixed.append(tuple(r))
    return spark.createDataFrame(fixed, BRONZE)


def event(eid, etype="PushEvent", actor=1, login="alice", repo=10, name="org/a",
          created="2024-01-15 05:00:00", action=None, source="2024-01-15-5.json.gz",
          loaded="2024-01-15 06:00:00"):
    return (eid, etype, actor, login, repo, name, created, action, source, loaded)
