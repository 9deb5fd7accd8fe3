from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from salesloom.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    if session.conf.get("spark.checkpoint.dir", None) is None:
        # A setting of the context: it must be there when the session is made.
        session.stop()
        shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="salesloom-tests-")}
        session = local_session(8, shuffle_partitions=4, settings=shared)
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def values(frame, *columns):
    """Rows as plain tuples, sorted."""
    rows = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in rows.collect()), key=lambda row: tuple((v is None, str(v)) for v in row))
