from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cartwheel.session import build_session, release_scratch

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[*]",
        app_name="cartwheel-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": str(base / "warehouse")},
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint dir; a cluster names a shared one.
    session.sparkContext.setCheckpointDir(str(base / "checkpoints"))
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture()
def out(tmp_path):
    """A fresh output folder per test."""
    return str(tmp_path)


@pytest.fixture()
def db(spark, request):
    """A fresh database for table tests."""
    from cartwheel.session import scratch_database

    return scratch_database(spark, request.node.name.replace("[", "_").replace("]", "_")[:20])
