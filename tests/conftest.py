import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from oreline.session import local_session
    session = local_session(cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Lookups count as too large, keys are soon hot, and Spark may not broadcast on its own."""
    from oreline.operators import lookup
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_ROWS", 3)
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)
