from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tallyframe.session import build_session

    events = tempfile.mkdtemp(prefix="tallyframe-events-")
    session = build_session(
        "local[4]",
        app_name="tallyframe-tests",
        shuffle_partitions=8,
        conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events,
            # Uncompressed logs are flushed per event and readable while running.
            "spark.eventLog.compress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from tallyframe.session import scratch_path

    return lambda kind="test": scratch_path(spark, kind)


def rows(df, *cols):
    """Sorted list of tuples of ``df`` (optionally projected)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))
