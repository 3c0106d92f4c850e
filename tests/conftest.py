from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from lexitrack.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from rows and a DDL schema, in several partitions."""
    def make(schema, rows, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
