from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    s = get_session("local[4]", app="strata-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_check import duck

    return duck(SF_SMALL)
