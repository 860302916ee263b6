from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollwise.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app="rollwise-tests", driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollwise-test-ckpt-"))
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as dicts, sorted for order-free comparison."""
    out = [r.asDict() for r in df.collect()]
    key = order or sorted(df.columns)
    return sorted(out, key=lambda d: tuple(str(d[k]) for k in key))
