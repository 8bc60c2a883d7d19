import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tillstream-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when omitted)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple(str(x) for x in t))
