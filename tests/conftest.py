import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gatewatch.session import build_session, prepare
    s = build_session("local[*]", app="gatewatch-tests", shuffle_partitions=8)
    prepare(s)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="gatewatch-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def one(spark, expr_col):
    """Evaluate a Column on a one-row DataFrame."""
    return spark.range(1).select(expr_col.alias("x")).first()["x"]
