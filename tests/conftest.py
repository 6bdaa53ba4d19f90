import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from flightlake.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="flightlake-test-")
    s = get_spark("flightlake-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparison)."""
    cols = order or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
