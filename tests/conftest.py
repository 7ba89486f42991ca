import copy
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a checkpoint folder of our own when the session names none
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="civicspark-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="civicspark-test-")


@pytest.fixture(autouse=True)
def payloads_as_written():
    """Some tests alter the feed payloads of test_feeds in place: the next test gets them as written."""
    from tests import test_feeds
    before = {name: copy.deepcopy(getattr(test_feeds, name)) for name in ("DOC", "PAGE", "SURVEY")}
    yield
    for name, value in before.items():
        shared = getattr(test_feeds, name)
        if isinstance(shared, list):
            shared[:] = value
        elif isinstance(shared, dict):
            shared.clear()
            shared.update(value)
