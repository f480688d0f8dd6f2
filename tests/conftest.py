import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerspark.session import build_session, checkpoint_dir
    # one session plans every query of the suite: room for generated classes and plans, and few
    # retained executions
    s = build_session("local[4]", app="ledgerspark-tests", shuffle_partitions=4, extra={
        "spark.driver.memory": "6g", "spark.sql.ui.retainedExecutions": "1",
        "spark.ui.retainedJobs": "10", "spark.ui.retainedStages": "10",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerspark-wh-")})
    checkpoint_dir(s)  # tests set their own scratch checkpoint folder (unset locally)
    yield s
    for q in s.streams.active:      # streams are availableNow and awaited; belt and braces
        q.stop()
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ledgerspark-test-")


SF = "/root/testdata/sf0.001"
