import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


# A run of several hundred queries in one JVM: heap for it, and no history of plans and jobs kept.
CONF = {"spark.driver.memory": "4g", "spark.sql.ui.retainedExecutions": "1", "spark.ui.retainedJobs": "20", "spark.ui.retainedStages": "20",
        "spark.ui.retainedTasks": "100", "spark.sql.streaming.ui.retainedQueries": "1"}


@pytest.fixture(scope="module")
def spark():
    """A session for each module: what one leaves behind (broadcasts, shuffles, streams) ends with it."""
    from marketlens.session import get_session
    s = get_session("local[8]", 4, app_name="marketlens-tests", extra=CONF)
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
