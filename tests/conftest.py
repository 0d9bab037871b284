import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lodestar.session import checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .config("spark.driver.memory", "4g")
         .config("spark.sql.shuffle.partitions", "8")
         # plans of the unrolled rounds are large: keep few of those that ran
         .config("spark.sql.ui.retainedExecutions", "20")
         .config("spark.ui.retainedJobs", "50")
         .config("spark.ui.retainedStages", "50")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture(autouse=True)
def _no_leftovers(request):
    """Frames that a test left in the cache don't stay for the next one."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or tuple(df.columns)
    data = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(data, key=lambda t: [(v is not None, v if v is not None else 0) for v in t])
