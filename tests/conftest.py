import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from creatorlens.session import local_session
    s = local_session("4", shuffle_partitions=8, app="creatorlens-tests")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def nothing_stays_cached():
    """What a test caches is let go when it ends; others look at what the session holds."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    if s is not None:
        s.catalog.clearCache()
