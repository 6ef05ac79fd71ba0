import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from basketlens.session import get_spark
    # one JVM runs every test: give it a realistic heap (the default 1 GB is for toy sessions)
    s = get_spark("local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    yield s


@pytest.fixture(autouse=True, scope="module")
def _release_cached_tables(request):
    """Drop shared feature tables and cached blocks after each test module."""
    yield
    from pyspark.sql import SparkSession
    from basketlens.plans import catalog
    catalog.reset_cache()
    active = SparkSession.getActiveSession()
    if active is not None:
        active.catalog.clearCache()
