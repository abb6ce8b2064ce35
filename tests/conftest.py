import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brightloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", shuffle_partitions=6, app="tests")


@pytest.fixture
def many_parts(spark):
    """Keep small shuffles in several partitions, so that partition borders are exercised."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
