import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tallyframe-tests-")
    session = build_session(
        "local[4]",
        app_name="tallyframe-tests",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": os.path.join(scratch, "shared"),
            # Print pushed filters in full in plan strings the tests read.
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tmp_shared(spark):
    from tallyframe.session import shared_dir

    return shared_dir(spark)
