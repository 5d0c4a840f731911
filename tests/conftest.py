import os

import pytest

from orderloom.session import build_session

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "orderloom-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # Plans that tests read are not cut off, however long the session's column numbers have grown.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.driver.memory": "8g",
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
