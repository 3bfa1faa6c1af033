import os

import pytest

from docpipe import session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "docpipe-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield spark
    session.clear_scratch(spark)
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
