"""Shared folder for checkpoints of the tests' session."""

import pytest


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
