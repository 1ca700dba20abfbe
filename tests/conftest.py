from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("surfrank-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="surfrank-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def edges_of(spark):
    """Build a ``(src string, dst string)`` DataFrame from ``"a>b b>c ..."``."""

    def make(spec: str, id_type: str = "string"):
        pairs = [tuple(tok.split(">")) for tok in spec.split()]
        schema = f"src {id_type}, dst {id_type}"
        if id_type != "string":
            pairs = [(int(a), int(b)) for a, b in pairs]
        return spark.createDataFrame(pairs, schema)

    return make


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="surfrank-test-")
