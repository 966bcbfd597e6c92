from __future__ import annotations

import random

import pytest
from pyspark.sql import SparkSession

from ledgerline.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def sf() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def rng() -> random.Random:
    return random.Random(11)
