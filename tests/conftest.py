import os
import random
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


@pytest.fixture(scope="session")
def spark():
    # a zone with daylight saving: no result may depend on the session's zone
    session = (
        SparkSession.builder.master("local[4]")
        .appName("transferkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/Los_Angeles")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="transferkit-warehouse-"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="transferkit-test-")


# Block starts and ends of the scripts random text is drawn from.
BLOCKS = [
    (0x20, 0x7E), (0xC0, 0x17F), (0x370, 0x3FF), (0x400, 0x4FF), (0x5D0, 0x5EA), (0x620, 0x64A),
    (0x905, 0x939), (0xE01, 0xE30), (0x2010, 0x2027), (0x2200, 0x22FF), (0x2500, 0x257F), (0x3041, 0x3096),
    (0x30A1, 0x30FA), (0x4E00, 0x4FFF), (0xAC00, 0xAE00), (0x1F600, 0x1F64F),
]
AWKWARD = ['"', "'", ",", "\n", "\r\n", "\\", "\t", " ", "{", "}", "|", ";", "''", '""', "NULL", "\\N"]


def random_text(rng: random.Random, longest: int) -> str:
    out = []
    for _ in range(rng.randint(0, longest)):
        if rng.random() < 0.2:
            out.append(rng.choice(AWKWARD))
        else:
            first, last = rng.choice(BLOCKS)
            out.append(chr(rng.randint(first, last)))
    return "".join(out)
