import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from verdant.contract import RAW_COLUMNS as HEADER  # noqa: E402

# Two plants at one time, one of them later again: a negative and a long
# reading, an accented status, and an empty last cell.
SAMPLE_ROWS = [
    ["2025-04-15 02:28:40", "Plant 1", "Healthy", "61.07", "412.5", "58", "3", "27", "11",
     "-4.25", "02:28", "-6.5", "71.3", "18.75", ""],
    ["2025-04-15 02:28:40", "Plant 2", "séchée", "99.9", "7", "58.125", "3", "0", "11",
     "1e1", "02:28", "-6.5", "71.3", "19", "44"],
    ["2025-05-05 16:04:32", "Plant 1", "Wilted", "12", "999999.99", "60", "2", "26", "10",
     "21", "16:04", "14", "55", "22.5", ""],
]
RUN_TS = "2025-05-01 10:00:00"


@pytest.fixture(scope="session")
def spark():
    from verdant.session import build_session
    ckpt = tempfile.mkdtemp(prefix="verdant-test-ckpt-")
    s = build_session("local[4]", app="verdant-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def grid(spark):
    """Build a raw grid DataFrame from lists of cells (with ordinals)."""
    from verdant.contract import RAW_SCHEMA

    def make(rows, header=HEADER):
        data = [(i, *r) for i, r in enumerate(rows)]
        if header == HEADER:
            return spark.createDataFrame(data, RAW_SCHEMA)
        cols = ["_row_no", *header]
        return spark.createDataFrame(data, cols)
    return make


@pytest.fixture
def scratch(spark):
    from verdant.session import fresh_dir
    return lambda name="t": fresh_dir(spark, name)
