import os
import sys
from pathlib import Path

# Small matrices: threads would only wait for each other. Before numpy is loaded.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest  # noqa: E402

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from daymetrics import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build("local[8]", spark__sql__shuffle__partitions="8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from a DDL schema and rows."""

    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    """Collect as sorted tuples."""

    def collect(df, *columns):
        got = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, v) for v in r))

    return collect
