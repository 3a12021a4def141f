import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.session import FAILURES  # noqa: E402, F401
from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), ...)``"""

    def build(fields, *rows):
        return spark.createDataFrame(list(rows), fields)

    return build


def rows_of(df, *columns):
    """Rows as sorted tuples, null first."""
    chosen = df.select(*columns) if columns else df
    rows = (tuple(r) for r in chosen.collect())
    return sorted(rows, key=lambda t: [(v is not None, str(v)) for v in t])
