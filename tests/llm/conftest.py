import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import SCHEMA, rows_of  # noqa: E402


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from texts, or from full rows; extra columns bear names that operators use."""

    def make(rows):
        rows = list(rows)
        if rows and not isinstance(rows[0], tuple):
            rows = rows_of(rows)
        return spark.createDataFrame(rows, SCHEMA)

    return make
