import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import COLUMNS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(d, t, "en", "s", len(t or ""), *["clash"] * 9) for d, t in odd_rows()]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
