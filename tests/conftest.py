import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemart.session import build_session

    session = build_session("tidemart-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    import compare

    return compare.duck(compare.SMALL)


@pytest.fixture(scope="session")
def sample(spark):
    from compare import SMALL
    from tidemart.sources.sample import Sample

    return Sample(spark, SMALL)
