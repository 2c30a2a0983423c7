import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply column functions to single text values: values([...], f, g) -> list of tuples."""
    from pyspark.sql import functions as F

    def run(texts, *functions):
        df = spark.createDataFrame(list(enumerate(texts)), "n int, v string").coalesce(1)
        picked = df.orderBy("n").select(*[f(F.col("v")).alias(str(i)) for i, f in enumerate(functions)])
        rows = [tuple(row) for row in picked.collect()]
        return [row[0] for row in rows] if len(functions) == 1 else rows

    return run
