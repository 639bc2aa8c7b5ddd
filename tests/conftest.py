import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        # Keep several range segments even on tiny inputs, so that their seams are tested.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def ratings(spark):
    """Build interactions from (user, item, rating, ts) tuples; ``tie`` numbers the rows."""

    def build(rows):
        return spark.createDataFrame(
            [(*r, i) for i, r in enumerate(rows)], "user_id long, item_id long, rating double, ts long, tie long"
        )

    return build


@pytest.fixture
def tiny(ratings):
    """300 daily ratings of 10 users and 20 items, so ten 30-day slices of 30 rows."""
    return ratings([(i % 10 + 1, i % 20 + 1, 3.5 + (i % 3) * 0.5, 1420070400 + i * 86400) for i in range(300)])
