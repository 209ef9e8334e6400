import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("lading-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inventory(spark):
    """Builds an inventory from (key, size, etag, last_modified) tuples."""
    def build(*rows):
        full = [(tuple(r) + (None,) * 4)[:4] for r in rows]
        return spark.createDataFrame(
            full, "key string, size long, etag string, last_modified string"
        ).selectExpr(
            "'b' as bucket", "key", "cast(last_modified as timestamp_ntz) as last_modified",
            "size", "cast(null as string) as storage_class", "etag",
            "cast(null as string) as version_id",
        )

    return build
