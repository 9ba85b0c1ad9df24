import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tickloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts, kind="string"):
        frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], f"i int, x {kind}").coalesce(1)
        rows = frame.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [row["y"] for row in rows]

    return run
