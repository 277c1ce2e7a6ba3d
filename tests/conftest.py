import os
import sys
import time

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data, many parts
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def feed(spark, tmp_path):
    """Runs a stream over lists of ``(name, seconds after 2024-01-01)``, one
    micro-batch each, and returns what it wrote."""

    def run(batches, transform, fmt="parquet", configure=lambda w: w):
        inbox = str(tmp_path / "in")
        for rows in batches:
            sent = [(name, str((BASE_S + s) * 1000)) for name, s in rows]
            spark.createDataFrame(sent, "payload string, timestamp_ms string").coalesce(1).write.mode(
                "append"
            ).parquet(inbox)
            time.sleep(0.02)
        from millrace.sources.messages import message_stream

        out = str(tmp_path / "out")
        writer = configure(transform(message_stream(spark, inbox, maxFilesPerTrigger=1)).writeStream)
        query = (
            writer.format(fmt).option("path", out).outputMode("append")
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return out

    return run


BASE_S = 1704067200  # 2024-01-01T00:00Z
