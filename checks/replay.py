"""Streams over rounds of arriving files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from checks.inputs import STREAM_SCHEMA, stream_rounds
from millrace.session import scratch_path
from millrace.sources.messages import message_stream

PARTITIONS_CONF = "spark.sql.shuffle.partitions"

Start = Callable[[DataFrame, str, str], DataStreamWriter]


@contextmanager
def _stream_settings(spark: SparkSession) -> Iterator[None]:
    """On one machine no more state partitions than it has cores."""
    before = spark.conf.get(PARTITIONS_CONF)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(PARTITIONS_CONF, str(min(spark.sparkContext.defaultParallelism, int(before))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS_CONF, before)


def replay(spark: SparkSession, sf_dir: str, start: Start, late: bool = False) -> str:
    """The folder a stream wrote to.

    Each round of messages is written, and the stream then catches up with it from
    its checkpoint: one micro-batch for the round, and one without rows in which
    windows close that the round has moved the watermark past.
    """
    inbox, target, checkpoint = (
        scratch_path(spark, label) for label in ("inbox", "target", "checkpoint")
    )
    with _stream_settings(spark):
        for sent in stream_rounds(spark, sf_dir, late):
            sent.write.mode("append").parquet(inbox)
            arriving = message_stream(spark, inbox, STREAM_SCHEMA, keep=["event_id"])
            start(arriving, target, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return target
