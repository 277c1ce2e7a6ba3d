"""Message streams: a payload and the time its sender put on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "payload string, timestamp_ms string"


def label_time(label: Column) -> Column:
    """An event time given as epoch milliseconds or as RFC 3339 text; NULL if it is neither."""
    return F.coalesce(F.timestamp_millis(label.try_cast("bigint")), F.try_to_timestamp(label))


def messages(raw: DataFrame, payload: str = "payload", label: str = "timestamp_ms",
             keep: Sequence[str] = (), on_bad_label: str = "raise") -> DataFrame:
    """``(payload, event_ts)`` and the columns of ``keep``, out of any source, batch
    or streaming, that delivers a payload and a time label.

    A label that cannot be read, or is missing, fails the job when the time is used;
    with ``on_bad_label="null"`` it gives no time.  Operators on windows leave out
    rows without a time: count them with ``bad_labels``.
    """
    if on_bad_label not in ("raise", "null"):
        raise ValueError(f"unknown on_bad_label {on_bad_label}")
    text = F.col(label).cast("string")
    time = label_time(text)
    if on_bad_label == "raise":
        complaint = F.concat(F.lit("not a time label: "), F.coalesce(text, F.lit("NULL")))
        time = F.coalesce(time, F.raise_error(complaint).cast("timestamp"))
    return raw.select(
        *keep,
        F.col(payload).cast("string").alias("payload"),
        time.alias("event_ts"),
    )


def bad_labels(label: str = "timestamp_ms") -> Column:
    """An aggregate counting the labels that give no time, for ``df.observe`` or ``agg``."""
    return F.count_if(label_time(F.col(label).cast("string")).isNull()).alias("bad_labels")


def message_stream(spark: SparkSession, path: str, schema: str = MESSAGE_SCHEMA,
                   keep: Sequence[str] = (), on_bad_label: str = "raise",
                   **options: str | int) -> DataFrame:
    """Messages from a folder that Parquet files keep arriving in.  ``options`` are
    those of Spark's file source: ``maxBytesPerTrigger`` bounds a micro-batch."""
    raw = spark.readStream.schema(schema).options(**options).parquet(path)
    return messages(raw, keep=keep, on_bad_label=on_bad_label)
