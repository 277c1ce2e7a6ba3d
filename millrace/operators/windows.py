"""Windows put on rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.windows import WindowSize, window_by_type, window_for, window_table


def with_window(df: DataFrame, event_ts: str, size: WindowSize, name: str = "window") -> DataFrame:
    return df.withColumn(name, window_for(F.col(event_ts), size))


def with_typed_window(df: DataFrame, event_ts: str, window_type: str,
                      mode: str = "nominal", name: str = "window") -> DataFrame:
    return df.withColumn(name, window_by_type(F.col(event_ts), window_type, mode))


def with_shard_table(df: DataFrame, event_ts: str, table: str | Callable[[Column], Column],
                     window_type: str, mode: str = "nominal", name: str = "table_name") -> DataFrame:
    """The table each row goes to: its window is taken from the event time anew,
    whatever window the row already carries.  ``table`` is a base name that gets
    the window's suffix, or a function from the window to the whole name."""
    window = window_by_type(F.col(event_ts), window_type, mode)
    if callable(table):
        return df.withColumn(name, table(window))
    return df.withColumn(name, window_table(table, window["start"], window_type))
