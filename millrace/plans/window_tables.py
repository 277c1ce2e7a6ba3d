"""A stream of JSON messages, converted by a schema and appended to one table per
window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.windows import WindowSize, minutes
from millrace.operators.rows import project_schema
from millrace.operators.windows import with_shard_table, with_window
from millrace.streaming.sinks import window_table_writer

# The window messages are read in, and the one tables are cut by.
PROCESS_WINDOW = minutes(5)
SHARD_WINDOW_TYPE = "FIVE_MINUTE"


def rows(
    messages: DataFrame,
    schema: T.StructType,
    table: str | Callable[[Column], Column],
    process_window: WindowSize = PROCESS_WINDOW,
    shard_type: str = SHARD_WINDOW_TYPE,
    mode: str = "nominal",
    process_ts: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(payload, event_ts)`` to the columns of ``schema`` and ``table_name``.

    Every message becomes one row, whichever pane it would be in: nothing here
    groups, so nothing waits for a trigger.
    """
    placed = messages.transform(with_window, "event_ts", process_window).transform(
        with_shard_table, "event_ts", table, shard_type, mode
    )
    return project_schema(
        placed, schema, event_ts="event_ts", window="window", process_ts=process_ts,
        keep=(*keep, "table_name"),
    )


def writer(messages: DataFrame, schema: T.StructType, table: str | Callable[[Column], Column],
           target: str, checkpoint: str, **options) -> DataStreamWriter:
    """Call ``.trigger(..).start()`` on the result.  Rows come once per
    micro-batch; ``processingTime="30 seconds"`` is the early delay of the
    program this stands for."""
    return window_table_writer(rows(messages, schema, table, **options), target, checkpoint)
