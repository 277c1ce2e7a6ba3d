"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.windows import pane_path
from millrace.sinks.commits import append_once
from millrace.sinks.pane_format import write_named_files
from millrace.streaming.panes import Sink


def table(path: str, partition_by: Sequence[str] = ()) -> Sink:
    """Each micro-batch is added to the table at ``path`` once."""
    return lambda rows, number: append_once(rows, path, number, partition_by)


def pane_files(path: str, payload: str, prefix: str = "", separator: str = "", by_shard: bool = False) -> Sink:
    """One file per fired pane, its elements in the order of their sequence, ``separator``
    after each."""
    def write(fired: DataFrame, number: int) -> None:
        index = F.concat_ws("/", "shard", "pane_index") if by_shard else F.col("pane_index")
        named = fired.select(
            pane_path(prefix, F.col("window")["end"], index).alias("file"), "element", F.col(payload).alias("value")
        )
        write_named_files(named, path, "file", "value", ["element"], separator)

    return write


def window_table_writer(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Rows appended to the table their ``table_name`` says.  No shuffle: a
    micro-batch holds few windows, and each task writes to those it has.  The log of
    Spark's file sink keeps a micro-batch from being written twice."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("table_name")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
