"""Text and table sinks for batch DataFrames."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.windows import window_max_ts
from millrace.session import setting
from millrace.sinks.commits import BATCH_COLUMN, append_once, delete, exists
from millrace.sinks.pane_format import write_named_files

TABLE_COLUMN = "table_name"
#: Up to so many outputs a task keeps open instead of sorting its rows by output.
OPEN_OUTPUTS = 16
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One string column as lines of a sharded file set."""
    df.write.mode(mode).text(path)


def write_outputs(tagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(output, value)`` rows, one folder of text files per output.

    A task has a file of each output open, so its rows are neither sorted nor spilled.
    Those of an output beyond the first ``OPEN_OUTPUTS`` are sorted.
    """
    with setting(tagged.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_OUTPUTS)):
        tagged.select("output", "value").write.mode(mode).partitionBy("output").text(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _shape(schema: T.StructType) -> dict[str, str]:
    # The table name comes back from folder names, so its type is not stored.
    return {
        f.name: f.dataType.simpleString() for f in schema.fields if f.name not in (TABLE_COLUMN, BATCH_COLUMN)
    }


def _check_existing(df: DataFrame, path: str, by_batch: bool) -> None:
    try:
        existing = df.sparkSession.read.parquet(path).schema
    except AnalysisException as problem:
        if problem.getCondition() in _NOTHING_THERE:
            return
        raise
    old, new = _shape(existing), _shape(df.schema)
    if old != new:
        raise ValueError(f"table at {path} has columns {old}, not {new}")
    if (BATCH_COLUMN in existing.fieldNames()) != by_batch:
        raise ValueError(f"all appends to {path} name their batch, or none does")


def append_table(df: DataFrame, path: str, schema: T.StructType, batch: int | str | None = None) -> None:
    """Append to a table of a declared schema, creating it if it is not there.

    With ``batch``, the rows of a batch are there once, however often it is appended;
    read the table with ``sinks.commits.appended``.
    """
    rows = conform(df, schema)
    _check_existing(rows, path, batch is not None)
    if batch is None:
        rows.write.mode("append").parquet(path)
    else:
        append_once(rows, path, batch)


def append_window_tables(df: DataFrame, path: str, schema: T.StructType, batch: int | str | None = None) -> None:
    """Append every row to the table its ``table_name`` says, once if ``batch`` is given, as
    of ``append_table``.

    The tables are partition folders of one Parquet set, so a reader that filters
    on ``table_name`` opens one folder.  Rebalancing gives each table few files;
    adaptive execution splits the partition of a table that holds most rows.
    """
    rows = conform(df, T.StructType([*schema.fields, T.StructField(TABLE_COLUMN, T.StringType())]))
    _check_existing(rows, path, batch is not None)
    rows = rows.hint("rebalance", F.col(TABLE_COLUMN))
    if batch is None:
        rows.write.mode("append").partitionBy(TABLE_COLUMN).parquet(path)
    else:
        append_once(rows, path, batch, [TABLE_COLUMN])


def write_pane_files(
    panes: DataFrame,
    path: str,
    payload: str,
    order: Sequence[str | Column],
    mode: str = "errorifexists",
    separator: str = "\n",
) -> None:
    """One file per pane, below ``window_max_ts=<last millisecond of the window>/
    pane_index=<n>``, ``separator`` after each element.  For elements back to back
    see ``write_pane_bodies``.

    A pane is the unit of the shuffle and has a bounded size, so nothing is
    collected: the file is written as its rows arrive, in ``order``, and put in its
    folder by a task, so that the driver does nothing for a single pane.
    """
    spark, mode = panes.sparkSession, mode.lower()
    if mode not in ("append", "overwrite", "ignore", "error", "errorifexists", "default"):
        raise ValueError(f"no such mode: {mode}")
    nothing = spark.createDataFrame([], "window_max_ts string, pane_index long, value string")
    marked = nothing.write.partitionBy("window_max_ts", "pane_index")
    if mode != "append" and exists(spark, path):
        if mode == "ignore":
            return
        if mode == "overwrite" and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic":
            raise ValueError("pane files are overwritten as a whole: set spark.sql.sources.partitionOverwriteMode to static")
        marked.mode(mode).text(path)  # deletes what is there, or complains of it
        delete(spark, f"{path}/_SUCCESS")
    # As Spark names the folders of partitions, where a colon is escaped.
    at = {"window_max_ts": F.replace(window_max_ts(F.col("window")["end"]), F.lit(":"), F.lit("%3A")),
          "pane_index": F.col("pane_index").cast("string")}
    folder = [F.concat(F.lit(f"{n}="), F.coalesce(c, F.lit(_NULL_FOLDER))) for n, c in at.items()]
    name = F.concat_ws("/", *folder, F.lit(f"part-{uuid.uuid4().hex}.txt")).alias("_file")
    write_named_files(panes.select("*", name), path, "_file", payload, order, separator)
    marked.mode("append").text(path)


def write_pane_bodies(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The ``(path, n_elements, body)`` rows of ``pane_files``, one file each, for
    bodies whose elements are joined by another separator or by none.

    A path ``<prefix>/<last millisecond>/<pane index>`` becomes the folders
    ``prefix=../window_max_ts=../pane_index=..``, as of ``write_pane_files``.
    """
    at = F.split("path", "/")
    last = {"window_max_ts": F.get(at, F.size(at) - 2), "pane_index": F.get(at, F.size(at) - 1)}
    prefix = F.array_join(F.slice(at, F.lit(1), F.greatest(F.size(at) - 2, F.lit(0))), "/")
    files.select(prefix.alias("prefix"), *[c.alias(n) for n, c in last.items()], F.col("body").alias("value")).repartition(
        "prefix", *last
    ).write.mode(mode).partitionBy("prefix", *last).text(path)
