"""Writes that a rerun cannot double.

What a batch writes is staged next to its place, under a name that readers pass over,
and then renamed.  The folders that are there are the manifest of the batches that are
done: one that is there already is not written again, and what a broken run left behind
is replaced.  This asks for a file system whose rename of a folder is one step, such as
HDFS or a shared disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BATCH_COLUMN = "batch"


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _located(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _located(spark, path)
    files.delete(place, True)


def write_once(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as a Parquet table at ``path``, unless there is one, read back.

    A run that finds the table reads what an earlier run has written, whatever ``df``
    would now be.
    """
    spark = df.sparkSession
    files, place = _located(spark, path)
    if not files.exists(place):
        staged = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_staged-{place.getName()}")
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(staged.toString())
        if not files.rename(staged, place) and not files.exists(place):
            raise OSError(f"cannot rename {staged.toString()} to {path}")
    return spark.read.schema(df.schema).parquet(path)


def append_once(df: DataFrame, path: str, batch: int | str, partition_by: Sequence[str] = ()) -> None:
    """The rows of one batch, added to the table at ``path`` once.

    ``batch`` names the batch, such as the number that ``foreachBatch`` gives, and is a
    partition column of the table.  Batches may be written in any order and again.
    """
    if BATCH_COLUMN in {c.lower() for c in df.columns}:
        raise ValueError(f"rename the column {BATCH_COLUMN}: the table has one of this name")
    write_once(df, f"{path.rstrip('/')}/{BATCH_COLUMN}={batch}", partition_by)


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` without the batches its rows came in."""
    return spark.read.parquet(path).drop(BATCH_COLUMN)
