"""How scanned rows lie over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_small(scan: DataFrame) -> DataFrame:
    """The rows of a small scan on every core.

    A file is read by no more tasks than it has row groups, so a small table can
    keep one core busy with all the work that follows.  Where Spark cuts the scan
    into as many partitions as there are cores, which it does with every table
    above ``cores * spark.sql.files.maxPartitionBytes``, nothing is moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
