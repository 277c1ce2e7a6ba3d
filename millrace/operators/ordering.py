"""Row numbers within groups that no single task could hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import settled

_ROW, _AT, _PIECE, _FIRST, _BEFORE, _N = "_row", "_at", "_piece", "_first", "_before", "_n"


def _sum_before(earlier: WindowSpec) -> Column:
    return F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_BEFORE)


def _sum_all(group: Sequence[str], total: str) -> Column:
    return F.sum(_N).over(Window.partitionBy(*group)).alias(total)


def number_by_slot(df: DataFrame, group: Sequence[str], slot: str, order: Sequence[str | Column],
                   slot_counts: DataFrame, name: str, total: str) -> DataFrame:
    """``name``, the 1-based position of every row in its group, and ``total``, the
    rows of the group, where ``slot`` cuts a group into consecutive stretches of
    ``order``.

    Rows move once, to their slot; ``slot_counts`` (``group``, ``slot``,
    ``_n`` rows) turns a position in the slot into one in the group.  A task
    sorts one slot at a time, and adds up one count per slot of a group.
    """
    keys = [*group, slot]
    earlier = Window.partitionBy(*group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    before = slot_counts.select(*keys, _sum_before(earlier), _sum_all(group, total))
    here = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = df.withColumn(_AT, here)
    position = F.col(_AT) + F.col(_BEFORE)
    return numbered.join(before, keys).withColumn(name, position).drop(_AT, _BEFORE)


def number_by_range(df: DataFrame, group: Sequence[str], order: Sequence[str],
                    name: str, total: str) -> DataFrame:
    """The same numbers for any data, also where all rows are alike.

    The rows are range-partitioned by group and order with their scan position
    as the last key, so neither a hot group nor a hot instant nor copies of one
    row can fill a task.  They are written once, because the two reads that
    follow must see the same partitions.
    """
    keys = [*group, *order]
    rows = df.withColumn(_ROW, F.monotonically_increasing_id())
    laid_out = (
        rows.repartitionByRange(*keys, _ROW)
        .sortWithinPartitions(*keys, _ROW)
        .withColumn(_PIECE, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id())
        .drop(_ROW)
    )
    placed = settled(laid_out)
    # One row per partition and group in it, so small that it is mostly broadcast.
    pieces = settled(
        placed.groupBy(*group, _PIECE).agg(F.count(F.lit(1)).alias(_N), F.min(_AT).alias(_FIRST))
    )
    earlier = Window.partitionBy(*group).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(*group, _PIECE, _FIRST, _sum_before(earlier), _sum_all(group, total))
    position = F.col(_BEFORE) + F.col(_AT) - F.col(_FIRST) + 1
    return (
        placed.join(before, [*group, _PIECE])
        .withColumn(name, position)
        .drop(_PIECE, _AT, _FIRST, _BEFORE)
    )
