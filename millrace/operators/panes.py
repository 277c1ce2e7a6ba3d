"""Batch form of windows cut into panes: a valid run of the streaming operator in
``millrace.streaming.panes``, whose outcome does not depend on when a micro-batch
happened to start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.windows import WindowSize, floor_div, pane_path, window_for
from millrace.operators.ordering import number_by_range, number_by_slot
from millrace.session import settled

EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"

# Most rows that one task may have to sort because they share a slot.
MAX_TASK_ROWS = 5_000_000
# A window is cut into at most this many stretches of time.
SLOTS_PER_WINDOW = 65_536

_SLOT, _RANK, _TOTAL, _N = "_slot", "_rank", "_total", "_n"


def _peak(counts: DataFrame) -> int:
    return counts.agg(F.max(_N)).first()[0] or 0


def _sortable(df: DataFrame, but: str) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name != but and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def assign_panes(
    df: DataFrame,
    event_ts: str,
    size: WindowSize,
    pane_size: int,
    order: Sequence[str] = (),
    max_task_rows: int = MAX_TASK_ROWS,
) -> DataFrame:
    """Adds ``window``, ``pane_index``, ``timing``, ``is_first``, ``is_last``.

    Rows of a window, in the order of event time and then ``order``, fill panes
    of ``pane_size``; a full pane fires early, what is left fires on time.  Each
    row is in one pane.  Rows without an event time belong to no window.

    ``order`` is every other column if left out.  Rows that tie in it should be
    alike: which of them goes first may change when a lost task is run again.
    """
    order = list(order) or _sortable(df, but=event_ts)
    rows = df.where(F.col(event_ts).isNotNull()).withColumn("window", window_for(F.col(event_ts), size))
    width = max(1, -(-size.longest_micros // SLOTS_PER_WINDOW))
    offset = F.unix_micros(event_ts) - F.unix_micros(F.col("window")["start"])
    slotted = rows.withColumn("_ws", F.col("window")["start"]).withColumn(
        _SLOT, floor_div(offset, width)
    )
    # Reads the event time only; settled because three steps below read it.
    counts = settled(slotted.groupBy("_ws", _SLOT).agg(F.count(F.lit(1)).alias(_N)))
    by = [event_ts, *order]
    if _peak(counts) <= max_task_rows:
        ranked = number_by_slot(slotted, ["_ws"], _SLOT, by, counts, _RANK, _TOTAL)
    else:
        ranked = number_by_range(slotted, ["_ws"], by, _RANK, _TOTAL)
    pane = floor_div(F.col(_RANK) - 1, pane_size)
    full = (F.col("pane_index") + 1) * F.lit(pane_size) <= F.col(_TOTAL)
    return (
        ranked.withColumn("pane_index", pane)
        .withColumn("timing", F.when(full, EARLY).otherwise(ON_TIME))
        .withColumn("is_first", F.col("pane_index") == 0)
        .withColumn("is_last", (F.col("pane_index") + 1) * F.lit(pane_size) >= F.col(_TOTAL))
        .drop("_ws", _SLOT, _RANK, _TOTAL)
    )


def pane_files(
    panes: DataFrame,
    payload: str,
    prefix: str,
    order: Sequence[str],
    separator: str = "\n",
) -> DataFrame:
    """``(path, n_elements, body)``, one row per pane: what its file is called and
    holds.  A pane has at most ``pane_size`` elements, so a body is as long as the
    caller chose to make it."""
    element = F.struct(*order, F.col(payload).alias("_payload"))
    grouped = panes.groupBy("window", "pane_index").agg(
        F.sort_array(F.collect_list(element)).alias("_elements")
    )
    return grouped.select(
        pane_path(prefix, F.col("window")["end"], F.col("pane_index")).alias("path"),
        F.size("_elements").cast("bigint").alias("n_elements"),
        F.array_join(F.col("_elements")["_payload"], separator).alias("body"),
    )
