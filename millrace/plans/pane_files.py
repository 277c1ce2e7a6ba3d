"""A message stream cut into panes, one file each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.windows import WindowSize, hours
from millrace.streaming.panes import PaneRules, Sink, Trigger, stream_panes
from millrace.streaming.sinks import pane_files

# Window, lateness and triggers of this program.
WINDOW = hours(1)
ALLOWED_LATENESS_MS = 24 * 3600 * 1000
PANE_ELEMENTS = 1000
LATE_DELAY_MS = 10_000


def rules(
    size: WindowSize = WINDOW,
    allowed_lateness_ms: int = ALLOWED_LATENESS_MS,
    pane_elements: int = PANE_ELEMENTS,
    late_delay_ms: int = LATE_DELAY_MS,
    shards: int | Column = 1,
    **options,
) -> PaneRules:
    return PaneRules(
        "event_ts",
        size,
        allowed_lateness_ms,
        early=Trigger(count=pane_elements),
        late=Trigger(count=pane_elements, delay_ms=late_delay_ms),
        shards=shards,
        **options,
    )


def writer(messages: DataFrame, target: str, ledger: str, checkpoint: str, prefix: str = "",
           separator: str = "", late: Sink | None = None, **options) -> DataStreamWriter:
    """Files ``<prefix>/<last millisecond of the window>/<pane index>`` below ``target``.

    Call ``.trigger(..).start()`` on the result.  More than one shard puts its number
    before the pane index.
    """
    one = options.get("shards", 1)
    sink = pane_files(target, "payload", prefix, separator, by_shard=not (isinstance(one, int) and one == 1))
    return stream_panes(messages, rules(**options), ledger, checkpoint, sink, late)
