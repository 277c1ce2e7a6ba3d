"""Windows of a stream that fire once, when the watermark passes their end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.windows import WindowSize

_DAY_MS = 86_400_000
#: On the line of months each month has so many days, more than any month needs.
_LINE_DAYS = 40
#: No month is shorter.
_LEAST_MONTH_DAYS = 28


def closed_windows(df: DataFrame, event_ts: str, size: WindowSize, *aggregates: Column,
                   allowed_lateness_ms: int = 0) -> DataFrame:
    """One row per window, ``window`` and the aggregates, for append mode.

    Partial aggregates are made where the rows are read and merged in the state, so a
    hot window shuffles one row per task and keeps one row per window.  A window waits
    for rows up to ``allowed_lateness_ms`` after its end, 28 days at most where it is one
    of months; rows later than that are left out, and counted by Spark in the
    ``numRowsDroppedByWatermark`` of the query's progress.
    """
    if size.unit == "month":
        return _closed_months(df, event_ts, size, aggregates, allowed_lateness_ms)
    return (
        df.withWatermark(event_ts, f"{allowed_lateness_ms} milliseconds")
        .groupBy(F.window(event_ts, size.interval))
        .agg(*aggregates)
    )


def _closed_months(df: DataFrame, event_ts: str, size: WindowSize, aggregates: tuple[Column, ...],
                   allowed_lateness_ms: int) -> DataFrame:
    """Months are no interval that a watermark can close.  So time is told on a line on which
    every month begins ``_LINE_DAYS`` days after the one before, and goes on day by day from
    there; windows of months have a fixed length on it, and what comes first stays first."""
    if allowed_lateness_ms > _LEAST_MONTH_DAYS * _DAY_MS:
        raise ValueError(f"windows of months wait for {_LEAST_MONTH_DAYS} days at most")
    day_micros = _DAY_MS * 1000
    at = F.col(event_ts)
    month = (F.year(at) - 1970) * 12 + F.month(at) - 1
    into = F.unix_micros(at) - F.unix_micros(F.date_trunc("month", at))
    line = "_line"
    told = df.withColumn(line, F.timestamp_micros(month.cast("bigint") * _LINE_DAYS * day_micros + into))
    closed = (
        told.withWatermark(line, f"{allowed_lateness_ms} milliseconds")
        .groupBy(F.window(line, f"{_LINE_DAYS * size.count} days").alias(line))
        .agg(*aggregates)
    )
    epoch = F.lit("1970-01-01").cast("date")

    def back(edge: str) -> Column:
        number = F.unix_micros(F.col(line)[edge]) / F.lit(_LINE_DAYS * day_micros)
        return F.add_months(epoch, F.round(number).cast("int")).cast("timestamp").alias(edge)

    rest = [c for c in closed.columns if c != line]
    return closed.select(F.struct(back("start"), back("end")).alias("window"), *rest)
