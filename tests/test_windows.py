import pytest
from pyspark.sql import functions as F

from millrace.functions.windows import (
    WINDOW_TYPES, days, hours, minutes, months, window_for, window_max_ts, window_suffix,
    window_size, window_text,
)


def _window(spark, text, size):
    row = (
        spark.createDataFrame([(text,)], "t string")
        .select(window_for(F.col("t").cast("timestamp"), size).alias("w"))
        .select(F.col("w.start").cast("string"), F.col("w.end").cast("string"))
        .first()
    )
    return tuple(row)


@pytest.mark.parametrize("text, size, start, end", [
    ("2024-01-03 09:09:59.999999", minutes(5), "2024-01-03 09:05:00", "2024-01-03 09:10:00"),
    ("2024-01-03 09:10:00", minutes(5), "2024-01-03 09:10:00", "2024-01-03 09:15:00"),
    ("1969-12-31 23:59:59", minutes(5), "1969-12-31 23:55:00", "1970-01-01 00:00:00"),
    ("2024-01-03 10:00:00", days(7), "2023-12-28 00:00:00", "2024-01-04 00:00:00"),
    ("2024-01-03 10:00:00", days(3), "2024-01-03 00:00:00", "2024-01-06 00:00:00"),
    ("2024-02-29 12:00:00", months(1), "2024-02-01 00:00:00", "2024-03-01 00:00:00"),
    ("2023-12-31 23:59:59", months(1), "2023-12-01 00:00:00", "2024-01-01 00:00:00"),
    ("2024-05-15 00:00:00", months(3), "2024-04-01 00:00:00", "2024-07-01 00:00:00"),
    ("1969-11-15 00:00:00", months(3), "1969-10-01 00:00:00", "1970-01-01 00:00:00"),
])
def test_bounds(spark, text, size, start, end):
    assert _window(spark, text, size) == (start, end)


@pytest.mark.parametrize("size", [minutes(5), hours(6), days(3), days(14)])
def test_fixed_windows_are_sparks_own(spark, size):
    ts = spark.range(500).select(F.timestamp_seconds(1704000000 + F.col("id") * 7919).alias("ts"))
    own = ts.select("ts", F.window("ts", size.interval).alias("w")).select("w.start", "w.end")
    ours = ts.select(window_for(F.col("ts"), size).alias("w")).select("w.start", "w.end")
    assert own.exceptAll(ours).count() == 0


def test_types_in_both_modes():
    assert window_size("ONE_HOUR") == hours(1) and window_size("ONE_HOUR", "literal") == minutes(1)
    assert window_size("TWO_WEEK") == days(14) and window_size("TWO_WEEK", "literal") == days(2)
    same = [n for n in WINDOW_TYPES if window_size(n) == window_size(n, "literal")]
    assert len(WINDOW_TYPES) == 13 and len(same) == 7
    with pytest.raises(ValueError):
        window_size("ONE_HOUR", "other")


def test_texts(spark):
    ts = F.lit("2024-01-03 09:05:00").cast("timestamp")
    w = window_for(ts, minutes(5))
    row = spark.range(1).select(
        window_suffix(ts, "FIVE_MINUTE"), window_suffix(ts, "ONE_WEEK"), window_suffix(ts, "ONE_MONTH"),
        window_max_ts(w["end"]), window_text(w),
    ).first()
    assert tuple(row) == (
        "20240103_905", "20240103", "202401", "2024-01-03T09:09:59.999Z",
        "[2024-01-03T09:05:00.000Z..2024-01-03T09:10:00.000Z)",
    )
