"""What the operators read, made from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path, use_utc
from millrace.sinks.files import write_text
from millrace.sources.layout import spread_small

# The columns of a message table, as a schema document.
MESSAGE_COLUMNS = """
{"schema": {"fields": [
  {"name": "FinanceKey", "type": "INTEGER", "mode": "nullable"},
  {"name": "DateKey", "type": "STRING", "mode": "nullable"},
  {"name": "OrganizationName", "type": "STRING", "mode": "nullable"},
  {"name": "DepartmentGroupName", "type": "STRING", "mode": "nullable"},
  {"name": "ScenarioName", "type": "STRING", "mode": "nullable"},
  {"name": "AccountDescription", "type": "STRING", "mode": "nullable"},
  {"name": "Amount", "type": "FLOAT", "mode": "nullable"},
  {"name": "ProcessWindow", "type": "STRING", "mode": "nullable"},
  {"name": "EventTimestamp", "type": "TIMESTAMP", "mode": "nullable"},
  {"name": "ProcessTimestamp", "type": "TIMESTAMP", "mode": "nullable"}
]}}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(ts: Column) -> Column:
    """As DuckDB's TIMESTAMP, which has no zone."""
    return ts.cast("timestamp_ntz")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
    return spread_small(text)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# -- finance lines, two parts of lineitem ------------------------------------


def finance_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both parts together are the whole table."""
    items = spread_small(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_returnflag", "l_linestatus",
            "l_extendedprice",
        )
    )
    fields = [
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.col("l_suppkey"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.col("l_orderkey"),
        F.col("l_extendedprice"),
    ]
    line = F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value")
    first = F.col("l_linenumber") <= 2
    return items.where(first).select(line), items.where(~first).select(line)


def finance_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    paths = []
    for n, part in enumerate(finance_lines(spark, sf_dir), start=1):
        path = scratch_path(spark, f"finance-part{n}")
        write_text(part, path)
        paths.append(path)
    return paths[0], paths[1]


# -- JSON messages, one per event ---------------------------------------------


def _quoted(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value.cast("string"), F.lit('"'))


def _bare(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def json_messages(spark: SparkSession, sf_dir: str, damaged: bool = False,
                  denied: bool = False) -> DataFrame:
    """``(event_id, event_ts, timestamp_ms, payload)``.

    ScenarioName is a JSON null for views, the text NULL for clicks, missing for
    signups and a nested object for the rest.  ``damaged``: the payloads of
    errors break off half-way.  ``denied``: three keys more.
    """
    kind = F.col("event_type")
    scenario = (
        F.when(kind == "view", '"ScenarioName":null')
        .when(kind == "click", '"ScenarioName":"NULL"')
        .when(kind != "signup", _bare("ScenarioName", F.col("props")))
    )
    fields = [
        _bare("FinanceKey", F.col("event_id")),
        _quoted("DateKey", F.date_format("ts", "yyyyMMdd")),
        _quoted("OrganizationName", F.col("user_id")),
        _quoted("DepartmentGroupName", kind),
        scenario,
        _quoted("AccountDescription", kind),
        _bare("Amount", F.col("value")),
        _bare("amount", F.col("value")),
        F.lit('"Extra":"x"'),
    ]
    if denied:
        fields += [F.lit('"Category":"c"'), F.lit('"MessageType":"m"'), _quoted("TimeStamp", F.col("ts"))]
    payload = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    if damaged:
        half = F.substring(payload, F.lit(1), F.floor(F.length(payload) / 2).cast("int"))
        payload = F.when(kind == "error", half).otherwise(payload)
    millis = F.unix_millis("ts")
    return spread_small(events(spark, sf_dir)).select(
        "event_id",
        F.timestamp_millis(millis).alias("event_ts"),
        millis.cast("string").alias("timestamp_ms"),
        payload.alias("payload"),
    )


# -- arrivals -------------------------------------------------------------------


STREAM_SCHEMA = "event_id bigint, payload string, timestamp_ms string"
ROUNDS = 3
_FIRST_DAY = 19723  # 2024-01-01, where the events begin
_ROUND_DAYS = 11
_FAR_MS = 4102444800000  # 2100-01-01: pushes the watermark past every window


def stream_rounds(spark: SparkSession, sf_dir: str, late: bool) -> list[DataFrame]:
    """The messages in the rounds they arrive in: by event day, or, if ``late``,
    a third of them three days after it.  The last round ends with a message
    far ahead, so that every window closes."""
    day = F.floor(F.col("timestamp_ms").cast("bigint") / 86_400_000) - _FIRST_DAY
    if late:
        day = day + F.when(F.col("event_id") % 3 == 0, 3).otherwise(0)
    turn = F.least(F.floor(day / _ROUND_DAYS), F.lit(ROUNDS - 1))
    sent = json_messages(spark, sf_dir).select("event_id", "payload", "timestamp_ms", turn.alias("turn"))
    rounds = [sent.where(F.col("turn") == n).drop("turn") for n in range(ROUNDS)]
    closing = spark.createDataFrame([(-1, "{}", str(_FAR_MS))], STREAM_SCHEMA)
    rounds[-1] = rounds[-1].unionByName(closing)
    return rounds
