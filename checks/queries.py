"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import (
    MESSAGE_COLUMNS,
    events,
    finance_files,
    finance_lines,
    json_messages,
    lines,
    ntz,
    stream_rounds,
    table,
)
from checks.replay import replay
from millrace.functions.messages import field_text
from millrace.functions.windows import (
    WINDOW_TYPES,
    WindowSize,
    days,
    hours,
    minutes,
    months,
    pane_path,
    window_by_type,
    window_max_ts,
    window_suffix,
    zoned_text,
)
from millrace.operators import grouping, panes, rows, words
from millrace.operators.windows import with_shard_table, with_typed_window, with_window
from millrace.plans import account_blocks, fixed_tables, pane_files, window_tables, word_report
from millrace.session import scratch_path
from millrace.sinks import files
from millrace.sinks.commits import appended
from millrace.sinks.pane_format import read_named_files, write_named_files
from millrace.sources import message_log
from millrace.sources.layout import spread_small
from millrace.sources.schema import load_schema, schema_from_json
from millrace.sources.text import ACCOUNT, parse_finance_lines, scan_finance_lines, scan_text, scan_values
from millrace.streaming import sinks as stream_sinks
from millrace.streaming.panes import PaneRules, Trigger, stream_panes
from millrace.streaming.windows import closed_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokenize(lines(spark, sf_dir), keep=["doc_id"])


# -- text ---------------------------------------------------------------------


@query
def scan_text_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    files.write_text(lines(spark, sf_dir).select("value"), path)
    return scan_text(spark, path)


@query
def sink_text(spark, sf_dir):
    path = scratch_path(spark, "words")
    files.write_text(_words(spark, sf_dir).select("word"), path)
    return scan_text(spark, path).select(F.col("value").alias("word"))


@query
def tokenize(spark, sf_dir):
    return _words(spark, sf_dir)


@query
def word_length(spark, sf_dir):
    return words.with_length(_words(spark, sf_dir))


@query
def mean_global(spark, sf_dir):
    return words.mean_length(_words(spark, sf_dir))


@query
def side_input_scalar(spark, sf_dir):
    return words.with_mean(_words(spark, sf_dir))


@query
def filter_ge_scalar(spark, sf_dir):
    return words.at_least_mean(_words(spark, sf_dir))


@query
def filter_lt_scalar(spark, sf_dir):
    return words.below_mean(_words(spark, sf_dir))


@query
def concat_word_len(spark, sf_dir):
    above = words.at_least_mean(_words(spark, sf_dir))
    return above.select("doc_id", words.word_with_length(F.col("word")).alias("value"))


@query
def multi_output(spark, sf_dir):
    outputs = words.word_outputs(_words(spark, sf_dir))
    named = [df.select(F.lit(name).alias("output"), "value") for name, df in outputs.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def multi_output_one_pass(spark, sf_dir):
    return words.word_outputs_tagged(_words(spark, sf_dir), keep=["doc_id"])


@query
def side_output_split(spark, sf_dir):
    return words.with_band(_words(spark, sf_dir))


@query
def upper_word(spark, sf_dir):
    return words.upper_words(_words(spark, sf_dir))


@query
def word_colon_len(spark, sf_dir):
    return words.words_with_length_text(_words(spark, sf_dir))


@query
def word_chain(spark, sf_dir):
    return words.word_chain(lines(spark, sf_dir), keep=["doc_id"])


@query
def word_report_files(spark, sf_dir):
    source, target = scratch_path(spark, "text"), scratch_path(spark, "report")
    files.write_text(lines(spark, sf_dir).select("value"), source)
    word_report.run(spark, source, target)
    return spark.read.text(target).select("output", "value")


# -- finance lines ------------------------------------------------------------


def _finance(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    first, second = finance_lines(spark, sf_dir)
    return parse_finance_lines(first), parse_finance_lines(second)


def _all_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _finance(spark, sf_dir)
    return first.unionByName(second)


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(values), lambda v: v.cast("string")), ",")


@query
def scan_finance_csv(spark, sf_dir):
    return scan_finance_lines(spark, list(finance_files(spark, sf_dir)))


@query
def key_by_field(spark, sf_dir):
    return grouping.key_by(_all_finance(spark, sf_dir), ACCOUNT)


@query
def group_by_key(spark, sf_dir):
    """Every key in parts of four records."""
    groups = grouping.group_by_key(_all_finance(spark, sf_dir), ACCOUNT, ["FinanceKey", "Amount"], max_group_rows=4)
    return groups.select(
        "key", "part", "n_parts",
        F.size("records").cast("bigint").alias("n"),
        _joined(F.col("records")["FinanceKey"]).alias("finance_keys"),
        _joined(F.col("records")["Amount"]).alias("amounts"),
    )


@query
def group_by_key_hot(spark, sf_dir):
    """Three keys for all rows, each cut into slices and parts, and added up again."""
    groups = grouping.group_by_key(
        _all_finance(spark, sf_dir), "DepartmentGroupName", ["FinanceKey"], max_group_rows=2000, slice_bytes=1 << 16
    )
    records = groups.select("key", F.explode("records").alias("record"))
    return records.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("record.FinanceKey").alias("sum_keys")
    )


@query
def cogroup(spark, sf_dir):
    """Every key in parts of three records, those of the left first."""
    groups = grouping.cogroup(*_finance(spark, sf_dir), ACCOUNT, ["Amount"], max_group_rows=3)
    left, right = F.col("p1")["Amount"], F.col("p2")["Amount"]
    return groups.select(
        "key", "part", "n_parts",
        F.size("p1").cast("bigint").alias("n1"),
        F.size("p2").cast("bigint").alias("n2"),
        _joined(left).alias("amounts1"),
        _joined(right).alias("amounts2"),
    )


@query
def cogroup_hot(spark, sf_dir):
    """Two keys for all rows, cut into parts on either side."""
    groups = grouping.cogroup(
        *_finance(spark, sf_dir), "ScenarioName", ["FinanceKey"], max_group_rows=2000, slice_bytes=1 << 16
    )
    sides = [
        groups.select("key", F.lit(n).alias("side"), F.explode(p).alias("record"))
        for n, p in ((1, "p1"), (2, "p2"))
    ]
    return sides[0].unionByName(sides[1]).groupBy("key", "side").agg(
        F.count(F.lit(1)).alias("n"), F.sum("record.FinanceKey").alias("sum_keys")
    )


@query
def format_cogroup(spark, sf_dir):
    groups = grouping.cogroup(*_finance(spark, sf_dir), ACCOUNT, ["Amount"], max_group_rows=3)
    return grouping.format_cogroup(groups, "Amount", ordered=True).select("key", "part", "n_parts", "block")


@query
def cogroup_lines(spark, sf_dir):
    """The text of every account, line by line."""
    return grouping.cogroup_lines(*_finance(spark, sf_dir), ACCOUNT, "Amount", ordered=True)


@query
def account_blocks_files(spark, sf_dir):
    target = scratch_path(spark, "blocks")
    account_blocks.run(spark, *finance_files(spark, sf_dir), target)
    return scan_text(spark, target)


@query
def account_blocks_hot_files(spark, sf_dir):
    """The same with the lines of an account in order."""
    target = scratch_path(spark, "blocks")
    account_blocks.run(spark, *finance_files(spark, sf_dir), target, ordered=True)
    return scan_text(spark, target)


# -- JSON messages --------------------------------------------------------------

SCHEMA = schema_from_json(MESSAGE_COLUMNS)
TIMES = ("EventTimestamp", "ProcessTimestamp")


def _process_ts() -> Column:
    return F.col("event_ts") + F.expr("interval 5 seconds")


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: ntz(F.col(c)) for c in TIMES if c in df.columns})


def _projected(df: DataFrame, on_error: str = "raise", schema: T.StructType = SCHEMA) -> DataFrame:
    placed = with_window(df, "event_ts", minutes(5))
    projected = rows.project_schema(
        placed, schema, event_ts="event_ts", window="window", process_ts=_process_ts(),
        on_error=on_error,
    )
    return _plain(projected)


@query
def json_project_schema(spark, sf_dir):
    return _projected(json_messages(spark, sf_dir))


@query
def json_project_loaded_schema(spark, sf_dir):
    folder = scratch_path(spark, "schemas")
    document = spark.createDataFrame([(" ".join(MESSAGE_COLUMNS.split()),)], "value string")
    files.write_text(document.coalesce(1), f"{folder}/Messages_schema.json")
    return _projected(json_messages(spark, sf_dir), schema=load_schema(spark, folder, "Messages"))


@query
def on_error_raise(spark, sf_dir):
    return _projected(json_messages(spark, sf_dir, denied=True))


@query
def on_error_drop(spark, sf_dir):
    return _projected(json_messages(spark, sf_dir, damaged=True), on_error="drop")


@query
def on_error_drop_count(spark, sf_dir):
    return json_messages(spark, sf_dir, damaged=True).agg(rows.bad_payloads("payload"))


@query
def json_project_denylist(spark, sf_dir):
    sent = json_messages(spark, sf_dir, damaged=True, denied=True)
    built = rows.project_denylist(sent, process_ts=_process_ts(), keep=("event_id",))
    return built.select("event_id", F.explode("row").alias("name", "value"))


@query
def json_project_required(spark, sf_dir):
    sent = with_window(json_messages(spark, sf_dir, damaged=True), "event_ts", hours(1))
    return _plain(rows.project_required(sent, process_ts=_process_ts()))


@query
def null_literal_to_empty(spark, sf_dir):
    sent = json_messages(spark, sf_dir)
    return rows.payload_field(sent, "ScenarioName").select("event_id", "ScenarioName")


@query
def meta_event_ts(spark, sf_dir):
    return _projected(json_messages(spark, sf_dir)).select("FinanceKey", "EventTimestamp")


@query
def meta_process_window(spark, sf_dir):
    return _projected(json_messages(spark, sf_dir)).select("FinanceKey", "ProcessWindow")


@query
def meta_process_ts(spark, sf_dir):
    return json_messages(spark, sf_dir).select(
        "event_id", zoned_text(_process_ts()).alias("ProcessTimestamp")
    )


@query
def meta_window_pane(spark, sf_dir):
    """Rows built after a grouping, with the pane they were in."""
    sent = json_messages(spark, sf_dir)
    cut = panes.assign_panes(sent, "event_ts", hours(1), 5, ["event_id"])
    built = rows.project_required(
        cut,
        pane={"is_first": "is_first", "is_last": "is_last", "timing": "timing"},
        process_ts=_process_ts(),
        keep=("event_id",),
    )
    return built.select("event_id", "window", "isFirst", "isLast", "timing", "event_time")


# -- table sinks -----------------------------------------------------------------


@query
def sink_table_append(spark, sf_dir):
    """Two appends: the messages once as they are, once with the bad ones dropped."""
    path = scratch_path(spark, "appended")
    for damaged in (False, True):
        sent = with_window(json_messages(spark, sf_dir, damaged=damaged), "event_ts", minutes(5))
        built = rows.project_schema(
            sent, SCHEMA, event_ts="event_ts", window="window", process_ts=_process_ts(),
            on_error="drop",
        )
        files.append_table(built, path, SCHEMA)
    return _plain(spark.read.parquet(path))


@query
def sink_table_append_again(spark, sf_dir):
    """The two appends of ``sink_table_append``, each run twice."""
    path = scratch_path(spark, "appended")
    for batch in (0, 1, 0, 1):
        sent = with_window(json_messages(spark, sf_dir, damaged=batch == 1), "event_ts", minutes(5))
        built = rows.project_schema(
            sent, SCHEMA, event_ts="event_ts", window="window", process_ts=_process_ts(), on_error="drop",
        )
        files.append_table(built, path, SCHEMA, batch=batch)
    return _plain(appended(spark, path))


@query
def denylist_table(spark, sf_dir):
    path = scratch_path(spark, "denylist")
    sent = json_messages(spark, sf_dir, damaged=True, denied=True)
    fixed_tables.append_denylist(sent, path, SCHEMA, process_ts=_process_ts())
    columns = [f.name for f in SCHEMA.fields if f.name not in ("ProcessWindow", "EventTimestamp")]
    return _plain(spark.read.parquet(path).select(*columns))


@query
def required_table(spark, sf_dir):
    path = scratch_path(spark, "required")
    sent = with_window(json_messages(spark, sf_dir, damaged=True), "event_ts", hours(1))
    fixed_tables.append_required(sent, path, process_ts=_process_ts())
    return _plain(spark.read.parquet(path))


@query
def sink_table_per_window(spark, sf_dir):
    path = scratch_path(spark, "by-window")
    built = window_tables.rows(
        json_messages(spark, sf_dir), SCHEMA, "Messages", shard_type="THREE_HOUR",
        process_ts=_process_ts(),
    )
    files.append_window_tables(built, path, SCHEMA)
    return _plain(spark.read.parquet(path))


@query
def sink_table_per_window_again(spark, sf_dir):
    """Two batches of messages, one of them run twice."""
    path = scratch_path(spark, "by-window")
    for batch in (0, 1, 0):
        sent = json_messages(spark, sf_dir).where(F.col("event_id") % 2 == batch)
        built = window_tables.rows(sent, SCHEMA, "Messages", shard_type="THREE_HOUR", process_ts=_process_ts())
        files.append_window_tables(built, path, SCHEMA, batch=batch)
    return _plain(appended(spark, path))


@query
def sink_table_per_window_stream(spark, sf_dir):
    def start(sent, target, checkpoint):
        return window_tables.writer(
            sent, SCHEMA, "Messages", target, checkpoint, shard_type="ONE_DAY",
            process_ts=_process_ts(),
        )

    written = spark.read.parquet(replay(spark, sf_dir, start))
    return _plain(written.where(F.col("FinanceKey").isNotNull()))


# -- windows ---------------------------------------------------------------------


def _bounds(window: str = "window") -> list[Column]:
    return [
        ntz(F.col(window)["start"]).alias(f"{window}_start"),
        ntz(F.col(window)["end"]).alias(f"{window}_end"),
    ]


def _windowed(spark: SparkSession, sf_dir: str, size: WindowSize) -> DataFrame:
    return with_window(events(spark, sf_dir), "ts", size).select("event_id", *_bounds())


@query
def win_fixed_5_minutes(spark, sf_dir):
    return _windowed(spark, sf_dir, minutes(5))


@query
def win_fixed_1_hour(spark, sf_dir):
    return _windowed(spark, sf_dir, hours(1))


@query
def win_calendar_days(spark, sf_dir):
    return _windowed(spark, sf_dir, days(3))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))


@query
def win_calendar_months(spark, sf_dir):
    return with_window(_orders(spark, sf_dir), "ts", months(1)).select("o_orderkey", *_bounds())


@query
def win_calendar_quarters(spark, sf_dir):
    return with_window(_orders(spark, sf_dir), "ts", months(3)).select("o_orderkey", *_bounds())


def _by_type(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    ts = F.col("ts")
    each = []
    for name in WINDOW_TYPES:
        window = window_by_type(ts, name, mode)
        each.append(
            F.struct(
                F.lit(name).alias("window_type"),
                ntz(window["start"]).alias("window_start"),
                ntz(window["end"]).alias("window_end"),
                window_suffix(window["start"], name).alias("suffix"),
            )
        )
    return spread_small(events(spark, sf_dir)).select("event_id", F.inline(F.array(*each)))


@query
def win_by_type_nominal(spark, sf_dir):
    return _by_type(spark, sf_dir, "nominal")


@query
def win_by_type_literal(spark, sf_dir):
    return _by_type(spark, sf_dir, "literal")


@query
def win_suffix(spark, sf_dir):
    placed = with_typed_window(_orders(spark, sf_dir), "ts", "ONE_MONTH")
    return placed.select("o_orderkey", window_suffix(F.col("window")["start"], "ONE_MONTH").alias("suffix"))


@query
def win_rewindow(spark, sf_dir):
    """The row's own window, and the table by another one."""
    placed = with_window(events(spark, sf_dir), "ts", minutes(5))
    return with_shard_table(placed, "ts", "Messages", "SIX_HOUR").select(
        "event_id", *_bounds(), "table_name"
    )


@query
def window_access(spark, sf_dir):
    placed = with_window(events(spark, sf_dir), "ts", hours(1))
    return placed.select("event_id", window_max_ts(F.col("window")["end"]).alias("window_max_ts"))


# -- panes, batch -------------------------------------------------------------------


def _panes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return panes.assign_panes(events(spark, sf_dir), "ts", hours(1), 5, ["event_id"], **options)


_PANE = ["pane_index", "timing", "is_first", "is_last"]


@query
def pane_info(spark, sf_dir):
    return _panes(spark, sf_dir).select("event_id", ntz(F.col("window")["start"]).alias("window_start"), *_PANE)


@query
def pane_info_hot(spark, sf_dir):
    """As if no task could sort more than two rows of a slot."""
    cut = _panes(spark, sf_dir, max_task_rows=0)
    return cut.select("event_id", ntz(F.col("window")["start"]).alias("window_start"), *_PANE)


@query
def trig_early_count(spark, sf_dir):
    cut = panes.assign_panes(events(spark, sf_dir), "ts", days(1), 100, ["event_id"])
    return cut.groupBy(ntz(F.col("window")["start"]).alias("window_start"), "pane_index", "timing").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query
def group_by_key_windowed(spark, sf_dir):
    cut = _panes(spark, sf_dir)
    return cut.groupBy(ntz(F.col("window")["start"]).alias("window_start"), "pane_index").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("event_id")), lambda v: v.cast("string")), ",").alias("ids")
    )


@query
def sink_pane_files(spark, sf_dir):
    """What the file of each pane is called and holds."""
    return panes.pane_files(_panes(spark, sf_dir), "props", "requests", ["ts", "event_id"])


@query
def sink_pane_files_unseparated(spark, sf_dir):
    return panes.pane_files(_panes(spark, sf_dir), "props", "requests", ["ts", "event_id"], separator="")


@query
def sink_pane_files_named(spark, sf_dir):
    """The pane files under their own names, their elements back to back."""
    path = scratch_path(spark, "panes")
    named = _panes(spark, sf_dir).withColumn("file", pane_path("requests", F.col("window")["end"], F.col("pane_index")))
    write_named_files(named, path, "file", "props", ["ts", "event_id"])
    return read_named_files(spark, path)


@query
def sink_pane_files_written(spark, sf_dir):
    path = scratch_path(spark, "panes")
    cut = panes.assign_panes(events(spark, sf_dir), "ts", days(1), 100, ["event_id"])
    files.write_pane_files(cut, path, "props", ["ts", "event_id"])
    # window_max_ts=<last millisecond>/pane_index=<n>/part-..
    folder = F.split("file", "/")
    return read_named_files(spark, path).select(
        F.url_decode(F.substring_index(folder[0], "=", -1)).alias("window_max_ts"),
        F.substring_index(folder[1], "=", -1).cast("bigint").alias("pane_index"),
        "body",
    )


# -- streams -------------------------------------------------------------------------


@query
def stream_source(spark, sf_dir):
    def start(sent, target, checkpoint):
        return sent.writeStream.format("parquet").option("path", target).option(
            "checkpointLocation", checkpoint
        )

    read = spark.read.parquet(replay(spark, sf_dir, start)).where(F.col("event_id") >= 0)
    return read.select("event_id", ntz(F.col("event_ts")).alias("event_ts"), "payload")


@query
def stream_source_log(spark, sf_dir):
    """The messages in a log of eight partitions, their times in an attribute; the log grows
    while the stream, which takes a third of a round at a time, is started again and again."""
    root, target, checkpoint = (scratch_path(spark, n) for n in ("log", "target", "checkpoint"))
    ends: dict[str, int] = {}
    for sent in stream_rounds(spark, sf_dir, late=True):
        logged = sent.where(F.col("event_id") >= 0).select(
            F.pmod(F.xxhash64("event_id"), F.lit(8)).alias("partition"), F.col("payload").alias("data"),
            F.create_map(F.lit("timestamp_ms"), "timestamp_ms", F.lit("id"), F.col("event_id").cast("string")).alias("attributes"),
        )
        before = sum(ends.values())
        ends = message_log.append_log(logged, root, "partition", ends)
        limit = -(-(sum(ends.values()) - before) // 3) + 8
        for _ in range(3):
            read = message_log.log_messages(spark, root, "timestamp_ms", limit, f"{target}-position", keep=("attributes",))
            read.writeStream.format("parquet").option("path", target).option(
                "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).select(
        F.col("attributes")["id"].cast("bigint").alias("event_id"), ntz(F.col("event_ts")).alias("event_ts"), "payload"
    )


DAY_MS = 86_400_000
NEVER_MS = 10**15


def _closed(spark: SparkSession, sf_dir: str, size: WindowSize, late: bool, allowed_lateness_ms: int) -> DataFrame:
    def start(sent, target, checkpoint):
        closed = closed_windows(
            sent, "event_ts", size, F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("sum_ids"),
            allowed_lateness_ms=allowed_lateness_ms,
        )
        return closed.writeStream.outputMode("append").format("parquet").option(
            "path", target
        ).option("checkpointLocation", checkpoint)

    closed = spark.read.parquet(replay(spark, sf_dir, start, late=late))
    return closed.select(*_bounds(), "n", "sum_ids")


@query
def trig_watermark(spark, sf_dir):
    return _closed(spark, sf_dir, hours(1), late=False, allowed_lateness_ms=0)


@query
def trig_watermark_late(spark, sf_dir):
    """A third of the messages three days late, two days of which are allowed."""
    return _closed(spark, sf_dir, hours(1), late=True, allowed_lateness_ms=2 * DAY_MS)


@query
def trig_watermark_months(spark, sf_dir):
    """A third of the messages three days late, which is less than a month waits."""
    return _closed(spark, sf_dir, months(1), True, 3 * DAY_MS)


def _shard_of() -> Column:
    return F.pmod(F.col("event_id"), F.lit(4))


def _cut(spark: SparkSession, sf_dir: str, rules: PaneRules) -> tuple[DataFrame, DataFrame]:
    """The panes and the dropped rows of a stream a third of whose messages come three days late."""
    def start(sent, target, checkpoint):
        return stream_panes(
            sent, rules, f"{target}/ledger", checkpoint, stream_sinks.table(f"{target}/panes"),
            stream_sinks.table(f"{target}/late"),
        )

    target = replay(spark, sf_dir, start, late=True)
    window_start = ntz(F.col("window")["start"]).alias("window_start")
    return tuple(
        appended(spark, f"{target}/{name}").where(F.col("event_id") >= 0).select("*", window_start)
        for name in ("panes", "late")
    )


def _days(early: Trigger | None, late: Trigger | None, **options) -> PaneRules:
    """Day windows with a day of lateness, the shards of a window told by event."""
    options = {"shards": _shard_of(), "order": ["event_id"]} | options
    return PaneRules("event_ts", days(1), DAY_MS, early, late, **options)


def _panes_of(spark: SparkSession, sf_dir: str, rules: PaneRules) -> DataFrame:
    """Which events each pane holds."""
    fired, _ = _cut(spark, sf_dir, rules)
    ids = F.transform(F.sort_array(F.collect_list("event_id")), lambda v: v.cast("string"))
    return fired.groupBy("window_start", "shard", *_PANE).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(ids, ",").alias("ids")
    )


@query
def trig_early_count_stream(spark, sf_dir):
    return _panes_of(spark, sf_dir, _days(Trigger(count=20), Trigger(count=7)))


@query
def trig_early_time(spark, sf_dir):
    return _panes_of(spark, sf_dir, _days(Trigger(delay_ms=0), Trigger(delay_ms=0)))


@query
def trig_early_delay(spark, sf_dir):
    """A delay that is over in the next round, whether the window has rows in it or not."""
    shards = F.pmod(F.col("event_id"), F.lit(64))
    return _panes_of(spark, sf_dir, _days(Trigger(delay_ms=1), Trigger(delay_ms=1), shards=shards))


@query
def trig_late_time(spark, sf_dir):
    return _panes_of(spark, sf_dir, _days(None, Trigger(delay_ms=0)))


@query
def trig_late_first(spark, sf_dir):
    return _panes_of(spark, sf_dir, _days(None, Trigger(count=7, delay_ms=0)))


@query
def pane_info_stream(spark, sf_dir):
    """The newest pane is held back, so that the last one of each window is known."""
    return _panes_of(spark, sf_dir, _days(Trigger(count=20), Trigger(count=7), hold_last=True))


@query
def with_constant_key_stream(spark, sf_dir):
    """One sequence of panes a window, whatever its rows."""
    return _panes_of(spark, sf_dir, _days(Trigger(count=20), Trigger(count=7), shards=1))


@query
def pane_discard(spark, sf_dir):
    """Which event came in which pane: each in one."""
    fired, _ = _cut(spark, sf_dir, _days(Trigger(delay_ms=0), Trigger(delay_ms=0)))
    return fired.select("event_id", "window_start", "shard", "pane_index", "timing")


def _kept_and_dropped(spark: SparkSession, sf_dir: str, rules: PaneRules) -> DataFrame:
    """Every event in one of the two outputs."""
    fired, late = _cut(spark, sf_dir, rules)
    nothing = F.lit(None).cast("timestamp_ntz").alias("watermark")
    return fired.select("event_id", "window_start", "timing", nothing).unionByName(
        late.select("event_id", "window_start", F.lit("DROPPED").alias("timing"), ntz(F.col("watermark")).alias("watermark"))
    )


@query
def late_drop(spark, sf_dir):
    """Hours that take rows for two days after their end."""
    return _kept_and_dropped(spark, sf_dir, PaneRules("event_ts", hours(1), 2 * DAY_MS, late=Trigger(delay_ms=0)))


@query
def late_drop_hot(spark, sf_dir):
    """A third of all rows in one window and one sequence, which takes nothing after its end."""
    return _kept_and_dropped(spark, sf_dir, PaneRules("event_ts", days(11), 2 * DAY_MS))


@query
def pane_files_stream(spark, sf_dir):
    """The pane files by their names, with their bytes."""
    def start(sent, target, checkpoint):
        return pane_files.writer(
            sent.withColumn("payload", F.concat(F.col("event_id").cast("string"), F.lit(";"))),
            f"{target}/files", f"{target}/ledger", checkpoint, "requests", size=days(1),
            allowed_lateness_ms=DAY_MS, pane_elements=20, late_delay_ms=NEVER_MS, shards=_shard_of(), order=["event_id"],
        )

    return read_named_files(spark, f"{replay(spark, sf_dir, start, late=True)}/files").where("body <> '-1;'")


# -- keys -----------------------------------------------------------------------------


@query
def with_constant_key(spark, sf_dir):
    """One group per window and no key."""
    placed = with_window(events(spark, sf_dir), "ts", hours(1))
    return placed.groupBy("window").agg(F.count(F.lit(1)).alias("n")).select(*_bounds(), "n")


@query
def with_key_function(spark, sf_dir):
    """The key by an expression, the table by a function of the window."""
    keyed = grouping.key_by(events(spark, sf_dir), F.concat("event_type", F.lit("-"), "user_id"))
    return with_shard_table(
        keyed, "ts", lambda w: F.concat(F.lit("until_"), F.date_format(w["end"], "yyyyMMdd")), "ONE_DAY"
    ).select("event_id", "key", "table_name")


@query
def scan_literals(spark, sf_dir):
    """A literal collection, next to the events each of its values has."""
    kinds = scan_values(spark, ["view", "click", "signup", "purchase", "error", "other"])
    counts = events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return kinds.join(counts, kinds.value == counts.event_type, "left").select(
        "value", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def values_only(spark, sf_dir):
    keyed = grouping.key_by(events(spark, sf_dir), "event_type")
    return grouping.values_only(keyed).select("event_id", "event_type", "value")
