import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.sources.messages import bad_labels, messages
from millrace.functions.windows import hours, minutes
from millrace.operators import rows
from millrace.operators.windows import with_window
from millrace.sources.messages import messages
from millrace.sources.schema import load_schema, schema_from_json
from checks.inputs import MESSAGE_COLUMNS

SCHEMA = schema_from_json(MESSAGE_COLUMNS)
AT = dt.datetime(2024, 1, 3, 9, 5)


def _sent(spark, *payloads):
    raw = [(p, "1704272700123") for p in payloads]
    df = messages(spark.createDataFrame(raw, "payload string, timestamp_ms string"))
    return with_window(df, "event_ts", minutes(5))


def _project(df, **options):
    return rows.project_schema(
        df, SCHEMA, event_ts="event_ts", window="window",
        process_ts=F.lit("2024-01-03 10:00:00").cast("timestamp"), **options,
    )


def test_time_labels(spark):
    raw = [("", "1704272700123"), ("", "2024-01-03T09:05:00.123Z"), ("", "2024-01-03T10:05:00.123+01:00"), ("", "x")]
    got = messages(spark.createDataFrame(raw, "payload string, timestamp_ms string"), on_bad_label="null")
    want = dt.datetime(2024, 1, 3, 9, 5, 0, 123000)
    texts = [r[0] for r in got.select(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSS")).collect()]
    assert texts == [want.strftime("%Y-%m-%d %H:%M:%S.123")] * 3 + [None]


def test_null_rule_and_names(spark):
    row = _project(_sent(spark, '{"FinanceKey":5,"DateKey":null,"OrganizationName":"NuLL",'
                                '"departmentgroupname":"x","ScenarioName":{"a": [1, 2]},"Amount":"1.50",'
                                '"Unknown":1,"EventTimestamp":"1999-01-01"}')).first()
    assert row["FinanceKey"] == 5 and row["Amount"] == 1.5
    assert row["DateKey"] == "" and row["OrganizationName"] == ""
    assert row["DepartmentGroupName"] is None and row["AccountDescription"] is None
    assert row["ScenarioName"] == '{"a":[1,2]}'
    assert row["ProcessWindow"] == "[2024-01-03T09:05:00.000Z..2024-01-03T09:10:00.000Z)"
    assert row["EventTimestamp"].year == 2024
    assert "Unknown" not in row.asDict()


def test_null_text_in_typed_columns_is_null(spark):
    row = _project(_sent(spark, '{"FinanceKey":"null","Amount":"abc"}')).first()
    assert row["FinanceKey"] is None and row["Amount"] is None


@pytest.mark.parametrize("bad", ["{", "", None, "[1]", "plain"])
def test_bad_payload_raises_or_is_dropped(spark, bad):
    sent = _sent(spark, '{"FinanceKey":1}', bad)
    with pytest.raises(Exception):
        _project(sent).collect()
    assert [r["FinanceKey"] for r in _project(sent, on_error="drop").collect()] == [1]
    assert sent.agg(rows.bad_payloads()).first()[0] == 1


@pytest.mark.parametrize("bad", ["{", "", None])
def test_raise_does_so_whichever_columns_are_used(spark, bad):
    built = _project(_sent(spark, '{"FinanceKey":1}', bad))
    for used in (built, built.select("FinanceKey"), built.select("ProcessTimestamp"), built.select()):
        with pytest.raises(Exception):
            used.count()
        with pytest.raises(Exception):
            used.collect()


@pytest.mark.parametrize("on_error", ["drop", "raise"])
def test_payload_is_parsed_once(spark, on_error):
    plan = _project(_sent(spark, "{}"), on_error=on_error)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_unreadable_time_labels_raise_or_are_counted(spark):
    raw = spark.createDataFrame([("a", "1704067200000"), ("b", "soon"), ("c", None)], "payload string, timestamp_ms string")
    with pytest.raises(Exception, match="not a time label"):
        messages(raw).select("event_ts").collect()
    assert messages(raw, on_bad_label="null").where("event_ts IS NULL").count() == 2
    assert raw.agg(bad_labels()).first()[0] == 2


def test_denylist(spark):
    sent = _sent(spark, '{"Category":"c","MessageType":"m","TimeStamp":"t","a":null,"b":"x","ProcessTimestamp":"old"}', "{")
    built = rows.project_denylist(sent, process_ts=F.lit("2024-01-03 10:00:00").cast("timestamp")).collect()
    assert [r["row"] for r in built] == [{"a": "", "b": "x", "ProcessTimestamp": "2024-01-03T10:00:00.000 UTC"}]
    typed = rows.project_denylist(
        _sent(spark, '{"FinanceKey":"7"}'), schema=SCHEMA, process_ts=F.col("event_ts")
    ).first()
    assert typed["FinanceKey"] == 7 and typed["ProcessTimestamp"] is not None


FULL = ('{"FinanceKey":1,"DateKey":"d","OrganizationName":"o","DepartmentGroupName":"g",'
        '"ScenarioName":null,"AccountDescription":"null","Amount":2}')


def test_required_fields(spark):
    sent = _sent(spark, FULL, FULL.replace('"Amount"', '"amount"'), "{").withColumn("window", F.col("window"))
    got = rows.project_required(sent, process_ts=F.col("event_ts")).collect()
    assert len(got) == 1
    assert (got[0]["Date"], got[0]["ScenarioName"], got[0]["AccountDescription"]) == ("d", None, "null")
    assert (got[0]["isFirst"], got[0]["isLast"], got[0]["timing"]) == (True, True, "UNKNOWN")
    assert got[0]["event_time"] == "2024-01-03T09:05:00.123Z"


def test_now_is_taken_when_no_time_is_given(spark):
    row = rows.project_schema(_sent(spark, "{}"), SCHEMA).first()
    assert abs((dt.datetime.now() - row["ProcessTimestamp"]).total_seconds()) < 86400
    assert row["EventTimestamp"] is None and row["ProcessWindow"] is None


def test_schema_documents(spark, tmp_path):
    (tmp_path / "Records_schema.json").write_text(MESSAGE_COLUMNS)
    assert load_schema(spark, str(tmp_path), "Records") == SCHEMA
    with pytest.raises(Exception):
        load_schema(spark, str(tmp_path), "Missing")
    with pytest.raises(ValueError):
        schema_from_json('{"schema":{"fields":[{"name":"a","type":"GEOGRAPHY","mode":"nullable"}]}}')
    assert hours(1).interval == "1 hours"
