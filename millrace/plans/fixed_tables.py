"""JSON messages converted and appended to one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from millrace.operators.rows import project_denylist, project_required
from millrace.sinks.files import append_table

# The table of rows that carry the pane they came in.
PANE_ROW_SCHEMA = T.StructType(
    [
        T.StructField("FinanceKey", T.LongType()),
        T.StructField("Date", T.StringType()),
        T.StructField("OrganizationName", T.StringType()),
        T.StructField("DepartmentGroupName", T.StringType()),
        T.StructField("ScenarioName", T.StringType()),
        T.StructField("AccountDescription", T.StringType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("window", T.StringType()),
        T.StructField("isFirst", T.BooleanType()),
        T.StructField("isLast", T.BooleanType()),
        T.StructField("timing", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("ProcessTimestamp", T.TimestampType()),
    ]
)


def append_denylist(messages: DataFrame, path: str, schema: T.StructType,
                    process_ts: Column | None = None) -> None:
    """All keys but the denied ones, as far as the table has a column for them; bad
    messages are left out."""
    append_table(project_denylist(messages, schema=schema, process_ts=process_ts), path, schema)


def append_required(messages: DataFrame, path: str, pane: dict[str, str] | None = None,
                    process_ts: Column | None = None) -> None:
    """The seven required fields, the window and the pane; messages that are bad or
    lack a field are left out."""
    rows = project_required(messages, pane=pane, process_ts=process_ts)
    append_table(rows, path, PANE_ROW_SCHEMA)
