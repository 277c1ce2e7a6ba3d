"""JSON messages turned into table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.messages import field_as, field_text, has_fields, without_fields
from millrace.functions.windows import window_text, zoned_text

# Columns filled by the system when the target schema has them.
EVENT_TIMESTAMP = "EventTimestamp"
PROCESS_WINDOW = "ProcessWindow"
PROCESS_TIMESTAMP = "ProcessTimestamp"
# Keys left out by the deny-list conversion.
DENIED_FIELDS = ("Category", "MessageType", "TimeStamp")
# Keys a message must have, and the columns they go to.
REQUIRED_FIELDS = {
    "FinanceKey": "FinanceKey",
    "DateKey": "Date",
    "OrganizationName": "OrganizationName",
    "DepartmentGroupName": "DepartmentGroupName",
    "ScenarioName": "ScenarioName",
    "AccountDescription": "AccountDescription",
    "Amount": "Amount",
}
REQUIRED_TYPES = {"FinanceKey": T.LongType(), "Amount": T.DoubleType()}
PANE_UNKNOWN = "UNKNOWN"

_MAP = "map<string,string>"
_PARSED = "_parsed"


def parse_payload(df: DataFrame, payload: str = "payload", on_error: str = "raise",
                  parsed: str = _PARSED) -> DataFrame:
    """Adds the payload as a map.

    ``raise``: a payload that is no JSON object, or empty, fails the job.
    ``drop``: such a row is left out.
    """
    if on_error not in ("raise", "drop"):
        raise ValueError(f"unknown on_error {on_error}")
    # The filter stays above the generator, whatever columns are used later.  Over a plain
    # column Catalyst would push it down as a second from_json, and would leave the parsing
    # out where nothing of the payload is asked for.
    mode = {"mode": "FAILFAST"} if on_error == "raise" else {}
    once = F.explode(F.array(F.from_json(F.col(payload), _MAP, mode))).alias(parsed)
    sound = F.col(parsed).isNotNull()
    if on_error == "raise":
        complaint = F.raise_error(F.lit("empty payload")).cast("boolean")
        sound = F.when(sound, F.lit(True)).otherwise(complaint)
    return df.select("*", once).where(sound)


def bad_payloads(payload: str = "payload") -> Column:
    """An aggregate counting what ``drop`` leaves out, for ``df.observe`` or ``agg``."""
    return F.count_if(F.from_json(F.col(payload), _MAP).isNull()).alias("dropped")


def _now(process_ts: Column | None) -> Column:
    return F.current_timestamp() if process_ts is None else process_ts


def project_schema(
    df: DataFrame,
    schema: T.StructType,
    payload: str = "payload",
    event_ts: str | None = None,
    window: str | None = None,
    process_ts: Column | None = None,
    on_error: str = "raise",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of ``schema``: keys it does not name are dropped, columns the message
    lacks are NULL.  The three system columns are filled where the schema has
    them and then win over a key of the same name."""
    system: dict[str, Column] = {PROCESS_TIMESTAMP: _now(process_ts)}
    if event_ts is not None:
        system[EVENT_TIMESTAMP] = F.col(event_ts)
    if window is not None:
        system[PROCESS_WINDOW] = window_text(F.col(window))
    columns = [
        system.get(f.name, field_as(F.col(_PARSED), f.name, f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return parse_payload(df, payload, on_error).select(*keep, *columns)


def project_denylist(
    df: DataFrame,
    payload: str = "payload",
    schema: T.StructType | None = None,
    process_ts: Column | None = None,
    on_error: str = "drop",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every key but the denied ones, plus the processing time, as one map column
    ``row``; with a ``schema``, as its columns."""
    stamp = F.create_map(F.lit(PROCESS_TIMESTAMP), zoned_text(_now(process_ts)))
    rest = without_fields(F.col(_PARSED), (*DENIED_FIELDS, PROCESS_TIMESTAMP))
    rows = parse_payload(df, payload, on_error).select(
        *keep, F.map_concat(rest, stamp).alias("row")
    )
    if schema is None:
        return rows
    columns = [field_as(F.col("row"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*keep, *columns)


def project_required(
    df: DataFrame,
    payload: str = "payload",
    event_ts: str = "event_ts",
    window: str = "window",
    pane: dict[str, str] | None = None,
    process_ts: Column | None = None,
    on_error: str = "drop",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Seven fixed columns; a message that lacks one of them is dropped.

    ``pane`` names the columns that hold ``is_first``, ``is_last`` and
    ``timing``; with no grouping upstream there is one pane of unknown timing.
    """
    parsed = F.col(_PARSED)
    rows = parse_payload(df, payload, on_error).where(has_fields(parsed, REQUIRED_FIELDS))
    fields = [
        _required(parsed, source).alias(target) for source, target in REQUIRED_FIELDS.items()
    ]
    first, last, timing = (
        (F.lit(True), F.lit(True), F.lit(PANE_UNKNOWN))
        if pane is None
        else (F.col(pane["is_first"]), F.col(pane["is_last"]), F.col(pane["timing"]))
    )
    return rows.select(
        *keep,
        *fields,
        window_text(F.col(window)).alias("window"),
        first.alias("isFirst"),
        last.alias("isLast"),
        timing.alias("timing"),
        F.date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
        _now(process_ts).alias(PROCESS_TIMESTAMP),
    )


def _required(parsed: Column, name: str) -> Column:
    # No null rule here: a JSON null stays NULL, the text "NULL" stays text.
    value = parsed[name]
    return value.try_cast(REQUIRED_TYPES[name]) if name in REQUIRED_TYPES else value


def payload_field(df: DataFrame, name: str, payload: str = "payload",
                  on_error: str = "drop") -> DataFrame:
    """One field of the payload under the null rule, as a column of its name."""
    rows = parse_payload(df, payload, on_error)
    return rows.withColumn(name, field_text(F.col(_PARSED), name)).drop(_PARSED)
