"""The SQL (DuckDB) that gives what each query gives."""

from __future__ import annotations

WORDS = r"""
SELECT doc_id, word FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '[^a-zA-Z'']+')) AS word FROM documents
) WHERE word <> ''
"""
WITH_WORDS = f"WITH words AS ({WORDS}), mean AS (SELECT avg(length(word)) AS avg_len FROM words)"


def outputs(key: str = "") -> str:
    return f"""
{WITH_WORDS}
SELECT {key}'all' AS output, word AS value FROM words
UNION ALL
SELECT {key}CASE WHEN length(word) >= (SELECT avg_len FROM mean) THEN 'above' ELSE 'below' END,
  word || length(word) FROM words
"""

FINANCE = """
SELECT l_orderkey * 10 + l_linenumber AS FinanceKey,
  strftime(l_shipdate, '%Y%m%d') AS DateKey,
  CAST(l_suppkey AS VARCHAR) AS OrganizationName,
  l_returnflag AS DepartmentGroupName,
  l_linestatus AS ScenarioName,
  CAST(l_orderkey AS VARCHAR) AS AccountDescription,
  l_extendedprice AS Amount,
  CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END AS side
FROM lineitem
"""
BLOCK_LINES = """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS value FROM lineitem
UNION ALL
SELECT chr(9) || CAST(l_extendedprice AS VARCHAR) FROM lineitem
"""

ISO = "%Y-%m-%dT%H:%M:%S.%gZ"
EPOCH = "TIMESTAMP '1970-01-01'"


def bucket(interval: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{interval}', {ts}, {EPOCH})"


def window_text(interval: str, ts: str = "event_ts") -> str:
    start = bucket(interval, ts)
    return (f"'[' || strftime({start}, '{ISO}') || '..' || "
            f"strftime({start} + INTERVAL '{interval}', '{ISO}') || ')'")


def scenario(present_null: str) -> str:
    return (f"CASE event_type WHEN 'view' THEN {present_null} WHEN 'click' THEN '' "
            "WHEN 'signup' THEN NULL ELSE replace(props, ' ', '') END")


MESSAGES = f"""
SELECT event_id AS FinanceKey,
  strftime(ts, '%Y%m%d') AS DateKey,
  CAST(user_id AS VARCHAR) AS OrganizationName,
  event_type AS DepartmentGroupName,
  {scenario("''")} AS ScenarioName,
  event_type AS AccountDescription,
  value AS Amount,
  {window_text('5 minutes')} AS ProcessWindow,
  event_ts AS EventTimestamp,
  event_ts + INTERVAL 5 SECONDS AS ProcessTimestamp{{more}}
FROM (SELECT *, date_trunc('milliseconds', ts) AS event_ts FROM events)
"""


def messages(more: str = "", where: str = "") -> str:
    return MESSAGES.replace("{more}", more) + where


GOOD = "WHERE event_type <> 'error'"

DENYLIST = f"""
WITH sent AS (
  SELECT *, {scenario("''")} AS scenario, date_trunc('milliseconds', ts) AS event_ts
  FROM events {GOOD}
), fields AS (
  SELECT event_id, 'FinanceKey' AS name, CAST(event_id AS VARCHAR) AS value FROM sent
  UNION ALL SELECT event_id, 'DateKey', strftime(ts, '%Y%m%d') FROM sent
  UNION ALL SELECT event_id, 'OrganizationName', CAST(user_id AS VARCHAR) FROM sent
  UNION ALL SELECT event_id, 'DepartmentGroupName', event_type FROM sent
  UNION ALL SELECT event_id, 'ScenarioName', scenario FROM sent
  UNION ALL SELECT event_id, 'AccountDescription', event_type FROM sent
  UNION ALL SELECT event_id, 'Amount', CAST(value AS VARCHAR) FROM sent
  UNION ALL SELECT event_id, 'amount', CAST(value AS VARCHAR) FROM sent
  UNION ALL SELECT event_id, 'Extra', 'x' FROM sent
  UNION ALL SELECT event_id, 'ProcessTimestamp',
    strftime(event_ts + INTERVAL 5 SECONDS, '%Y-%m-%dT%H:%M:%S.%g UTC') FROM sent
)
SELECT event_id, name, value FROM fields WHERE value IS NOT NULL
"""

REQUIRED = f"""
SELECT event_id AS FinanceKey, strftime(ts, '%Y%m%d') AS "Date",
  CAST(user_id AS VARCHAR) AS OrganizationName, event_type AS DepartmentGroupName,
  CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'NULL'
    ELSE replace(props, ' ', '') END AS ScenarioName,
  event_type AS AccountDescription, value AS Amount,
  {window_text('1 hour')} AS "window",
  true AS isFirst, true AS isLast, 'UNKNOWN' AS timing,
  strftime(event_ts, '{ISO}') AS event_time,
  event_ts + INTERVAL 5 SECONDS AS ProcessTimestamp
FROM (SELECT *, date_trunc('milliseconds', ts) AS event_ts FROM events)
WHERE event_type NOT IN ('error', 'signup')
"""

# -- windows ------------------------------------------------------------------


def windowed(interval: str) -> str:
    start = bucket(interval)
    return (f"SELECT event_id, {start} AS window_start, "
            f"{start} + INTERVAL '{interval}' AS window_end FROM events")


_NOMINAL = {
    "FIVE_MINUTE": "5 minutes", "TEN_MINUTE": "10 minutes", "FIFTEEN_MINUTE": "15 minutes",
    "THIRTY_MINUTE": "30 minutes", "ONE_HOUR": "1 hour", "TWO_HOUR": "2 hours",
    "THREE_HOUR": "3 hours", "SIX_HOUR": "6 hours", "ONE_DAY": "1 day", "THREE_DAY": "3 days",
    "ONE_WEEK": "7 days", "TWO_WEEK": "14 days", "ONE_MONTH": "1 month",
}
_LITERAL = {
    **_NOMINAL,
    "ONE_HOUR": "1 minute", "TWO_HOUR": "2 minutes", "THREE_HOUR": "3 minutes",
    "SIX_HOUR": "6 minutes", "ONE_WEEK": "1 day", "TWO_WEEK": "2 days",
}


def by_type(intervals: dict[str, str]) -> str:
    parts = []
    for name, interval in intervals.items():
        start = "date_trunc('month', ts)" if interval == "1 month" else bucket(interval)
        shown = ("%Y%m" if name.endswith("MONTH")
                 else "%Y%m%d" if name.endswith(("DAY", "WEEK")) else "%Y%m%d_%-H%M")
        parts.append(
            f"SELECT event_id, '{name}' AS window_type, {start} AS window_start, "
            f"CAST({start} + INTERVAL '{interval}' AS TIMESTAMP) AS window_end, "
            f"strftime({start}, '{shown}') AS suffix FROM events"
        )
    return " UNION ALL ".join(parts)


# -- panes, batch ---------------------------------------------------------------


def panes(interval: str, size: int) -> str:
    start = bucket(interval)
    return f"""
  SELECT *, (rn - 1) // {size} AS pane_index,
    CASE WHEN ((rn - 1) // {size} + 1) * {size} <= total THEN 'EARLY' ELSE 'ON_TIME' END AS timing,
    rn <= {size} AS is_first, ((rn - 1) // {size} + 1) * {size} >= total AS is_last
  FROM (
    SELECT *, {start} AS window_start,
      row_number() OVER (PARTITION BY {start} ORDER BY ts, event_id) AS rn,
      count(*) OVER (PARTITION BY {start}) AS total
    FROM events
  )"""


PANE_INFO = (f"SELECT event_id, window_start, pane_index, timing, is_first, is_last "
             f"FROM ({panes('1 hour', 5)})")


def pane_bodies(separator: str) -> str:
    last = f"strftime(window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND, '{ISO}')"
    return f"""
SELECT 'requests/' || {last} || '/' || pane_index AS path, count(*) AS n_elements,
  string_agg(props, '{separator}' ORDER BY ts, event_id) AS body
FROM ({panes('1 hour', 5)}) GROUP BY window_start, pane_index
"""


META_PANE = f"""
SELECT event_id,
  '[' || strftime(window_start, '{ISO}') || '..' ||
    strftime(window_start + INTERVAL 1 HOUR, '{ISO}') || ')' AS "window",
  is_first AS isFirst, is_last AS isLast, timing,
  strftime(date_trunc('milliseconds', ts), '{ISO}') AS event_time
FROM ({{panes}}) WHERE event_type <> 'signup'
""".replace("{panes}", panes("1 hour", 5).replace(
    "ORDER BY ts, event_id", "ORDER BY date_trunc('milliseconds', ts), event_id"))

# -- panes, streams ---------------------------------------------------------------

# Messages come in three rounds of eleven days, a third of them three days late.
# The watermark of a round is the latest event time of the rounds before it.
ACCEPTED = """
WITH sent AS (
  SELECT event_id, date_trunc('milliseconds', ts) AS event_ts, date_trunc('day', ts) AS window_start,
    event_id % 4 AS shard,
    least((date_diff('day', TIMESTAMP '2024-01-01', ts) +
      CASE WHEN event_id % 3 = 0 THEN 3 ELSE 0 END) // 11, 2) AS turn
  FROM events
), marks AS (
  SELECT turn, max(max(event_ts)) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING) AS watermark
  FROM sent GROUP BY turn
), moved AS (
  SELECT turn, CASE WHEN turn = 2 THEN TIMESTAMP '2100-01-01' ELSE max(watermark) OVER (ORDER BY turn
    ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) END AS watermark FROM marks
), accepted AS (
  SELECT s.*, (SELECT min(m.turn) FROM moved m WHERE m.watermark >= window_start + INTERVAL 1 DAY) AS end_turn,
    (SELECT min(m.turn) FROM moved m WHERE m.watermark >= window_start + INTERVAL 2 DAYS) AS close_turn,
    coalesce(watermark >= window_start + INTERVAL 1 DAY, false) AS past
  FROM sent s JOIN marks USING (turn)
  WHERE watermark IS NULL OR watermark < window_start + INTERVAL 2 DAYS
)"""


def fired(early: str, late: str, shard: str = "shard", hold: bool = False, fires: str = "max(turn)",
          holds: str = "string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids") -> str:
    """``early`` and ``late`` number the panes of a phase; 1000000 is what is left
    at its end.  A pane which fires (in the round ``fires``) as the window closes is known to be
    the last; with ``hold`` the last pane is, whenever it fired."""
    newest = "row_number() OVER (PARTITION BY window_start, shard ORDER BY past DESC, part DESC) = 1"
    return f"""{ACCEPTED}, ranked AS (
  SELECT * REPLACE (CAST({shard} AS INTEGER) AS shard) FROM accepted
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY window_start, shard, past ORDER BY turn, event_id) AS rn,
    count(*) OVER (PARTITION BY window_start, shard, past) AS total,
    row_number() OVER (PARTITION BY window_start, shard, past, turn ORDER BY event_id) AS turn_rn,
    min(turn) OVER (PARTITION BY window_start, shard) AS first_turn
  FROM ranked
), parted AS (
  SELECT *, CASE WHEN past THEN {late} ELSE {early} END AS part FROM numbered
), sized AS (
  SELECT window_start, shard, past, part, close_turn, count(*) AS n, {holds},
    CASE WHEN part < 1000000 THEN {fires} WHEN past THEN close_turn ELSE end_turn END AS fire_turn
  FROM parted GROUP BY window_start, shard, past, part, close_turn, end_turn, first_turn
)
SELECT * EXCLUDE (past, part, close_turn, fire_turn), {newest + ("" if hold else " AND fire_turn = close_turn")} AS is_last,
  row_number() OVER (PARTITION BY window_start, shard ORDER BY past, part) - 1 AS pane_index,
  row_number() OVER (PARTITION BY window_start, shard ORDER BY past, part) = 1 AS is_first,
  CASE WHEN past THEN 'LATE' WHEN part = 1000000 THEN 'ON_TIME' ELSE 'EARLY' END AS timing
FROM sized
"""


def counted(n: int, rn: str = "rn", total: str = "total") -> str:
    """Full panes of n; the rest waits for the end."""
    return f"CASE WHEN ({rn} - 1) // {n} < {total} // {n} THEN ({rn} - 1) // {n} ELSE 1000000 END"


BY_TURN = "turn"
AT_END = "1000000"
# What came in a window's first round fires in the next, with what came by then, if the window is open.
NEXT_TURN = """CASE WHEN turn <= first_turn + 1 AND EXISTS (SELECT 1 FROM marks m
    WHERE m.turn = first_turn + 1 AND m.watermark < window_start + INTERVAL 1 DAY) THEN 0 ELSE 1000000 END"""
COUNT_OR_TURN = "turn * 1000 + (turn_rn - 1) // 7"

PANE_DISCARD = f"""{ACCEPTED}
SELECT event_id, window_start, CAST(shard AS INTEGER) AS shard,
  dense_rank() OVER (PARTITION BY window_start, shard ORDER BY past, turn) - 1 AS pane_index,
  CASE WHEN past THEN 'LATE' ELSE 'EARLY' END AS timing
FROM accepted
"""

STREAM_FILES = f"""
SELECT 'requests/' || strftime(window_start + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND, '{ISO}') || '/' ||
  shard || '/' || pane_index AS file, body
FROM ({fired(counted(20), counted(20), holds="string_agg(event_id || ';', '' ORDER BY turn, event_id) AS body")})
"""


def kept_and_dropped(window: str, kept: str, late: str) -> str:
    """Windows of ``window`` take rows for ``kept`` after their end, as ``late`` panes."""
    start = bucket(window, "event_ts")
    return f"""{ACCEPTED}, met AS (
  SELECT event_id, {start} AS window_start, {start} + INTERVAL {window} AS window_end, watermark
  FROM sent JOIN marks USING (turn)
), told AS (
  SELECT *, coalesce(watermark >= window_end + INTERVAL {kept}, false) AS dropped FROM met
)
SELECT event_id, window_start, CASE WHEN dropped THEN watermark END AS watermark,
  CASE WHEN dropped THEN 'DROPPED' WHEN watermark >= window_end THEN '{late}' ELSE 'ON_TIME' END AS timing
FROM told
"""


def in_parts(size: int, order: str) -> str:
    """Finance rows with the part of their account that they are in."""
    return f"""
SELECT *, CAST((row_number() OVER (PARTITION BY AccountDescription ORDER BY {order}) - 1) // {size} AS INTEGER) AS part,
  CAST((count(*) OVER (PARTITION BY AccountDescription) + {size - 1}) // {size} AS INTEGER) AS n_parts
FROM ({FINANCE})"""


SQL = {
    "scan_text_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "sink_text": f"SELECT word FROM ({WORDS})",
    "tokenize": WORDS,
    "word_length": f"SELECT doc_id, word, CAST(length(word) AS INTEGER) AS len FROM ({WORDS})",
    "mean_global": f"{WITH_WORDS} SELECT avg_len FROM mean",
    "side_input_scalar": f"{WITH_WORDS} SELECT doc_id, word, avg_len FROM words, mean",
    "filter_ge_scalar": f"{WITH_WORDS} SELECT doc_id, word FROM words, mean WHERE length(word) >= avg_len",
    "filter_lt_scalar": f"{WITH_WORDS} SELECT doc_id, word FROM words, mean WHERE length(word) < avg_len",
    "concat_word_len": f"{WITH_WORDS} SELECT doc_id, word || length(word) AS value FROM words, mean "
                       "WHERE length(word) >= avg_len",
    "multi_output": outputs(),
    "multi_output_one_pass": outputs("doc_id, "),
    "side_output_split": f"{WITH_WORDS} SELECT doc_id, word, "
                         "CASE WHEN length(word) >= avg_len THEN 'above' ELSE 'below' END AS band "
                         "FROM words, mean",
    "upper_word": f"SELECT doc_id, upper(word) AS word FROM ({WORDS})",
    "word_colon_len": f"SELECT doc_id, word || ': ' || length(word) AS word FROM ({WORDS})",
    "word_chain": f"SELECT doc_id, upper(word || ': ' || length(word)) AS word FROM ({WORDS})",
    "word_report_files": outputs(),
    "scan_finance_csv": f"SELECT * EXCLUDE (side) FROM ({FINANCE})",
    "key_by_field": f"SELECT * EXCLUDE (side), AccountDescription AS key FROM ({FINANCE})",
    "group_by_key": f"""
SELECT AccountDescription AS key, part, n_parts, count(*) AS n,
  string_agg(CAST(FinanceKey AS VARCHAR), ',' ORDER BY FinanceKey) AS finance_keys,
  string_agg(CAST(Amount AS VARCHAR), ',' ORDER BY Amount) AS amounts
FROM ({in_parts(4, "FinanceKey, Amount")}) GROUP BY 1, 2, 3""",
    "group_by_key_hot": f"""
SELECT DepartmentGroupName AS key, count(*) AS n, CAST(sum(FinanceKey) AS BIGINT) AS sum_keys
FROM ({FINANCE}) GROUP BY 1""",
    "cogroup": f"""
SELECT AccountDescription AS key, part, n_parts,
  count(*) FILTER (side = 1) AS n1, count(*) FILTER (side = 2) AS n2,
  coalesce(string_agg(CAST(Amount AS VARCHAR), ',' ORDER BY Amount) FILTER (side = 1), '') AS amounts1,
  coalesce(string_agg(CAST(Amount AS VARCHAR), ',' ORDER BY Amount) FILTER (side = 2), '') AS amounts2
FROM ({in_parts(3, "side, Amount")}) GROUP BY 1, 2, 3""",
    "cogroup_hot": f"""
SELECT ScenarioName AS key, side, count(*) AS n, CAST(sum(FinanceKey) AS BIGINT) AS sum_keys
FROM ({FINANCE}) GROUP BY 1, 2""",
    "format_cogroup": f"""
SELECT AccountDescription AS key, part, n_parts, CASE WHEN part = 0 THEN AccountDescription || chr(10) ELSE '' END ||
  string_agg(chr(9) || CAST(Amount AS VARCHAR), chr(10) ORDER BY side, Amount) AS block
FROM ({in_parts(3, "side, Amount")}) GROUP BY 1, 2, 3""",
    "cogroup_lines": f"""
WITH finance AS ({FINANCE})
SELECT DISTINCT AccountDescription AS key, 0 AS side, AccountDescription AS line FROM finance
UNION ALL SELECT AccountDescription, side, chr(9) || CAST(Amount AS VARCHAR) FROM finance
""",
    "account_blocks_files": BLOCK_LINES,
    "account_blocks_hot_files": BLOCK_LINES,
    "json_project_schema": messages(),
    "json_project_loaded_schema": messages(),
    "on_error_raise": messages(),
    "on_error_drop": messages(where=GOOD),
    "on_error_drop_count": "SELECT count(*) AS dropped FROM events WHERE event_type = 'error'",
    "json_project_denylist": DENYLIST,
    "json_project_required": REQUIRED,
    "denylist_table": "SELECT * EXCLUDE (ProcessWindow, EventTimestamp) FROM "
                      f"({messages(where=GOOD)})",
    "required_table": REQUIRED,
    "null_literal_to_empty": f"SELECT event_id, {scenario(chr(39) * 2)} AS ScenarioName FROM events",
    "meta_event_ts": "SELECT event_id AS FinanceKey, date_trunc('milliseconds', ts) AS EventTimestamp FROM events",
    "meta_process_window": f"SELECT event_id AS FinanceKey, {window_text('5 minutes', 'ts')} AS ProcessWindow FROM events",
    "meta_process_ts": "SELECT event_id, strftime(date_trunc('milliseconds', ts) + INTERVAL 5 SECONDS, "
                       "'%Y-%m-%dT%H:%M:%S.%g UTC') AS ProcessTimestamp FROM events",
    "meta_window_pane": META_PANE,
    "sink_table_append": messages() + " UNION ALL " + messages(where=GOOD),
    "sink_table_per_window": messages(
        f", 'Messages_' || strftime({bucket('3 hours', 'event_ts')}, '%Y%m%d_%-H%M') AS table_name"),
    "sink_table_per_window_again": messages(
        f", 'Messages_' || strftime({bucket('3 hours', 'event_ts')}, '%Y%m%d_%-H%M') AS table_name"),
    "sink_table_append_again": messages() + " UNION ALL " + messages(where=GOOD),
    "sink_table_per_window_stream": messages(", 'Messages_' || strftime(ts, '%Y%m%d') AS table_name"),
    "win_fixed_5_minutes": windowed("5 minutes"),
    "win_fixed_1_hour": windowed("1 hour"),
    "win_calendar_days": windowed("3 days"),
    "win_calendar_months": "SELECT o_orderkey, date_trunc('month', o_orderdate) AS window_start, "
                           "date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS window_end FROM orders",
    "win_calendar_quarters": "SELECT o_orderkey, date_trunc('quarter', o_orderdate) AS window_start, "
                             "date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTHS AS window_end FROM orders",
    "win_by_type_nominal": by_type(_NOMINAL),
    "win_by_type_literal": by_type(_LITERAL),
    "win_suffix": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS suffix FROM orders",
    "win_rewindow": f"""
SELECT event_id, {bucket('5 minutes')} AS window_start,
  {bucket('5 minutes')} + INTERVAL 5 MINUTES AS window_end,
  'Messages_' || strftime({bucket('6 hours')}, '%Y%m%d_%-H%M') AS table_name FROM events""",
    "window_access": f"SELECT event_id, strftime({bucket('1 hour')} + INTERVAL 1 HOUR "
                     f"- INTERVAL 1 MILLISECOND, '{ISO}') AS window_max_ts FROM events",
    "pane_info": PANE_INFO,
    "pane_info_hot": PANE_INFO,
    "trig_early_count": f"""
SELECT window_start, pane_index, timing, count(*) AS n, min(event_id) AS first_id,
  max(event_id) AS last_id FROM ({panes('1 day', 100)}) GROUP BY 1, 2, 3""",
    "group_by_key_windowed": f"""
SELECT window_start, pane_index,
  string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
FROM ({panes('1 hour', 5)}) GROUP BY 1, 2""",
    "sink_pane_files": pane_bodies("\n"),
    "sink_pane_files_unseparated": pane_bodies(""),
    "sink_pane_files_named": f"SELECT path AS file, body FROM ({pane_bodies('')})",
    "sink_pane_files_written": f"""
SELECT strftime(window_start + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND, '{ISO}') AS window_max_ts,
  pane_index, string_agg(props || chr(10), '' ORDER BY ts, event_id) AS body
FROM ({panes('1 day', 100)}) GROUP BY window_start, pane_index""",
    "late_drop": kept_and_dropped("1 hour", "2 days", "LATE"),
    "late_drop_hot": kept_and_dropped("11 days", "0 days", "LATE"),
    "trig_watermark": f"""
SELECT {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL 1 HOUR AS window_end,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_ids FROM events GROUP BY 1, 2""",
    "trig_watermark_late": f"""{ACCEPTED}
SELECT {bucket('1 hour', 'event_ts')} AS window_start, {bucket('1 hour', 'event_ts')} + INTERVAL 1 HOUR AS window_end,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_ids
FROM sent JOIN marks USING (turn)
WHERE watermark IS NULL OR {bucket('1 hour', 'event_ts')} + INTERVAL 1 HOUR > watermark - INTERVAL 2 DAYS
GROUP BY 1, 2""",
    "trig_watermark_months": """
SELECT date_trunc('month', ts) AS window_start, date_trunc('month', ts) + INTERVAL 1 MONTH AS window_end,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_ids FROM events GROUP BY 1, 2""",
    "trig_early_count_stream": fired(counted(20), counted(7)),
    "trig_early_time": fired(BY_TURN, BY_TURN),
    "trig_early_delay": fired(NEXT_TURN, AT_END, shard="event_id % 64", fires="first_turn + 1"),
    "pane_info_stream": fired(counted(20), counted(7), hold=True),
    "with_constant_key_stream": fired(counted(20), counted(7), shard="0"),
    "trig_late_time": fired(AT_END, BY_TURN),
    "trig_late_first": fired(AT_END, COUNT_OR_TURN),
    "pane_discard": PANE_DISCARD,
    "pane_files_stream": STREAM_FILES,
    "with_constant_key": f"""
SELECT {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL 1 HOUR AS window_end,
  count(*) AS n FROM events GROUP BY 1, 2""",
    "with_key_function": "SELECT event_id, event_type || '-' || user_id AS key, "
                         "'until_' || strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y%m%d') AS table_name "
                         "FROM events",
    "scan_literals": "SELECT v.value, count(event_id) AS n FROM (VALUES ('view'), ('click'), ('signup'), "
                     "('purchase'), ('error'), ('other')) v(value) LEFT JOIN events ON event_type = v.value GROUP BY 1",
    "values_only": "SELECT event_id, event_type, value FROM events",
}

_COMPACT = "replace(props, ' ', '')"
_PAYLOAD = f"""'{{"FinanceKey":' || event_id || ',"DateKey":"' || strftime(ts, '%Y%m%d') ||
  '","OrganizationName":"' || user_id || '","DepartmentGroupName":"' || event_type || '",' ||
  CASE event_type WHEN 'view' THEN '"ScenarioName":null,' WHEN 'click' THEN '"ScenarioName":"NULL",'
    WHEN 'signup' THEN '' ELSE '"ScenarioName":' || props || ',' END ||
  '"AccountDescription":"' || event_type || '","Amount":' || value || ',"amount":' || value ||
  ',"Extra":"x"}}'"""
SQL["stream_source"] = (f"SELECT event_id, date_trunc('milliseconds', ts) AS event_ts, "
                        f"{_PAYLOAD} AS payload FROM events")
SQL["stream_source_log"] = SQL["stream_source"]
