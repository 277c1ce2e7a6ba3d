"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8)
the local cores.  A query's time is the median of three runs after one to warm
up, from building the DataFrame, with what that runs eagerly, to its last row;
streams run once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.compare import session
from checks.queries import QUERIES

BATCH = [
    "tokenize", "mean_global", "filter_ge_scalar", "multi_output_one_pass", "word_report_files",
    "scan_finance_csv", "group_by_key", "group_by_key_hot", "cogroup", "format_cogroup",
    "account_blocks_files", "json_project_schema", "json_project_denylist",
    "json_project_required", "on_error_drop", "sink_table_append", "sink_table_per_window",
    "win_by_type_nominal", "pane_info", "pane_info_hot", "sink_pane_files",
]
STREAMS = ["stream_source", "trig_watermark", "trig_early_count_stream", "late_drop", "late_drop_hot"]


def timed(run) -> float:
    begun = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in BATCH + STREAMS:
        def run(name=name):
            return QUERIES[name](spark, sf_dir)

        if name in BATCH:
            timed(run)
            seconds[name] = round(statistics.median(timed(run) for _ in range(3)), 3)
        else:
            seconds[name] = round(timed(run), 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))


if __name__ == "__main__":
    main()
