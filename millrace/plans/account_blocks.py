"""Two files of finance lines, co-grouped by account, one text block each."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.operators.grouping import cogroup_lines
from millrace.sinks.files import write_text
from millrace.sources.text import ACCOUNT, scan_finance_lines


def run(spark: SparkSession, part1: str, part2: str, target: str, ordered: bool = False) -> None:
    lines = cogroup_lines(
        scan_finance_lines(spark, part1), scan_finance_lines(spark, part2), ACCOUNT, "Amount", ordered
    )
    write_text(lines.select("line"), target)
