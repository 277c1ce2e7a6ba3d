"""Word lengths against their mean: text in, three text outputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.operators.words import tokenize, word_outputs_tagged
from millrace.sinks.files import write_outputs
from millrace.sources.text import scan_text


def run(spark: SparkSession, source: str, target: str) -> None:
    """Writes ``<target>/output=all``, ``output=above`` and ``output=below``."""
    words = tokenize(scan_text(spark, source))
    write_outputs(word_outputs_tagged(words), target)
