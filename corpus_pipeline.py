"""From raw documents to token ids, one operator of ``millrace.llm`` a stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, mixing, near, quality, tokens
from millrace.llm.queries import mixture, vocabulary
from millrace.session import scratch_path, use_utc, with_package


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without what the quality rules reject; equal rows stay or go together."""
    return quality.keep_good(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id; of rows that are alike in both, one."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.75 or more, directly or not, the one with the smallest id."""
    return near.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three fifths of the tokens, by the weights of domains, languages and sources; rows alike in
    id and tokens come together or not at all."""
    return mixing.mixed(mixture(docs, docs.columns), docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``."""
    found = tokens.encode(docs, vocabulary())
    return found.select("doc_id", "lang", "source", tokens.n_tokens().alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Byte-level BPE cannot be said in SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = use_utc(with_package(spark)).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
