"""The operators applied to the test tables, each to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat, exact_dedup, html, infill, mixing, near, passages, periodic, personal, quality, secrets, sharding, tokens,
)
from millrace.llm.shared import words
from millrace.session import use_utc, with_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(with_package(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tokens.Vocabulary:
    return tokens.Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "word_distance", "char_distance",
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = tokens.encode(docs, vocabulary()).select("doc_id", "ids")
    return tokens.decode(encoded, vocabulary()).select(
        "doc_id", tokens.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    made = chat.format_conversations(rows.unionByName(extra))
    read = made.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("segments")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


#: Of all tokens three fifths are wanted, and no document more than twice.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 5), 2, 17


_SOURCE_NO = "coalesce(try_cast(regexp_extract(source, '^src([0-9]{1,4})$', 1) as int), 0)"


def mixture(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Documents by the tree of the test tables: sources in three domains, with their languages."""
    domain = F.expr(f"case when {_SOURCE_NO} < 10 then 'web' when {_SOURCE_NO} < 15 then 'books' else 'reference' end")
    weights = {
        "domain": F.expr("case domain when 'web' then 5 when 'books' then 3 else 2 end"),
        "lang": F.expr("case lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end"),
        "source": F.expr(f"1 + {_SOURCE_NO} % 3"),
    }
    n_tokens: Column = F.size(words(F.col("text")))
    return mixing.copies(docs, "doc_id", n_tokens, domain, weights, MIX_SHARE, MIX_EPOCHS, MIX_SEED, carry=carry)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents"), []).select(
        F.col("id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "budget", "copies"
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(_table(spark, sf_dir, "documents"), vocabulary())
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("random"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_data(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_copies(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return html.extract_text(pages).select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents")).drop("row_no")


def planted(text: Column, doc_id: Column) -> Column:
    """The text, or, for a tenth of the ids by their hash, one whose words repeat from some
    word on with some period."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    said = words(text)
    n = F.size(said).cast("long")
    a = g % n
    period = 1 + F.floor((n - a) / (3 + g % 8))
    block = F.slice(said, (a + 1).cast("int"), period.cast("int"))
    times = F.ceil((n - a) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - a).cast("int"))
    whole = F.array_join(F.concat(F.slice(said, F.lit(1), a.cast("int")), tail), " ")
    return F.when(h % 10 == 0, F.when(n > 0, whole)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.col("strongest")
    return periodic.periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(periodic.as_lines("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infilled(_table(spark, sf_dir, "documents"), seed=42)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return passages.without_repeats(docs, kept_as=lambda text: F.sha2(text, 256)).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_chat_format": op3_chat_format,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_personal_data": op6_personal_data,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_html_text": op8_html_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_infill": op12_infill,
    "op13_passages": op13_passages,
}
