"""Byte-level BPE over texts of any length: encode overlapping chunks, decode by joining bytes.

Token ids are kept packed, as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shared import attach, settled, text_or_empty

#: Code points of a chunk, and of the stretch that it shares with the next one.  A chunk
#: takes a few hundredths of a second; to spread shorter texts would cost more than it saves.
CHUNK, OVERLAP = 65_536, 1_024
#: No alternative of a pattern looks further ahead than this from the end of its match.
LOOK_AHEAD = 3
#: A vocabulary is sent to the tasks; a file above this size is refused.
VOCABULARY_BYTES = 64 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Ranks (lines of base64 and number) and the pattern that splits a text before merging."""

    ranks: bytes
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            ranks = file.read(VOCABULARY_BYTES + 1)
        if len(ranks) > VOCABULARY_BYTES:
            raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
        return Vocabulary(ranks, pattern)


@lru_cache(maxsize=2)
def _ranks(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(n) for t, n in (line.split() for line in ranks.splitlines() if line)}


@lru_cache(maxsize=2)
def _bytes_of(ranks: bytes) -> list[bytes]:
    known = {n: t for t, n in _ranks(ranks).items()}
    return [known.get(n, b"") for n in range(max(known) + 1)]


@lru_cache(maxsize=2)
def encoding(vocabulary: Vocabulary) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "own", pat_str=vocabulary.pattern, mergeable_ranks=_ranks(vocabulary.ranks), special_tokens={}
    )


@lru_cache(maxsize=2)
def _splitter(pattern: str) -> regex.Pattern:
    # White space as in Unicode's property, which is what the encoder means by it.
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _encoder(spark: SparkSession, vocabulary: Vocabulary):
    sent = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        own = encoding(sent.value)
        return pa.array(
            [np.array(own.encode_ordinary(t.as_py()), "<u4").tobytes() for t in texts], pa.binary()
        )

    return encode


def _decoder(spark: SparkSession, vocabulary: Vocabulary):
    sent = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def decode(packed_ids: pa.Array) -> pa.Array:
        table = _bytes_of(sent.value.ranks)
        return pa.array(
            [None if p is None else b"".join([table[n] for n in np.frombuffer(p, "<u4").tolist()])
             for p in packed_ids.to_pylist()],
            pa.binary(),
        )

    return decode


def boundaries(text: str, pattern: str, first: int, last: int) -> list[int]:
    """Ends of pre-tokens in ``first .. last`` before which no white space stands, from 0.

    Cutting there changes nothing: the only look ahead is that after white space.
    """
    ends = [0] + [m.end() for m in _splitter(pattern).finditer(text)]
    return [e for e in ends if first <= e <= last and (e == 0 or not text[e - 1].isspace())]


def _resynchronising(pattern: str, chunk: int, overlap: int):
    @F.arrow_udf("struct<head:array<int>,tail:array<int>>")
    def seams(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            text = t.as_py()
            head = boundaries(text[: overlap + LOOK_AHEAD], pattern, 0, overlap)
            sure = min(len(text) - LOOK_AHEAD, chunk + overlap)
            tail = [e - chunk for e in boundaries(text, pattern, chunk, sure)] if len(text) > chunk else []
            rows.append({"head": head, "tail": tail})
        return pa.array(rows, pa.struct([("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))]))

    return seams


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``digest, n, text``: overlapping chunks of distinct texts, spread by chunk."""
    parts = texts.select("digest", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("parts"))
    nexts = F.concat(F.slice("parts", F.lit(2), F.size("parts")), F.array(F.lit("")))
    both = parts.select("digest", F.posexplode(F.arrays_zip("parts", nexts.alias("next"))).alias("n", "part"))
    text = F.concat("part.parts", F.left("part.next", F.lit(overlap)))
    return both.select("digest", "n", text.alias("text")).dropDuplicates(["digest", "n"])


def _encode_long(texts: DataFrame, vocabulary: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    """``digest, ids`` of distinct long texts (``digest, text``, possibly repeated).

    Chunk ``n`` is cut from its neighbour at the first boundary of pre-tokens that
    both find in the stretch they share: from there on, the pattern finds the same
    in both.  A text with a seam where they share none is encoded whole.
    """
    encode = _encoder(texts.sparkSession, vocabulary)
    seams = _resynchronising(vocabulary.pattern, chunk, overlap)
    chunks = settled(_chunks(texts, chunk, overlap).withColumn("seams", seams("text")))
    order = Window.partitionBy("digest").orderBy("n")
    shared = F.array_min(F.array_intersect(F.lag("seams.tail").over(order), F.col("seams.head")))
    cut = F.when(F.col("n") == 0, F.lit(0)).otherwise(shared)
    cuts = chunks.select("digest", "n", "seams").select("digest", "n", cut.alias("cut"))
    cuts = settled(
        cuts.select("digest", "n", "cut", F.lead("cut").over(order).alias("next_cut"),
                    F.lead("n").over(order).isNull().alias("is_last"))
    )
    length = F.when(F.col("is_last"), F.length("text")).otherwise(F.lit(chunk) + F.col("next_cut"))
    piece = F.substring(F.col("text"), F.col("cut") + 1, length - F.col("cut"))
    pieces = chunks.drop("seams").join(cuts, ["digest", "n"])
    failed = settled(cuts.where(F.col("cut").isNull()).select("digest").distinct())
    seamless = failed.isEmpty()
    if not seamless:
        pieces = pieces.join(failed, "digest", "left_anti")
    encoded = pieces.select("digest", "n", encode(piece).alias("ids"))
    parts = encoded.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("n", "ids"))).alias("parts"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    stitched = parts.select("digest", joined.alias("ids"))
    if seamless:
        return stitched
    whole = texts.join(failed, "digest", "left_semi").dropDuplicates(["digest"])
    return stitched.unionByName(whole.select("digest", encode("text").alias("ids")))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` and ``ids_col``, the packed ids of each whole text, without special tokens.

    Texts of one chunk are encoded where they are.  Longer ones are cut into
    overlapping chunks, each distinct chunk once, which spread over the tasks.
    A null text counts as empty and has no ids; a column of the name ``ids_col``
    is replaced; an empty table gives no rows.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c != ids_col]
    text = text_or_empty(text_col)
    short = docs.where(F.length(text) <= chunk).withColumn(ids_col, _encoder(spark, vocabulary)(text))
    digest = F.unhex(F.sha2(text, 256))
    long = docs.where(F.length(text) > chunk)
    found = _encode_long(long.select(digest.alias("digest"), text.alias("text")), vocabulary, chunk, overlap)
    sizes = settled(long.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("copies")))
    total = sizes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # Plain columns under numbers, so that those nobody asks for are not moved.
    rows = long.select(*[F.col(c).alias(f"c{n}") for n, c in enumerate(columns)], digest.alias("digest"))
    met = attach(rows, found.join(sizes, "digest"), "digest", "copies", total)
    met = met.select(*[F.col(f"c{n}").alias(c) for n, c in enumerate(columns)], F.col("ids").alias(ids_col))
    return short.select(*columns, ids_col).unionByName(met)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` and ``bytes_col``, the bytes of its tokens one after the other.

    A null stays null.  The bytes need not be text where ids were cut.
    """
    return encoded.withColumn(bytes_col, _decoder(encoded.sparkSession, vocabulary)(F.col(ids_col)))


def n_tokens(ids: str | Column = "ids") -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")
