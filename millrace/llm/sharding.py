"""A reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import settled, text_or_empty

# The prime of the round function, and the keys of the rounds.
PRIME = 2_147_483_647
ROUND_KEYS = (1_013_904_223, 1_664_525, 22_695_477, 1_103_515_245, 214_013, 134_775_813)


def domain(total: int) -> tuple[int, int]:
    """Sides ``(a, b)`` of the smallest near-square that holds ``total`` rows.

    Less than ``a`` of its places are beyond the last row.
    """
    a = max(1, math.isqrt(max(1, total)))
    return a, -(-max(1, total) // a)


def _mix(x: Column, shift: Column) -> Column:
    """A number below ``PRIME``; all products stay below 2**62."""
    y = (x + shift) % PRIME
    z = (y * y + shift) % PRIME
    return (z * z + y) % PRIME


def permuted(place: Column, total: int, seed: int = 0) -> Column:
    """The image of a place in ``[0, a * b)`` under the Feistel network.

    A place is ``left * b + right``.  Each round adds a function of one half to
    the other, modulo its side, which can be undone.
    """
    a, b = domain(total)

    def number(n: int) -> Column:
        return F.lit(n).cast("long")

    rounds = F.array(*[
        F.struct(number((key + seed) % PRIME).alias("shift"), number((a, b)[n % 2]).alias("side"))
        for n, key in enumerate(ROUND_KEYS)
    ])
    halves = F.struct(
        F.floor(place / b).cast("long").alias("turned"), (place % b).alias("other")
    )
    return F.aggregate(
        rounds, halves,
        lambda h, r: F.struct(
            h["other"].alias("turned"),
            ((h["turned"] + _mix(h["other"], r["shift"])) % r["side"]).alias("other"),
        ),
        lambda h: h["turned"] * b + h["other"],
    )


def shuffled(numbered: DataFrame, total: int, seed: int = 0) -> DataFrame:
    """``place`` of each ``row_no`` below ``total``: the cycle is walked until a place is a row.

    Fewer than sqrt(total) places are no row, so that so few steps are always
    enough, and so few rows take any.
    """
    a, b = domain(total)
    first = numbered.withColumn("place", permuted(F.col("row_no"), total, seed))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, a * b - total))), F.col("place"),
        lambda at, _: F.when(at < total, at).otherwise(permuted(at, total, seed)),
    )
    return first.withColumn("place", F.when(F.col("place") < total, F.col("place")).otherwise(walked))


def global_row_numbers(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``row_no``, 0 .. n - 1 in ``order``; rows alike in ``order`` must be alike.

    One range shuffle.  The position in the input is the last key, so that many
    rows that are alike still spread over tasks; the offsets of the partitions,
    one number each, are what is summed in one place.
    """
    laid = (
        rows.withColumn("_scan", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_scan")
        .sortWithinPartitions(*order, "_scan")
        .drop("_scan")
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    placed = settled(laid)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first_at"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_part", "_first_at", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(before), "_part")  # a row per partition of the shuffle
        .withColumn("row_no", F.col("_before") + F.col("_at") - F.col("_first_at"))
        .drop("_part", "_at", "_first_at", "_before")
    )


def shards(docs: DataFrame, n_shards: int = 24, seed: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; law ``rows``.

    Rows are numbered by id, then text; number ``n`` goes to place ``p`` of the
    permutation, that is shard ``p % n_shards``, slot ``p // n_shards``, both of
    which anyone can compute from ``n``, the count and the seed.  A null id comes
    first; a null text has no bytes.  Rows alike in id and text get the places of
    their numbers, in any order.  An empty table gives no rows.
    """
    text = text_or_empty(text_col)
    narrow = settled(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
        )
    )
    total = narrow.count()
    numbered = global_row_numbers(narrow, ["doc_id", "text_crc32", "_hash", "size"])
    return shuffled(numbered, total, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("place") / n_shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )
