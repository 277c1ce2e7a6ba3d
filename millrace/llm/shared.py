"""What several operators of this folder need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path, settled, settled_at

# Fixed value: what stands between words.
_SPACES = r"[\x20\x09-\x0D]+"

#: A table of a few numbers a row may be broadcast up to so many rows (about 64 MB).
BROADCAST_ROWS = 1 << 21
#: A key is hot if it has more than one in so many rows; so there are at most so many hot keys.
HOT_SHARE = 1_000


class Workspace:
    """A folder of tables that are needed for a while only."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self._spark, self._path, self._tables = spark, scratch_path(spark, label), 0

    def settled(self, df: DataFrame) -> DataFrame:
        """As ``settled``, below the folder."""
        self._tables += 1
        return settled_at(df, f"{self._path}/{self._tables}")

    def drop(self) -> None:
        """Deletes the folder; nothing that still reads a table of it may follow."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(text: str | Column = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES, -1), lambda w: w != "")


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The rows in one struct ``row``, next to columns of our own whose names cannot clash."""
    row = F.struct("*").alias("row")
    return df.select(row, *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def bloom_word(*hashed: Column, n_words: int) -> Column:
    """The 64-bit word of a blocked Bloom filter that a value falls into."""
    return F.pmod(F.xxhash64(*hashed), F.lit(n_words)).alias("word")


def bloom_mask(*hashed: Column) -> Column:
    """The bits, up to three, that a value sets in its word."""
    bits = F.xxhash64(*hashed, F.lit(1))
    one = F.lit(1).cast("long")
    turn = [F.shiftrightunsigned(bits, n).bitwiseAND(F.lit(63)).cast("int") for n in (0, 6, 12)]
    parts = [F.call_function("shiftleft", one, t) for t in turn]
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).alias("mask")


def bloom_of(values: DataFrame, n: int, column: str, per_word: int = 4) -> tuple[DataFrame, int]:
    """The words (``word, bits``) of a filter of ``n`` values, and how many there can be."""
    n_words = max(1, n // per_word)
    words = values.groupBy(bloom_word(F.col(column), n_words=n_words)).agg(
        F.bit_or(bloom_mask(F.col(column))).alias("bits")
    )
    return settled(words), n_words


def bloom_tested(rows: DataFrame, bloom: DataFrame, n_words: int, *hashed: Column) -> DataFrame:
    """``rows`` and ``maybe``, whether the filter has the value.

    The filter is sent to the tasks up to ``BROADCAST_ROWS`` words; above, words
    and rows are joined by a shuffle.
    """
    small = F.broadcast(bloom) if bloom.count() <= BROADCAST_ROWS else bloom
    met = rows.withColumns({"word": bloom_word(*hashed, n_words=n_words), "mask": bloom_mask(*hashed)})
    hit = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return met.join(small, "word", "left").withColumn("maybe", hit).drop("word", "mask", "bits")


def hot_keys(sizes: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``key, _parts`` of the keys with more than a thousandth of ``total`` rows, so of a
    thousand at most: over how many parts to deal each."""
    limit = max(1, total // HOT_SHARE)
    parts = F.ceil(F.col(size) / limit).cast("int")
    return sizes.where(F.col(size) > limit).select(key, parts.alias("_parts"))


def join_dealt(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``; rows of the ``hot`` keys are dealt over
    several parts, by the partition they come from, and their rows of ``table`` are
    repeated for each part."""
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(F.spark_partition_id(), parts))
    repeated = table.join(F.broadcast(hot), key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return dealt.drop("_parts").join(repeated.drop("_parts"), [key, "_part"]).drop("_part")


def attach(rows: DataFrame, table: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key`` and, in
    ``size``, how many rows of ``rows`` the key has (``total`` together, at least)."""
    return join_dealt(rows, table, key, hot_keys(table, key, size, total))
