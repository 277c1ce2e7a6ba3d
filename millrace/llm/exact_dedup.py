"""Exact duplicates, found with two passes over a Bloom filter of text hashes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import attach, bloom_mask, bloom_tested, bloom_word, packed, settled, text_or_empty, unpacked

#: Rows for each 64-bit word of the filter.  A row sets up to three bits of one word.
ROWS_PER_WORD = 4


@dataclass
class Repeats:
    """What the two passes found.

    ``digests``: ``row_no, id, digest`` of every row; ``bloom``: ``word, bits`` of
    the hashes that may be repeated; ``groups``: ``digest, stays (id, row_no),
    group_size`` of the texts that are; ``total``: rows.
    """

    digests: DataFrame
    bloom: DataFrame
    groups: DataFrame
    total: int
    n_words: int

    def suspected(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``digest``) and ``maybe``, whether the filter has the digest."""
        return bloom_tested(rows, self.bloom, self.n_words, F.col("digest"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Repeats:
    """The two passes.  Text is read once; everything else works on 32-byte digests.

    Pass 1 counts the rows of each pattern of bits in each word, without the
    digests, and puts the patterns that occur twice into the filter.  Pass 2
    shuffles only the digests which the filter has.
    """
    digests = settled(
        docs.select(
            F.monotonically_increasing_id().alias("row_no"),
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"),
        )
    )
    total = digests.count()
    n_words = max(1, total // ROWS_PER_WORD)
    patterns = digests.groupBy(bloom_word(F.col("digest"), n_words=n_words), bloom_mask(F.col("digest"))).count()
    bloom = settled(
        patterns.where("count > 1").groupBy("word").agg(F.bit_or("mask").alias("bits"))
    )
    found = Repeats(digests, bloom, digests, total, n_words)
    suspects = found.suspected(digests).where("maybe")
    found.groups = settled(
        suspects.groupBy("digest")
        .agg(F.max(F.struct("id", "row_no")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    return found


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if identical; a null counts as empty.  The row with the largest
    id stays; a null id is the smallest.  Of rows that share id and text, exactly
    one stays.  An empty table gives no rows.  Other columns are not read.
    """
    found = repeats(docs, id_col, text_col)
    marked = found.suspected(found.digests)
    single = marked.where(~F.col("maybe")).select(
        "row_no", "id", "digest", F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    suspects = marked.where("maybe").drop("maybe")
    grouped = attach(suspects, found.groups, "digest", "group_size", found.total).select(
        "row_no", "id", "digest", F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("stays.row_no") == F.col("row_no")).alias("kept"),
    )
    # What the filter let through by chance is in no group.
    by_chance = suspects.join(found.groups.select("digest"), "digest", "left_anti").select(
        "row_no", "id", "digest", F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    return single.unionByName(grouped).unionByName(by_chance).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies, same columns, same rules as ``exact_copies``.

    Rows which the filter does not have pass straight through; only the others
    are joined with the groups, and only one row of each group moves.
    """
    found = repeats(docs, id_col, text_col)
    digest = F.unhex(F.sha2(text_or_empty(text_col), 256))
    marked = found.suspected(packed(docs, id=F.col(id_col), digest=digest))
    suspects = marked.where("maybe")
    groups = found.groups.select("digest", "stays", "group_size")
    kept = attach(suspects, groups, "digest", "group_size", found.total).where(
        F.col("id").eqNullSafe(F.col("stays.id"))
    )
    one_each = kept.select("row", "digest").dropDuplicates(["digest"])
    by_chance = suspects.join(groups.select("digest"), "digest", "left_anti")
    whole = marked.where(~F.col("maybe")).select("row").unionByName(by_chance.select("row"))
    return unpacked(whole.unionByName(one_each.select("row")), docs.columns)
