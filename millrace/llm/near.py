"""Exact Jaccard join of documents on word shingles, by regions of a metric space.

Jaccard distance is a metric.  Documents within the radius of each other are found
in three steps.

1. The pivots of the first level are shingles.  In one order of all shingles, the
   smallest that two such documents share is among the first few of either; so each
   document belongs to the regions of its first few shingles.  Shingles which many
   documents have come last in the order, so that few regions are crowded.  Regions
   of a few documents are joined pair by pair.
2. A crowded region has a document as its pivot, the one most made of common shingles.
   Exact distances from it decide: what lies within the radius is linked to it.
3. What is left of the region is joined with all of it that the triangle inequality
   does not rule out: two documents whose distances from the pivot differ by more than
   the radius cannot be linked, and those that both are linked to it need not be.

Document pivots alone could not split the corpus, as almost all documents share no
shingle and have distance 1 from nearly every pivot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import Workspace, attach, bloom_of, bloom_tested, hot_keys, join_dealt, settled, text_or_empty

WORDS = 5
#: Documents are linked if 100 * shared shingles >= 75 * shingles of both.
SIMILAR = 75
#: A region of more documents is crowded.
CROWDED = 32
#: Shingles that so many documents have are common; in a batch of so many shingles,
#: only those found at least so often are counted.  None of this changes the links.
COMMON, BATCH, BATCH_LEAST = 32, 1 << 22, 3
#: Bits of the table of common shingles; one in eight of them at most is set.
COMMON_BITS = 1 << 24

# Odd numbers that mix the hashes of the words of a shingle.
_MIX = [np.uint64(n) for n in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
)]


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; bytes know no other letters and spaces."""
    return text.encode().lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    if len(words) < WORDS:
        whole = [xxhash.xxh64_intdigest(b" ".join(words))] if words else []
        return np.array(whole, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    last = len(words) - WORDS + 1
    mixed = each[:last] * _MIX[0]
    for n in range(1, WORDS):
        mixed += (each[n : n + last] ^ (each[n : n + last] >> np.uint64(31))) * _MIX[n]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _at_least(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def first_few(found: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles whose regions a document belongs to, and how many of all are rare."""
    slots = (found >> np.uint64(40)).astype(np.int64)
    is_common = (common[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
    ordered = np.concatenate([found[~is_common], found[is_common]])
    return ordered[: len(found) - _at_least(len(found), SIMILAR) + 1], int(len(found) - is_common.sum())


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _key(found: np.ndarray, rare: int, digest: bytes) -> int:
    """8 bits for the share of rare shingles and 55 bits of the digest, so that the smallest
    key of a region is that of the document to be its pivot."""
    return (rare * 255 // len(found)) << 55 | int.from_bytes(digest[:8], "little") >> 9


def _rows(texts: pa.Array):
    for text in texts:
        yield words_of(text.as_py() or "")


def _longs(array: np.ndarray) -> pa.Array:
    return pa.array(array.view(np.int64), pa.int64())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _longs(flat))


def _sequences(batches):
    """Of each document its id, digest and set size; and the shingles found often in a batch."""
    pending, size = [], 0

    def often():
        found, counts = np.unique(np.concatenate(pending), return_counts=True)
        some = counts >= BATCH_LEAST
        nothing = pa.nulls(int(some.sum()))
        return pa.RecordBatch.from_arrays(
            [nothing.cast(pa.int64()), nothing.cast(pa.binary()), nothing.cast(pa.int64()), _longs(found[some]),
             pa.array(counts[some], pa.int64())], ["id", "digest", "n", "hash", "times"],
        )

    for batch in batches:
        digests, sizes = [], []
        for words in _rows(batch["text"]):
            found = shingles(words)
            digests.append(_digest(words))
            sizes.append(len(found))
            pending.append(found)
            size += len(found)
            if size >= BATCH:
                yield often()
                pending, size = [], 0
        nothing = pa.nulls(len(sizes), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), nothing, nothing],
            ["id", "digest", "n", "hash", "times"],
        )
    if pending:
        yield often()


@dataclass
class _Corpus:
    """``rows``: ``row_no, id, digest, n`` of every document; ``classes``: of each digest
    ``node`` (its smallest row number), ``least_id, n, copies``; ``total``: documents."""

    texts: DataFrame
    rows: DataFrame
    classes: DataFrame
    sent: Broadcast  # the table of common shingles
    total: int


def _read(docs: DataFrame, id_col: str, text_col: str) -> _Corpus:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    seen = settled(
        texts.mapInArrow(_sequences, "id long, digest binary, n long, hash long, times long")
        .withColumn("row_no", F.monotonically_increasing_id())
    )
    rows = seen.where("digest is not null").select("row_no", "id", "digest", "n")
    classes = settled(
        rows.groupBy("digest").agg(
            F.min("row_no").alias("node"), F.min("id").alias("least_id"), F.max("n").alias("n"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    often = seen.where("digest is null").groupBy("hash").agg(F.sum("times").alias("times"))
    # Bounded by the table's bits: of more, the most common.
    often = often.where(F.col("times") >= COMMON).orderBy(F.desc("times"), "hash").limit(COMMON_BITS // 8)
    slot = F.shiftrightunsigned("hash", 40)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = often.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    common = np.zeros(COMMON_BITS // 64, np.int64)
    for word, bits in words:
        common[word] = bits
    sent = docs.sparkSession.sparkContext.broadcast(common.view(np.uint8))
    return _Corpus(texts, rows, classes, sent, rows.count())


def _placed(corpus: _Corpus, work: Workspace) -> DataFrame:
    """``key, digest, n, first`` of each document with shingles."""
    sent = corpus.sent

    def place(batches):
        for batch in batches:
            keys, digests, sizes, firsts = [], [], [], []
            for words in _rows(batch["text"]):
                if not words:
                    continue
                found = shingles(words)
                digest = _digest(words)
                first, rare = first_few(found, sent.value)
                keys.append(_key(found, rare, digest))
                digests.append(digest)
                sizes.append(len(found))
                firsts.append(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 _lists(firsts)], ["key", "digest", "n", "first"],
            )

    return work.settled(corpus.texts.mapInArrow(place, "key long, digest binary, n long, first array<long>"))


def _seventh(a: Column, b: Column) -> Column:
    """The shingles that two documents must share to be linked."""
    return F.ceil((a + b) * SIMILAR / F.lit(100 + SIMILAR))


def _possible(shared: Column) -> Column:
    """Whether ``a`` and ``b``, of ``n_a`` and ``n_b`` shingles, may be linked if they share
    at most ``shared`` of their first ones.

    Whichever's first few end first in the order, all of them that the other has are
    among the other's first few; so it shares at most ``shared`` and its remaining ones.
    """
    a, b = F.col("n_a"), F.col("n_b")
    rest = F.greatest(F.ceil(a * SIMILAR / F.lit(100)), F.ceil(b * SIMILAR / F.lit(100))) - 1
    return (shared + rest >= _seventh(a, b)) & (100 * F.least(a, b) >= SIMILAR * F.greatest(a, b))


def _regions(placed: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """``hash, key`` without repetition of the regions with 2 to ``CROWDED`` keys, and of the others."""
    memberships = placed.select("key", F.explode("first").alias("hash"))
    counted = work.settled(memberships.groupBy("hash").count().where("count > 1").withColumnRenamed("count", "size"))
    n = counted.count()
    bloom, n_words = bloom_of(counted, n, "hash")
    repeated = bloom_tested(memberships, bloom, n_words, F.col("hash")).where("maybe").drop("maybe")
    total = counted.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    met = attach(repeated, counted, "hash", "size", total).select("hash", "key").distinct()
    met = work.settled(met)
    sizes = work.settled(met.groupBy("hash").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("pivot")))
    few = met.join(sizes.where(f"size between 2 and {CROWDED}").select("hash"), "hash", "left_semi")
    many = sizes.where(f"size > {CROWDED}")
    many = attach(met.join(many.select("hash"), "hash", "left_semi"), many, "hash", "size", total)
    return few, work.settled(many.select("hash", "key", "pivot"))


def _pairs_of_few(few: DataFrame) -> DataFrame:
    """``a, b, shared``: all pairs of each small region, with the number of regions they share."""
    members = few.groupBy("hash").agg(F.sort_array(F.collect_set("key")).alias("members"))  # CROWDED at most
    members = members.groupBy("members").agg(F.count(F.lit(1)).alias("regions"))
    one = members.select("members", "regions", F.posexplode("members").alias("at", "a"))
    pairs = one.select("a", "regions", F.explode(F.slice("members", F.col("at") + 2, F.lit(CROWDED))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.sum("regions").alias("shared"))


def _measured(corpus: _Corpus, placed: DataFrame, pairs: DataFrame, work: Workspace) -> DataFrame:
    """``a, b, digest_a, digest_b, d, linked``: the exact distances of ``pairs`` (``a, b``), written.

    The sets of all documents in pairs are read from the texts and moved once, to
    where the pairs are that name them; then each pair moves with one set.
    """
    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
    ends = work.settled(ends.groupBy("key").agg(F.count(F.lit(1)).alias("pairs")))
    hot = work.settled(hot_keys(ends, "key", "pairs", 2 * pairs.count()))
    digests = placed.select("key", "digest").join(ends.select("key"), "key", "left_semi").distinct()
    sets = _sets(corpus, work.settled(digests.join(corpus.classes, "digest").select("least_id")))
    for side in ("b", "a"):
        met = join_dealt(pairs.withColumnRenamed(side, "key"), sets, "key", hot)
        pairs = met.withColumnsRenamed({"key": side, "digest": f"digest_{side}", "found": f"found_{side}"})
    shared = F.size(F.array_intersect("found_a", "found_b"))
    both = F.size("found_a") + F.size("found_b") - shared
    return work.settled(pairs.select(
        "a", "b", "digest_a", "digest_b", (1 - shared / both).alias("d"),
        (100 * shared >= SIMILAR * both).alias("linked"),
    ))


def _sets(corpus: _Corpus, wanted: DataFrame) -> DataFrame:
    """``key, digest, found`` of the documents of the ids ``wanted``, and of a few more.

    A filter of the ids says which texts to read again.
    """
    bloom, n_words = bloom_of(wanted.where("least_id is not null"), wanted.count(), "least_id")
    some = bloom_tested(corpus.texts, bloom, n_words, F.col("id")).where("id is null or maybe")
    sent = corpus.sent

    def read(batches):
        for batch in batches:
            keys, digests, sets = [], [], []
            for words in _rows(batch["text"]):
                if words:
                    found, digest = shingles(words), _digest(words)
                    keys.append(_key(found, first_few(found, sent.value)[1], digest))
                    digests.append(digest)
                    sets.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(digests, pa.binary()), _lists(sets)], ["key", "digest", "found"]
            )

    return some.select("text").mapInArrow(read, "key long, digest binary, found array<long>")


def links(corpus: _Corpus) -> DataFrame:
    """``u, v``: edges between classes, whose components are those of all links."""
    work = Workspace(corpus.texts.sparkSession, "regions")
    placed = _placed(corpus, work)
    few, many = _regions(placed, work)
    sizes = work.settled(placed.groupBy("key").agg(F.max("n").alias("n")))
    # Of a key in crowded regions, which these are.
    crowds = work.settled(many.groupBy("key").agg(F.sort_array(F.collect_set("hash")).alias("crowds")))

    def with_sizes(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            n_crowds = F.coalesce(F.size("crowds"), F.lit(0)).alias(f"crowds_{side}")
            mine = sizes.join(crowds, "key", "left").select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), n_crowds)
            pairs = pairs.join(mine, side)
        return pairs

    close = with_sizes(_pairs_of_few(few)).withColumn("in_crowds", F.greatest(F.lit(0), F.least("crowds_a", "crowds_b")))
    close = close.where(_possible(F.col("shared") + F.col("in_crowds"))).select("a", "b")
    star = many.where("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    star = with_sizes(star).where(_possible(F.least("n_a", "n_b"))).select("a", "b")
    measured = _measured(corpus, placed, work.settled(close.unionByName(star).distinct()), work)
    left = work.settled(_left_over(many, crowds, sizes, measured, work))
    edges = measured if left.isEmpty() else measured.unionByName(_measured(corpus, placed, left, work))
    # Two classes of one key, by chance, are apart; so classes are linked, not keys.
    edges = edges.where("linked").select("digest_a", "digest_b").distinct()
    nodes = corpus.classes.select("digest", "node")
    for side, name in (("digest_a", "u"), ("digest_b", "v")):
        edges = edges.join(nodes.select(F.col("digest").alias(side), F.col("node").alias(name)), side)
    found = settled(edges.select("u", "v"))
    work.drop()
    return found


def _left_over(many: DataFrame, crowds: DataFrame, sizes: DataFrame, measured: DataFrame, work: Workspace) -> DataFrame:
    """``a, b``: the pairs of crowded regions that the distances from the pivot leave open.

    A pair which also shares a small region is among the pairs of that; so here a
    pair shares crowded regions only, and is made in the first of them.
    """
    from_pivot = measured.groupBy(F.col("a").alias("pivot"), F.col("b").alias("key")).agg(
        F.min("d").alias("d"), F.max("linked").alias("linked")
    )
    rows = many.where("key <> pivot").join(from_pivot, ["pivot", "key"], "left")
    # What was not measured is too different in size; it shares less than the smaller has.
    n_pivot = sizes.select(F.col("key").alias("pivot"), F.col("n").alias("n_pivot"))
    rows = rows.join(sizes, "key").join(n_pivot, "pivot").join(crowds, "key")
    least_d = 1 - F.least("n", "n_pivot") / F.greatest("n", "n_pivot")
    rows = work.settled(rows.select(
        "hash", "key", "n", "crowds", F.coalesce("d", least_d).alias("d"),
        F.coalesce("linked", F.lit(False)).alias("linked"),
    ))
    open_ = rows.where("not linked").select(
        "hash", F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("crowds").alias("crowds_a"), F.col("d").alias("d_a"),
    )
    others = rows.select(
        "hash", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("crowds").alias("crowds_b"),
        F.col("d").alias("d_b"), F.col("linked").alias("linked_b"),
    )
    radius = 1 - SIMILAR / 100 + 1e-9
    within = F.when(F.col("linked_b"), F.col("d_a") - F.col("d_b") <= radius).otherwise(F.col("a") < F.col("b"))
    # Sizes first: they rule out most pairs at little cost.
    shared = F.array_intersect("crowds_a", "crowds_b")
    near = within & _possible(F.least(F.size("crowds_a"), F.size("crowds_b")))
    near = near & _possible(F.size(shared)) & (F.get(shared, F.lit(0)) == F.col("hash"))
    met = open_.join(others, "hash").where(near)
    return met.select("a", "b").distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_no, doc_id, n_shingles, component_id, class_node`` of every document.

    Documents of the same words are one class; classes are joined.  A document
    without words, or without text, has no shingles and is linked with nothing; a
    null id is never the smallest if there is another.  An empty table gives no rows.
    """
    corpus = _read(docs, id_col, text_col)
    rooted = components(links(corpus))
    classes = corpus.classes.join(rooted.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = settled(classes.join(least, "root").select("digest", "copies", "component_id", "root"))
    met = attach(corpus.rows, classes, "digest", "copies", corpus.total)
    empty = F.col("n") == 0
    return met.select(
        "row_no", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.col("row_no")).otherwise(F.col("root")).alias("root"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id, same columns.

    Rows are numbered and written, since ids may be null or repeat.  Only the rows
    that a filter of the dropped ones has are joined; the others pass straight through.
    """
    numbered = settled(docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("at")
    ))
    at_text = numbered.select("at", F.col("row").getField(text_col).alias("text"))
    found = near_copies(at_text, "at").select(F.col("doc_id").alias("at"), "root")
    ids = numbered.select("at", F.col("row").getField(id_col).alias("id"))
    ranked = settled(found.join(ids, "at").select("root", "at", F.struct(F.col("id").isNull(), "id", "at").alias("rank")))
    stays = ranked.groupBy("root").agg(F.min("rank").alias("rank")).select(F.col("rank.at").alias("at"))
    dropped = settled(ranked.select("at").join(stays, "at", "left_anti"))
    bloom, n_words = bloom_of(dropped, dropped.count(), "at")
    tested = bloom_tested(numbered, bloom, n_words, F.col("at"))
    kept = tested.where("not maybe").select("row").unionByName(
        tested.where("maybe").join(dropped, "at", "left_anti").select("row")
    )
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
