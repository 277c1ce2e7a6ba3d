"""Passages that repeat across documents, found by seed and extend.

A window of ``WINDOW`` words is removed from a document if its words also stand in a
document with a smaller id.  What is removed are thus maximal repeats of ``WINDOW``
words or more.

1. Seeds.  Winnowing gives each window an anchor, the smallest hash among its stretches
   of ``SEED`` words, so that equal windows have equal anchors.  An anchor answers for
   the windows that chose it, and its reach is what these windows cover.
2. Join.  Anchors are joined across documents; those of one document only are left behind.
3. Extension of whole reaches.  Anchors with the same words on both sides, as far as they
   reach, are one class; all of it but its first document is repeated there.
4. Extension by the word.  Where an anchor has several classes, the matches between them
   end within reach.  The first document of each class extends its anchor to both sides
   as far as each of its windows asks, and looks for the first document that has these
   words around the same anchor.
5. Matches that touch or overlap are put together to maximal repeats.

No pairs of documents are made: a window needs but the first document that has it, and
that is an aggregate.  So a passage in a third of all rows costs no more than its words.
Texts that are equal are worked on once.  A stretch of words is told by 64 bits, next to
64 bits of its anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.grams import WordHashes, hashes_of, mixed, words_of
from millrace.llm.shared import Workspace, attach, settled, text_or_empty

# Fixed value: how long a repeat must be.
WINDOW = 50
#: Words of a seed.  Shorter ones give fewer anchors, of which more are shared by chance.
SEED = 16

_NO_ID = (1 << 63) - 1  # a null id comes after all others
_SPANS = "array<struct<start:bigint,end:bigint>>"


def anchors(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """From hashes of words, of each anchor its hash, its first and last window and its place."""
    if len(hashes) < window:
        nothing = np.zeros(0, np.int64)
        return nothing.astype(np.uint64), nothing, nothing, nothing
    grams = hashes_of(hashes, seed)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - seed + 1)
    chosen = np.arange(len(views)) + views.argmin(axis=1)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    return grams[chosen[first]], first, last, chosen[first]


def reaches(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """A hash of all words that the windows from ``first`` to ``last`` cover, with where the
    anchor stands among them."""
    whole = hashes_of(hashes, window)
    shape = ((last - first) * window + (place - first)).astype(np.uint64)
    # The first and the last of the windows cover it, as they choose from less than a window.
    return mixed(mixed(whole[first], whole[last]), shape)


def _seeds(window: int, seed: int):
    anchor = pa.struct([("anchor", pa.int64()), ("reach", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("joined", pa.string()), ("anchors", pa.list_(anchor))])
    known = WordHashes()

    @F.arrow_udf("n_words long, joined string, anchors array<struct<anchor:long,reach:long,first:int,last:int>>")
    def find(texts: pa.Array) -> pa.Array:
        sizes, joined, ends, columns = [], [], [0], [[], [], [], []]
        for text in texts:
            words = words_of(text.as_py())
            hashes = known.of(words) if len(words) >= window else np.zeros(0, np.uint64)
            grams, first, last, place = anchors(hashes, window, seed)
            reach = reaches(hashes, first, last, place, window) if len(grams) else grams
            for column, values in zip(columns, (grams.view(np.int64), reach.view(np.int64), first, last)):
                column.append(values)
            sizes.append(len(words))
            joined.append(b" ".join(words).decode())
            ends.append(ends[-1] + len(grams))
        flat = [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, anchor)]
        found = pa.StructArray.from_arrays(flat, fields=list(anchor))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found).cast(pa.list_(anchor))
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(joined, pa.string()), lists],
                                          fields=list(kind))

    return find


def _windows(window: int):
    kind = pa.list_(pa.list_(pa.int64()))
    known = WordHashes()

    @F.arrow_udf("array<array<bigint>>")
    def find(texts: pa.Array, asking: pa.Array) -> pa.Array:
        """Of each text and each of its anchors that ask, the hashes of the windows from first to last."""
        out = []
        for text, anchors_of in zip(texts, asking.to_pylist()):
            whole = hashes_of(known.of(words_of(text.as_py())), window).view(np.int64)
            out.append([whole[a["first"] : a["last"] + 1] for a in anchors_of])
        return pa.array(out, kind)

    return find


def _cut(words: list[bytes], whole: list[dict], starts: list[int], window: int) -> dict:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [r["first"] for r in whole] + starts, 1)
    np.add.at(change, [r["last"] + window for r in whole] + [s + window for s in starts], -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8))).tolist()
    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
    kept = b" ".join([words[n] for n in np.flatnonzero(~gone)]).decode()
    return {"n_removed": int(gone.sum()), "spans": spans, "kept": kept}


def _cutter(window: int):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kind = pa.struct([("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.string())])

    @F.arrow_udf(f"n_removed long, spans {_SPANS}, kept string")
    def cut(texts: pa.Array, whole: pa.Array, starts: pa.Array) -> pa.Array:
        rows = zip(texts, whole.to_pylist(), starts.to_pylist())
        return pa.array([_cut(words_of(t.as_py()), w or [], s or [], window) for t, w, s in rows], kind)

    return cut


def _texts(rows: DataFrame, kept_as: Callable[[Column], Column], window: int, seed: int) -> DataFrame:
    """One row for each distinct text: ``tid, digest, first_id, copies, n_words, kept, anchors``."""
    read = rows.select("id", "digest", _seeds(window, seed)(F.col("text")).alias("found"))
    read = read.select(
        "id", "digest", "found.n_words", kept_as(F.col("found.joined")).alias("kept"), "found.anchors"
    )
    texts = read.groupBy("digest").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("n_words", "kept", "anchors")],
    )
    return settled(texts.withColumn("tid", F.monotonically_increasing_id()))


def _answers(texts: DataFrame, work: Workspace) -> DataFrame:
    """Steps 2 and 3.  ``tid, first_id, anchor, first, last, whole``: the anchors of which all
    windows are repeated (``whole``), and those that have to ask for each."""
    total = texts.agg(F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()[0]
    seeds = texts.select("tid", "first_id", F.inline("anchors"))
    shared = work.settled(
        seeds.groupBy("anchor")
        .agg(F.min("first_id").alias("earliest"), F.max("first_id").alias("latest"), F.count(F.lit(1)).alias("size"))
        .where("earliest < latest").select("anchor", "size")
    )
    met = attach(seeds, shared, "anchor", "size", total)
    met = work.settled(
        met.select("tid", "first_id", F.struct("anchor", "reach").alias("class"), "first", "last", "size")
    )
    classes = work.settled(
        met.groupBy("class").agg(
            F.min("first_id").alias("earliest"), F.count(F.lit(1)).alias("class_size"),
            F.first("size").alias("anchor_size"),
        )
    )
    answered = attach(met.drop("size"), classes, "class", "class_size", total).select(
        "tid", "first_id", F.col("class.anchor").alias("anchor"), "first", "last",
        (F.col("earliest") < F.col("first_id")).alias("whole"),
        (F.col("class_size") < F.col("anchor_size")).alias("others"),
    )
    return work.settled(answered.where("whole or others").drop("others"))


def _met(rows: DataFrame, texts: DataFrame, answers: DataFrame, window: int, work: Workspace) -> DataFrame:
    """``tid, first_id, text, whole, asking`` of the texts with such anchors."""
    wanted = answers.groupBy("tid").agg(
        F.min("first_id").alias("first_id"),
        F.sort_array(F.collect_list(F.when(F.col("whole"), F.struct("first", "last")))).alias("whole"),
        F.sort_array(F.collect_list(F.when(~F.col("whole"), F.struct("first", "last", "anchor")))).alias("asking"),
    )
    long = F.length("text") >= 2 * window - 1  # a word and a space each, at least
    bodies = rows.where(long).groupBy("digest").agg(F.first("text").alias("text"))
    wanted = wanted.join(texts.select("tid", "digest"), "tid")
    return work.settled(bodies.join(wanted, "digest").drop("digest"))


def _repeated(met: DataFrame, window: int, work: Workspace) -> DataFrame:
    """Step 4.  ``tid, starts``: the windows which an asking anchor found in an earlier document."""
    asking = met.where(F.size("asking") > 0)
    hashes = _windows(window)(F.col("text"), F.col("asking"))
    each = asking.select("tid", "first_id", "asking", hashes.alias("hashes")).select(
        "tid", "first_id", F.explode(F.arrays_zip("asking", "hashes")).alias("one")
    )
    each = each.select("tid", "first_id", "one.asking.anchor", F.col("one.asking.first").alias("first"),
                       F.posexplode("one.hashes").alias("n", "hash"))
    windows = work.settled(each.select(
        "tid", "first_id", F.struct("anchor", "hash").alias("window"), (F.col("first") + F.col("n")).alias("start")
    ))
    firsts = work.settled(
        windows.groupBy("window").agg(
            F.min("first_id").alias("earliest"), F.max("first_id").alias("latest"), F.count(F.lit(1)).alias("size")
        ).where("earliest < latest").drop("latest")
    )
    found = attach(windows, firsts, "window", "size", windows.count()).where("earliest < first_id")
    return found.groupBy("tid").agg(F.collect_list("start").alias("starts"))


def without_repeats(docs: DataFrame, kept_as: Callable[[Column], Column] = lambda text: text,
                    window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept`` of every row.

    ``spans`` are the maximal repeats that go, in words from 0, end exclusive; ``kept`` are
    the other words joined by a space, or ``kept_as`` of that, such as a digest, which then
    is all that moves.  Ids are whole numbers.  Windows are judged on the texts as they come in.
    A null text has no words.  Rows of the same id do not take from each other, whether their texts are equal
    or not; a null id comes after all others.  Texts shorter than a window keep all.  Other
    columns are not read; an empty table gives no rows.  Texts are worked on as wholes, so a
    task needs memory for its longest text.
    """
    text = text_or_empty(text_col)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("id"), text.alias("text"),
                       F.unhex(F.md5(text)).alias("digest"))
    work = Workspace(docs.sparkSession, "passages")
    texts = _texts(rows, kept_as, window, seed)
    met = _met(rows, texts, _answers(texts, work), window, work)
    gone = met.select("tid", "text", "whole").join(_repeated(met, window, work), "tid", "left")
    gone = gone.where((F.size("whole") > 0) | F.col("starts").isNotNull())
    cut = gone.select("tid", _cutter(window)(F.col("text"), F.col("whole"), F.col("starts")).alias("cut"))
    cut = settled(cut.select("tid", "cut.n_removed", "cut.spans", kept_as(F.col("cut.kept")).alias("rest")))
    work.drop()
    judged = texts.drop("anchors").join(cut, "tid", "left")
    copies = attach(rows.drop("text"), judged, "digest", "copies", docs.count())
    again = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= window)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return copies.select(
        "doc_id", "n_words",
        F.when(again, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(again, everything).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans"),
        F.when(again, kept_as(F.lit(""))).otherwise(F.coalesce("rest", "kept")).alias("kept"),
    )
