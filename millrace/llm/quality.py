"""Quality rules: base counts, and how far a text's histograms lie from those of the languages.

Everything is array and aggregate functions; a text's work stays in its row.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import exact_dedup
from millrace.llm.shared import settled, text_or_empty, unpacked

# The classes of characters, each as a pattern of Java.
CHAR_CLASSES = {
    "lower": "[a-z]+",
    "upper": "[A-Z]+",
    "space": r"[\x20\x09-\x0D]+",
    "digit": "[0-9]+",
    "stop": "[.,;:!?'\"()-]+",
    "other_ascii": r"[\x00-\x08\x0E-\x1F#$%&*+/<=>@\[\\\]^_`{|}~\x7F]+",
}
SYMBOLS = "[#*$%&|<>]"
#: Texts of fewer words fail.
BASE_WORDS = 50

#: Below so many words, or characters, a histogram says nothing and the distance is not used.
MIN_WORDS, MIN_CHARS = 100, 200
#: Jensen-Shannon distance (0 to 1) from the nearest reference above which a text is rejected:
#: of words as a share of the distance that a text without any listed word has, of characters as it is.
MAX_WORD_SHARE, MAX_CHAR_DISTANCE = 0.85, 0.28
#: A language has a reference from so many distinct texts on.
REFERENCE_TEXTS = 30
#: Its listed words are so many at most, the most frequent ones, each with such a mean share at least.
LISTED_WORDS, LISTED_SHARE = 25, 0.002
#: Where a text without any listed word is nearer than this, the words of a language say nothing.
LEAST_BARE = 0.2
#: Shares are summed in whole parts of this, so that a sum does not depend on its order.
PARTS = 1_000_000_000
#: Medians of shares are told to one in so many.
STEPS = 10_000


def _found(text: Column) -> Column:
    """The words of a text that is not null."""
    # Splitting at one character needs no pattern.
    return F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]+", " "), " ", -1), "")


def _taken(rows: DataFrame, keep: Sequence[str], **more: Column) -> DataFrame:
    """The columns ``keep`` of ``rows`` (with ``text`` and ``found``), ``more``, and in place of the
    text what the counts need of it: ``n_words``, ``n_chars``, ``hashed`` (the words), ``left`` (the
    words put together)."""
    return rows.select(
        *keep, F.size("found").cast("long").alias("n_words"), F.length("text").alias("n_chars"),
        F.transform("found", lambda w: F.xxhash64(w)).alias("hashed"), F.array_join("found", "").alias("left"),
        *[c.alias(name) for name, c in more.items()],
    )


def _window_hashes(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``_taken``) with, in place of ``hashed``, ``hashes`` of the three words from each
    on, and ``n_again``, how many of them are there already before."""
    # The last two are of fewer words, so they are like no other.
    hashes = F.transform("hashed", lambda h, i: F.xxhash64(h, F.get("hashed", i + 1), F.get("hashed", i + 2)))
    rows = rows.withColumn("hashes", hashes).drop("hashed")
    return rows.withColumn("n_again", (F.size("hashes") - F.size(F.array_distinct("hashes"))).cast("long"))


def _repeat_words(rows: DataFrame, where: Column) -> DataFrame:
    """``rows`` (of ``_window_hashes``) with, in place of the hashes, ``n_repeat_words``: how many words
    are in windows found twice or more, worked out ``where`` that is asked for, else 0.

    The hashes alone are sorted first.  Each that has its like next to it sets one of 64
    bits, and only windows whose bit is set are sorted again with their places.
    """
    one = F.lit(1).cast("long")

    def bit(h: Column) -> Column:
        return h.bitwiseAND(F.lit(63)).cast("int")

    def bits(hashes: Column) -> Column:
        again = F.filter(hashes, lambda h, i: F.get(hashes, i + 1) == h)
        return F.aggregate(again, F.lit(0).cast("long"), lambda all_, h: all_.bitwiseOR(
            F.call_function("shiftleft", one, bit(h))))

    def suspects(mask: Column) -> Column:
        placed = F.transform("hashes", lambda h, i: F.when(
            F.call_function("shiftrightunsigned", mask, bit(h)).bitwiseAND(one) == 1,
            F.struct(h.alias("hash"), i.alias("at"))))
        return F.sort_array(F.filter(placed, lambda w: w.isNotNull()))

    def like_a_neighbour(windows: Column) -> Column:
        return F.filter(
            F.transform(windows, lambda w, i: F.when(
                (F.get(windows, i + 1)["hash"] == w["hash"]) | (F.get(windows, i - 1)["hash"] == w["hash"]), w["at"])),
            lambda at: at.isNotNull(),
        )

    repeated = _let(_let(bits(F.col("in_order")), suspects), like_a_neighbour)
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda at: F.array(at, at + 1, at + 2))))
    count = F.when(F.col("in_order").isNotNull(), F.size(covered)).otherwise(0).cast("long")
    # A column, since inside a lambda the sort would not be compiled.
    rows = rows.withColumn("in_order", F.when(where, F.sort_array("hashes"))).withColumn("n_repeat_words", count)
    return rows.drop("hashes", "n_again", "in_order")


def base_counts(docs: DataFrame, text_col: str, carry: Sequence[str], listed: Sequence[str]) -> DataFrame:
    """The columns ``carry`` in ``row``, with ``common`` (the words that are ``listed``, in order),
    ``chars`` and the base counts.

    A window of three words is told by a 64-bit hash of the three.
    """
    row = F.struct(*[F.col(c) for c in dict.fromkeys(carry)]).alias("row")
    text = text_or_empty(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(row, text.alias("text"), _found(text).alias("found"), lines.alias("lines"))
    n_dup_lines = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    # The text and its words go no further than here, for each further step would copy them.
    rows = _taken(rows, ["row"], n_dup_lines=n_dup_lines, common=_common(listed))
    rows = _char_shares(_repeat_words(_window_hashes(rows), F.col("n_again") > 0))
    return rows.withColumn("base_failed", _base_failed())


def _base_failed() -> Column:
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _char_shares(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``_taken``) with, in place of ``left``, ``chars``: ``kind, bin, share`` of each
    class of characters; ``word_chars``, ``n_symbols``."""
    # What is not in words is space.  Class after class is taken out of the words put
    # together, so that each pattern meets few and long stretches of only what is left.
    left = F.length("left")
    rows = rows.withColumns({"word_chars": left.cast("long"), "n_space": F.col("n_chars") - left})
    for name, pattern in CHAR_CLASSES.items():
        if name == "space":
            continue
        if name == "other_ascii":
            # All symbols are in this class; none was taken out before.
            without = F.length(F.regexp_replace("left", SYMBOLS, ""))
            rows = rows.withColumn("n_symbols", (left - without).cast("long"))
        rows = rows.withColumn("less", F.regexp_replace("left", pattern, ""))
        rows = rows.withColumn(f"n_{name}", left - F.length("less")).drop("left").withColumnRenamed("less", "left")
    sizes = {name: F.col(f"n_{name}") for name in CHAR_CLASSES} | {"other": left}
    chars = F.array(*[
        F.struct(F.lit("char").alias("kind"), F.lit(name).alias("bin"), F.try_divide(size, F.col("n_chars")).alias("share"))
        for name, size in sizes.items()
    ])
    nothing = F.slice(chars, F.lit(1), F.lit(0))
    rows = rows.withColumn("chars", F.when(F.col("n_chars") > 0, chars).otherwise(nothing))
    return rows.drop("left", *[f"n_{name}" for name in CHAR_CLASSES])


def _common(listed: Sequence[str]) -> Column:
    """Those of the words ``found`` that are ``listed``, in lower case and in order."""
    longest = max(map(len, listed), default=0) + 1  # lower case may be a character longer, or shorter
    return F.sort_array(F.transform(
        F.filter("found", lambda w: (F.length(w) <= longest) & F.lower(w).isin(list(listed))), F.lower
    ))


def histograms(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``base_counts``) with ``bins``: for each kind (char, word) and bin its share of the kind.

    The word bins are the listed words, of all languages, and all others together.
    """
    size = F.size("common")
    starts = F.filter(
        F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.expr("array()").cast("array<int>")),
        lambda i: (i == 0) | (F.get("common", i) != F.get("common", i - 1)),
    )
    rest = rows.withColumn("starts", starts)
    of_listed = F.transform(
        "starts",
        lambda i, k: F.struct(
            F.lit("word").alias("kind"), F.get("common", i).alias("bin"),
            F.try_divide(F.coalesce(F.get("starts", k + 1), size) - i, F.col("n_words")).alias("share"),
        ),
    )
    others = F.struct(
        F.lit("word").alias("kind"), F.lit("").alias("bin"),
        F.try_divide(F.col("n_words") - size, F.col("n_words")).alias("share"),
    )
    bins = F.concat("chars", of_listed, F.filter(F.array(others), lambda b: b["share"] > 0))
    return rest.withColumn("bins", bins).drop("chars", "common", "starts")


@dataclass
class References:
    """``languages``; ``worded``, those of them whose listed words say something;
    ``listed``, the words of all of them; ``shares``, of each kind and bin the share
    in each language."""

    languages: list[str]
    worded: list[str]
    listed: list[str]
    shares: dict[str, list[float]]


def _sums(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, kind, bin, step, parts`` over the distinct texts of each language whose base rules hold.

    Of a word the sum of its shares; of a class of characters how many texts have
    it in which share; of the kind text how many there are.
    """
    lang, text = F.col(lang_col).cast("string"), text_or_empty(text_col)
    # Fewer characters cannot hold the words.  The length tells language and text apart.
    pairs = docs.where(lang.isNotNull() & (F.length(text) >= 2 * BASE_WORDS - 1)).select(
        lang.alias("lang"), F.concat(F.length(lang).cast("string"), F.lit(":"), lang, text).alias("pair")
    )
    # Copies are alike in both columns, so any of them will do; only what may be one moves.
    digest = F.unhex(F.sha2("pair", 256)).alias("digest")
    marked = exact_dedup.repeats(pairs, "lang", "pair").suspected(pairs.select("lang", "pair", digest))
    distinct = marked.where(~F.col("maybe")).unionByName(marked.where("maybe").dropDuplicates(["digest"]))
    start = F.length("lang") + F.length(F.length("lang").cast("string")) + 2
    rows = distinct.select("lang", F.substr("pair", start).alias("text"))
    rows = _window_hashes(_taken(rows.withColumn("found", _found(F.col("text"))), ["lang", "found"]))
    # A window that is there again puts up to three words, and those of the first such one, into
    # the count; so only where there are many can a rule fail.
    rows = _repeat_words(rows, 100 * 6 * F.col("n_again") > 50 * F.col("n_words"))
    # The row number keeps the filter where it is: pushed down, it would work out
    # every column that it rests on again, once for each mention.
    numbered = rows.withColumns({"failed": _base_failed(), "at": F.monotonically_increasing_id()})
    rows = _char_shares(numbered.where(~F.col("failed") & (F.col("at") >= 0)).select("lang", "found", "n_words", "n_chars", "left"))

    # No word begins with a space: so do the names of what is counted and not a word.
    counted = F.transform("chars", lambda c: F.concat_ws(
        ":", F.lit(" char"), c["bin"], F.round(c["share"] * STEPS).cast("int").cast("string")))
    entries = F.concat("found", counted, F.array(F.lit(" text")))
    # There is always an entry; of a plain explode Spark would test that in a filter, for which it works them out.
    each = rows.select("lang", F.expr(f"{PARTS}L div n_words").alias("part"), F.explode_outer(entries).alias("name"))
    other = F.col("name").startswith(" ")
    sums = each.groupBy("lang", F.lower("name").alias("name")).agg(
        F.sum(F.when(other, F.lit(1).cast("long")).otherwise(F.col("part"))).alias("parts")
    )
    said = F.split("name", ":")
    return sums.select(
        "lang", F.when(~other, "word").when(F.col("name") == " text", "text").otherwise("char").alias("kind"),
        F.when(other, F.coalesce(F.get(said, F.lit(1)), F.lit(""))).otherwise(F.col("name")).alias("bin"),
        F.when(other, F.get(said, F.lit(2)).cast("int")).alias("step"), "parts",
    )


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """The usual histogram of each language that has ``REFERENCE_TEXTS`` distinct texts whose base rules hold.

    Copies count once.  Of a word the mean share; of a class of characters the
    median, which the many symbols of some texts do not move.  Listed are the most
    frequent words that begin with a letter.  What the driver gets grows with the
    number of languages only.
    """
    sums = _sums(docs, text_col, lang_col)
    sums = settled(sums.where((F.col("kind") != "word") | (F.col("parts") >= int(LISTED_SHARE * PARTS * REFERENCE_TEXTS))))
    texts = sums.where((F.col("kind") == "text") & (F.col("parts") >= REFERENCE_TEXTS))
    texts = settled(texts.select("lang", F.col("parts").alias("n")))
    counts = dict(texts.collect())
    languages = sorted(counts)
    known = sums.join(F.broadcast(texts), "lang")
    share = F.col("parts") / (F.col("n") * F.lit(float(PARTS)))
    worth = known.where((F.col("kind") == "word") & F.col("bin").rlike(r"^\p{L}")).withColumn("share", share)
    by_share = Window.partitionBy("lang").orderBy(F.desc("parts"), "bin")
    ranked = worth.where(F.col("share") >= LISTED_SHARE).withColumn("rank", F.row_number().over(by_share))
    listed = sorted({r["bin"] for r in ranked.where(F.col("rank") <= LISTED_WORDS).select("bin").collect()})
    of_words = {n: {} for n in languages}
    for r in worth.where(F.col("bin").isin(listed)).select("lang", "bin", "share").collect():
        of_words[r["lang"]][r["bin"]] = r["share"]
    # The first step at which half of the texts are counted.
    upto = F.sum("parts").over(Window.partitionBy("lang", "bin").orderBy("step"))
    half = known.where(F.col("kind") == "char").withColumn("upto", upto).where(2 * F.col("upto") >= F.col("n"))
    of_chars = {n: {} for n in languages}
    for r in half.groupBy("lang", "bin").agg(F.min("step").alias("step")).collect():
        of_chars[r["lang"]][r["bin"]] = r["step"]
    shares: dict[str, list[float]] = {}

    def put(key: str, n: int, value: float) -> None:
        shares.setdefault(key, [0.0] * len(languages))[n] = value

    worded = []
    for n, name in enumerate(languages):
        total = sum(of_chars[name].values()) or 1
        for c, step in of_chars[name].items():
            put(f"{c}:char", n, step / total)
        others = max(0.0, 1 - sum(of_words[name].values()))
        if _bare_value(others) >= LEAST_BARE:
            worded.append(name)
            for w, value in of_words[name].items():
                put(f"{w}:word", n, value)
            put(":word", n, others)
    return References(languages, worded, listed, shares)


def _bin(kind: Column, name: Column) -> Column:
    # The name first, since keys are compared one by one from their first letter.
    return F.concat(name, F.lit(":"), kind)


def _distance(met: Column, language: int) -> Column:
    """Jensen-Shannon distance, 0 to 1, of the bins ``met`` (``share, theirs``) from a language.

    A bin which only the reference has adds half its share.
    """
    def term(total: Column, b: Column) -> Column:
        p, q = b["share"], b["theirs"][language]
        both = p * F.log2(2 * p / (p + q)) + q * F.log2(2 * q / (p + q)) - q
        return total + F.when(q > 0, both).otherwise(p)

    return F.aggregate(met, F.lit(1.0), term, lambda total: F.sqrt(F.greatest(F.lit(0.0), total / 2)))


def _bare_value(q: float) -> float:
    """Distance of a text without any listed word from a language in which all others have the share ``q``."""
    met = math.log2(2 / (1 + q)) + (q * math.log2(2 * q / (1 + q)) if q else 0.0)
    return math.sqrt(max(0.0, (met + 1 - q) / 2))


def _bare(q: Column) -> Column:
    q_term = F.when(q > 0, q * F.log2(2 * q / (1 + q))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest(F.lit(0.0), (F.log2(2 / (1 + q)) + q_term + 1 - q) / 2))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, also where ``then`` has it in a lambda."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda total, x: total + x)


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
           carry: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``), the base counts, ``word_distance``,
    ``char_distance``, ``kept``.

    A first pass over the texts gathers the references, a second one takes counts
    and histograms.  A text whose language has a reference is measured against the
    nearest of all references, whatever it says its own language is, and of their
    mixture in the proportions of its listed words, for texts in more than one
    language.  It is kept if no base rule fails and no distance exceeds its limit;
    that of words counts from ``MIN_WORDS`` words, that of characters from
    ``MIN_CHARS`` characters on.  A null text has no words and fails.  Where a
    language has no reference, or is not given, distances are null and only the
    base rules decide; so is the distance of words where a language has no frequent
    words.  An empty table gives no rows.
    """
    found = references(docs, text_col, lang_col)
    rows = _measured(docs, text_col, [lang_col, *(docs.columns if carry is None else carry)], found)
    # Written, since a caller's filter would otherwise be pushed down, as in _sums.
    return settled(_verdicts(rows, found, F.col("row").getField(lang_col)))


def _measured(docs: DataFrame, text_col: str, carry: Sequence[str], found: References) -> DataFrame:
    return histograms(base_counts(docs, text_col, carry, found.listed))


def _verdicts(rows: DataFrame, found: References, lang: Column) -> DataFrame:
    lang = lang.cast("string")
    nothing = F.array(*[F.lit(0.0)] * len(found.languages)).cast("array<double>")
    rows = rows.withColumn("reference", F.from_json(F.lit(json.dumps(found.shares)), "map<string,array<double>>"))

    def theirs(key: Column) -> Column:
        return F.coalesce(F.element_at("reference", key), nothing)

    met = F.transform(
        F.filter("bins", lambda b: b["share"] > 0),
        lambda b: F.struct(b["kind"].alias("kind"), b["bin"].alias("bin"), b["share"].alias("share"),
                           theirs(_bin(b["kind"], b["bin"])).alias("theirs")),
    )
    rows = rows.withColumn("met", F.when(lang.isin(found.languages), met))
    # Each listed word counts for the languages in proportion to their shares of it.
    sums = F.aggregate(
        F.filter("met", lambda b: (b["kind"] == "word") & (b["bin"] != "")), nothing,
        lambda sums, b: _let(_total(b["theirs"]), lambda all_: F.zip_with(
            sums, b["theirs"], lambda w, q: w + F.coalesce(F.try_divide(b["share"] * q, all_), F.lit(0.0)))),
    )
    weights = _let(sums, lambda ws: _let(_total(ws), lambda all_: F.transform(
        ws, lambda w: F.coalesce(F.try_divide(w, all_), F.lit(0.0)))))

    def mixed(ws: Column) -> Column:
        def also(shares: Column) -> Column:
            return F.concat(shares, F.array(_dot(shares, ws)))

        return F.struct(
            F.transform("met", lambda b: F.struct(
                b["kind"].alias("kind"), b["share"].alias("share"), also(b["theirs"]).alias("theirs"))).alias("met"),
            F.transform(also(theirs(F.lit(":word"))), _bare).alias("bare"),
        )

    rows = rows.withColumn("mixed", F.when(F.col("met").isNotNull(), _let(weights, mixed)))
    each = F.sequence(F.lit(0), F.lit(len(found.languages)))

    def distances(kind: str) -> Column:
        own = F.filter("mixed.met", lambda b: b["kind"] == kind)
        return _let(own, lambda o: F.when(F.size(o) > 0, F.transform(each, lambda n: _distance(o, n))))

    rows = rows.withColumns({
        "of_words": F.when(lang.isin(found.worded), distances("word")), "of_chars": distances("char"),
        "bare": F.col("mixed.bare"),
    })
    rows = rows.withColumns({
        "word_distance": F.array_min("of_words"), "char_distance": F.array_min("of_chars"),
        "word_share": F.array_min(F.zip_with("of_words", "bare", F.try_divide)),
    })
    far_words = (F.col("n_words") >= MIN_WORDS) & (F.col("word_share") > MAX_WORD_SHARE)
    far_chars = (F.col("n_chars") >= MIN_CHARS) & (F.col("char_distance") > MAX_CHAR_DISTANCE)
    kept = ~F.col("base_failed") & ~F.coalesce(far_words, F.lit(False)) & ~F.coalesce(far_chars, F.lit(False))
    return rows.withColumn("kept", kept).drop(
        "bins", "met", "mixed", "reference", "n_chars", "of_words", "of_chars", "bare", "word_share"
    )


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that are not ``kept``, same columns."""
    found = references(docs, text_col, lang_col)
    rows = _measured(docs, text_col, docs.columns, found)
    verdicts = _verdicts(rows, found, F.col("row").getField(lang_col))
    # As in _sums.
    numbered = verdicts.withColumn("at", F.monotonically_increasing_id())
    return unpacked(numbered.where(F.col("kept") & (F.col("at") >= 0)), docs.columns)
