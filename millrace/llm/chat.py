"""Conversations as one string each, with a loss mask, made and read by Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings.  All begin with "<", which no escaped text contains.
TURN, TEXT, MORE, END = "<turn>", "<text>", "<more>", "</turn>\n"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    r"""``\`` becomes ``\e`` and ``<`` becomes ``\l``: no control string is left."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\e"))
    return F.replace(text, F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\e"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_blocks, formatted, segments`` from rows ``conv_id, turn, role, text``.

    Turns are sorted by turn, role and text.  Adjacent turns of one role become
    one block, ``<turn>role<text>first<more>second</turn>``, and a line feed.
    ``segments`` (``part, loss``) are the pieces of ``formatted`` in order;
    those under the loss mask are the assistant's texts and nothing else.  A null
    text or role is empty; a row without an id is a conversation of its own; repeated
    rows are repeated turns, and ties in turn, role and text are such; other columns are
    not read.  An empty table gives no rows.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    known = F.col("conv_id").isNotNull()
    sorted_turns = turns.where(known).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    sorted_turns = sorted_turns.unionByName(turns.where(~known).select("conv_id", F.array(turn).alias("turns")))
    # Each turn with the roles around it, by shifted copies of the array rather than by index.
    roles = F.col("turns.role")
    nobody = F.array(F.lit(None).cast("string"))
    around = sorted_turns.select(
        "conv_id",
        F.arrays_zip(
            roles.alias("role"), F.col("turns.text").alias("text"),
            F.slice(F.concat(nobody, roles), 1, F.size("turns")).alias("before"),
            F.concat(F.slice(roles, 2, F.size("turns")), nobody).alias("after"),
        ).alias("turns"),
    )

    def pieces(t: Column) -> Column:
        opens, closes = ~t["before"].eqNullSafe(t["role"]), ~t["after"].eqNullSafe(t["role"])
        head = F.when(opens, F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT))).otherwise(F.lit(MORE))
        tail = F.when(closes, F.lit(END)).otherwise(F.lit(""))
        learned = t["role"] == LEARNED_ROLE
        return F.array(
            F.struct(head.alias("part"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"]).alias("part"), learned.alias("loss")),
            F.struct(tail.alias("part"), F.lit(False).alias("loss")),
        )

    made = around.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return made.select(
        "conv_id", F.array_join("segments.part", "").alias("formatted"), "segments",
    )


def read_turns(formatted: Column) -> Column:
    """The turns, ``role, text``, of a formatted conversation, merged ones apart again."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    def turns(block: Column) -> Column:
        role = unescaped(F.substring_index(F.substring(block, len(TURN) + 1, 2**30), TEXT, 1))
        texts = F.split(F.substring_index(block, TEXT, -1), MORE, -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, in order, as it was before escaping."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["part"])), "")
