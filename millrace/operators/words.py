"""Words, their mean length, and the words on either side of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.words import word_colon_length, word_with_length, words_in

ABOVE = "above"
BELOW = "below"
ALL = "all"


def tokenize(lines: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of ``text``; ``keep`` names columns to carry along."""
    return lines.select(*keep, F.explode(words_in(F.col(text))).alias("word"))


def with_length(words: DataFrame) -> DataFrame:
    return words.withColumn("len", F.length("word"))


def mean_length(words: DataFrame) -> DataFrame:
    """One row, ``avg_len``: NULL when there are no words."""
    return words.agg(F.avg(F.length("word")).alias("avg_len"))


def _mean_of(words: DataFrame, mean: DataFrame | None) -> Column:
    # A scalar subquery: one value by construction, so no join and nothing to
    # size before a broadcast; Spark raises if `mean` should hold a second row.
    return (mean_length(words) if mean is None else mean).scalar()


def with_mean(words: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """Every word next to the one global mean."""
    return words.withColumn("avg_len", _mean_of(words, mean))


def at_least_mean(words: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """Words as long as the mean or longer."""
    return words.where(F.length("word") >= _mean_of(words, mean))


def below_mean(words: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """Words shorter than the mean."""
    return words.where(F.length("word") < _mean_of(words, mean))


def with_band(words: DataFrame, mean: DataFrame | None = None) -> DataFrame:
    """Both sides of the mean in one pass, told apart by ``band``."""
    longer = F.length("word") >= _mean_of(words, mean)
    return words.withColumn("band", F.when(longer, ABOVE).otherwise(BELOW))


def word_outputs(words: DataFrame) -> dict[str, DataFrame]:
    """The three named outputs: bare words, and the words of either side with
    their length attached."""
    mean = mean_length(words)
    labelled = word_with_length(F.col("word")).alias("value")
    return {
        ALL: words.select(F.col("word").alias("value")),
        ABOVE: at_least_mean(words, mean).select(labelled),
        BELOW: below_mean(words, mean).select(labelled),
    }


def word_outputs_tagged(words: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The same three outputs as ``(output, value)`` rows.

    Written with ``partitionBy("output")`` they cost one pass over the text for
    the mean and one for everything else; three separate writes cost six.
    """
    word = F.col("word")
    rows = F.array(
        F.struct(F.lit(ALL).alias("output"), word.alias("value")),
        F.struct(F.col("band").alias("output"), word_with_length(word).alias("value")),
    )
    return with_band(words).select(*keep, F.inline(rows))


def upper_words(words: DataFrame) -> DataFrame:
    return words.withColumn("word", F.upper("word"))


def words_with_length_text(words: DataFrame) -> DataFrame:
    return words.withColumn("word", word_colon_length(F.col("word")))


def word_chain(lines: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Split, attach the length, upper-case."""
    return tokenize(lines, text, keep).transform(words_with_length_text).transform(upper_words)
