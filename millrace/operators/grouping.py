"""Records grouped by key, and two inputs co-grouped by key.

A key may hold a third of all rows, so no group is ever one array without a
bound: every key comes as ``n_parts`` rows, numbered by ``part`` from 0, of
``max_group_rows`` records each but for the last, fewer where records are large.
The bytes of each key are added up first.  Keys that fit a task are grouped in one
step; larger ones are cut into as many slices as their size asks for.  Text is made
without arrays, one line a row, by ``cogroup_lines``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_GROUP_ROWS = 200_000
#: A key of more bytes is cut into slices of so many, and a part holds so many at most,
#: as its key's records are on average.
SLICE_BYTES = 64 << 20
#: So many keys are cut at most, since their list goes to all tasks: a key is not cut
#: unless it has more than one in so many of all bytes.
MOST_SLICED = 100_000
# What a field takes besides its characters, about.
_FIELD_BYTES = 16

_KEY = "_key"
_SIDE = "_side"
_RECORD = "_record"
_N, _SLICE, _UPTO, _TOTAL, _BYTES = "_n", "_slice", "_upto", "_total", "_bytes"


def key_by(df: DataFrame, field: str | Column, key: str = "key") -> DataFrame:
    """The key may be a field, any expression, or a constant (``F.lit``)."""
    return df.withColumn(key, F.col(field) if isinstance(field, str) else field)


def values_only(df: DataFrame, key: str = "key") -> DataFrame:
    return df.drop(key)


def _with_bytes(tagged: DataFrame) -> DataFrame:
    """With the key in a struct, as a NULL in one equals another, and about how large each record is."""
    record = tagged.schema[_RECORD].dataType
    sizes = [
        F.coalesce(F.octet_length(F.col(_RECORD)[f.name]), F.lit(0)) + _FIELD_BYTES
        if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(_FIELD_BYTES)
        for f in record.fields
    ]
    return tagged.select(F.struct("key").alias(_KEY), _SIDE, _RECORD, sum(sizes, F.lit(0)).cast("long").alias(_BYTES))


def _parts(tagged: DataFrame, limit: int, slice_bytes: int) -> DataFrame:
    """``(key, part, n_parts, _records)``, the records with their ``side``, left ones first.

    The list of the keys to be cut has ``MOST_SLICED`` rows at most, whatever the data.
    """
    rows = _with_bytes(tagged)
    sizes = rows.groupBy(_KEY).agg(F.sum(_BYTES).alias(_BYTES), F.count(F.lit(1)).alias(_TOTAL))
    everything = sizes.agg(F.sum(_BYTES)).scalar()
    fits = F.greatest(F.lit(slice_bytes), F.ceil(everything / MOST_SLICED))
    cut = sizes.where(F.col(_BYTES) > fits).select(
        _KEY, _TOTAL, F.ceil(F.col(_BYTES) / fits).alias("_slices"),
        F.greatest(F.lit(1), F.least(F.lit(limit), F.floor(slice_bytes * F.col(_TOTAL) / F.col(_BYTES)))).alias("_limit"),
    )
    small = rows.join(F.broadcast(cut), _KEY, "left_anti")
    large = rows.join(F.broadcast(cut), _KEY)
    return _whole(small, limit).unionByName(_sliced(large)).select(
        F.col(_KEY)["key"].alias("key"), "part", "n_parts", "_records"
    )


def _whole(rows: DataFrame, limit: int) -> DataFrame:
    """Keys that fit a task: one step, and their records in order, so that a rerun cuts them alike."""
    record = F.struct(F.col(_SIDE).alias("side"), F.col(_RECORD).alias("record"), F.lit(1).alias("n"))
    groups = rows.groupBy(_KEY).agg(F.sort_array(F.collect_list(record)).alias("_all"))
    n_parts = F.ceil(F.size("_all") / limit).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n_parts - 1), lambda i: F.slice("_all", i * limit + 1, F.lit(limit)))
    return groups.select(_KEY, n_parts.alias("n_parts"), F.posexplode(parts).alias("part", "_records"))


def _sliced(rows: DataFrame) -> DataFrame:
    """Keys that do not fit.  Records that are alike are counted before they move, so copies do
    not crowd a task.  A record's place in its key follows from sums, first within a slice of
    the key, which a hash of the record tells, then over the slices; so it is the same whenever
    it is worked out again.
    """
    known = [F.first(c).alias(c) for c in ("_slices", "_limit", _TOTAL)]
    alike = rows.groupBy(_KEY, _SIDE, _RECORD).agg(F.count(F.lit(1)).alias(_N), *known)
    slice_ = F.col(_SIDE) * F.col("_slices") + F.pmod(F.xxhash64(_RECORD), F.col("_slices"))
    alike = alike.withColumn(_SLICE, slice_)
    sums = alike.groupBy(_KEY, _SLICE).agg(F.sum(_N).alias(_N))
    earlier = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(_KEY, _SLICE, F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(_KEY, _SLICE).orderBy(_RECORD).rowsBetween(Window.unboundedPreceding, 0)
    placed = alike.withColumn(_UPTO, F.sum(_N).over(within)).join(sums, [_KEY, _SLICE])
    placed = placed.withColumn(_UPTO, F.col(_UPTO) + F.col("_before"))
    limit = F.col("_limit")
    first, last = F.floor((F.col(_UPTO) - F.col(_N)) / limit), F.floor((F.col(_UPTO) - 1) / limit)
    cut = placed.withColumn("part", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    here = F.least(F.col(_UPTO), (F.col("part") + 1) * limit) - F.greatest(
        F.col(_UPTO) - F.col(_N), F.col("part") * limit
    )
    record = F.struct(F.col(_SIDE).alias("side"), F.col(_RECORD).alias("record"), here.cast("int").alias("n"))
    return cut.groupBy(_KEY, "part").agg(
        F.first(F.ceil(F.col(_TOTAL) / limit).cast("int")).alias("n_parts"), F.collect_list(record).alias("_records")
    )


def _repeated(records: Column) -> Column:
    return F.flatten(F.transform(records, lambda r: F.array_repeat(r["record"], r["n"])))


def group_by_key(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(key, part, n_parts, records)``: all records per key, in order where a key fits a task.

    ``values`` names the fields wanted later, of types that can be compared;
    nothing else is shuffled.
    """
    tagged = df.select(F.col(key).alias("key"), F.lit(1).alias(_SIDE), F.struct(*values).alias(_RECORD))
    return _parts(tagged, max_group_rows, slice_bytes).select(
        "key", "part", "n_parts", _repeated(F.col("_records")).alias("records")
    )


def _tagged(left: DataFrame, right: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    sides = [
        df.select(F.col(key).alias("key"), F.lit(n).alias(_SIDE), F.struct(*values).alias(_RECORD))
        for n, df in ((1, left), (2, right))
    ]
    return sides[0].unionByName(sides[1])


def cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    values: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(key, part, n_parts, p1, p2)``: every key of either side with its records
    from both; a side that lacks the key has an empty array.

    One union is grouped, where grouping both sides and a full outer join would
    move the rows three times.  All records of the left come before those of the
    right, also over several parts.
    """
    groups = _parts(_tagged(left, right, key, values), max_group_rows, slice_bytes)
    sides = [
        _repeated(F.filter("_records", _of_side(n))).alias(name)
        for n, name in ((1, "p1"), (2, "p2"))
    ]
    return groups.select("key", "part", "n_parts", *sides)


def _of_side(n: int):
    return lambda record: record["side"] == n


def _java_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _line(value: Column) -> Column:
    return F.concat(F.lit("\t"), _java_text(value))


def format_cogroup(groups: DataFrame, value: str, ordered: bool = False) -> DataFrame:
    """``(key, part, n_parts, block)``: the key, then a line with a tab and ``value`` for
    every left record and every right record; parts after the first have lines only.

    The order within a side is undefined unless ``ordered``, which sorts each side
    of a part; ``cogroup_lines`` sorts keys of any size.
    """
    sides = [F.col(side)[value] for side in ("p1", "p2")]
    if ordered:
        sides = [F.sort_array(side) for side in sides]
    lines = F.transform(F.concat(*sides), _line)
    heading = F.when(F.col("part") == 0, F.array(_java_text(F.col("key")))).otherwise(F.array().cast("array<string>"))
    return groups.select("key", "part", "n_parts", F.array_join(F.concat(heading, lines), "\n").alias("block"))


def cogroup_lines(left: DataFrame, right: DataFrame, key: str, value: str, ordered: bool = False) -> DataFrame:
    """``(key, side, line)``, in the order of the text: for each key a line with the
    key (side 0), those of the left (1) and those of the right (2).

    One shuffle by ranges of key, side and place in the input, whatever the size of
    a key: a hot key covers several partitions, and written out it reads as one
    block over consecutive files.
    """
    rows = _tagged(left, right, key, [value]).select(
        "key", F.col(_SIDE).alias("side"), F.col(_RECORD)[value].alias("value"),
        F.monotonically_increasing_id().alias("_scan"),
    )
    headings = rows.select("key").distinct().select(
        "key", F.lit(0).alias("side"), F.lit(None).cast(rows.schema["value"].dataType).alias("value"),
        F.lit(-1).cast("long").alias("_scan"),
    )
    order = ["key", "side", "value", "_scan"] if ordered else ["key", "side", "_scan"]
    laid = headings.unionByName(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    line = F.when(F.col("side") == 0, _java_text(F.col("key"))).otherwise(_line(F.col("value")))
    return laid.select("key", "side", line.alias("line"))
