"""Windows of a stream cut into panes by triggers.

A window fires early panes while the watermark has not reached its end, one on-time
pane when it does, and late panes until the allowed lateness is over.  Each pane holds
what came in since the pane before it.

Every micro-batch is worked off by Spark jobs in ``foreachBatch``; no row passes through
Python.  Three tables a micro-batch hold what is kept, below the folder ``ledger``:

* ``rows``: the rows as they came, sorted by window within their partition, so that the
  rows of a window are numbered without a shuffle;
* ``places``: which numbers of its window's sequence each partition holds.  Numbers go on
  from partition to partition and from batch to batch by prefix sums of counts, so a window
  is one sequence however many tasks work on it;
* ``windows``: the counters of each open window and the panes that it fires in this batch,
  as ranges of numbers.

The last is written in one step, before any output; a batch that is run again finds it and
puts out the same panes.  Rows wait where they were written first, and are read once more
when they fire.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.windows import WindowSize, floor_div, window_for
from millrace.operators.panes import EARLY, LATE, ON_TIME
from millrace.sinks.commits import delete, exists, write_once

Sink = Callable[[DataFrame, int], None]

ADDED = ("window", "shard", "pane_index", "timing", "is_first", "is_last", "element")
LATE_ADDED = ("window", "shard", "watermark")

_KEY = ("start", "end", "shard")
#: Rows that wait are put together again if they lie in more micro-batches than this.
COMPACT = 32
_RANGE = "struct<from:bigint,to:bigint,index:bigint,per:bigint,timing:string>"
_WINDOWS = (
    "start bigint, end bigint, shard int, total bigint, fired bigint, panes bigint, first_ms bigint, past boolean,"
    f" held {_RANGE}, needed bigint, closed boolean, fires array<{_RANGE}>, seen bigint, dropped bigint"
)
_BEAT = "_beat"


@dataclass(frozen=True)
class Trigger:
    """Fires when ``count`` elements wait or, at the first micro-batch ``delay_ms`` of
    processing time after the first of them came, whatever that micro-batch holds;
    whichever comes first.  A delay of 0 fires at every micro-batch."""

    count: int | None = None
    delay_ms: int | None = None

    def __post_init__(self) -> None:
        if self.count is None and self.delay_ms is None:
            raise ValueError("a trigger needs a count or a delay")


def _now_ms() -> int:
    return int(time.time() * 1000)


@dataclass
class PaneRules:
    """How windows are cut.

    ``late=None``: nothing follows the on-time pane, and a row that comes after the end
    of its window is dropped, whether the window had rows before or not.  ``hold_last``:
    the newest pane of a window is held back until the next one fires or the window
    closes, so that exactly one pane is the last.  ``order``: rows of a micro-batch are
    numbered in this order; else as they lie in its partitions.
    """

    event_ts: str
    size: WindowSize
    allowed_lateness_ms: int
    early: Trigger | None = None
    late: Trigger | None = None
    shards: int | Column = 1
    order: Sequence[str] = ()
    hold_last: bool = False
    clock: Callable[[], int] = field(default=_now_ms)

    @property
    def kept_ms(self) -> int:
        """How long after its end a window takes rows."""
        return self.allowed_lateness_ms if self.late else 0


def _shard(columns: Sequence[str], shards: int | Column) -> Column:
    if isinstance(shards, Column):
        return shards.cast("int")
    if shards == 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int")


def _reached(watermark: int | None, end: Column) -> Column:
    return F.lit(False) if watermark is None else F.lit(watermark) >= end


def _range(start: Column, end: Column, index: Column, per: Column, timing: Column) -> Column:
    return F.struct(start.alias("from"), end.alias("to"), index.alias("index"), per.cast("long").alias("per"),
                    timing.alias("timing"))


@dataclass(frozen=True)
class _Status:
    """After a batch: the watermark, the rows dropped so far, the tables of rows that are needed."""

    seen: int | None
    dropped: int
    slices: list[str]


class PaneLedger:
    """Takes micro-batches, by number, and gives the panes each one fires to ``panes`` and
    the rows it drops to ``late``.  Both may be called again with the number of a batch."""

    def __init__(self, path: str, rules: PaneRules, panes: Sink, late: Sink | None = None) -> None:
        self._path, self._rules, self._panes, self._late = path.rstrip("/"), rules, panes, late
        self._known: dict[int, _Status] = {}

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        self._tidy(spark, number)
        met = self._status(spark, number - 1)
        before = self._windows(spark, number - 1).where("start IS NOT NULL AND NOT closed")
        rows = write_once(self._shaped(batch, met.seen), self._table("rows", number))
        places = write_once(self._placed(spark, rows, before, met, number), self._table("places", number))
        now = self._counted(places, met, number)
        arrived = places.where((F.col("slice") == str(number)) & ~F.col("late")).groupBy(*_KEY).agg(F.sum("n").alias("n"))
        after = self._advanced(before.join(arrived, list(_KEY), "full"), met.seen, now.seen)
        clock = spark.range(1).select(
            F.lit(now.seen).cast("long").alias("seen"), F.lit(now.dropped).cast("long").alias("dropped")
        )
        after = after.unionByName(clock, allowMissingColumns=True).select(*before.columns)
        windows = write_once(after, self._table("windows", number))
        self._known = {number - 1: met, number: now}
        self._panes(self._fired(windows, places, now.slices or [str(number)], rows), number)
        if self._late is not None:
            self._late(self._dropped(rows, met.seen), number)

    def _status(self, spark: SparkSession, number: int) -> _Status:
        """What is known after a batch, from its tables where this object did not work it off itself."""
        if number < 0:
            return _Status(None, 0, [])
        if number not in self._known:
            seen, dropped = self._windows(spark, number).where("start IS NULL").select("seen", "dropped").first()
            slices = spark.read.parquet(self._table("places", number)).agg(F.collect_set("slice")).first()[0]
            self._known[number] = _Status(seen, dropped, sorted(slices))
        return self._known[number]

    @staticmethod
    def _counted(places: DataFrame, met: _Status, number: int) -> _Status:
        new = F.col("slice") == str(number)
        seen, dropped, slices = places.agg(
            F.max(F.when(new, F.col("seen"))), F.sum(F.when(new & F.col("late"), F.col("n"))), F.collect_set("slice")
        ).first()
        seen = max((s for s in (met.seen, seen) if s is not None), default=None)
        return _Status(seen, met.dropped + (dropped or 0), sorted(slices))

    def _table(self, name: str, number: int | str) -> str:
        return f"{self._path}/{name}/{number}"

    def _windows(self, spark: SparkSession, number: int) -> DataFrame:
        if number < 0:
            return spark.createDataFrame([], _WINDOWS)
        return spark.read.schema(_WINDOWS).parquet(self._table("windows", number))

    # -- rows ---------------------------------------------------------------

    def _shaped(self, batch: DataFrame, watermark: int | None) -> DataFrame:
        """The rows in ``row``, next to their window and where they lie."""
        rules = self._rules
        if _BEAT in batch.columns:
            batch = batch.where(~F.col(_BEAT)).drop(_BEAT)
        window = window_for(F.col(rules.event_ts), rules.size)
        timed = batch.select(
            F.struct(*batch.columns).alias("row"), F.unix_millis(rules.event_ts).alias("event_ms"),
            F.unix_millis(window["start"]).alias("start"), F.unix_millis(window["end"]).alias("end"),
            _shard(batch.columns, rules.shards).alias("shard"),
        )
        late = F.col("event_ms").isNull() | _reached(watermark, F.col("end") + rules.kept_ms)
        order = ["late", "start", "shard", *[F.col("row").getField(c) for c in rules.order]]
        timed = timed.withColumn("late", late)
        if rules.order:
            timed = timed.repartitionByRange(*order)
        return timed.sortWithinPartitions(*order).withColumns(
            {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
        )

    def _placed(self, spark: SparkSession, rows: DataFrame, before: DataFrame, met: _Status, number: int) -> DataFrame:
        """``slice, late, start, end, shard, part, number, least, n, seen``: of each table of
        rows and each of its partitions what numbers of a window it has, from which ``at`` on."""
        found = rows.groupBy("late", *_KEY, "part").agg(
            F.min("at").alias("least"), F.count(F.lit(1)).alias("n"), F.max("event_ms").alias("seen")
        )
        past = Window.partitionBy("late", *_KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        first = F.coalesce("total", F.lit(0)) + F.coalesce(F.sum("n").over(past), F.lit(0))
        new = found.join(before.select(*_KEY, "total"), list(_KEY), "left").select(
            F.lit(str(number)).alias("slice"), "late", *_KEY, "part", first.alias("number"), "least", "n", "seen"
        )
        if not met.slices:
            return new
        old = spark.read.schema(new.schema).parquet(self._table("places", number - 1))
        waiting = old.join(before.select(*_KEY, "needed"), list(_KEY)).where(
            ~F.col("late") & (F.col("number") + F.col("n") > F.col("needed"))
        )
        if len(met.slices) > COMPACT:
            waiting = self._compacted(waiting, met.slices, number, rows)
        return new.unionByName(waiting.select(*new.columns))

    def _read(self, slices: Sequence[str], like: DataFrame) -> DataFrame:
        read = like.sparkSession.read.schema(like.schema)
        tables = [read.parquet(self._table("rows", s)).select(F.lit(s).alias("slice"), "*") for s in slices]
        return reduce(DataFrame.unionByName, tables).where(~F.col("late"))

    def _numbered(self, places: DataFrame, slices: Sequence[str], like: DataFrame) -> DataFrame:
        """The rows of ``places`` with their numbers.  A place is what one partition has of a
        window, so no key of this join is larger than a partition."""
        known = places.drop("late", "seen", "end")
        met = self._read(slices, like).join(known, ["slice", "start", "shard", "part"])
        return met.withColumn("number", F.col("number") + F.col("at") - F.col("least"))

    def _compacted(self, waiting: DataFrame, slices: Sequence[str], number: int, like: DataFrame) -> DataFrame:
        """The places of the rows that wait, after these were written to one table."""
        name = f"{number}-compact"
        order = ["start", "shard", "number"]
        rows = self._numbered(waiting, slices, like).where("number >= needed")
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
        )
        rows = write_once(rows.select(*like.columns, "number"), self._table("rows", name))
        return rows.groupBy("late", *_KEY, "part").agg(
            F.min("number").alias("number"), F.min("at").alias("least"), F.count(F.lit(1)).alias("n"),
            F.max("event_ms").alias("seen"),
        ).withColumn("slice", F.lit(name))

    def _tidy(self, spark: SparkSession, number: int) -> None:
        """Deletes what only the batch before the one before needed; neither runs again."""
        old = self._table("places", number - 2)
        if number < 2 or not exists(spark, old):
            return
        still = set(self._status(spark, number - 1).slices)
        for name in self._status(spark, number - 2).slices:
            if name not in still:
                delete(spark, self._table("rows", name))
        delete(spark, self._table("windows", number - 2))
        delete(spark, old)

    # -- windows ------------------------------------------------------------

    def _advanced(self, windows: DataFrame, met: int | None, seen: int | None) -> DataFrame:
        """The counters after the batch, and the ranges of numbers that fire.

        ``met`` is the watermark that the rows of the batch meet, ``seen`` the one after
        them; that moves windows on which had no rows.
        """
        rules, now = self._rules, F.lit(self._rules.clock()).cast("long")
        zero = F.lit(0).cast("long")
        new = windows.select(
            *_KEY, F.col("held").cast(_RANGE).alias("held"), "first_ms",
            F.coalesce("past", F.lit(False)).alias("past"),
            *[F.coalesce(c, zero).alias(c) for c in ("n", "total", "fired", "panes")],
        )
        end = F.col("end")
        ended = _reached(met, end)

        def by_timing(value: Callable[[Trigger], Column | None], default: Column) -> Column:
            of = [default if t is None or value(t) is None else value(t) for t in (rules.late, rules.early)]
            return F.when(ended, of[0]).otherwise(of[1])

        waiting = F.col("upto") - F.col("fired")
        new = new.withColumns({"upto": F.col("total") + F.col("n"), "past": F.col("past") | ended})
        new = new.withColumns({
            "full": by_timing(lambda t: t.count and floor_div(waiting, t.count), zero),
            "per": by_timing(lambda t: t.count and F.lit(t.count).cast("long"), zero),
            "timing": F.when(ended, LATE).otherwise(EARLY),
        })
        # Full panes take what waited before, so what is left came now.
        new = new.withColumns({
            "mid": F.col("fired") + F.col("full") * F.col("per"),
            "first_ms": F.when((F.col("full") > 0) | (F.col("total") == F.col("fired")), now).otherwise(F.col("first_ms")),
        })
        left = F.col("upto") - F.col("mid")
        aged = by_timing(lambda t: None if t.delay_ms is None else now - F.col("first_ms") >= t.delay_ms, F.lit(False))
        new = new.withColumn("due", (left > 0) & aged)
        new = new.withColumns({
            "rest": F.when(F.col("due"), zero).otherwise(left),
            "panes_mid": F.col("panes") + F.col("full"),
            "closed": _reached(seen, end + rules.kept_ms),
            "ends": _reached(seen, end) & ~F.col("past"),
        })
        last = (F.col("rest") > 0) & (F.col("ends") | F.col("closed"))
        panes_due = F.col("panes_mid") + F.col("due").cast("long")
        fires = F.array(
            F.when(F.col("full") > 0, _range(F.col("fired"), F.col("mid"), F.col("panes"), F.col("per"), F.col("timing"))),
            F.when(F.col("due"), _range(F.col("mid"), F.col("upto"), F.col("panes_mid"), left, F.col("timing"))),
            F.when(last, _range(F.col("upto") - F.col("rest"), F.col("upto"), panes_due, F.col("rest"),
                                F.when(F.col("ends"), ON_TIME).otherwise(LATE))),
        )
        new = new.withColumns({
            "fires": F.filter(fires, lambda g: g.isNotNull()),
            "fired": F.when(last, F.col("upto")).otherwise(F.col("upto") - F.col("rest")),
            "panes": panes_due + last.cast("long"),
            "past": F.col("past") | _reached(seen, end),
            "total": F.col("upto"),
        })
        if rules.hold_last:
            new = self._holding(new)
        needed = F.coalesce(F.col("held")["from"], F.col("fired"))
        return new.select(*_KEY, "total", "fired", "panes", "first_ms", "past", "held", needed.alias("needed"),
                          "closed", F.col("fires").cast(f"array<{_RANGE}>").alias("fires"))

    @staticmethod
    def _holding(windows: DataFrame) -> DataFrame:
        """The newest pane of open windows moved from ``fires`` to ``held``, what was held before the others."""
        newest = F.try_element_at("fires", F.lit(-1))
        whole = floor_div_by(newest["to"] - newest["from"], newest["per"])
        alone = _range(newest["to"] - newest["per"], newest["to"], newest["index"] + whole - 1, newest["per"], newest["timing"])
        without = _range(newest["from"], newest["to"] - newest["per"], newest["index"], newest["per"], newest["timing"])
        rest = F.concat(F.slice("fires", F.lit(1), F.size("fires") - 1), F.array(without))
        held = F.filter(F.array("held"), lambda g: g.isNotNull())
        some = F.size("fires") > 0
        return windows.withColumns({
            "fires": F.when(F.col("closed"), F.concat(held, "fires")).when(
                some, F.filter(F.concat(held, rest), lambda g: g["to"] > g["from"])
            ).otherwise(F.slice("fires", F.lit(1), F.lit(0))),
            "held": F.when(F.col("closed"), F.lit(None).cast(_RANGE)).when(some, alone.cast(_RANGE)).otherwise(F.col("held")),
        })

    # -- outputs ------------------------------------------------------------

    def _fired(self, windows: DataFrame, places: DataFrame, slices: Sequence[str], rows: DataFrame) -> DataFrame:
        columns = rows.schema["row"].dataType.names
        fires = windows.where(F.size("fires") > 0).select(*_KEY, "fires", "closed")
        reaching = F.exists("fires", lambda g: (F.col("number") < g["to"]) & (F.col("number") + F.col("n") > g["from"]))
        wanted = places.where(~F.col("late")).join(fires, list(_KEY)).where(reaching)
        numbered = self._numbered(wanted, slices, rows)
        at = F.col("number")
        pane = F.get(F.filter("fires", lambda g: (at >= g["from"]) & (at < g["to"])), F.lit(0))
        newest = F.try_element_at("fires", F.lit(-1))
        index = F.col("pane.index") + floor_div_by(at - F.col("pane.from"), F.col("pane.per"))
        of_newest = newest["index"] + floor_div_by(newest["to"] - newest["from"], newest["per"]) - 1
        cut = numbered.withColumn("pane", pane).where(F.col("pane").isNotNull()).withColumn("index", index)
        return cut.select(
            *[F.col("row").getField(c).alias(c) for c in columns], _bounds(), "shard",
            F.col("index").alias("pane_index"), F.col("pane.timing").alias("timing"),
            (F.col("index") == 0).alias("is_first"), (F.col("closed") & (F.col("index") == of_newest)).alias("is_last"),
            at.alias("element"),
        )

    def _dropped(self, rows: DataFrame, watermark: int | None) -> DataFrame:
        columns = rows.schema["row"].dataType.names
        met = F.timestamp_millis(F.lit(watermark).cast("long")).alias("watermark")
        return rows.where("late").select(
            *[F.col("row").getField(c).alias(c) for c in columns],
            F.when(F.col("start").isNotNull(), _bounds()).alias("window"), "shard", met,
        )


def floor_div_by(value: Column, by: Column) -> Column:
    """Whole-number division of a number that is not negative."""
    return ((value - value % by) / by).cast("bigint")


def _bounds() -> Column:
    return F.struct(F.timestamp_millis("start").alias("start"), F.timestamp_millis("end").alias("end")).alias("window")


def with_heartbeat(df: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """The stream ``df`` with a source of beats, so that micro-batches go on, and delays fire,
    while no message comes.  ``stream_panes`` takes the beats out again."""
    spark = df.sparkSession
    beats = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.withColumn(_BEAT, F.lit(False)).unionByName(beats.select(*nothing, F.lit(True).alias(_BEAT)))


def stream_panes(df: DataFrame, rules: PaneRules, ledger: str, checkpoint: str, panes: Sink,
                 late: Sink | None = None) -> DataStreamWriter:
    """Gives the panes of each micro-batch to ``panes``, and the rows that no pane takes to
    ``late``; call ``.trigger(..).start()`` on the result.

    The panes have the columns of ``df`` with ``window``, ``shard``, ``pane_index``,
    ``timing``, ``is_first``, ``is_last`` and ``element``, the row's number in the sequence
    of its window and shard.  The late rows have ``window`` (null where a row has no event
    time), ``shard`` and ``watermark``.  Every row is in one of the two, once.  Both sinks
    are called with the number of the micro-batch, and after a failure again with the same
    number and rows, so they should write by number (``sinks.commits.append_once``).

    A window and shard is one pane sequence, and any number of tasks works on it.  The
    watermark a row meets is the latest event time of the micro-batches before; on-time
    panes and the last ones fire at the end of the micro-batch that moves the watermark
    over them.  Empty panes are not fired.  Without ``hold_last``, ``is_last`` is true only
    of a pane that fires as its window closes.  ``ledger`` and ``checkpoint`` belong
    together: both new or both kept.
    """
    if isinstance(rules.shards, int) and rules.shards < 1:
        raise ValueError("shards must be 1 or more")
    clash = set(ADDED) & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"rename {sorted(clash)}: stream_panes adds columns of these names")
    return df.writeStream.foreachBatch(PaneLedger(ledger, rules, panes, late)).option("checkpointLocation", checkpoint)


def dropped_so_far(spark: SparkSession, ledger: str) -> int:
    """How many rows the micro-batches until now have dropped."""
    windows = spark.read.schema(_WINDOWS).parquet(f"{ledger.rstrip('/')}/windows/*")
    return windows.where("start IS NULL").agg(F.max("dropped")).first()[0] or 0
