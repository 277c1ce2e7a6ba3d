"""A log of messages as a streaming source: partitions, offsets, and a limit a micro-batch.

The log is a folder with a folder for each partition, which holds files of JSON lines named
by the offset of their first line, such as ``orders/0/00000000000000000120.jsonl``.  Files
are put there whole and stay as they are.  A line is an object with ``data``, the payload,
and ``attributes``, a map of texts; a message's place in its partition is its offset.

The source is made with Spark's data source interface: the driver lists file names, tasks
read lines.  Spark keeps the offsets of every micro-batch, so a stream that starts again
goes on where it was.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.sources.messages import messages

FORMAT = "message_log"
SUFFIX = ".jsonl"
SCHEMA = "partition string, offset bigint, data string, attributes map<string,string>"
_ARROW = pa.schema([("partition", pa.string()), ("offset", pa.int64()), ("data", pa.string()),
                    ("attributes", pa.map_(pa.string(), pa.string()))])
#: Lines given to Spark at a time, and offsets of one partition that one task reads.
_BATCH, TASK_MESSAGES = 4_096, 100_000
# The reader goes to the tasks with the query, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _first(file: str) -> int:
    return int(file.rpartition("/")[2].removesuffix(SUFFIX))


def _files(files: fs.FileSystem, folder: str) -> list[str]:
    """The files of a partition by their first offset."""
    found = [i.path for i in files.get_file_info(fs.FileSelector(folder)) if i.path.endswith(SUFFIX)]
    return sorted((f for f in found if not f.rpartition("/")[2].startswith((".", "_"))), key=_first)


def _lines(files: fs.FileSystem, file: str) -> Iterator[bytes]:
    with files.open_input_stream(file) as stream:
        rest = b""
        while block := stream.read(1 << 20):
            *whole, rest = (rest + block).split(b"\n")
            yield from whole
        if rest:
            yield rest


@dataclass
class _Slice(InputPartition):
    partition: str
    start: int
    end: int
    files: list[str]

    def __post_init__(self) -> None:
        self.value = None


class _Reader(DataSourceStreamReader):
    """Offsets are, of each partition, the number of the next message."""

    def __init__(self, path: str, limit: int | None, position: str | None) -> None:
        self._path, self._limit, self._position = path, limit, position
        self._given: dict[str, int] = {}
        self._ends: dict[str, tuple[str, int]] = {}  # of each partition its last file and where that ends

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        """No more than ``limit`` messages after those that were given before."""
        there = self._there()
        if self._limit is None:
            return there
        if not self._given:
            self._given = self._kept()
        left, out = self._limit, {}
        waiting = sorted((end - self._given.get(name, 0), name) for name, end in there.items())
        for n, (more, name) in enumerate(waiting):
            # What a partition does not use goes to those after it, which have more.
            taken = min(more, left // (len(waiting) - n))
            out[name] = self._given.get(name, 0) + taken
            left -= taken
        self._given = out
        return out

    def partitions(self, start: dict, end: dict) -> list[_Slice]:
        files, base = _open(self._path)
        slices = []
        for name, last in sorted(end.items()):
            begin, known = start.get(name, 0), None
            for at in range(begin, last, TASK_MESSAGES):
                known = known or _files(files, f"{base}/{name}")
                upto = min(at + TASK_MESSAGES, last)
                own = [f for f, g in zip(known, [*known[1:], None]) if _first(f) < upto and (g is None or _first(g) > at)]
                slices.append(_Slice(name, at, upto, own))
        if self._limit is not None:
            self._given = {n: max(e, self._given.get(n, 0)) for n, e in end.items()}
        return slices or [_Slice("", 0, 0, [])]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self._path)
        rows: list[tuple] = []
        for file in partition.files:
            for offset, line in enumerate(_lines(files, file), _first(file)):
                if partition.start <= offset < partition.end:
                    message = json.loads(line)
                    rows.append((partition.partition, offset, message.get("data"), list((message.get("attributes") or {}).items())))
                    if len(rows) == _BATCH:
                        yield _arrow(rows)
                        rows = []
                elif offset >= partition.end:
                    break
        if rows:
            yield _arrow(rows)

    def commit(self, end: dict) -> None:
        if self._position is not None:
            files, place = _open(self._position)
            with files.open_output_stream(f"{place}.new") as out:
                out.write(json.dumps(end).encode())
            files.move(f"{place}.new", place)

    def _kept(self) -> dict[str, int]:
        """Up to where an earlier run had come, or to less than one micro-batch before that."""
        files, place = _open(self._position)
        if files.get_file_info(place).type == fs.FileType.NotFound:
            return {}
        with files.open_input_stream(place) as kept:
            return json.loads(kept.read())

    def _there(self) -> dict[str, int]:
        files, base = _open(self._path)
        ends = {}
        for info in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            name = info.base_name
            if info.type != fs.FileType.Directory or name.startswith((".", "_")):
                continue
            found = _files(files, info.path)
            if not found:
                continue
            if self._ends.get(name, ("", 0))[0] != found[-1]:
                self._ends[name] = (found[-1], _first(found[-1]) + sum(1 for _ in _lines(files, found[-1])))
            ends[name] = self._ends[name][1]
        return ends


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Reader:  # noqa: N802
        limit = self.options.get("limit")
        return _Reader(self.options["path"].rstrip("/"), int(limit) if limit else None, self.options.get("position"))


def log_stream(spark: SparkSession, path: str, limit: int | None = None, position: str | None = None) -> DataFrame:
    """The messages of a log: ``partition, offset, data, attributes``.

    ``limit`` is how many messages a micro-batch takes at most.  It needs ``position``, a
    file of this stream in the shared folder, which tells a stream that starts again up to
    where it has read; it may be one micro-batch behind Spark's own offsets, which decide.
    """
    if limit is not None and not position:
        raise ValueError("a limit asks for a position, a file that keeps the offsets read")
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(FORMAT).option("path", path)
    if limit is not None:
        reader = reader.option("limit", limit).option("position", position)
    return reader.load()


def attribute(name: str) -> Column:
    return F.col("attributes")[name]


def log_messages(spark: SparkSession, path: str, label: str, limit: int | None = None, position: str | None = None,
                 keep: tuple[str, ...] = (), on_bad_label: str = "raise") -> DataFrame:
    """``(payload, event_ts)`` and the columns of ``keep``; the event time is read from the
    attribute ``label``, as of ``sources.messages.messages``."""
    read = log_stream(spark, path, limit, position).withColumn("label", attribute(label))
    return messages(read, "data", "label", keep, on_bad_label)


def append_log(rows: DataFrame, path: str, partition: str, at: dict[str, int] | None = None) -> dict[str, int]:
    """Puts messages (``data``, ``attributes``) at the end of a log, and says where that then is.

    ``at`` is where it was.  A partition's messages are one new file, in no particular order;
    a reader sees it when it is whole.
    """
    from millrace.sinks.pane_format import write_named_files

    at = dict(at or {})
    line = F.to_json(F.struct("data", "attributes"), {"ignoreNullFields": "false"})
    counts = rows.groupBy(F.col(partition).cast("string").alias("name")).count().collect()
    starts = F.coalesce(*[F.when(F.col("name") == n, F.lit(o)) for n, o in at.items()], F.lit(0))
    named = rows.select(F.col(partition).cast("string").alias("name"), line.alias("value")).withColumn(
        "file", F.concat(F.col("name"), F.lit("/"), F.lpad(starts.cast("string"), 20, "0"), F.lit(SUFFIX)))
    write_named_files(named, path, "file", "value", separator="\n")
    for name, n in counts:
        at[name] = at.get(name, 0) + n
    return at
