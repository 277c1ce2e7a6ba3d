"""A file for each group of rows, under the name the rows give, its bytes back to back.

A format for ``df.write``, made with Spark's data source interface: tasks write to a
staging folder, and when all of them are done the files are renamed, by tasks again.  A
file that is there already is replaced, so that writing a batch again changes nothing.
The driver learns one folder a task, and no names of files.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.session import settled

FORMAT = "named_files"
# The writer goes to the tasks with the query, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Files of a task's staging folder and of the folder of all tasks.
_NAMES, _DONE = "names", "done"
_NAME_ROWS = pa.schema([("name", pa.string())])
#: So many rows, or bytes of text, a task hands on at once.
_BATCH_ROWS, _BATCH_BYTES = 4096, 1 << 24


@dataclass
class _Staged(WriterCommitMessage):
    folder: str  # with files 0, 1, .. and, in that order, the names they are to get


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root.replace("file:/", "file:///") if "://" not in root else root)
    return fs.LocalFileSystem(), root


def _runs(names: pa.Array) -> Iterator[tuple[str, int, int]]:
    """Rows next to each other that have the same name."""
    found = pc.run_end_encode(names)
    start = 0
    for name, end in zip(found.values.to_pylist(), found.run_ends.to_pylist()):
        yield name, start, end
        start = end


def _bytes(values: pa.Array, separator: bytes) -> bytes:
    """The texts of a slice one after the other; a null is an empty one."""
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    if separator:
        values = pc.binary_join_element_wise(values, pa.scalar(separator, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if not len(values):
        return b""
    offsets = values.buffers()[1]
    ends = memoryview(offsets).cast("q")
    return bytes(memoryview(values.buffers()[2])[ends[values.offset] : ends[values.offset + len(values)]])


def _delete(root: str, folder: str) -> None:
    files, base = _open(root)
    place = f"{base}/{folder}"
    if files.get_file_info(place).type == fs.FileType.Directory:
        files.delete_dir(place)


class _Writer(DataSourceArrowWriter):
    """Rows come sorted by name, a name within one task."""

    def __init__(self, root: str, separator: str, staging: str) -> None:
        self._root, self._separator, self._staging = root, separator.encode(), staging

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Staged:
        files, base = _open(self._root)
        task = uuid.uuid4().hex
        folder = f"{base}/{self._staging}/{task}"
        files.create_dir(folder, recursive=True)
        n, at, out = 0, None, None
        with files.open_output_stream(f"{folder}/{_NAMES}") as listed, pa.ipc.new_stream(listed, _NAME_ROWS) as names_out:
            for batch in batches:
                names, values = batch["file"], batch["value"]
                begun = []
                for name, start, end in _runs(names):
                    if name != at:
                        if out is not None:
                            out.close()
                        at = name
                        begun.append(name)
                        out = files.open_output_stream(f"{folder}/{n}")
                        n += 1
                    out.write(_bytes(values.slice(start, end - start), self._separator))
                names_out.write_batch(pa.RecordBatch.from_arrays([pa.array(begun, pa.string())], schema=_NAME_ROWS))
        if out is not None:
            out.close()
        return _Staged(task)

    def commit(self, messages: list[_Staged | None]) -> None:
        files, base = _open(self._root)
        files.create_dir(f"{base}/{self._staging}", recursive=True)
        with files.open_output_stream(f"{base}/{self._staging}/{_DONE}") as done:
            done.write("\n".join(m.folder for m in messages if m is not None).encode())

    def abort(self, messages: list[_Staged | None]) -> None:
        _delete(self._root, self._staging)


def _move(root: str, staging: str, tasks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of staging folders to their names; again, if some are there already."""
    files, base = _open(root)
    made = set()
    for task in (t for batch in tasks for t in batch["task"].to_pylist()):
        staged = f"{base}/{staging}/{task}"
        n = 0
        with files.open_input_stream(f"{staged}/{_NAMES}", compression=None) as listed, pa.ipc.open_stream(listed) as names_in:
            for name in (name for batch in names_in for name in batch["name"].to_pylist()):
                place = f"{base}/{name.lstrip('/')}"
                folder = place.rpartition("/")[0]
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                try:
                    files.move(f"{staged}/{n}", place)
                except FileNotFoundError:  # another attempt of the task has moved it
                    if files.get_file_info(place).type != fs.FileType.File:
                        raise
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["moved"])


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("separator", ""), self.options["staging"])


def write_named_files(rows: DataFrame, path: str, file: str, value: str, order: Sequence[str | Column] = (),
                      separator: str = "") -> None:
    """The texts in ``value`` to the file below ``path`` that ``file`` says, in ``order``,
    ``separator`` after each.

    A file is the unit of the shuffle and is written as its rows arrive, so it may be
    larger than memory.  A null text is empty.  Files of one name from an earlier write
    are replaced, others stay.
    """
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    root, staging = path.rstrip("/"), f"_staged-{uuid.uuid4().hex}"
    named = rows.select(F.col(file).alias("file"), F.col(value).alias("value"), F.struct(*order, F.lit(0)).alias("order"))
    sorted_ = named.repartition("file").sortWithinPartitions("file", "order").select("file", "value")
    options = {"path": root, "separator": separator, "staging": staging}
    sorted_.write.format(FORMAT).options(**options).mode("append").save()
    try:
        files, base = _open(root)
        with files.open_input_stream(f"{base}/{staging}/{_DONE}") as done:
            tasks = done.read().decode().split()
        if tasks:
            spread = spark.createDataFrame([(t,) for t in tasks], "task string").repartition(len(tasks))
            spread.mapInArrow(partial(_move, root, staging), "moved long").write.format("noop").mode("overwrite").save()
    finally:
        _delete(root, staging)


def _hidden(path: str) -> bool:
    """Whether Spark's readers pass over a file or folder."""
    name = path.rpartition("/")[2]
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _listed(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is in each folder, by its path below ``root``, but for empty files."""
    files, base = _open(root)
    for folder in (f for batch in batches for f in batch["path"].to_pylist()):
        met = files.get_file_info(fs.FileSelector(f"{base}/{folder}"))
        met = [i for i in met if not _hidden(i.path) and (i.type == fs.FileType.Directory or i.size)]
        for at in range(0, len(met), _BATCH_ROWS):
            some = met[at : at + _BATCH_ROWS]
            paths = [f"{folder}/{i.path.rpartition('/')[2]}".lstrip("/") for i in some]
            folders = [i.type == fs.FileType.Directory for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(folders, pa.bool_())], ["path", "is_folder"])


def _contents(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(names: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["file", "content"])

    files, base = _open(root)
    names, texts, size = [], [], 0
    for path in (p for batch in batches for p in batch["path"].to_pylist()):
        with files.open_input_stream(f"{base}/{path}", compression=None) as read:
            texts.append(read.read())
        names.append(path)
        size += len(texts[-1])
        if len(names) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield batch_of(names, texts)
            names, texts, size = [], [], 0
    if names:
        yield batch_of(names, texts)


def read_named_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, the name below ``path``, and ``body``, the text, of every file there that
    is not empty; Spark's readers pass over empty ones too.

    Folders are listed by tasks, a level at a time, and the lists are tables; the driver
    learns only whether there is another level.
    """
    root = path.rstrip("/")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folders, levels = spark.createDataFrame([("",)], "path string"), []
    while levels == [] or not folders.isEmpty():
        some = folders.repartition(parts if levels else 1)
        met = settled(some.mapInArrow(partial(_listed, root), "path string, is_folder boolean"))
        levels.append(met.where("not is_folder").select("path"))
        folders = met.where("is_folder").select("path")
    found = reduce(DataFrame.unionByName, levels).repartition(parts)
    return found.mapInArrow(partial(_contents, root), "file string, content binary").select(
        "file", F.col("content").cast("string").alias("body")
    )
