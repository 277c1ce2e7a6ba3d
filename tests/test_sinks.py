import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.windows import minutes
from millrace.operators import panes
from millrace.session import scratch_path, settled, shared_root
from millrace.sinks import commits, files
from millrace.sinks.pane_format import read_named_files, write_named_files
from millrace.sources.layout import spread_small
from conftest import BASE_S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_append_creates_and_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        files.append_table(spark.createDataFrame([(str(n), "x", 0)], "id string, name string, more int"), path, SCHEMA)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_append_refuses_another_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    files.append_table(spark.createDataFrame([(1, "x")], "id long, name string"), path, SCHEMA)
    other = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    with pytest.raises(ValueError, match="has columns"):
        files.append_table(spark.createDataFrame([(1, "x")], "id long, name string"), path, other)
    assert spark.read.parquet(path).count() == 1


def test_window_tables_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(
        "id", F.lit("x").alias("name"), F.concat(F.lit("T_"), (F.col("id") % 3).cast("string")).alias("table_name")
    )
    for _ in range(2):
        files.append_window_tables(df, path, SCHEMA)
    one = spark.read.parquet(path).where("table_name = 'T_1'")
    assert one.count() == 66
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_name" in plan


def test_pane_files_keep_order_and_one_file_each(spark, tmp_path):
    df = spark.range(50).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("payload"),
        F.timestamp_seconds(BASE_S + 49 - F.col("id")).alias("ts"),
    )
    cut = panes.assign_panes(df, "ts", minutes(5), 20)
    path = tmp_path / "panes"
    files.write_pane_files(cut, str(path), "payload", ["ts"])
    folder = next(p for p in path.iterdir() if p.is_dir())
    parts = {p.name: list(p.glob("part-*")) for p in folder.iterdir()}
    assert [len(parts[f"pane_index={i}"]) for i in range(3)] == [1, 1, 1]
    assert parts["pane_index=0"][0].read_text().split() == [f"m{i}" for i in range(49, 29, -1)]


def test_pane_bodies_without_separator(spark, tmp_path):
    bodies = spark.createDataFrame(
        [("p/T1/0", 2, "xy"), ("p/T1/1", 1, "z"), ("p/T2/0", 1, "w")], "path string, n_elements long, body string"
    )
    files.write_pane_bodies(bodies, str(tmp_path / "b"))
    written = {str(p.parent.relative_to(tmp_path / "b")): p.read_text() for p in (tmp_path / "b").rglob("part-*")}
    assert written == {
        "prefix=p/window_max_ts=T1/pane_index=0": "xy\n", "prefix=p/window_max_ts=T1/pane_index=1": "z\n",
        "prefix=p/window_max_ts=T2/pane_index=0": "w\n",
    }


def test_pane_files_with_a_separator(spark, tmp_path):
    df = spark.range(6).select(F.col("id").cast("string").alias("payload"), F.timestamp_seconds(BASE_S + F.col("id")).alias("ts"))
    files.write_pane_files(panes.assign_panes(df, "ts", minutes(5), 4), str(tmp_path / "p"), "payload", ["ts"], separator=";")
    assert sorted(p.read_text() for p in (tmp_path / "p").rglob("part-*")) == ["0;1;2;3;", "4;5;"]


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(10).select("id", F.lit("x").alias("name"))
    broken = rows.withColumn("name", F.when(F.col("id") == 7, F.raise_error(F.lit("broken off"))).otherwise("x"))
    with pytest.raises(Exception, match="broken off"):
        files.append_table(broken, path, SCHEMA, batch=0)
    for batch in (0, 1, 1, 0):
        files.append_table(rows, path, SCHEMA, batch=batch)
    got = commits.appended(spark, path)
    assert got.columns == ["id", "name"] and sorted(r["id"] for r in got.collect()) == sorted([*range(10)] * 2)
    with pytest.raises(ValueError, match="name their batch"):
        files.append_table(rows, path, SCHEMA)


def test_a_window_table_batch_is_appended_once_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(99).select(
        "id", F.lit("x").alias("name"), F.concat(F.lit("T_"), (F.col("id") % 3).cast("string")).alias("table_name")
    )
    for batch in ("a", "b", "a"):
        files.append_window_tables(df, path, SCHEMA, batch=batch)
    one = commits.appended(spark, path).where("table_name = 'T_1'")
    assert one.count() == 66
    assert "PartitionFilters: [isnotnull(table_name" in one._jdf.queryExecution().executedPlan().toString()


def test_write_once_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.write_once(spark.range(3), path).count() == 3
    assert commits.write_once(spark.range(5), path).count() == 3
    commits.delete(spark, path)
    assert not commits.exists(spark, path)


@pytest.mark.parametrize("separator", ["", "\n", "é;"])
def test_named_files(spark, tmp_path, separator):
    rows = spark.range(1000).select(
        F.concat(F.lit("p/"), (F.col("id") % 7).cast("string"), F.lit("/:x")).alias("file"), (-F.col("id")).alias("n"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("ü"), F.col("id").cast("string"))).alias("text"),
    ).repartition(5)
    for _ in range(2):  # the second time replaces the files
        write_named_files(rows, str(tmp_path / "f"), "file", "text", ["n"], separator)
    want = {}
    for i in reversed(range(1000)):
        want.setdefault(f"p/{i % 7}/:x", []).append((f"ü{i}" if i % 10 else "") + separator)
    root = tmp_path / "f"
    got = {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}
    assert got == {name: "".join(parts) for name, parts in want.items()}


def test_named_files_of_a_broken_write_are_not_seen(spark, tmp_path):
    rows = spark.range(100).select(F.lit("a").alias("file"), F.when(F.col("id") == 99, F.raise_error(F.lit("broken off"))).otherwise("x").alias("text"))
    with pytest.raises(Exception, match="broken off"):
        write_named_files(rows.repartition(4), str(tmp_path / "f"), "file", "text")
    assert [p for p in (tmp_path / "f").rglob("*") if p.is_file()] == []


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert scratch_path(spark, "a").startswith(root) and scratch_path(spark, "a") != scratch_path(spark, "a")


def test_only_a_small_scan_is_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "small"))
    spark.range(100).repartition(40).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "many"))
    assert spread_small(spark.read.parquet(str(tmp_path / "small"))).rdd.getNumPartitions() == 4
    many = spark.read.parquet(str(tmp_path / "many"))
    assert spread_small(many) is many


def _named(spark, n):
    return spark.range(n).select(F.format_string("p/%02d/%s", F.col("id") % 3, F.concat(F.lit("%3A +:"), "id")).alias("file"),
                                 F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"))


def test_named_files_are_read_by_their_names(spark, tmp_path):
    write_named_files(_named(spark, 30), str(tmp_path / "f"), "file", "text")
    (tmp_path / "f" / "_hidden").mkdir()
    (tmp_path / "f" / "_hidden" / "x").write_text("no")
    (tmp_path / "f" / "top").write_text("t")
    (tmp_path / "f" / "empty").write_text("")
    got = {tuple(r) for r in read_named_files(spark, str(tmp_path / "f")).collect()}
    assert got == {tuple(r) for r in _named(spark, 30).collect()} | {("top", "t")}


def test_the_driver_does_not_learn_the_names_of_files(spark, tmp_path):
    import pickle

    import pyarrow as pa

    from millrace.sinks import pane_format

    sizes = []
    for n in (10, 1000):
        rows = pa.RecordBatch.from_pydict({"file": [f"f{i:05}" for i in range(n)], "value": ["x"] * n})
        sizes.append(len(pickle.dumps(pane_format.NamedFiles(
            {"path": str(tmp_path / str(n)), "staging": "_s"}).writer(None, False).write(iter([rows])))))
    assert sizes[0] == sizes[1]


def test_pane_files_modes_and_folders_as_spark_names_them(spark, tmp_path):
    df = spark.range(6).select(F.col("id").cast("string").alias("payload"), F.timestamp_seconds(BASE_S + F.col("id")).alias("ts"))
    cut, path = panes.assign_panes(df, "ts", minutes(5), 4), str(tmp_path / "p")

    def files_now():
        return sorted((str(p.parent.relative_to(path)), p.read_text()) for p in (tmp_path / "p").rglob("part-*"))

    once = [(f"window_max_ts=2024-01-01T00%3A04%3A59.999Z/pane_index={i}", t) for i, t in ((0, "0,1,2,3,"), (1, "4,5,"))]
    files.write_pane_files(cut, path, "payload", ["ts"], separator=",")
    assert files_now() == once and (tmp_path / "p" / "_SUCCESS").exists()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_pane_files(cut, path, "payload", ["ts"], separator=",")
    files.write_pane_files(cut, path, "payload", ["ts"], "ignore", ",")
    assert files_now() == once
    files.write_pane_files(cut, path, "payload", ["ts"], "append", ",")
    assert files_now() == sorted(once * 2)
    files.write_pane_files(cut, path, "payload", ["ts"], "overwrite", ",")
    assert files_now() == once
    assert spark.read.text(path).select("pane_index").distinct().count() == 2


def test_pane_files_are_not_committed_by_the_driver(spark, tmp_path, monkeypatch):
    moved = []
    monkeypatch.setattr(files, "write_named_files", lambda *args: moved.append(args))
    df = spark.range(6).select(F.col("id").cast("string").alias("payload"), F.timestamp_seconds(BASE_S + F.col("id")).alias("ts"))
    files.write_pane_files(panes.assign_panes(df, "ts", minutes(5), 4), str(tmp_path / "p"), "payload", ["ts"])
    assert len(moved) == 1


def test_a_settled_table_leaves_no_shuffle_behind(spark):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {name for name in found.split("\n") if "shuffle_" in name}

    before = shuffled()
    assert settled(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    # The count after it may leave its own, which is one row a task.
    names = shuffled() - before
    assert len({n.rpartition("/")[2].split("_")[1] for n in names}) <= 1
