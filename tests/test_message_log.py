import json
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources import message_log
from millrace.sources.message_log import append_log, log_messages, log_stream


def _put(root, partition, first, texts, **attributes):
    folder = root / partition
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps({"data": t, "attributes": {"at": str(1704067200000 + i), **attributes}}) for i, t in enumerate(texts)]
    part = folder / f".{first}.part"
    part.write_text("\n".join(lines) + "\n")
    part.rename(folder / f"{first:020d}.jsonl")


def _run(df, tmp_path, spark, after=None, until=None):
    sizes = []

    def take(batch, number):
        batch.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={number}"))
        sizes.append(spark.read.parquet(str(tmp_path / f"out/batch={number}")).count())
        if after is not None and len(sizes) == after:
            raise RuntimeError("broken off")

    writer = df.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "ck"))
    if until is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return sizes
    query, end = writer.start(), time.time() + 120
    while query.isActive and time.time() < end and sum(sizes) < until:
        time.sleep(0.1)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return sizes


def _read(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r["partition"], r["offset"], r["data"]) for r in rows)


@pytest.fixture
def log(tmp_path):
    root = tmp_path / "log"
    _put(root, "0", 0, [f"a{i}é" for i in range(30)])
    _put(root, "0", 30, [f"b{i}" for i in range(5)])
    _put(root, "1", 0, ["c\nd", None, ""], kind="x")
    return root


WANT = sorted([("0", i, f"a{i}é") for i in range(30)] + [("0", 30 + i, f"b{i}") for i in range(5)]
              + [("1", 0, "c\nd"), ("1", 1, None), ("1", 2, "")], key=str)


def test_all_partitions_and_files(spark, tmp_path, log, monkeypatch):
    monkeypatch.setattr(message_log, "TASK_MESSAGES", 7)
    assert _run(log_stream(spark, str(log)), tmp_path, spark) == [38]
    assert sorted(_read(spark, tmp_path), key=str) == WANT


def test_what_comes_later_is_read_once(spark, tmp_path, log):
    for n in range(3):
        _run(log_stream(spark, str(log)), tmp_path, spark)
        _put(log, "2", n * 2, [f"later{n}", "x"])
    _run(log_stream(spark, str(log)), tmp_path, spark)
    got = [r for r in _read(spark, tmp_path) if r[0] == "2"]
    assert [r[1] for r in got] == list(range(6))
    assert sorted((r for r in _read(spark, tmp_path) if r[0] != "2"), key=str) == WANT


def _limited(spark, log, tmp_path):
    return log_stream(spark, str(log), limit=10, position=str(tmp_path / "position"))


def test_a_limit_and_a_restart_in_mid_stream(spark, tmp_path, log):
    for after in (2, 1):
        with pytest.raises(Exception, match="broken off"):
            _run(_limited(spark, log, tmp_path), tmp_path, spark, after, until=100)
    assert all(n <= 10 for n in _run(_limited(spark, log, tmp_path), tmp_path, spark, until=20))
    while len(_read(spark, tmp_path)) < len(WANT):
        assert _run(_limited(spark, log, tmp_path), tmp_path, spark, until=1)[0] <= 10
    assert sorted(_read(spark, tmp_path), key=str) == WANT
    assert len(list((tmp_path / "out").glob("batch=*"))) >= 4


def test_a_limit_needs_a_position(spark, tmp_path, log):
    with pytest.raises(ValueError, match="position"):
        log_stream(spark, str(log), limit=10)


def test_event_times_come_from_an_attribute(spark, tmp_path, log):
    sent = log_messages(spark, str(log), "at", keep=("partition", "offset"))
    _run(sent.withColumnRenamed("payload", "data").withColumn("ms", F.unix_millis("event_ts")), tmp_path, spark)
    rows = spark.read.parquet(str(tmp_path / "out")).where("partition = '0' AND offset < 30").collect()
    assert {r["ms"] - 1704067200000 - r["offset"] for r in rows} == {0}


def test_appends_go_on_where_the_log_ends(spark, tmp_path):
    root, at = str(tmp_path / "log"), {}
    for n in range(2):
        rows = spark.range(20).select((F.col("id") % 3).alias("p"), F.concat(F.lit(f"{n}:"), F.col("id").cast("string")).alias("data"),
                                      F.create_map(F.lit("n"), F.lit(str(n))).alias("attributes"))
        at = append_log(rows, root, "p", at)
    assert at == {"0": 14, "1": 14, "2": 12}
    _run(log_stream(spark, root), tmp_path, spark)
    got = _read(spark, tmp_path)
    assert sorted(d for _, _, d in got) == sorted(f"{n}:{i}" for n in range(2) for i in range(20))
    assert sorted((p, o) for p, o, _ in got) == sorted((p, o) for p, n in at.items() for o in range(n))
