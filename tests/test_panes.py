import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.windows import days, hours, minutes, months
from millrace.operators import panes
from millrace.operators.ordering import number_by_range
from conftest import BASE_S


def _events(spark, n=400, step_s=97):
    return spark.range(n).select(
        "id", F.timestamp_seconds(BASE_S + F.pmod(F.col("id") * 7919, F.lit(n)) * step_s).alias("ts")
    )


def _expected(df, interval, size):
    w = Window.partitionBy(F.window("ts", interval))
    rank = F.row_number().over(w.orderBy("ts", "id"))
    total = F.count("*").over(w)
    return df.select(
        "id",
        F.floor((rank - 1) / size).alias("pane_index"),
        F.when((F.floor((rank - 1) / size) + 1) * size <= total, "EARLY").otherwise("ON_TIME").alias("timing"),
        (F.floor((rank - 1) / size) == F.floor((total - 1) / size)).alias("is_last"),
    )


@pytest.mark.parametrize("task_rows", [10**9, 0])
@pytest.mark.parametrize("size, interval", [(hours(1), "1 hour"), (days(1), "1 day")])
def test_panes_follow_event_time(spark, size, interval, task_rows):
    df = _events(spark)
    got = panes.assign_panes(df, "ts", size, 7, ["id"], max_task_rows=task_rows)
    got = got.select("id", "pane_index", "timing", "is_last")
    want = _expected(df, interval, 7)
    assert got.count() == 400
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("task_rows", [10**9, 0])
def test_one_instant_of_copies_holds_most_rows(spark, task_rows):
    copies = spark.range(3000).select(F.lit(1).alias("id"), F.timestamp_seconds(F.lit(BASE_S + 60)).alias("ts"))
    rest = spark.range(50).select(
        (F.col("id") + 10).cast("int").alias("id"), F.timestamp_seconds(BASE_S + F.col("id")).alias("ts")
    )
    got = panes.assign_panes(copies.unionByName(rest), "ts", hours(1), 100, ["id"], max_task_rows=task_rows)
    sizes = {r["pane_index"]: r["count"] for r in got.groupBy("pane_index").count().collect()}
    assert sizes == {**{i: 100 for i in range(30)}, 30: 50}
    assert got.where("is_first").count() == 100 and got.where("is_last").count() == 50


def test_hot_rows_are_spread_over_tasks(spark):
    copies = spark.range(4000).select(F.lit(1).alias("id"), F.timestamp_seconds(F.lit(BASE_S)).alias("ts"))
    numbered = number_by_range(copies, ["id"], ["ts"], "rank", "total")
    assert sorted(r["rank"] for r in numbered.collect()) == list(range(1, 4001))
    laid_out = copies.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("id", "ts", "row")
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_calendar_months_and_missing_times(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-31 23:59:59"), (2, "2024-02-01 00:00:00"), (3, "2024-02-29 10:00:00"), (4, None)],
        "id int, t string",
    ).select("id", F.col("t").cast("timestamp").alias("ts"))
    got = panes.assign_panes(df, "ts", months(1), 1, ["id"])
    rows = {r["id"]: (str(r["window"]["start"]), r["pane_index"], r["timing"], r["is_last"]) for r in got.collect()}
    assert rows == {
        1: ("2024-01-01 00:00:00", 0, "EARLY", True),
        2: ("2024-02-01 00:00:00", 0, "EARLY", False),
        3: ("2024-02-01 00:00:00", 1, "EARLY", True),
    }


def test_other_columns_break_ties(spark):
    df = spark.createDataFrame([(c, {c: 1}) for c in "dbca"], "name string, m map<string,int>").withColumn(
        "ts", F.timestamp_seconds(F.lit(BASE_S))
    )
    got = panes.assign_panes(df, "ts", minutes(5), 2).select("name", "pane_index").collect()
    assert {r["name"]: r["pane_index"] for r in got} == {"a": 0, "b": 0, "c": 1, "d": 1}


def test_rows_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = panes.assign_panes(_events(spark), "ts", hours(1), 7, ["id"])
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    big_side = text.split("SortMergeJoin")[1].split("Scan ExistingRDD")[0]
    assert text.count("SinglePartition") == 0
    assert big_side.count("Exchange hashpartitioning(_ws") <= 3  # rows once, the counts twice


def test_pane_files(spark):
    df = spark.createDataFrame(
        [("a", 0), ("b", 1), ("c", 2)], "payload string, s int"
    ).select("payload", F.timestamp_seconds(F.lit(BASE_S) + F.col("s")).alias("ts"))
    cut = panes.assign_panes(df, "ts", minutes(5), 2, ["payload"])
    got = {tuple(r) for r in panes.pane_files(cut, "payload", "p", ["ts"], separator="").collect()}
    assert got == {("p/2024-01-01T00:04:59.999Z/0", 2, "ab"), ("p/2024-01-01T00:04:59.999Z/1", 1, "c")}


# -- lateness -------------------------------------------------------------------
