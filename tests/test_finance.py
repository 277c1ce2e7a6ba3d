import pytest
from pyspark.sql import functions as F

from millrace.operators import grouping
from millrace.plans import account_blocks
from millrace.sinks.files import write_text
from millrace.sources.text import ACCOUNT, parse_finance_lines, scan_finance_csv, scan_finance_lines


def _parse(spark, *texts):
    return parse_finance_lines(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_fields_and_extra_fields(spark):
    row = _parse(spark, "7,20240103,Org,Dept,Scen,Cash,1.5d,extra,,").first()
    assert tuple(row) == (7, "20240103", "Org", "Dept", "Scen", "Cash", 1.5)


def test_quotes_are_text(spark):
    assert _parse(spark, '1,d,"o,g,s,a,2').first()["OrganizationName"] == '"o'


@pytest.mark.parametrize("line", [
    "FinanceKey,DateKey,OrganizationName,DepartmentGroupName,ScenarioName,AccountDescription,Amount",
    "1,a,b,c,d,e",
    "1,a,b,c,d,e,",
    " 1,a,b,c,d,e,2",
    "1 ,a,b,c,d,e,2",
    "1.5,a,b,c,d,e,2",
    '1,"x,y",b,c,d,e,2',
    "",
])
def test_bad_line_fails_also_where_its_fields_are_not_used(spark, line):
    with pytest.raises(Exception, match="not a finance line"):
        _parse(spark, "1,a,b,c,d,e,2", line).select("AccountDescription").collect()


def test_line_is_split_once(spark):
    plan = _parse(spark, "1,a,b,c,d,e,2")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_lenient_reading(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    write_text(spark.createDataFrame([('1,"x,y",b,c,d,e,2',), ("",), ("bad",)], "value string"), path)
    rows = scan_finance_csv(spark, path)
    assert [r["DateKey"] for r in rows.collect()] == ["x,y"]
    # Whichever columns are used.
    assert rows.count() == 1 and rows.select("DateKey").count() == 1
    assert [tuple(r) for r in rows.select("AccountDescription").collect()] == [("e",)]


PART1 = ["1,d,o,g,s,Cash,3.0", "2,d,o,g,s,Cash,1.0", "3,d,o,g,s,Left,1.0E7"]
PART2 = ["4,d,o,g,s,Cash,2.0", "5,d,o,g,s,Right,0.5"]


def test_cogroup_has_keys_of_either_side(spark):
    groups = grouping.cogroup(_parse(spark, *PART1), _parse(spark, *PART2), ACCOUNT, ["Amount"])
    got = {r["key"]: (sorted(a[0] for a in r["p1"]), [a[0] for a in r["p2"]]) for r in groups.collect()}
    assert got == {"Cash": ([1.0, 3.0], [2.0]), "Left": ([1e7], []), "Right": ([], [0.5])}


def test_blocks(spark):
    groups = grouping.cogroup(_parse(spark, *PART1), _parse(spark, *PART2), ACCOUNT, ["Amount"])
    assert sorted(r["block"] for r in grouping.format_cogroup(groups, "Amount", ordered=True).collect()) == [
        "Cash\n\t1.0\n\t3.0\n\t2.0", "Left\n\t1.0E7", "Right\n\t0.5",
    ]


def test_blocks_with_missing_amounts(spark):
    left = spark.createDataFrame([("k", None), ("k", 1.0)], "key string, v double")
    groups = grouping.cogroup(left, left.limit(0), "key", ["v"])
    row = grouping.format_cogroup(groups, "v", ordered=True).first()
    assert row["block"] == "k\n\tnull\n\t1.0"


def _copies(spark, n):
    """A hot key whose records are all alike, and a few others."""
    hot = spark.range(n).select(F.lit("hot").alias("key"), F.lit(1.0).alias("v"))
    return hot.unionByName(spark.createDataFrame([("a", 2.0), ("b", 3.0), (None, 4.0)], "key string, v double"))


@pytest.mark.parametrize("slice_bytes", [1, 1000, 1 << 26])
@pytest.mark.parametrize("limit", [1, 10, 500, 10**6])
def test_one_shape_at_every_size(spark, limit, slice_bytes):
    rows = _copies(spark, 5000).unionByName(spark.range(300).selectExpr("'hot' AS key", "cast(id AS double) AS v"))
    groups = grouping.group_by_key(rows, "key", ["v"], max_group_rows=limit, slice_bytes=slice_bytes).collect()
    limit = min(limit, max(1, slice_bytes // 16))
    by_key = {}
    for r in groups:
        by_key.setdefault(r["key"], []).append(r)
    for parts in by_key.values():
        parts.sort(key=lambda r: r["part"])
        assert [r["part"] for r in parts] == list(range(parts[0]["n_parts"])) and len({r["n_parts"] for r in parts}) == 1
        assert all(len(r["records"]) == limit for r in parts[:-1]) and 0 < len(parts[-1]["records"]) <= limit
    got = {k: sorted(x["v"] for r in parts for x in r["records"]) for k, parts in by_key.items()}
    assert got == {"hot": sorted([1.0] * 5000 + [float(n) for n in range(300)]), "a": [2.0], "b": [3.0], None: [4.0]}


@pytest.mark.parametrize("slice_bytes", [100, 1 << 26])
@pytest.mark.parametrize("limit", [1, 7, 10**6])
def test_cogroup_has_its_left_side_first_over_all_parts(spark, limit, slice_bytes):
    left, right = _copies(spark, 40), _copies(spark, 25).where("key = 'hot' OR key IS NULL")
    groups = grouping.cogroup(left, right, "key", ["v"], max_group_rows=limit, slice_bytes=slice_bytes)
    blocks = grouping.format_cogroup(groups, "v", ordered=True).orderBy("key", "part").collect()
    text = {}
    for r in blocks:
        text.setdefault(r["key"], []).append(r["block"])
    assert {k: "\n".join(parts).split("\n") for k, parts in text.items()} == {
        "hot": ["hot"] + ["\t1.0"] * 65, "a": ["a", "\t2.0"], "b": ["b", "\t3.0"], None: ["null", "\t4.0", "\t4.0"],
    }
    sides = [(len(r["p1"]), len(r["p2"])) for r in groups.where("key = 'hot'").orderBy("part").collect()]
    assert sum(a for a, _ in sides) == 40 and sides == sorted(sides, key=lambda s: (s[0] == 0, s[1] > 0))


def test_a_hot_key_is_spread_by_its_size(spark):
    """A third of all rows under one key: no slice of it is much larger than others."""
    hot = spark.range(30_000).selectExpr("'hot' AS key", "cast(id AS string) AS v")
    rest = spark.range(60_000).selectExpr("cast(id % 6000 AS string) AS key", "cast(id AS string) AS v")
    groups = grouping.group_by_key(hot.unionByName(rest), "key", ["v"], max_group_rows=10**6, slice_bytes=20_000)
    sizes = [len(r["records"]) for r in groups.where("key = 'hot'").collect()]
    assert sum(sizes) == 30_000 and max(sizes) <= 20_000 / 16 and len(sizes) > 20
    small = groups.where("key <> 'hot'")
    assert small.count() == 6000 and small.where("n_parts <> 1 OR size(records) <> 10").isEmpty()


def test_parts_are_bounded_in_bytes(spark):
    rows = spark.range(200).select(F.lit("k").alias("key"), F.concat(F.repeat(F.lit("x"), 1000), F.col("id").cast("string")).alias("v"))
    parts = grouping.group_by_key(rows, "key", ["v"], slice_bytes=20_000).collect()
    assert max(len(r["records"]) for r in parts) <= 19 and sum(len(r["records"]) for r in parts) == 200
    assert sorted(r["part"] for r in parts) == list(range(parts[0]["n_parts"]))


@pytest.mark.parametrize("ordered", [False, True])
def test_lines_read_as_one_block_for_each_key(spark, tmp_path, ordered):
    for path, lines in (("p1", PART1 + [f"{n},d,o,g,s,Hot,1.0" for n in range(60)]),
                        ("p2", PART2 + [f"{n},d,o,g,s,Hot,2.0" for n in range(40)])):
        write_text(spark.createDataFrame([(t,) for t in lines], "value string"), str(tmp_path / path))
    account_blocks.run(spark, str(tmp_path / "p1"), str(tmp_path / "p2"), str(tmp_path / "out"), ordered)
    files = sorted((tmp_path / "out").glob("part-*"))
    lines = [line for p in files for line in p.read_text().splitlines()]
    blocks = {}
    for line in lines:
        if not line.startswith("\t"):
            account = line
            assert account not in blocks
        blocks.setdefault(account, []).append(line)
    assert sum(bool(p.read_text()) for p in files) > 1
    assert blocks.pop("Hot") == ["Hot"] + ["\t1.0"] * 60 + ["\t2.0"] * 40
    assert {k: sorted(v) for k, v in blocks.items()} == {
        "Cash": ["\t1.0", "\t2.0", "\t3.0", "Cash"], "Left": ["\t1.0E7", "Left"], "Right": ["\t0.5", "Right"],
    }


def test_finance_files(spark, tmp_path):
    write_text(spark.createDataFrame([(t,) for t in PART1], "value string"), str(tmp_path / "p"))
    assert scan_finance_lines(spark, str(tmp_path / "p")).count() == 3
