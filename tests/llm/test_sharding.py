import zlib

import pytest

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import queries, sharding


def place_of(row_no, total, seed):
    """The permutation by plain arithmetic, walking the cycle step by step."""
    a, b = sharding.domain(total)
    at = row_no
    while True:
        left, right = divmod(at, b)
        for n, key in enumerate(sharding.ROUND_KEYS):
            shift = (key + seed) % sharding.PRIME
            x = right if n % 2 == 0 else left
            y = (x + shift) % sharding.PRIME
            z = (y * y + shift) % sharding.PRIME
            f = (z * z + y) % sharding.PRIME
            if n % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        at = left * b + right
        if at < total:
            return at


@pytest.mark.parametrize("total", [1, 2, 3, 7, 24, 101, 1000, 1023])
def test_permutation(spark, total):
    rows = sharding.shuffled(spark.range(total).withColumnRenamed("id", "row_no"), total, seed=5).collect()
    assert {r["row_no"]: r["place"] for r in rows} == {n: place_of(n, total, 5) for n in range(total)}
    assert sorted(r["place"] for r in rows) == list(range(total))


def check(got, rows, n_shards=24, seed=0):
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    none_first = lambda i: (i is not None, i or 0)
    assert sorted((none_first(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (none_first(i), size(t), crc(t)) for i, t in rows
    )
    counts = [0] * n_shards
    slots = set()
    for r in got:
        counts[r["shard"]] += 1
        slots.add((r["shard"], r["slot"]))
        assert r["law"] == "rows" and r["grown_shard"] is None
        assert r["slot"] * n_shards + r["shard"] == place_of(r["row_no"], len(rows), seed)
    assert max(counts) - min(counts) <= 1
    assert slots == {(s, n) for s in range(n_shards) for n in range(counts[s])}
    numbered = sorted(got, key=lambda r: r["row_no"])
    assert [none_first(r["doc_id"]) for r in numbered] == sorted(none_first(i) for i, _ in rows)


def test_odd_rows(spark):
    check(sharding.shards(documents(spark, ODD)).collect(), ODD)


def test_many_copies_of_one_row(spark):
    rows = [(1, "same")] * 500 + [(n, f"text {n}") for n in range(200)]
    check(sharding.shards(documents(spark, rows), seed=3).collect(), rows, seed=3)


def test_the_layout_does_not_matter(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one = sharding.shards(docs).collect()
    other = sharding.shards(docs.repartition(7, "lang")).collect()
    assert sorted(one) == sorted(other)
    assert sorted(r[:6] for r in one) == sorted(r[:6] for r in queries.op10_sharding(spark, SF_DIR).collect())


def test_empty_table(spark):
    assert sharding.shards(documents(spark, [])).collect() == []
