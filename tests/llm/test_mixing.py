import hashlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm_cases import ODD, documents
from millrace.llm import mixing


def budgets(spark, leaves, share=(1, 2), epochs=2):
    schema = "domain string, lang string, source string, tokens long, domain_weight long, lang_weight long, source_weight long"
    rows = mixing.budgets(spark.createDataFrame(leaves, schema), share, epochs).collect()
    return {(r["domain"], r["lang"], r["source"]): r["budget"] for r in rows}


def test_no_shortage(spark):
    leaves = [("w", "en", "a", 1000, 3, 1, 1), ("w", "en", "b", 1000, 3, 1, 2), ("x", "de", "c", 1000, 1, 1, 1)]
    assert budgets(spark, leaves, share=(1, 3)) == {("w", "en", "a"): 250, ("w", "en", "b"): 500, ("x", "de", "c"): 250}


def test_siblings_first_then_ancestors(spark):
    leaves = [
        ("w", "en", "a", 10, 1, 1, 1), ("w", "en", "b", 1000, 1, 1, 1), ("w", "de", "c", 1000, 1, 1, 1),
        ("x", "en", "d", 1000, 1, 1, 1),
    ]
    got = budgets(spark, leaves, share=(800, 3010), epochs=1)
    # Each domain has 400, each language of w 200; what a lacks goes to b, and to nobody else.
    assert got == {("w", "en", "a"): 10, ("w", "en", "b"): 190, ("w", "de", "c"): 200, ("x", "en", "d"): 400}
    leaves[1] = ("w", "en", "b", 50, 1, 1, 1)
    got = budgets(spark, leaves, share=(800, 2060), epochs=1)
    # b is full as well, so the language's shortage goes to the other language of the domain.
    assert got == {("w", "en", "a"): 10, ("w", "en", "b"): 50, ("w", "de", "c"): 340, ("x", "en", "d"): 400}
    leaves[2] = ("w", "de", "c", 100, 1, 1, 1)
    got = budgets(spark, leaves, share=(800, 1160), epochs=1)
    assert got == {("w", "en", "a"): 10, ("w", "en", "b"): 50, ("w", "de", "c"): 100, ("x", "en", "d"): 640}


def test_more_than_there_is(spark):
    leaves = [("w", "en", "a", 10, 1, 1, 1), ("x", "en", "b", 30, 5, 1, 1)]
    assert budgets(spark, leaves, share=(9, 1), epochs=2) == {("w", "en", "a"): 20, ("x", "en", "b"): 60}


def chosen(docs, share, epochs, seed=0, **weights):
    weights = {k: F.lit(1) for k in mixing.LEVELS} | weights
    return mixing.copies(docs, "doc_id", F.length("text"), F.lit("w"), weights, share, epochs, seed)


@pytest.mark.parametrize("share,epochs", [((1, 2), 2), ((5, 2), 3), ((0, 1), 1), ((7, 1), 2)])
def test_prefix_of_a_seeded_epoch(spark, share, epochs):
    rows = [(n, "x" * (n % 17)) for n in range(300)]
    docs = documents(spark, rows).withColumn("source", F.lit("s"))
    got = {r["id"]: r["copies"] for r in chosen(docs, share, epochs, seed=4).collect()}
    total = sum(len(t) for _, t in rows)
    budget = min(total * share[0] // share[1], total * epochs)
    full, rest = divmod(budget, total)
    want, upto = {}, 0
    for i, t in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|4|{full}".encode()).hexdigest()):
        upto += len(t)
        want[i] = full + (0 < rest >= upto)
    assert got == want


def test_odd_rows(spark):
    docs = documents(spark, ODD).withColumn("lang", F.when(F.col("doc_id") != 7, F.col("lang")))
    rows = chosen(docs, (1, 2), 2).collect()
    assert len(rows) == len(ODD) and all(0 <= r["copies"] <= 2 for r in rows)
    assert {r["lang"] for r in rows} == {"en", ""}
    leaves = {}
    for r in rows:
        leaf = leaves.setdefault((r["domain"], r["lang"], r["source"]), [r["budget"], 0])
        leaf[1] += r["copies"] * r["n_tokens"]
    assert all(used <= budget for budget, used in leaves.values())


def test_documents_come_as_often_as_chosen(spark):
    docs = documents(spark, [(n, f"text {n}") for n in range(50)])
    picked = chosen(docs, (3, 2), 3)
    out = mixing.mixed(picked, docs.columns)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r["id"]: r["copies"] for r in picked.collect() if r["copies"]}


def test_weight_zero_and_empty_table(spark):
    docs = documents(spark, [(n, "text") for n in range(9)])
    weight = F.when(F.col("source") == "src1", 0).otherwise(1)
    assert {r["copies"] for r in chosen(docs, (1, 1), 1, source=weight).where("source = 'src1'").collect()} == {0}
    assert chosen(documents(spark, []), (1, 2), 2).collect() == []


def test_weights_are_met_as_fractions(spark):
    leaves = [("w", "en", f"s{n}", 10_000, 1, 1, n + 1) for n in range(4)]
    got = budgets(spark, leaves, share=(1, 4), epochs=1)
    for n in range(4):
        assert abs(got["w", "en", f"s{n}"] - Fraction(10_000 * (n + 1), 10)) < 1
