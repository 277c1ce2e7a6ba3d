import hashlib

import pytest

from llm_cases import ODD, documents
from millrace.llm import exact_dedup, shared


def brute(rows):
    """Of each text: how often, and the largest id."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {t: (len(ids), max((i for i in ids if i is not None), default=None)) for t, ids in groups.items()}


def check(spark, rows):
    got = exact_dedup.exact_copies(documents(spark, rows)).collect()
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in brute(rows).items()}
    assert len(got) == len(rows)
    for row in got:
        assert (row["group_size"], row["keep_id"]) == by_digest[row["text_sha256"]]
        assert not row["kept"] or row["doc_id"] == row["keep_id"]
    assert sorted(r["text_sha256"] for r in got if r["kept"]) == sorted(by_digest)


def test_odd_rows(spark):
    check(spark, ODD)


@pytest.mark.parametrize("broadcast_rows", [0, 1 << 21])
def test_a_hot_group_and_many_pairs(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(shared, "HOT_SHARE", 10)
    check(spark, [(n, "hot" if n % 3 == 0 else f"text {n // 4}") for n in range(900)])


def test_a_filter_that_has_everything(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_WORD", 10**9)
    check(spark, [(n, f"text {n % 70}" if n < 100 else f"only {n}") for n in range(400)])


def test_drop_copies_keeps_whole_rows(spark):
    docs = documents(spark, ODD)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in kept.collect())
    assert got == sorted((t, -1 if i is None else i) for t, (_, i) in brute(ODD).items())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.exact_copies(docs).collect() == [] and exact_dedup.drop_copies(docs).collect() == []
