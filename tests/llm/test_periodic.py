import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    """By the failure function."""
    fail = [0] * len(words)
    for i in range(1, len(words)):
        k = fail[i - 1]
        while k and words[i] != words[k]:
            k = fail[k - 1]
        fail[i] = k + (words[i] == words[k])
    return len(words) - fail[-1]


def brute(words):
    """Every period is tried at every place."""
    ids = np.unique(words, return_inverse=True)[1]
    runs = []
    for p in range(1, len(words) // 4 + 1):
        same, start = (ids[p:] == ids[:-p]).tolist() + [False], None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            if not s and start is not None:
                length = i - start + p
                if length >= max(6, 4 * p) and smallest_period(ids[start : start + length].tolist()) == p:
                    runs.append((start, length, p))
                start = None
    return sorted(runs)


def digests(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op11_periodic_runs(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    some = 0
    for r in rows:
        words = planted(r["doc_id"], WORD.findall(texts[r["doc_id"]] or ""))
        runs = brute(words)
        some += bool(runs)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["n_runs"] == len(runs)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == digests(words, runs)
    assert some >= 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert periodic.find_runs(np.array(words, np.int64)) == brute(words)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 15, 16, 17, 32, 33, 64, 65, 100, 257])
@pytest.mark.parametrize("spare", [0, 1, 5])
def test_each_scale_from_its_least_length(period, spare):
    draw = np.random.default_rng(period)
    block = draw.integers(0, 3, period - 1).tolist() + [9]
    words = draw.integers(10, 10**6, 37).tolist() + (block * 6)[: 4 * period + spare] + [-1]
    assert periodic.find_runs(np.array(words)) == brute(words)


def test_periods_inside_a_longer_period():
    words = (([1] * 30 + [2]) * 5 + [3]) * 4
    runs = periodic.find_runs(np.array(words))
    assert runs == brute(words) and {p for _, _, p in runs} == {1, 31, 156}


def test_long_text_takes_time_by_its_length():
    words = np.array(([1, 2, 3] * 100 + list(range(10, 1010))) * 400)
    runs = periodic.find_runs(words)
    assert (0, len(words), 1300) in runs and len(runs) == 401


def test_odd_rows(spark):
    got = sorted((r["doc_id"] or 0, r["collapsed"], len(r["runs"])) for r in periodic.periodic_runs(documents(spark, ODD)).collect())
    want = []
    for i, text in ODD:
        words = WORD.findall(text or "")
        runs = [(0, len(words), 10)] if i == 7 else brute(words)
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        want.append((i or 0, " ".join(w for k, w in enumerate(words) if k not in gone), len(runs)))
    assert got == sorted(want)


def test_empty_table(spark):
    assert periodic.periodic_runs(documents(spark, [])).collect() == []
