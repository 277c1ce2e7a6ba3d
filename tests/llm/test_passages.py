import random

import pytest

from llm_cases import ODD, documents
from millrace.llm import passages
from pyspark.sql import functions as F


def brute(rows, window):
    """Rows as ``(id, words)``; a null id is the largest."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, words in rows:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key not in first or order(i) < order(first[key]):
                first[key] = i
    out = []
    for i, words in rows:
        gone = set()
        for s in range(len(words) - window + 1):
            if order(first[tuple(words[s : s + window])]) < order(i):
                gone |= set(range(s, s + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((str(i), len(words), len(gone), kept))
    return sorted(out)


def found(spark, rows, **how):
    got = passages.without_repeats(documents(spark, rows), **how).collect()
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got)


def corpus(seed, n, window):
    """Texts of common passages, cut anywhere, with words changed here and there."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4 if draw.random() < 0.2 else 5000)}"
    common = [[word() for _ in range(draw.randrange(window // 2, 6 * window))] for _ in range(6)]
    common.append(["again"] * (3 * window))
    texts = []
    for _ in range(n):
        words = []
        for _ in range(draw.randrange(6)):
            part = draw.choice(common)
            a, b = sorted(draw.randrange(len(part) + 1) for _ in range(2))
            part = part[a:b] if draw.random() < 0.6 else part[:]
            if part and draw.random() < 0.5:
                part[draw.randrange(len(part))] = word()
            words += part + [word() for _ in range(draw.randrange(30))]
        texts.append(words)
    return texts + draw.sample(texts, n // 5)


@pytest.mark.parametrize(("seed", "window", "length"), [(1, 50, 16), (2, 12, 4), (3, 9, 9), (4, 8, 1), (5, 50, 32)])
def test_equals_brute_force(spark, seed, window, length):
    texts = corpus(seed, 60, window)
    draw = random.Random(seed)
    ids = [draw.randrange(len(texts)) if draw.random() < 0.95 else None for _ in texts]  # some shared, some null
    rows = list(zip(ids, texts))
    got = found(spark, [(i, " ".join(words)) for i, words in rows], window=window, seed=length)
    want = brute(rows, window)
    assert got == want and 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_a_hot_passage_at_edges_that_differ(spark):
    """More rows than a thousandth of all share a passage, each cut elsewhere."""
    draw = random.Random(0)
    hot = [f"h{n}" for n in range(120)]
    rows = []
    for i in range(400):
        a, b = draw.randrange(40), 120 - draw.randrange(40)
        rows.append((i, [f"x{i}a{n}" for n in range(5)] + hot[a:b] + [f"x{i}b{n}" for n in range(5)]))
    got = found(spark, [(i, "\t".join(w) + "\n") for i, w in rows])
    assert got == brute(rows, 50)


def test_whitespace_does_not_tell_texts_apart(spark):
    words = [f"w{n}" for n in range(60)]
    got = found(spark, [(2, " ".join(words)), (1, "\n".join(words)), (3, " \t".join(words[:49]))])
    assert [r[2] for r in got] == [0, 60, 0]


def test_odd_rows(spark):
    rows = [(i, (t or "").split()) for i, t in ODD]
    assert found(spark, ODD) == brute(rows, 50)


def test_kept_as_and_empty_table(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    digests = passages.without_repeats(docs, kept_as=lambda t: F.sha2(t, 256)).orderBy("doc_id").collect()
    want = docs.orderBy("doc_id").select(F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    assert [r["kept"] for r in digests] == [r[0] for r in want]
    assert passages.without_repeats(documents(spark, [])).collect() == []
