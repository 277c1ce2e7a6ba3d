import collections
import random

import pytest

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import near, queries
from millrace.llm.components import components


def brute(rows):
    """``(words in a set, smallest linked id)`` for each row, by comparing all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    owners = collections.defaultdict(list)
    for n, s in enumerate(sets):
        for shingle in s:
            owners[shingle].append(n)
    shared = collections.Counter()
    for who in owners.values():
        for i, a in enumerate(who):
            for b in who[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(i, len(s), least.get(find(n))) for n, ((i, _), s) in enumerate(zip(rows, sets))]


def check(spark, rows):
    got = near.near_copies(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))
    assert order(map(tuple, got)) == order(brute(rows))


def chains(seed, n=160, vocabulary=400):
    """Families of texts, each a change of an earlier one, around passages that many share."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(vocabulary)}"
    passages = [[word() for _ in range(60)] for _ in range(3)]
    texts = []
    for _ in range(n):
        if texts and draw.random() < 0.6:
            own = list(draw.choice(texts))
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = word()
        else:
            own = [word() for _ in range(draw.randrange(3, 120))]
            if draw.random() < 0.5:
                own += draw.choice(passages)
        texts.append(own)
    return [(n, " ".join(t)) for n, t in enumerate(texts)]


def test_table_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op7_jaccard_join(spark, SF_DIR).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


@pytest.mark.parametrize("crowded,common", [(32, 32), (2, 10**9), (3, 4)])
def test_crowded_regions_lose_no_link(spark, monkeypatch, crowded, common):
    monkeypatch.setattr(near, "CROWDED", crowded)
    monkeypatch.setattr(near, "COMMON", common)
    check(spark, chains(seed=crowded) + [(1000 + i if i is not None else None, t) for i, t in ODD])


def test_a_filter_of_one_word_still_finds_all(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.shared.BROADCAST_ROWS", 0)
    check(spark, chains(seed=9, n=60))


def test_exactly_at_the_limit(spark):
    # 20 shingles against 15 of them: 100 * 15 = 75 * 20; and one shingle less.
    words = [f"x{n}" for n in range(24)]
    check(spark, [(1, " ".join(words)), (2, " ".join(words[:19])), (3, " ".join(words[6:]))])


def test_one_of_each(spark):
    rows = chains(seed=5, n=80) + [(1000 + i if i is not None else None, t) for i, t in ODD]
    docs = documents(spark, rows)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    found = near.near_copies(docs.select("doc_id", "text"))
    assert kept.count() == found.select("root").distinct().count()
    linked = [r for r in brute(rows) if r[0] is not None and r[0] < 1000]
    stayed = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and r["doc_id"] < 1000]
    assert sorted(stayed) == sorted({r[2] for r in linked})


def test_empty_table(spark):
    docs = documents(spark, [])
    assert near.near_copies(docs).collect() == [] and near.one_of_each(docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(n, n + 1) for n in range(40)]
    star = [(100, 100 + n) for n in range(1, 60)] + [(200, 200)]
    draw = random.Random(1)
    edges = [(a, b) if draw.random() < 0.5 else (b, a) for a, b in path + star]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{n: 0 for n in range(41)}, **{100 + n: 100 for n in range(60)}}
