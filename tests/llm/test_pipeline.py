"""The pipeline against a brute-force version of its stages."""

import pytest

import corpus_pipeline
from llm_cases import ODD, documents
from millrace.llm import queries, tokens
from test_near import brute as near_brute

# No three words in a row come twice in a text, and no text is like another.
PROSE = [" ".join(f"the a{n}x{k} of b{n}x{k} in c{n}x{k} and" for k in range(30)) for n in range(30)]


@pytest.fixture
def sf_dir(spark, tmp_path):
    rows = [(n, t) for n, t in enumerate(PROSE)]
    rows += [(100 + n, t) for n, t in enumerate(PROSE[:9])]  # exact copies
    rows += [(200 + n, t + " and then some") for n, t in enumerate(PROSE[5:12])]  # near copies
    documents(spark, rows + [(1000 + (i or 0), t) for i, t in ODD]).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_each_stage_on_what_the_one_before_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{sf_dir}/{n}"
        stage(spark, left[-1], sf_dir).write.parquet(path)
        left.append(spark.read.parquet(path))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert left[-1].columns == columns
    rows = [[(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()] for df in left[:-1]]
    good = {t for _, t in rows[1]}
    assert set(PROSE) <= good and not good & {t for _, t in ODD}
    newest = {}
    for i, t in rows[1]:
        newest[t] = max(i, newest.get(t, -1))
    assert sorted(rows[2]) == sorted((i, t) for t, i in newest.items())
    assert sorted(i for i, _ in rows[3]) == sorted({r[2] for r in near_brute(rows[2])})
    assert {i for i, _ in rows[4]} <= {i for i, _ in rows[3]}
    own = tokens.encoding(queries.vocabulary())
    encoded = sorted((r["doc_id"], r["n_tokens"]) for r in left[-1].collect())
    assert encoded == sorted((i, len(own.encode_ordinary(t))) for i, t in rows[4])


def test_run_is_its_stages_and_is_repeatable(spark, sf_dir):
    once, again = (corpus_pipeline.run(spark, sf_dir).collect() for _ in range(2))
    assert once and sorted(map(str, once)) == sorted(map(str, again))


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_five_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]
