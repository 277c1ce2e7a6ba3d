import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import queries, tokens


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def packed(text, vocabulary):
    return np.array(tokens.encoding(vocabulary).encode_ordinary(text or ""), "<u4").tobytes()


def test_table_as_the_library_has_it(spark, vocabulary):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op2_byte_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = packed(texts[row["doc_id"]], vocabulary)
        assert row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (40, 40), (65_536, 1024)])
def test_odd_rows_in_chunks_of_any_size(spark, vocabulary, chunk, overlap):
    more = [
        (20, "it's we'll\n\n  spaced   out\t\ttabs \u3000wide 1234567890 'quoted' don't " * 40),
        (21, " " * 500 + "end"), (22, "no seam" + "é" * 700 + " then " + "7" * 400),
        (23, "🙂🙃" * 200), (23, "🙂🙃" * 200),
    ]
    rows = ODD + more
    docs = documents(spark, rows)
    out = tokens.decode(tokens.encode(docs, vocabulary, chunk=chunk, overlap=overlap), vocabulary)
    assert set(out.columns) == {*docs.columns, "decoded"}
    got = sorted((r["doc_id"] or 0, r["text"] or "", bytes(r["ids"]), bytes(r["decoded"])) for r in out.collect())
    want = sorted((i or 0, t or "", packed(t, vocabulary), (t or "").encode()) for i, t in rows)
    assert got == want


def test_empty_table(spark, vocabulary):
    assert tokens.encode(documents(spark, []), vocabulary).collect() == []


def test_null_ids_decode_to_null(spark, vocabulary):
    one = spark.range(1).select(F.lit(None).cast("binary").alias("ids"))
    assert tokens.decode(one, vocabulary).first()["decoded"] is None


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a1 '\nsré\u3000-", max_size=120), st.integers(5, 40), st.integers(4, 12))
def test_cutting_at_a_shared_boundary_changes_nothing(text, chunk, overlap):
    pattern = public_tokenizers.PATTERN
    vocabulary = queries.vocabulary()
    own = tokens.encoding(vocabulary)
    if len(text) <= chunk:
        return
    head = tokens.boundaries(text[chunk : chunk + overlap + tokens.LOOK_AHEAD], pattern, 0, overlap)
    first = text[: chunk + overlap]
    sure = min(len(first) - tokens.LOOK_AHEAD, chunk + overlap)
    tail = [e - chunk for e in tokens.boundaries(first, pattern, chunk, sure)]
    if len(text) - chunk <= overlap:
        head = [e for e in head if e <= sure - chunk]
    shared = sorted(set(head) & set(tail))
    if shared:
        cut = chunk + shared[0]
        assert own.encode_ordinary(text[:cut]) + own.encode_ordinary(text[cut:]) == own.encode_ordinary(text)
