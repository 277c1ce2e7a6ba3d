import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import ODD, documents
from millrace.llm import infill
from pyspark.sql import functions as F

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKED = [(20, "has <P> already"), (21, "has <S>"), (22, "has <M>"), (23, "<P <S <M é"), (24, " lead"), (25, "trail "),
          (26, "漢字 🙂🙂\x0b\x0cé  ü x y \r\n"), (27, "<" * 40), (28, "<P" * 30 + " " + "<S" * 9 + " <M <M")]


def brute(doc_id, text, seed, unit="token"):
    text = text or ""
    units = TOKEN.findall(text) if unit == "token" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", infill.UNITS)
def test_equals_brute_force_and_comes_back(spark, unit):
    rows = ODD + MARKED + [(100 + n, t) for n in range(30) for _, t in MARKED]
    docs, forms = documents(spark, rows), set()
    for seed in (42, 7):
        made = infill.infilled(docs, seed, unit).withColumn("back", infill.restored()).collect()
        want = sorted((str(i), *map(str, brute(i, t, seed, unit)), t or "") for i, t in rows)
        assert sorted((str(r[0]), *map(str, r[1:6]), r["back"]) for r in made) == want
        forms |= {r["form"] for r in made}
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \té漢\U0001f642 "), max_size=60))
def test_index_converts_both_ways(text):
    index = infill.SparseIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:n].encode()) for n in chars])
    assert index.n_chars == len(text)
    assert index.to_bytes(chars).tolist() == cuts.tolist() and index.to_chars(cuts).tolist() == chars.tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.sampled_from(infill.UNITS))
def test_cuts_are_the_same_in_bytes_and_characters(text, first, second, unit):
    text = text.encode("utf-8", "ignore").decode()
    n, cuts, chars = infill.cut(text.encode(), first, second, unit)
    assert n == (len(TOKEN.findall(text)) if unit == "token" else len(text))
    assert [text.encode()[:c].decode() for c in cuts] == [text[:c] for c in chars]


def test_rates(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words to be cut").alias("text"))
    none = infill.infilled(docs, 1, fim_percent=0).select("form").distinct().collect()
    every = infill.infilled(docs, 1, fim_percent=100, spm_percent=0).select("form").distinct().collect()
    assert [r[0] for r in none] == ["plain"] and [r[0] for r in every] == ["psm"]


def test_unknown_unit_and_empty_table(spark):
    with pytest.raises(ValueError):
        infill.infilled(documents(spark, []), 1, unit="line")
    assert infill.infilled(documents(spark, []), 1).collect() == []
