import collections
import math
import re

from pyspark.sql import functions as F

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
              len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])


def base(row):
    return (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"])


def test_base_counts_of_the_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op1_quality(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert base(row) == brute(texts[row["doc_id"]]), row["doc_id"]
        assert not (row["kept"] and row["base_failed"])


def test_odd_rows(spark):
    rows = quality.judged(documents(spark, ODD), carry=["doc_id", "text"]).collect()
    assert sorted(map(base, rows)) == sorted(brute(t) for _, t in ODD)


def test_empty_table_and_columns(spark):
    kept = quality.keep_good(documents(spark, []))
    assert kept.columns == documents(spark, []).columns and kept.collect() == []


def test_no_known_language(spark):
    prose = " ".join(f"word{n}" for n in range(120))
    docs = documents(spark, [(1, prose)]).withColumn("lang", F.lit(None).cast("string"))
    rows = quality.judged(docs).collect()
    assert rows[0]["kept"] and rows[0]["word_distance"] is None


def test_clean_prose_stays_and_most_poor_texts_go(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = queries.op1_quality(spark, sf_dir).join(labels, "doc_id").where("not base_failed").collect()
    clean = [r for r in found if r["quality"] == 1]
    assert clean and all(r["kept"] for r in clean)
    poor = [r for r in found if r["quality"] == 0 and r["n_words"] >= 100]
    assert sum(not r["kept"] for r in poor) >= 0.7 * len(poor)  # 19 of 25


def test_distance_is_that_of_jensen_and_shannon(spark):
    p, q = {"a": 0.5, "b": 0.5}, {"a": 0.25, "c": 0.75}
    met = F.array(*[F.struct(F.lit(v).alias("share"), F.array(F.lit(q.get(k, 0.0))).alias("theirs")) for k, v in p.items()])
    got = spark.range(1).select(quality._distance(met, 0)).first()[0]
    middle = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in "abc"}
    want = sum(x * math.log2(x / middle[k]) for d in (p, q) for k, x in d.items()) / 2
    assert abs(got - math.sqrt(want)) < 1e-12


TABLE = SF_DIR.replace("0.001", "0.01")


def test_copies_do_not_become_the_reference(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    far = {r["doc_id"] for r in quality.judged(docs, carry=["doc_id"]).where("not kept and not base_failed").select("row.doc_id").collect()}
    junk = " ".join(f"#{n}$%&* |<{n}>|" for n in range(100))
    copies = spark.range(500).select((-1 - F.col("id")).alias("doc_id"), F.lit(junk).alias("text"), F.lit("de").alias("lang"))
    more = quality.settled(docs.select("doc_id", "text", "lang").unionByName(copies))
    kept = {r["doc_id"] for r in quality.keep_good(more).select("doc_id").collect()}
    assert far and not kept & far and min(kept) >= 0


def test_languages_without_a_list_of_their_own(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet").select("doc_id", "text", "lang")
    common = "и в не на что он с как это по но из за то все так".split()
    prose = [" ".join(f"{common[(n * k) % 16]} слово{'абвгдежзик'[n % 10]}{'лмнопрстуф'[k % 10] * (k // 10 + 1)}" for k in range(60))
             for n in range(1, 121, 2)]
    rows = [(-n, t, "ru") for n, t in enumerate(prose, start=1)] + [(-100, prose[0] + " конец", "xx"), (-101, prose[1] + " конец", None)]
    rows += [(-102, " ".join("#$%&*" + str(n) for n in range(120)), "ru")]
    more = quality.settled(docs.unionByName(spark.createDataFrame(rows, docs.schema)))
    found = quality.judged(more, carry=["doc_id"])
    got = {r["row"]["doc_id"]: r for r in found.where("row.doc_id < 0").collect()}
    assert all(got[-n]["kept"] and got[-n]["char_distance"] < 0.1 for n in range(1, 61))
    assert got[-100]["kept"] and got[-101]["kept"] and got[-100]["word_distance"] is None
    assert not got[-102]["kept"] and not got[-102]["base_failed"]
