import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_cases import ODD, SF_DIR, documents
from millrace.llm import personal, queries, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def found(docs):
    return personal.personal_data(docs).select(
        "doc_id", secrets.joined(F.col("base")).alias("base"), secrets.joined(F.col("spans")).alias("spans")
    ).collect()


def test_base_spans_of_the_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op6_personal_data(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = brute(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert all(row[f"n_{k}"] == want.count(f"{k}:") for k in personal.KINDS[:4])


def test_base_spans_of_random_and_odd_texts(spark):
    draw = random.Random(3)
    rows = [(100 + n, "".join(draw.choices("aA1 2.3@b-+(4)5%_é\n9 0", k=draw.randrange(60)))) for n in range(1500)]
    rows += [
        (10, "1" * 5000), (11, "a." * 3000 + "@x.y"), (12, "+1 " * 50), (13, "x@y" + ".z" * 5000),
        (14, "4111 1111 1111 1111, 4111-1111-1111-1111x 007.1.2.255 a@b.c_d@e.f é 300.1.2.3.4.5.6 +1 (555) 123-4567"),
    ]
    rows += ODD
    got = sorted((r["doc_id"] or 0, r["base"]) for r in found(documents(spark, rows)))
    assert got == sorted((i or 0, brute(t)) for i, t in rows)


def test_wider_spans_are_added_to_base_spans_only(spark):
    known = [(n, f"please call tel +1 (20{n % 10}) 555 12{n % 10}4 or mail a{n}@host.org today") for n in range(60)]
    extra = [(90, "call tel 555 123 4567 or mail bob (at) example (dot) com"), (91, "plain words, no data at all")]
    got = {r["doc_id"]: r for r in found(documents(spark, known + extra))}
    assert got[90]["base"] == "" and "phone:9:21" in got[90]["spans"] and "email:" in got[90]["spans"]
    assert got[91]["spans"] == ""
    for row in got.values():
        assert {s for s in row["base"].split(",") if s} <= set(row["spans"].split(","))


def test_labelers_are_told_apart(spark):
    # Two labelers that are right 9 times of 10, one that always says yes, one that never votes.
    rows = []
    for n in range(1000):
        truth, other = n % 2, (n // 2) % 10
        rows.append((0, [truth if other else 1 - truth, truth if other != 5 else 1 - truth, 1, None], 1))
    patterns = spark.createDataFrame(rows, "kind int, votes array<int>, n long").groupBy("kind", "votes").agg(F.sum("n").alias("n"))
    model = personal.fit_labelers(patterns)
    good = [model["yes"][k] - model["no"][k] for k in personal.LABELERS[:2]]
    assert min(good) > 0.6 and model["yes"]["context"] - model["no"]["context"] < 0.2


def test_empty_table(spark):
    assert found(documents(spark, [])) == []
