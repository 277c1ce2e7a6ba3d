import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import words
from millrace.plans import word_report
from millrace.sinks.files import write_outputs, write_text


def _lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def _values(df):
    return sorted(r[0] for r in df.collect())


def test_tokenize_keeps_apostrophes_and_splits_elsewhere(spark):
    got = words.tokenize(_lines(spark, "Don't  stop--now 42", "", "'", "été naïve", None))
    assert _values(got) == ["'", "Don't", "na", "now", "stop", "t", "ve"]


def test_word_of_mean_length_is_above(spark):
    found = words.tokenize(_lines(spark, "a bbb cc"))
    outputs = words.word_outputs(found)
    assert _values(outputs["all"]) == ["a", "bbb", "cc"]
    assert _values(outputs["above"]) == ["bbb3", "cc2"]
    assert _values(outputs["below"]) == ["a1"]


def test_no_words_give_null_mean_and_empty_outputs(spark):
    found = words.tokenize(_lines(spark, "", "123 ..."))
    assert words.mean_length(found).first()["avg_len"] is None
    assert [df.count() for df in words.word_outputs(found).values()] == [0, 0, 0]
    assert words.word_outputs_tagged(found).count() == 0


def test_one_pass_outputs_are_the_three_outputs(spark):
    found = words.tokenize(_lines(spark, "the quick brown fox", "a an the"))
    tagged = words.word_outputs_tagged(found)
    for name, df in words.word_outputs(found).items():
        assert _values(df) == _values(tagged.where(tagged.output == name).select("value"))


def test_word_chain(spark):
    assert _values(words.word_chain(_lines(spark, "Ab cde"))) == ["AB: 2", "CDE: 3"]


def test_no_window_and_no_join_for_the_mean(spark):
    found = words.tokenize(_lines(spark, "a bb ccc"))
    for df in (words.at_least_mean(found), words.with_band(found), words.with_mean(found)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan and "Cartesian" not in plan


def test_report_files(spark, tmp_path):
    write_text(_lines(spark, "a bbb", "cc"), str(tmp_path / "in"))
    word_report.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = spark.read.text(str(tmp_path / "out")).collect()
    assert sorted((r["output"], r["value"]) for r in rows) == [
        ("above", "bbb3"), ("above", "cc2"), ("all", "a"), ("all", "bbb"), ("all", "cc"), ("below", "a1"),
    ]


def test_outputs_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    tagged = words.word_outputs_tagged(words.tokenize(_lines(spark, "a bbb", "cc")))
    kind = type(tagged.write)
    text = kind.text
    monkeypatch.setattr(kind, "text", lambda self, *args: (seen.append(int(spark.conf.get(name))), text(self, *args)))
    write_outputs(tagged, str(tmp_path / "out"))
    assert seen and seen[0] >= 3  # Spark sorts by output unless so many files may be open
    assert spark.conf.get(name) == before
    assert spark.read.text(str(tmp_path / "out")).count() == 6


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="abZ' \n\t-9\u00e9\u4e2d\U0001f600.", max_size=40), min_size=1, max_size=50))
def test_any_text(spark, texts):
    found = words.tokenize(_lines(spark, *texts))
    want = sorted(w for t in texts for w in re.findall("[a-zA-Z']+", t))
    assert _values(found) == want
    if want:
        mean = sum(map(len, want)) / len(want)
        outputs = words.word_outputs(found)
        assert _values(outputs["above"]) == sorted(f"{w}{len(w)}" for w in want if len(w) >= mean)
        assert _values(outputs["below"]) == sorted(f"{w}{len(w)}" for w in want if len(w) < mean)
