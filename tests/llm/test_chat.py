from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_cases import SF_DIR
from millrace.llm import chat, queries


def read_back(made):
    return made.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("segments")).alias("learned"), "formatted", "segments",
    ).collect()


def check(spark, turns):
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = read_back(chat.format_conversations(rows))
    by_conv = {}
    for n, (conv, turn, role, text) in enumerate(turns):
        key = ("alone", n) if conv is None else conv
        by_conv.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = [(None if isinstance(k, tuple) else k, [(r, t) for _, _, r, t in sorted(v)]) for k, v in by_conv.items()]
    assert sorted(((r["conv_id"], [tuple(x) for x in r["turns"]]) for r in got), key=str) == sorted(said, key=str)
    for row in got:
        want = [tuple(x) for x in row["turns"]]
        assert row["learned"] == "".join(t for r, t in want if r == "assistant")
        assert "".join(s["part"] for s in row["segments"]) == row["formatted"]
    return got


TEXTS = st.lists(st.tuples(
    st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from(["user", "assistant", "", None, "<turn>"]),
    st.one_of(st.none(), st.text(alphabet="\\<le/turn>mo\n ", max_size=12)),
), min_size=1, max_size=14)


def test_reads_back_whatever_was_said(spark):
    @settings(max_examples=25, deadline=None)
    @given(TEXTS)
    def run(turns):
        check(spark, turns)

    run()


def test_adjacent_turns_of_one_role_share_a_block(spark):
    said = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "</turn>"), (1, 3, "assistant", None),
            (2, 0, None, ""), (None, 5, "assistant", "x"), (None, 5, "assistant", "x")]
    got = {r["conv_id"]: r["formatted"] for r in check(spark, said)}
    assert got[1] == "<turn>user<text>a<more>b</turn>\n<turn>assistant<text>\\l/turn><more></turn>\n"


def test_very_long_conversation(spark):
    check(spark, [(1, n, "assistant" if n % 3 else "user", f"text {n} <" * 5) for n in range(3000)])


def test_extra_columns_are_not_read(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", "x", "y")], "conv_id long, turn long, role string, text string, turns string, segments string")
    assert read_back(chat.format_conversations(rows))[0]["turns"][0]["text"] == "a"


def test_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(rows).collect() == []


def test_the_extra_conversation(spark):
    row = queries.op3_chat_format(spark, SF_DIR).where("conv_id = -7").first()
    assert row["n_turns"] == 2 and row["loss_chars"] == len("\\### Assistant: </turn> ok")
