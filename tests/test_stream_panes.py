import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions.windows import minutes, months
from millrace.plans import pane_files
from millrace.sinks.commits import appended
from millrace.sources.messages import message_stream
from millrace.streaming import panes as panes_module
from millrace.streaming.panes import PaneLedger, PaneRules, Trigger, dropped_so_far, stream_panes, with_heartbeat
from millrace.streaming.sinks import table
from millrace.streaming.windows import closed_windows
from conftest import BASE_S

FAR = ("x", 10**8)
MINUTE = 60_000


class Run:
    """Micro-batches of ``(name, seconds)`` given to a ledger one after the other."""

    def __init__(self, spark, folder, **rules):
        self.spark, self.folder, self.now, self.number = spark, str(folder), 1000, 0
        settings = {"allowed_lateness_ms": MINUTE, "size": minutes(5), "order": ["name"], "clock": lambda: self.now}
        self.ledger = PaneLedger(
            f"{self.folder}/ledger", PaneRules("ts", **(settings | rules)), table(f"{self.folder}/panes"),
            table(f"{self.folder}/late"),
        )

    def batch(self, rows, parts=3):
        df = self.spark.createDataFrame(rows, "name string, s long")
        return df.select("name", F.timestamp_seconds(F.col("s") + BASE_S).alias("ts")).repartition(parts)

    def send(self, *rows, parts=3):
        self.ledger(self.batch(list(rows), parts), self.number)
        self.number += 1
        return self

    def panes(self):
        """{(window start s, shard): [(index, timing, is_first, is_last, names)]}"""
        found = defaultdict(lambda: defaultdict(list))
        for r in appended(self.spark, f"{self.folder}/panes").withColumn("s", F.unix_seconds("window.start")).collect():
            found[r["s"] - BASE_S, r["shard"]][r["pane_index"], r["timing"], r["is_first"], r["is_last"]].append(
                (r["element"], r["name"])
            )
        return {k: [(*p, [n for _, n in sorted(v[p])]) for p in sorted(v)] for k, v in found.items() if k[0] < 10**7}

    def late(self):
        return sorted(r["name"] for r in appended(self.spark, f"{self.folder}/late").collect())

    def open_windows(self):
        return self.spark.read.parquet(f"{self.folder}/ledger/windows/{self.number - 1}").where(
            "start IS NOT NULL AND NOT closed").count()


def test_counts_and_lateness(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(count=3), late=Trigger(count=2))
    run.send(("a", 10), ("b", 20), ("c", 30), ("d", 40)).send(("e", 100), ("f", 310))  # the watermark passes 300 s
    run.send(("g", 200), ("h", 340)).send(("i", 210))                                  # late: two fire
    run.send(("j", 220)).send(("l", 355)).send(("m", 400))                             # one more as the window closes
    run.send(("n", 240)).send(FAR)                                                     # beyond 300 s + 60 s: dropped
    assert run.panes() == {
        (0, 0): [(0, "EARLY", True, False, ["a", "b", "c"]), (1, "ON_TIME", False, False, ["d", "e"]),
                 (2, "LATE", False, False, ["g", "i"]), (3, "LATE", False, True, ["j"])],
        (300, 0): [(0, "EARLY", True, False, ["f", "h", "l"]), (1, "ON_TIME", False, True, ["m"])],
    }
    assert run.late() == ["n"] and dropped_so_far(spark, f"{tmp_path}/ledger") == 1


def test_a_delay_fires_in_a_quiet_window(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(delay_ms=1000), late=Trigger(delay_ms=1000))
    run.send(("a", 10))
    run.now += 999
    run.send(("p", 1))
    assert (0, 0) not in run.panes()
    run.now += 1
    run.send()                                   # no row at all
    assert run.panes()[0, 0] == [(0, "EARLY", True, False, ["a", "p"])]
    run.now += 5000
    run.send(("q", 20))
    run.send(("r", 301))                         # on time, once, before its delay is over
    assert run.panes()[0, 0][1:] == [(1, "ON_TIME", False, False, ["q"])]
    run.send(("s", 30))                          # late, waits
    run.now += 1000
    run.send()
    assert run.panes()[0, 0][2:] == [(2, "LATE", False, False, ["s"])]
    run.send(FAR).send()
    assert run.open_windows() == 1               # that of the far row only
    assert [p[1] for p in run.panes()[0, 0]] == ["EARLY", "ON_TIME", "LATE"]


def test_age_counts_from_the_first_that_waits(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(count=3, delay_ms=30_000))
    for now, *names in [(1000, "a"), (30_999, "b"), (31_000, "c"), (40_000, "d"), (70_000, "e"), (80_000, *"fghi"),
                        (109_999,), (110_000, "j")]:
        run.now = now
        run.send(*[(n, 10) for n in names])
    assert [p[4] for p in run.panes()[0, 0]] == [list("abc"), list("de"), list("fgh"), list("ij")]


@pytest.mark.parametrize("shards", [1, 16])
def test_without_a_late_trigger_nothing_follows_the_end(spark, tmp_path, shards):
    run = Run(spark, tmp_path, early=Trigger(delay_ms=0), shards=shards)
    run.send(*[(f"a{n:02}", n) for n in range(40)]).send(("b", 310))
    run.send(*[(f"c{n:02}", n) for n in range(40)], ("d", 320)).send(FAR)
    got = run.panes()
    kept = [n for (s, _), ps in got.items() if s == 0 for p in ps for n in p[4]]
    assert sorted(kept) == [f"a{n:02}" for n in range(40)] and run.late() == [f"c{n:02}" for n in range(40)]
    assert (len([k for k in got if k[0] == 0]) > 1) == (shards > 1)


def test_a_sequence_is_the_same_from_any_number_of_tasks(spark, tmp_path):
    rows = [[(f"p{i:03}", i % 290) for i in range(k, 300, 3)] for k in range(3)]
    found = []
    for parts in (1, 16):
        run = Run(spark, tmp_path / str(parts), early=Trigger(count=10))
        for some in rows:
            run.send(*some, parts=parts)
        found.append(run.send(FAR).panes())
        elements = sorted(r[0] for r in appended(spark, f"{tmp_path}/{parts}/panes").where("name != 'x'").select("element").collect())
        assert elements == list(range(300))
    assert found[0] == found[1] and [p[0] for p in found[0][0, 0]] == list(range(30))


def test_sequences_without_an_order_are_whole(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(count=7), order=(), shards=4)
    run.send(*[(f"p{i}", i % 290) for i in range(200)], parts=8).send(*[(f"q{i}", i % 290) for i in range(50)]).send(FAR)
    names = [n for ps in run.panes().values() for p in ps for n in p[4]]
    assert sorted(names) == sorted([f"p{i}" for i in range(200)] + [f"q{i}" for i in range(50)])
    for ps in run.panes().values():
        assert [p[0] for p in ps] == list(range(len(ps))) and all(len(p[4]) == 7 for p in ps if p[1] == "EARLY")


def test_exactly_one_pane_is_the_last(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(count=2), late=Trigger(count=2), hold_last=True, shards=2)
    for n in range(6):
        run.send(*[(f"n{n}{i}", 50 * n + i) for i in range(7)])
    run.send(("t", 310)).send(("u", 10), ("v", 11)).send(FAR).send()
    for ps in run.panes().values():
        assert [p[3] for p in ps] == [False] * (len(ps) - 1) + [True]
        assert [p[0] for p in ps] == list(range(len(ps)))
    assert sum(len(p[4]) for ps in run.panes().values() for p in ps) == 45


def test_month_windows_and_rows_without_a_time(spark, tmp_path):
    day = 86_400
    run = Run(spark, tmp_path, late=Trigger(count=1), allowed_lateness_ms=1000, size=months(1))
    run.send(("a", 0), ("b", 30 * day), ("none", None)).send(("c", 31 * day)).send(("d", 1)).send(FAR)
    got = run.panes()
    assert got[0, 0] == [(0, "ON_TIME", True, False, ["a", "b"]), (1, "LATE", False, False, ["d"])]
    assert got[31 * day, 0][0][4] == ["c"] and run.late() == ["none"]


def test_a_batch_that_runs_again_puts_out_the_same(spark, tmp_path):
    run = Run(spark, tmp_path, early=Trigger(delay_ms=1000))
    run.send(("a", 10), ("late", None))
    broken = PaneLedger(f"{tmp_path}/ledger", run.ledger._rules, lambda df, n: 1 / 0, None)
    with pytest.raises(ZeroDivisionError):
        broken(run.batch([("b", 20)]), 1)        # before its delay is over
    run.now += 60_000
    run.send(("b", 20))                          # the plan of the broken run holds
    assert run.panes() == {}
    for _ in range(2):
        run.ledger(run.batch([("c", 30)]), 2)    # once more after it was done
    assert run.panes() == {(0, 0): [(0, "EARLY", True, False, ["a", "b", "c"])]} and run.late() == ["late"]


def test_waiting_rows_are_compacted_and_old_tables_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(panes_module, "COMPACT", 2)
    run = Run(spark, tmp_path, early=Trigger(count=8), shards=2)
    for n in range(12):
        run.send(*[(f"n{n:02}{i}", i) for i in range(3)])
        assert len(list((tmp_path / "ledger/rows").glob("[0-9]*"))) <= 7
        assert len(list((tmp_path / "ledger/windows").glob("[0-9]*"))) <= 2
    run.send(FAR)
    assert sorted(n for ps in run.panes().values() for p in ps for n in p[4]) == sorted(
        f"n{n:02}{i}" for n in range(12) for i in range(3))
    for ps in run.panes().values():
        names = [n for p in ps for n in p[4]]
        assert names == sorted(names) and all(len(p[4]) == 8 for p in ps[:-1])


def plain(batches, size, lateness, early, late):
    """The rules in plain Python: every row of a window in a list, panes cut off its front."""
    windows, out, dropped, seen = {}, defaultdict(list), [], None

    def fire(s, timing, n):
        w = windows[s]
        if n:
            out[s].append((len(out[s]), timing, w["waiting"][:n]))
            w["waiting"], w["since"] = w["waiting"][n:], None

    for now, rows in batches:
        met, came = seen, defaultdict(list)
        for name, t in sorted(rows):
            s = t // size * size
            if met is not None and met >= s + size + (lateness if late else 0):
                dropped.append(name)
            else:
                came[s].append(name)
        for s in set(windows) | set(came):
            w = windows.setdefault(s, {"waiting": [], "since": None, "past": False})
            past = met is not None and met >= s + size
            w["past"] |= past
            trigger, timing = (late, "LATE") if past else (early, "EARLY")
            old = len(w["waiting"])
            w["waiting"] += came[s]
            while trigger and trigger.count and len(w["waiting"]) >= trigger.count:
                fire(s, timing, trigger.count)
                old = 0
            if w["waiting"] and not old:
                w["since"] = now
            if trigger and trigger.delay_ms is not None and w["waiting"] and now - w["since"] >= trigger.delay_ms:
                fire(s, timing, len(w["waiting"]))
        seen = max([t for _, t in rows] + ([] if met is None else [met]), default=None)
        for s, w in list(windows.items()):
            if seen is not None and seen >= s + size and not w["past"]:
                w["past"] = True
                fire(s, "ON_TIME", len(w["waiting"]))
            if seen is not None and seen >= s + size + (lateness if late else 0):
                fire(s, "LATE", len(w["waiting"]))
                del windows[s]
    return dict(out), sorted(dropped)


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_rules_in_plain_python(spark, tmp_path, seed):
    draw = random.Random(seed)
    triggers = [Trigger(count=3), Trigger(delay_ms=1500), Trigger(count=4, delay_ms=2500), None]
    early, late = draw.choice(triggers), draw.choice(triggers)
    batches, now, at = [], 1000, 0
    for n in range(8):
        now += draw.choice([0, 1000, 2000])
        at += draw.randrange(250)
        rows = [(f"{n}-{i:02}", max(0, at - int(draw.expovariate(1 / 150)))) for i in range(draw.randrange(12))]
        batches.append((now, rows))
    run = Run(spark, tmp_path, early=early, late=late)
    for now, rows in batches:
        run.now = now
        run.send(*rows)
    want, dropped = plain(batches, 300, 60, early, late)
    assert {s: [(p[0], p[1], p[4]) for p in ps] for (s, _), ps in run.panes().items()} == want
    assert run.late() == dropped


def _inbox(spark, path, rows):
    sent = [(name, str((BASE_S + s) * 1000)) for name, s in rows]
    spark.createDataFrame(sent, "payload string, timestamp_ms string").coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


def test_a_stream_goes_on_after_a_restart(spark, tmp_path):
    inbox, rules = str(tmp_path / "in"), PaneRules("event_ts", minutes(5), MINUTE, Trigger(count=2))
    for rows in ([("a", 10), ("b", 20), ("c", 30)], [("d", 40)], [FAR]):
        _inbox(spark, inbox, rows)
        writer = stream_panes(message_stream(spark, inbox, maxFilesPerTrigger=1), rules, str(tmp_path / "ledger"),
                              str(tmp_path / "ck"), table(str(tmp_path / "out")))
        writer.trigger(availableNow=True).start().awaitTermination()
    got = appended(spark, str(tmp_path / "out")).where("payload != 'x'").groupBy("pane_index", "timing").count().collect()
    assert sorted(map(tuple, got)) == [(0, "EARLY", 2), (1, "EARLY", 2)]


def test_a_heartbeat_fires_delays_without_messages(spark, tmp_path):
    inbox, fired = str(tmp_path / "in"), []
    _inbox(spark, inbox, [("a", 10)])
    sent = with_heartbeat(message_stream(spark, inbox))
    rules = PaneRules("event_ts", minutes(5), MINUTE, Trigger(delay_ms=1000))
    query = stream_panes(sent, rules, str(tmp_path / "ledger"), str(tmp_path / "ck"),
                         lambda df, n: fired.extend(r["payload"] for r in df.collect())).start()
    try:
        until = time.time() + 60
        while not fired and time.time() < until:
            time.sleep(0.2)
    finally:
        query.stop()
    assert fired == ["a"]


def test_pane_files_have_their_names_and_bytes(spark, tmp_path):
    inbox = str(tmp_path / "in")
    _inbox(spark, inbox, [(f"m{i:02}é", i) for i in range(25)])
    _inbox(spark, inbox, [("x", 10**8)])
    writer = pane_files.writer(
        message_stream(spark, inbox, maxFilesPerTrigger=1), str(tmp_path / "out"), str(tmp_path / "ledger"),
        str(tmp_path / "ck"), "requests", pane_elements=10, order=["payload"],
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    root = tmp_path / "out"
    files = {str(p.relative_to(root)): p.read_bytes().decode() for p in root.rglob("*") if p.is_file() and not p.name.startswith(".")}
    hour = "requests/2024-01-01T00:59:59.999Z"
    assert files == {f"{hour}/{n}": "".join(f"m{i:02}é" for i in range(10 * n, min(25, 10 * n + 10))) for n in range(3)}


def test_windows_that_close_once(spark, tmp_path):
    inbox = str(tmp_path / "in")
    for rows in ([("a", 10), ("b", 20)], [("c", 310)], [("d", 320)], [("late", 30)], [FAR]):
        _inbox(spark, inbox, rows)
    closed = closed_windows(message_stream(spark, inbox, maxFilesPerTrigger=1), "event_ts", minutes(5), F.count("*").alias("n"))
    closed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).select(F.unix_seconds("window.start").alias("s"), "n").collect()
    assert {r["s"] - BASE_S: r["n"] for r in rows} == {0: 2, 300: 2}


def test_months_close_once(spark, tmp_path):
    inbox, day = str(tmp_path / "in"), 86_400
    for rows in ([("a", 0), ("b", 31 * day - 1)], [("c", 31 * day)], [("late", 5), ("d", 59 * day)], [("e", 63 * day)],
                 [("gone", 6)], [FAR]):
        _inbox(spark, inbox, rows)
    sent = message_stream(spark, inbox, maxFilesPerTrigger=1)
    closed = closed_windows(sent, "event_ts", months(1), F.sort_array(F.collect_list("payload")).alias("names"),
                            allowed_lateness_ms=20 * day * 1000)
    closed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(
        F.date_format("window.start", "yyyyMMdd").alias("s"), F.date_format("window.end", "yyyyMMdd").alias("e"), "names")
    assert {(r["s"], r["e"]): r["names"] for r in got.collect()} == {
        ("20240101", "20240201"): ["a", "b", "late"], ("20240201", "20240301"): ["c", "d"], ("20240301", "20240401"): ["e"]}
    with pytest.raises(ValueError, match="28 days"):
        closed_windows(sent, "event_ts", months(1), F.count("*"), allowed_lateness_ms=29 * day * 1000)


def test_what_is_refused(spark):
    with pytest.raises(ValueError):
        Trigger()
    df = spark.range(1).selectExpr("timestamp_seconds(id) AS event_ts", "id AS shard")
    with pytest.raises(ValueError, match="shard"):
        stream_panes(df, PaneRules("event_ts", minutes(5), 0), "l", "c", lambda df, n: None)
    with pytest.raises(ValueError, match="shards"):
        stream_panes(df.drop("shard"), PaneRules("event_ts", minutes(5), 0, shards=0), "l", "c", lambda df, n: None)
