"""Runs of words that repeat with a period, found by multi-scale minimizers.

A run is a stretch of words, as long as can be, in which words ``period`` apart are
the same, and which holds its smallest period ``LEAST_TIMES`` times or more.

Short periods are found by comparing the text with itself, shifted by each of them.
For periods of more than ``h`` and up to ``2 h`` words, at each scale ``h``:

* hashes of ``2 h`` words are taken from each place on, and in each window of ``h``
  places the smallest is a minimizer;
* inside a run minimizers repeat at the distance of its period, and no run of ``2 h``
  words comes back sooner, since the period is the smallest; so two minimizers next to
  each other among those of one hash are a period apart;
* such a pair is the seed of a run, which is extended word by word to both sides.

A run of four periods or more has room for a window and for the same one a period
later at its scale, so none is missed.  Extension compares words, so none is made up.
Everything is done in time ``n log^2 n`` at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.grams import doubled, numbered, over_windows, words_of
from millrace.llm.shared import text_or_empty

# What is a run.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Periods that are looked for one by one; a power of two.
SHORT = 8
_BLOCK = 64  # words compared at first when a seed is extended

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that are true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _agreed(left: np.ndarray, right: np.ndarray) -> int:
    """How many words two stretches have in common from their beginning on."""
    done, block, n = 0, _BLOCK, min(len(left), len(right))
    left, right = left[:n], right[:n]
    while done < n:
        unlike = left[done : done + block] != right[done : done + block]
        if unlike.any():
            return done + int(unlike.argmax())
        done, block = min(done + block, n), 2 * block
    return n


def _long_enough(length: int, period: int) -> bool:
    return length >= max(LEAST_WORDS, LEAST_TIMES * period)


def _short_periods(words: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    for period in range(1, min(SHORT, len(words) // LEAST_TIMES) + 1):
        same = words[period:] == words[:-period]
        least = max(LEAST_WORDS, LEAST_TIMES * period) - period
        if np.count_nonzero(same) < least:
            continue
        starts, ends = _stretches(same)
        for n in np.flatnonzero(ends - starts >= least):
            found.setdefault((int(starts[n]), int(ends[n]) + period), period)


def _seeds(hashes: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of minimizers that come next to each other among their like,
    by distance and place."""
    least = over_windows(np.minimum, hashes, half)
    around = np.concatenate((np.zeros(half - 1, np.uint64), least, np.zeros(half - 1, np.uint64)))
    at = np.flatnonzero(over_windows(np.maximum, around, half) == hashes)
    order = np.argsort(hashes[at], kind="stable")
    values, at = hashes[at][order], at[order]
    apart = np.diff(at)
    seeds = np.flatnonzero((values[1:] == values[:-1]) & (apart > half) & (apart <= 2 * half))
    seeds = seeds[np.lexsort((at[seeds], apart[seeds]))]
    return at[seeds], apart[seeds]


def _long_periods(words: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    hashes, half, step = words.astype(np.uint64), SHORT, 1
    while LEAST_TIMES * (half + 1) <= len(words):
        while step < 2 * half:
            hashes, step = doubled(hashes, step), 2 * step
        last, end = 0, 0
        for at, period in zip(*(seeds.tolist() for seeds in _seeds(hashes, half))):
            if period == last and at + period < end:
                continue  # in the stretch before
            after = _agreed(words[at:], words[at + period :])
            before = _agreed(words[:at][::-1], words[: at + period][::-1])
            last, start, end = period, at - before, at + period + after
            if _long_enough(end - start, period):
                found.setdefault((start, end), period)
        half *= 2


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start and period; words as numbers.

    A stretch that repeats after several periods is the very same stretch for each;
    the smallest is met first.
    """
    found: dict[tuple[int, int], int] = {}
    _short_periods(words, found)
    _long_periods(words, found)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def _dropped(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of ``n`` words a run has after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of such ones the first, and of these the shortest period."""
    best = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _row(text: str) -> dict:
    words = words_of(text)
    runs = find_runs(numbered(words)) if len(words) >= LEAST_WORDS else []
    if runs:
        words = [words[n] for n in np.flatnonzero(~_dropped(runs, len(words)))]
    return {"runs": [_named(run) for run in runs], "strongest": _named(_strongest(runs)),
            "collapsed": b" ".join(words).decode()}


def _named(run: tuple[int, int, int] | None) -> dict | None:
    return run and dict(zip(("start", "length", "period"), run))


def _finder():
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    kind = pa.struct([("runs", pa.list_(run)), ("strongest", run), ("collapsed", pa.string())])

    @F.arrow_udf(f"runs array<{RUN}>, strongest {RUN}, collapsed string")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([_row(text.as_py()) for text in texts], kind)

    return find


def periodic_runs(docs: DataFrame, text_col: str | Column = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, runs, strongest, collapsed`` of every row.

    ``runs`` are all runs by start and period, counted in words from 0; ``strongest`` is
    the one with the most periods (of ties the first, then the shortest period), or null;
    ``collapsed`` is the text's words, joined by a space, without those that a run has
    after its first period.  A null or blank text has no runs and collapses to an empty
    one.  Repeated rows and ids stay as they are; other columns are not read; an empty
    table gives no rows.  A text is worked on as a whole, in one task.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), _finder()(text_or_empty(text_col)).alias("found"))
    return found.select("doc_id", "found.runs", "found.strongest", "found.collapsed")


def as_lines(runs: str | Column = "runs") -> Column:
    """``start,length,period`` and a line feed of each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
