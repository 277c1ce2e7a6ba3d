"""Secrets in texts: known forms, and random strings found by how badly they compress to tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import Vocabulary, encoding

# The forms, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # leftmost whole runs of at least 24

# Strings that may be random, and what of them is known not to be secret.
RUN_CHARS = 20
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{RUN_CHARS},}}")
VALUE = re.compile("[^=]+")
PIECE = re.compile(r"(?i:(?<![0-9a-z])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-z]))|[^/_-]+")
DIGEST = re.compile(r"(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
UUID = re.compile(r"(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})")
DIGITS_AND_MARKS = re.compile(r"[0-9+/_=-]*")
#: Below so many characters for each token a string is taken as random.
CHARS_PER_TOKEN = 2.0
#: Runs are encoded in slices, so that the time for a very long one grows with its length only.
SLICE = 1_000


def _known(run: str) -> bool:
    return any(form.fullmatch(run) for form in (DIGEST, UUID, DIGITS_AND_MARKS))


def _dense(run: str, own) -> bool:
    tokens = sum(len(own.encode_ordinary(run[i : i + SLICE])) for i in range(0, len(run), SLICE))
    return len(run) < CHARS_PER_TOKEN * tokens


def _is_random(run: str, own) -> bool:
    return not _known(run) and _dense(run, own)


def _random_spans(run: str, own) -> list[tuple[int, int]]:
    """The random strings of a run: the run itself, or else what stands between its
    ``=``, or else the longest rows of its pieces that are random each.

    Each is told by its own characters a token, so that what is readable before or
    after it does not hide it; strings that are cut by ``/``, ``_`` or ``-`` stay whole.
    """
    if _known(run):
        return []
    forms = any(len(m[0]) >= RUN_CHARS and _known(m[0]) for m in PIECE.finditer(run.replace("=", "/")))
    if not forms and _dense(run, own):
        return [(0, len(run))]
    spans = []
    for part in VALUE.finditer(run):
        if len(part[0]) < RUN_CHARS or _known(part[0]):
            continue
        if not forms and _dense(part[0], own):
            spans.append(part.span())
            continue
        start = end = None
        pieces = [m for m in PIECE.finditer(run, part.start(), part.end())]
        for m in [*pieces, None]:
            if m is not None and not (len(m[0]) >= RUN_CHARS and _known(m[0])) and _dense(m[0], own):
                start, end = (m.start() if start is None else start), m.end()
                continue
            if start is not None and end - start >= RUN_CHARS and _is_random(run[start:end], own):
                spans.append((start, end))
            start = end = None
    return spans


def _free(runs: Iterable[tuple[int, int]], base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What sorted spans ``base`` leave of sorted ``runs``, in one pass over both."""
    n, covered = 0, 0
    for start, end in runs:
        at = max(start, covered)
        while n < len(base) and base[n][0] < end:
            if base[n][0] > at:
                yield at, base[n][0]
            covered = max(covered, base[n][1])
            at = max(at, covered)
            n += 1
        if at < end:
            yield at, end


def find(text: str, own) -> list[tuple[int, int, int]]:
    """``(start, number of the kind, end)``, sorted.  Base kinds overlap freely; a random
    string is only added where no base span lies, and may stand next to one."""
    spans = []
    folded = text.lower()
    if any(word in folded for word in ("passw", "secret", "token", "api")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted((start, end) for start, _, end in spans)
    for start, end in _free((m.span() for m in RUN.finditer(text)), base):
        if end - start >= RUN_CHARS:
            spans += [(start + a, 3, start + b) for a, b in _random_spans(text[start:end], own)]
    return sorted(spans)


def secrets(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``start, kind, end`` in code points, end exclusive.

    Sorted by start, then by kind as listed.  One row per row; a null text is
    empty; an empty table gives no rows; other columns are not read.  A text is read
    as a whole, in time that grows with its length.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])

    @F.arrow_udf("array<struct<start:bigint,kind:string,end:bigint>>")
    def spans(texts: pa.Array) -> pa.Array:
        own = encoding(sent.value)
        rows = (find(t.as_py() or "", own) for t in texts)
        return pa.array(
            [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in row] for row in rows], pa.list_(span)
        )

    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
