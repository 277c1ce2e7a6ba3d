"""Fill-in-the-middle texts, cut by units with a sparse index of multibyte characters.

A text is cut in three, and its middle moved to the end, so that a model learns to fill
gaps.  Cuts are wanted both in bytes, where a text is sliced without being decoded, and
in code points, which is how spans are told.  Only characters of several bytes make the
two differ; the index holds their places and the bytes in excess up to each, and a
binary search in it turns one kind of cut into the other.  Where a text has no such
characters the index is empty, and nothing but the cut itself is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import text_or_empty

# What marks the parts, and how often texts are changed, in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT = 50, 80
UNITS = ("token", "char")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class SparseIndex:
    """Where a text's characters of several bytes are, and how many bytes they add."""

    def __init__(self, data: np.ndarray) -> None:
        self.n_bytes = len(data)
        lead = np.flatnonzero(data >= 0xC0)
        self._extra = np.concatenate(([0], np.cumsum(1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0), dtype=np.int64)))
        self._bytes = lead  # the first byte of each
        self._chars = lead - self._extra[:-1]  # its place in code points
        self.n_chars = self.n_bytes - int(self._extra[-1])

    def to_bytes(self, chars):
        """The byte at which the character of each number begins."""
        return chars + self._extra[np.searchsorted(self._chars, chars, "left")]

    def to_chars(self, cuts):
        """The number of the character that begins at each byte."""
        return cuts - self._extra[np.searchsorted(self._bytes, cuts, "left")]


def token_ends(data: np.ndarray) -> np.ndarray:
    """The byte after each token: white space with the word that follows, or at the end alone.

    White space is told by single bytes, which are never part of another character.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(data))


def cut(raw: bytes, first: int, second: int, unit: str) -> tuple[int, list[int], list[int]]:
    """How many units there are, and where prefix and middle end, in bytes and code points.

    ``first`` and ``second`` are any numbers; each is taken modulo one more than the
    units, and the smaller cuts first.
    """
    data = np.frombuffer(raw, np.uint8)
    index = SparseIndex(data)
    ends = token_ends(data) if unit == "token" else None
    n = index.n_chars if ends is None else len(ends)
    units = np.sort([first % (n + 1), second % (n + 1)])
    if ends is None:
        return n, index.to_bytes(units).tolist(), units.tolist()
    cuts = np.concatenate(([0], ends))[units]
    return n, cuts.tolist(), index.to_chars(cuts).tolist()


def _row(text: str, draws: list[int], unit: str, fim: int, spm: int) -> dict:
    raw = text.encode()
    first, second, form, order = draws
    n, (a, b), (a_chars, b_chars) = cut(raw, first, second, unit)
    if not raw or form % 100 >= fim or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    marks = {"P": PREFIX.encode() + prefix, "S": SUFFIX.encode() + suffix, "M": MIDDLE.encode() + middle}
    kind = "spm" if order % 100 < spm else "psm"
    return {"n": n, "form": kind, "prefix_chars": a_chars, "middle_chars": b_chars - a_chars,
            "output": b"".join(marks[part.upper()] for part in kind).decode()}


def _draws(seed: int, id_col: str) -> Column:
    """Four numbers of 32 bits for each id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * n, 8), 16, 10).cast("long") for n in range(4)])


def _maker(unit: str, fim: int, spm: int):
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output", pa.string())])

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def make(texts: pa.Array, draws: pa.Array) -> pa.Array:
        return pa.array(
            [_row(t.as_py(), d, unit, fim, spm) for t, d in zip(texts, draws.to_pylist())], kind
        )

    return make


def infilled(docs: DataFrame, seed: int, unit: str = "token", fim_percent: int = FIM_PERCENT,
             spm_percent: int = SPM_PERCENT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``unit`` is what is cut between, tokens or characters; ``n`` counts them.  ``form``
    is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``:
    so many in a hundred are changed, and of these so many are ``spm``, by a hash of seed
    and id.  Empty texts and those which have one of the marks stay plain.  A null text
    is empty; rows of one id and text are changed alike; other columns are not read; an
    empty table gives no rows.  A text is worked on as a whole, in time that grows with
    its length.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    made = _maker(unit, fim_percent, spm_percent)(text_or_empty(text_col), _draws(seed, id_col))
    return docs.select(F.col(id_col).alias("doc_id"), made.alias("made")).select("doc_id", "made.*")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of.

    A text with marks was left plain, so the first mark of each kind is the one put in.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    middle = F.split(output, MIDDLE, 2)
    if_psm = F.split(F.substring(middle[0], len(PREFIX) + 1, 1 << 30), SUFFIX, 2)
    if_spm = F.split(F.substring(middle[0], len(SUFFIX) + 1, 1 << 30), PREFIX, 2)
    return (
        F.when(form == "psm", F.concat(if_psm[0], middle[1], if_psm[1]))
        .when(form == "spm", F.concat(if_spm[1], middle[1], if_spm[0]))
        .otherwise(output)
    )
