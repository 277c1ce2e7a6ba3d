"""Column expressions over a JSON object parsed to ``map<string, string>``.

The map keeps apart a key that is present with a null and a key that is absent,
which a parsed struct does not.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that stands for "nothing", in any letter case.
NULL_TEXT = "null"


def null_text_to_empty(value: Column) -> Column:
    """A null, and text that reads ``null`` in any case, becomes ``''``."""
    text = F.coalesce(value, F.lit(NULL_TEXT))
    return F.when(F.lower(text) == NULL_TEXT, "").otherwise(text)


def field_text(parsed: Column, name: str) -> Column:
    """The text under a key (matched by exact name): NULL only if it is absent."""
    return F.when(
        F.map_contains_key(parsed, F.lit(name)), null_text_to_empty(parsed[name])
    )


def field_as(parsed: Column, name: str, kind: T.DataType) -> Column:
    """``field_text`` in a declared type; text that does not fit gives NULL."""
    text = field_text(parsed, name)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def has_fields(parsed: Column, names: Iterable[str]) -> Column:
    """Whether every key is there; one that holds a null is there."""
    wanted = F.array(*[F.lit(n) for n in names])
    return F.size(F.array_except(wanted, F.map_keys(parsed))) == 0


def without_fields(parsed: Column, names: Iterable[str]) -> Column:
    """The other keys, with the null rule applied to their values."""
    unwanted = list(names)
    kept = F.map_filter(parsed, lambda key, _: ~key.isin(unwanted))
    return F.transform_values(kept, lambda _, value: null_text_to_empty(value))
