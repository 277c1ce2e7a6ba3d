"""Rows that every operator on documents must take."""

from millrace.session import with_package

SF_DIR = "/root/testdata/sf0.001"

#: Nulls in both columns, empty and blank texts, repeated rows, ties, other scripts, long texts.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "one"), (None, None), (5, "one two three four"),
    (6, "Ünïcode 漢字 🙂 text of a few words"), (7, "a b c d e f g h i j " * 3000), (8, "x" * 50_000),
    (9, "the same words the same words the same words"), (9, "another text under the same id"),
]


def documents(spark, rows):
    """Documents from ``(doc_id, text)``, with columns whose names the operators use themselves."""
    schema = (
        "doc_id long, text string, lang string, source string, row_no long, digest string, at int, key long,"
        " copies int, kept boolean, word int, maybe string, leaf string, ids string"
    )
    rows = [(i, t, "en", f"src{n % 3}", 1, "d", 2, 3, 4, False, 5, "m", "l", "x") for n, (i, t) in enumerate(rows)]
    return with_package(spark).createDataFrame(rows, schema)
