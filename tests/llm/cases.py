"""Rows that every operator must take: nulls, empty and long texts, repeats, and columns with clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, component_id long, kept boolean, label string, size long, row string, ids string, stats string"
)
LONG = " ".join(f"word{i % 5000} and the of" for i in range(60_000))


def rows():
    def row(doc_id, text, lang="en", source="a"):
        return (doc_id, text, lang, source, len(text or ""), 0.5, 7, True, "x", 3, "r", "i", "s")

    plain = "the quick brown fox jumps over the lazy dog and runs away from it at once"
    return [
        row(1, plain), row(2, plain, source=None), row(3, None), row(4, ""), row(5, " \n\t "), row(6, "one two"), row(7, "one two"),
        row(8, "... 123 !!!"), row(9, LONG, source="b"), row(10, LONG, None, "b"), row(None, plain), row(11, plain + " today"), row(11, plain + " today"),
        row(12, "ein Satz mit vielen Wörtern auf Deutsch und noch etwas mehr davon", "de", "c"), row(13, "привет мир", None, "c"),
    ]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
