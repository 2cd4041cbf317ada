"""Small tables that the tests of this folder share."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"

#: Columns that clash with names inside of the operators.
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, id string, key string, size long, "
    "`odd name` string, matches string, n_words string, label string"
)
_LONG = " ".join(f"word{i % 97}x{i % 89}" for i in range(30_000))
_PASSAGE = " ".join(f"passage{i}" for i in range(70))


def _row(doc_id, text, source="a"):
    return (doc_id, text, None, source, None, "r", "i", None, 1, "o", "m", "w", None)


def edge_documents():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, several scripts."""
    return [
        _row(1, "alpha beta gamma " + _PASSAGE + " delta"),
        _row(2, _PASSAGE + " tail of the second one"),
        _row(2, _PASSAGE + " tail of the second one"),
        _row(2, "another text under the same id", None),
        _row(3, None, None),
        _row(4, ""),
        _row(4, ""),
        _row(5, " \t\n\x0b\x0c\r "),
        _row(None, _PASSAGE + " a document without an id", None),
        _row(None, None, None),
        _row(6, _LONG, "b"),
        _row(7, _LONG + " end", "b"),
        _row(8, "one", "b"),
        _row(9, "one", ""),
        _row(10, "ein Täxt mit Ümläuten, ñandú, 漢字 かな,     \U0001f600 und ԯ՘ <|endoftext|> Ende", "é"),
        _row(11, "x" * 5_000 + " " + "y" * 9, "é"),
        _row(12, "same line\nsame line\nsame line\nother", "é"),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(edge_documents() if rows is None else rows, DOCUMENTS).repartition(3)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)
