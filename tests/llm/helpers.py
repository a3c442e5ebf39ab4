"""Small tables with the columns of the large ones, and columns that clash with names used inside."""

from tests.conftest import SF_DIR  # noqa: F401

ODD = [
    (1, "Hello world. This is a text."),
    (2, None),
    (3, ""),
    (4, "Hello world. This is a text."),
    (4, "Hello world. This is a text."),
    (None, "no id here"),
    (5, "é🙂 <|endoftext|> ▁ '  x\n\n\t end"),
    (6, "word " * 4000),
    (7, "12345 ... !!!"),
]


def documents(spark, rows):
    """``doc_id`` and ``text`` with further columns; some are named like what operators make."""
    made = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    return made.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "length(text) as n_chars", "1 as piece", "'x' as h", "2 as score")


def as_rows(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
