"""Small tables with the odd cases that every operator must stand."""

from pyspark.sql import SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, score double, node long, value string"
)

LONG = " ".join(f"w{k % 977}" for k in range(30_000))

ODD = [
    (1, "The first text has some plain words in it, more than a window of thirteen words has.", "en", "a"),
    (2, "The first text has some plain words in it, more than a window of thirteen words has.", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, " \t\n\x0b\f\r ", "fr", "b"),
    (6, "one", "fr", None),
    (7, LONG, "de", "c"),
    (8, LONG + " end", "de", "c"),
    (1, "The first text has some plain words in it, more than a window of thirteen words has.", "en", "a"),
    (None, "No id has this text, which is otherwise like any other text with a few words.", None, "a"),
    (None, None, None, None),
    (9, "été à la plage; 12345 !!!", "fr", "d"),
    (10, "12345 ... !!!", "en", "d"),
    (11, "a b c " * 40, "en", "d"),
]


def odd_documents(spark: SparkSession, rows=None):
    """Documents with nulls, blanks, long texts, repeated rows and clashing extra columns."""
    full = [(*r, len(r[1] or ""), 7, 0.5, 1, "x") for r in (ODD if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA)


def no_documents(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)
