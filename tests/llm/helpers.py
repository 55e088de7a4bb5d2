"""Small awkward tables for the tests of this folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = ("The house of the old man was on the hill and it was cold in the winter, but the people of the town came "
         "to see him for his stories, and they sat by the fire until the night was over.")

AWKWARD = [
    (1, PROSE, "en", "a", None),
    (2, PROSE, "en", "a", 3),
    (2, PROSE, "en", "a", 3),  # a repeated row
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "fr", "b", 4),
    (6, "\U0001f600 日本語 x́ \x00 end", None, "a", 9),
    (7, "one", "en", None, 3),
    (8, "word " * 3000 + "end", "en", "a", 0),
    (None, PROSE + " And more of it.", "en", "a", 1),
]


def awkward(spark: SparkSession):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use inside."""
    df = spark.createDataFrame(AWKWARD, DOCS)
    return df.withColumns({c: F.lit("x") for c in ("size", "_rank", "_bucket", "target", "copies", "sig", "rejected", "_t", "n_words", "kept", "_hash", "_text", "lang_pred", "score", "fp", "a", "spans", "_position", "rate")})


def clashing(spark: SparkSession):
    """The same with further names that operators use inside, and one with a dot."""
    names = ("h", "_key", "node", "a.b", "c0", "_row", "root", "first", "_id", "_lines", "item", "_copy", "_other", "held_out", "entropy")
    df = awkward(spark)
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])


def empty(spark: SparkSession):
    return spark.createDataFrame([], DOCS)
