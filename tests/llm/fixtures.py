"""Small awkward tables that the tests of this folder share."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *[T.StructField(n, T.StringType()) for n in ("size", "words", "key", "label", "n", "kept", "taken", "shard", "part", "host")],
])

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PASSAGE = "one fine line that opens the passage here\nand a second line that goes on for some words\nthen a third line ends it at last"
TEXTS = [
    (1, None, "a"), (2, "", "a"), (3, "  \n\t ", None), (4, "Hello", "b"), (5, LONG, "b"), (6, LONG + " tail", "b"),
    (7, "Released under the MIT License. Some more words follow here to make it ten", "c"),
    (8, "Released under the MIT License. Some more words follow here to make it ten", "c"),
    (8, "Released under the MIT License. Some more words follow here to make it ten", "c"),
    (9, "licensed under cc by nc 4 0 and cc-BY-nc again, Apache License, Version 2.0", None),
    (None, "a row without a name but with a few words of its own text", "z"),
    (10, "x y z " * 200, "a"), (11, "\n".join(["same line again and again"] * 6), "a"),
    (12, f"first words of twelve\n{PASSAGE}\nlast words", "b"), (13, f"other words of thirteen\n{PASSAGE}\nend", "b"),
    (14, "É Ünïcode – “quotes” 漢字 \U0001F600   K İ under the M\u0130T License \u212Aind", "é"), (15, "#*$%&|<>" * 30, "a"),
]


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), *["x"] * 10) for d, t, s in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
