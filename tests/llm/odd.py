"""Rows every operator must survive, and small builders."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997}" for i in range(60_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t  "), (4, LONG), (5, "same text twice over here now"),
         (5, "same text twice over here now"), (6, "Größe 中文 \U0001d573 é́ token=abcdef123456"), (None, "no id at all"),
         (7, "x"), (8, "line one\n\n| a | b | c |\nline three!!"), (9, "a" * 5000)]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in (
                          "size", "taken", "fp", "row", "items", "spans", "n_words", "toxicity", "quality", "label",
                          "blob", "odd name.with `marks`")])
EXTRA = len(SCHEMA) - 5


def documents(spark, texts=None):
    """The odd texts as documents with extra columns whose names operators also use."""
    rows = [(i, t, None if i == 3 else "en", None if i in (2, None) else f"src{(i or 0) % 3}", None if t is None else len(t))
            + tuple(f"extra{k}" for k in range(EXTRA)) for i, t in (TEXTS if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
