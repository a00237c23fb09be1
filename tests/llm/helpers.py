"""Small tables with awkward rows, shared by the tests of this folder."""

import pyspark.sql.types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, texts, extra=None):
    """A documents table; a text may be (id, text)."""
    rows = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        rows.append((i, t, None, None, None if t is None else len(t)))
    df = spark.createDataFrame(rows, DOCS)
    return df


def awkward(words=400):
    """Texts with nulls, empties, ties, repeated rows and one long row."""
    long = " ".join(f"w{i % 97} über{i % 13}." for i in range(20 * words))
    return [None, "", " ", "one", "Two words", "a  b\n\n c ", "é" * 50, "日本 語 x", (None, "no id here at all"), (4, "Two words"), (4, "Two words"), long, long, " ".join(f"Word{i}" for i in range(words))]


def sample(spark, n=None):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return rows if n is None else rows.limit(n)


def collected(df):
    return [r.asDict() for r in df.collect()]
