"""Small tables for the tests of the training-data operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: names that the operators use inside
CLASHES = ["key", "node", "n", "word", "h", "lid", "score", "start", "len", "comp", "row", "sig", "part", "spans"]


def sentence(rnd: random.Random, n: int, vocab: int = 4000) -> str:
    return " ".join(f"w{rnd.randrange(vocab):x}" for _ in range(n))


def edge_rows():
    rnd = random.Random(5)
    long = "\n".join(sentence(rnd, 40) for _ in range(500))          # 20,000 words
    base = sentence(rnd, 80)
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"),      # copies, a repeated row
        (3, None, "en", None), (4, "", None, "a"), (5, " \t\n\x0b ", "en", "b"), (6, "one", "en", "b"),
        (7, "one two three", "en", "b"), (8, "ONE two  three", "en", "b"), (None, base + " tail", "en", "a"),
        (None, None, None, None), (9, long, "en", "a"), (10, "x" * 200_000, "en", "a"),
        (11, "a a a a a a a a a a", "en", "a"), (12, base + " more words", "de", "a"),
        (13, "é́ ß   \U0001f600 \x00 end", "fr", "c"),
    ]


def documents(spark, rows, clashes=False):
    df = spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
