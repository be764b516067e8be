"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

# Names that operators use inside.
CLASHING = ["key", "fp", "hash", "line", "doc", "draw", "bucket", "record", "place", "n", "bad", "stats", "ids", "n_tokens", "lines_total", "__at"]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in CLASHING]])


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvéüñ") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    rng = random.Random(seed * 7919 + n)
    return " ".join(rng.choice(words) for _ in range(n))


def awkward():
    long = "\n".join(prose(5, 60) for _ in range(3)) + "\n" + prose(6, 20_000)
    return [
        (None, "one two three four five six seven"), (None, None), (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "word"), (5, "a b c"), (5, "a b c"),
        (6, long), (6, long), (6, "same key, other text of more than five words"), (7, "İ ß ﬁ Σς 日本語 😀́   x y <|endoftext|> <s> ▁▁ it's"),
        (8, "x" * 3000), (9, " " * 3000 + "end" + "\n" * 500), (10, "one two three four five six seven"), (11, "One  two three, four five six seven."),
        (12, "0123456789" * 400), (13, "\n\n\na b c d e f\n\na b c d e f\n"),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *range(len(CLASHING))) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
