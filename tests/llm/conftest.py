import random

import pytest
from pyspark.sql import types as T

CLASH = ["row", "words", "size", "key", "shard", "bucket", "place", "score", "hits", "items", "start", "label"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in CLASH]
)


def edge_rows():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base = prose(80)
    texts = [None, "", " \n\t ", "one", "Ünïcode ÄÖ 日本語 text with spaces", base, base, base.replace("w1 ", "zz ", 1), base + " tail of it", prose(30), "same line here\nsame line here\nsame line here\nother",
             "a b c d e a b c d e a b c d e", "!!! ### $$$ " * 20, prose(40_000), "x" * 50_000, "İstanbul <|endoftext|> it's we'll", "퟿\U0010ffff é combining ́ mark"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, [None, "en", "de"][i % 3], [None, "a", "b", "a"][i % 4], None if t is None else len(t), *[i] * len(CLASH)))
    return [*rows, rows[5]]  # a repeated row


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
