import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"

#: Columns whose names the operators use inside.
CLASHES = ("id", "key", "node", "label", "class", "gram", "place", "words", "seed", "x0", "score", "shard", "size", "kept")


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text) as a table with extra columns of clashing names."""
    def build(rows, **columns):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        fields += [T.StructField(c, T.StringType()) for c in CLASHES]
        return spark.createDataFrame([(*r, *["?"] * len(CLASHES)) for r in rows], T.StructType(fields))
    return build


@pytest.fixture(scope="session")
def prose():
    """A maker of repeatable invented prose."""
    def text(seed, words=200, vocabulary=3000):
        r = random.Random(seed)
        return " ".join("".join(chr(97 + (r.randrange(vocabulary) * p) % 26) for p in (1, 3, 7, 11)) + str(r.randrange(vocabulary))
                        for _ in range(words))
    return text


EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (None, "no id"), (None, None),
    (6, "Ünïcödé ǅ \U0001F600 中文 " * 30), (7, "a" * 5000), (8, "\n\n\n"), (9, "\x0b\x0c x \x85 y  z"), (10, "word " * 20000),
]


@pytest.fixture(scope="session")
def edge():
    return EDGE


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
