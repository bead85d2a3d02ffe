import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    # Names that the operators use inside.
    + [T.StructField(n, T.StringType()) for n in ("key", "id", "tid", "block", "word", "spans", "copies", "a", "_label", "score")]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from (doc_id, text), with null and clashing further columns."""

    def build(rows):
        full = [(i, t, None, None, None if t is None else len(t), *["x"] * 10) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return build


@pytest.fixture(scope="session")
def prose():
    """Invented text of n words, the same for the same seed."""

    def build(n, seed, parts=("ba", "ke", "li", "mo", "nu", "ro", "ti", "su", "the", "wo")):
        r = random.Random(seed)
        return " ".join("".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(n))

    return build


EDGE = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "no key here"), (5, "é" * 50), (6, "word " * 3000), (7, "\x00\x1f  odd")]


@pytest.fixture(scope="session")
def edge():
    return EDGE
