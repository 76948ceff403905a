import os

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, shard int, kept boolean"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return SF


def rows_of(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def sample(spark, sf):
    return rows_of(spark, sf)


def frame(spark, rows):
    """Documents with extra columns whose names the operators use too."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, 0.5, 3, None) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up many jugs of liquid paper. " * 2

EDGE = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one", "b"), (5, "One two", "b"), (6, "one two", None),
    (7, PASSAGE, "a"), (8, PASSAGE, "a"), (8, PASSAGE, "a"), (9, PASSAGE.replace("fox", "cat", 1), "c"),
    (None, PASSAGE, "c"), (None, None, None), (10, "é ü ☃ " * 40, "c"), (11, "x " * 60_000, "a"), (12, "y" * 150_000, "b"),
    (13, "\n".join(f"line {k} of a very long text that goes on" for k in range(4000)), "d"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 1, 0), (8, 0, 1), (8, 1, 0), (None, 0, 1), (9, None, None), (13, 0, 1), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.limit(0)
