from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    vocabulary = "the of and a in to is was he for it with as his on be at by i this had not are but from or an né für ß".split()
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", ".", "\n", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 90)) for _ in range(30)]
    passage = prose(rng, 40)
    rows = [(i, t, "en", f"src{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, passage + "\n" + prose(rng, 12), "en", "src0", 0) for i in range(6)]
    rows += [(200 + i, texts[0], None, None, None) for i in range(5)]  # copies
    rows += [(300, None, None, None, None), (301, "", "en", "src1", 0), (302, " \n\t ", "en", None, 3),
             (303, "x" * 70_000, "en", "src2", 70_000), (304, prose(rng, 9_000), "fr", "src3", 0),
             (305, "é 日本語   <|endoftext|> 'll don't 1234 ½ \x0b ok\r\n", "en", "src1", 0),
             (7, texts[7], "en", "src3", len(texts[7])), (7, texts[7], "en", "src3", len(texts[7]))]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for clash in ("size", "shard", "score", "piece", "bucket", "key", "digest", "ids", "fp", "row", "held_out", "target"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def with_null_ids(odd_docs, spark):
    """The same and rows without an id."""
    more = [(None, "no id here", "en", "src0", 1), (None, None, None, None, None), (None, "no id here", "en", "src0", 1)]
    return odd_docs.unionByName(spark.createDataFrame(more, DOCS), allowMissingColumns=True)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
