import random

import pytest
from pyspark.sql import functions as F

WORDS = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, short and very long texts, repeated rows and ids, and clashing columns."""
    rows = [
        (1, ""),
        (2, None),
        (3, " \n\t\x0b "),
        (4, "Word"),
        (5, "x" * 120_000),
        (6, prose(1, 30_000)),
        (7, prose(2, 80)),
        (7, prose(2, 80)),  # a repeated row
        (8, prose(2, 80)),  # a tie
        (9, "Ünïcödé ſecret K 漢字 🙂\r\n" * 40),
        (10, "\n".join([prose(3, 8)] * 5)),
        (None, prose(4, 70)),
        (11, prose(5, 60)),
        (11, prose(6, 60)),  # another text under the same id
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {c: F.lit("x") for c in ("score", "runs", "row", "node", "component_id", "label", "version", "key", "_text", "_id", "held_out", "host")}
    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), **extra})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def few_docs(spark, smallest):
    return spark.read.parquet(f"{smallest}/documents.parquet")
