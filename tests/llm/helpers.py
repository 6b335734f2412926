"""Small documents with the cases that every operator must bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, data string, mark long, size int, key string, word string, node long"


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """doc_id, text and lang, with further columns whose names the operators use inside."""
    full = [(i, text, lang, "s", None, "x", 7, 3, "k", "w", 5) for i, text, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, n: int, vocabulary: int = 300) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null and empty texts, one word, white space only, a very long text, a repeated row, a null language."""
    long = prose(1, 30_000)
    return [
        (1, None, "en"),
        (2, "", "en"),
        (3, "alone", None),
        (4, " \n\t ", "en"),
        (5, long, "en"),
        (6, "the cat sat on the mat again", None),
        (6, "the cat sat on the mat again", None),
        (7, "the cat sat on the mat again", "de"),
    ]


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(spark: SparkSession) -> list[tuple[int, str]]:
    return [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
