"""Small document tables for the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns of documents, and others whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, `key` string, id long, one int, grams int"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for doc, text, *rest in rows:
        lang, source = (*rest, "en", "s1")[:2] if len(rest) < 2 else rest
        full.append((doc, text, lang, source, None if text is None else len(text), 7, "k", -1, 1, 2))
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, syllables: str = "the an er on re at ti es or th ha en to nd st") -> str:
    pick = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    plain = prose(1, 80)
    return [
        (1, plain, "en", "s1"),
        (2, plain, "en", "s1"),
        (3, None, None, None),
        (3, None, None, None),
        (4, "", "en", "s1"),
        (5, " \t\n", None, "s2"),
        (6, "é", "fr", "s2"),
        (7, prose(2, 60), None, None),
        (7, prose(2, 60), None, None),
        (8, "x" * 70_000 + " " + prose(3, 3000), "en", "s3"),
        (None, prose(4, 70), "en", "s3"),
        (9, "123 456 \U0001f600", "de", ""),
        (10, plain.upper(), "de", "s2"),
    ]


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    return {row[key]: row for row in df.collect()}
