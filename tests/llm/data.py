"""Odd tables: nulls in every column, empty and very long texts, repeated rows, columns whose names clash."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "size long, target double, TEXT_ string, h long, key string, fp long, gone binary, uid long, tox_score double, owner string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows(rng: random.Random | None = None) -> list[tuple]:
    rng = rng or random.Random(5)
    some = words(rng, 60)
    long = words(rng, 30_000)
    rows = [
        (1, some, "en", "a", len(some)),
        (1, some, "en", "a", len(some)),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, some, "en", "b", 9),
        (None, None, "en", None, None),
        (4, long, "en", "a", len(long)),
        (5, " \t\n\n  \n", "en", "b", 7),
        (6, "one", "en", "c", 3),
        (7, "é" * 5000 + "\n" + some, "fr", "c", 5),
    ]
    rows += [(100 + i, f"Shared line of words\n{words(rng, 20)}", "en", "a" if i % 3 else None, 1) for i in range(12)]
    return rows


def odd(spark):
    """The odd rows with further columns, one differing from a wanted one in case only."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), DOC)
    for c in CLASH.split(", "):
        name, kind = c.split(" ")
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df.withColumn("Doc_ID_", F.lit(1)).withColumnRenamed("TEXT_", "TEXT").withColumnRenamed("Doc_ID_", "DOC_ID")


def empty(spark):
    return spark.createDataFrame([], DOC)
