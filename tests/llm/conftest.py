from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns that clash with results
    T.StructField("score", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("fp", T.IntegerType()), T.StructField("n_words", T.StringType()), T.StructField("kinds", T.StringType()), T.StructField("rejected", T.StringType()),
])
SYLLABLES = {"en": "the ing er on and ish ly ou".split(), "de": "der sch ung ein keit ber zu ü".split()}


def prose(rnd: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 3))) for _ in range(n))


def make_rows() -> list[tuple]:
    rnd, rows = random.Random(3), []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        rows.append((i, prose(rnd, lang, rnd.randint(3, 120)), lang, f"src{i % 3}"))
    rows += [
        (60, None, "en", None), (61, "", None, "src0"), (62, " \n\t ", "de", "src0"), (63, "12345 ---", "en", "odd"),
        (64, prose(rnd, "en", 30_000), "en", "src1"),  # very long
        (65, rows[1][1], "en", "src0"), (66, rows[1][1], "en", "src0"),  # ties: the same text under other ids
        (67, "\N{COMBINING ACUTE ACCENT}x \N{KELVIN SIGN} don't\x1cwait <|endoftext|> #&$ Ünï", "de", "src2"),
        (None, rows[2][1], "de", "src2"), rows[5], rows[5],  # a null id, repeated rows
    ]
    return [(*r, len(r[1] or ""), "a", "b", 1, "c", "d", "e") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
