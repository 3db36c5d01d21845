"""Sums and running totals against Python's decimals, in one group and many, in any order and partitioning."""

from __future__ import annotations

import random
import time
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tidewell.operators import order, summarize
from tidewell.operators.summarize import Agg


def exactly(values, texts: dict[float, str]) -> float:
    """By Java's decimal texts, which before version 19 are not always the shortest."""
    with localcontext() as c:
        c.prec = 400
        return float(sum((Decimal(texts[v]) for v in values), Decimal(0))) + 0.0


@pytest.fixture(scope="module")
def texts(spark):
    every = sorted({v for vs in groups().values() for v in vs})
    return dict(spark.createDataFrame([(v,) for v in every], "v double").select("v", F.col("v").cast("string")).collect())


def groups() -> dict[int, list[float]]:
    rnd = random.Random(6)
    out = {0: [1e20, 1.0, -1e20], 1: [0.1] * 10, 2: [1e-11, -1e-11, 1e-20], 3: [1e-20, 2.5e-19], 4: [-5.0, 0.3], 5: [5.0, -0.3, -1e-15], 6: [0.0, -0.0], 7: [1e21, 0.1, 1e-21, -1e21], 8: [1.5e-21] * 3, 9: [-1e10, 1e-11]}
    for g in range(10, 60):
        out[g] = [rnd.choice([-1, 1]) * rnd.uniform(0.1, 1) * 10 ** rnd.randint(-19, 20) for _ in range(rnd.randint(1, 12))]
    for g in range(60, 80):
        out[g] = [round(rnd.uniform(-1e6, 1e6), 2) for _ in range(rnd.randint(1, 30))]
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_are_exact_in_any_order(spark, texts, parts):
    rows = [(g, v) for g, vs in groups().items() for v in vs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    got = {r.g: r.s for r in summarize.summarize(df, ["g"], Agg("sum", "v", "s")).collect()}
    wrong = {g: (got[g], exactly(vs, texts)) for g, vs in groups().items() if got[g] != exactly(vs, texts)}
    assert not wrong


def test_what_is_beyond_stays_a_sum_of_doubles(spark):
    df = spark.createDataFrame([(1e300,), (1.0,), (None,)], "v double")
    assert summarize.summarize(df, [], Agg("sum", "v", "s")).first().s == 1e300
    assert summarize.summarize(df.filter("v is null"), [], Agg("sum", "v", "s")).first().s is None


def test_running_totals_are_exact(spark, texts):
    rows = [(g, i, v) for g, vs in groups().items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g int, i int, v double").repartition(5)
    got = {(r.g, r.i): r.t for r in order.running_total(df, "v", "t", ["i"], ["g"]).collect()}
    wrong = [(g, i, got[g, i], exactly(vs[: i + 1], texts)) for g, vs in groups().items() for i in range(len(vs)) if got[g, i] != exactly(vs[: i + 1], texts)]
    assert not wrong
    assert order.running_total(spark.createDataFrame([(0.12345678901,)], "v double"), "v", "t", ["v"]).first().t == 0.12345678901


def test_one_huge_group_uses_all_tasks(spark):
    n = 400_000
    df = spark.range(n).select(F.lit("one").alias("g"), "id", F.when(F.col("id") == n - 10, None).otherwise(F.col("id") * 0.01).alias("v"))
    began = time.time()
    out = order.running_total(df, "v", "t", ["id"], ["g"]).cache()
    assert out.filter("t is null").count() == 10 and out.select(F.spark_partition_id()).distinct().count() > 1
    top = out.filter(F.col("id") == n - 11).first()
    assert top.t == (n - 11) * (n - 10) // 2 / 100 and time.time() - began < 120
    skipped = order.running_total(df, "v", "t", ["id"], ["g"], null="skip").filter(F.col("id") >= n - 11).orderBy("id").limit(2).collect()
    assert skipped[0].t == skipped[1].t == top.t


def test_tiles_by_sum(spark):
    rows = [("a", i, float(v)) for i, v in enumerate([5, 5, 5, 5, 0, 20])] + [("zero", 0, 0.0), ("zero", 1, 0.0), (None, 1, None), (None, 2, 1e-12)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {(r.g, r.i): r.t for r in order.tile_sum(df, 4, "v", "t", ["i"], ["g"]).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, ("a", 2): 2, ("a", 3): 2, ("a", 4): 2, ("a", 5): 4, ("zero", 0): 1, ("zero", 1): 1, (None, 1): 1, (None, 2): 4}
    assert order.tile_sum(df, 2, "v", "t", ["i", "g"]).count() == len(rows)
