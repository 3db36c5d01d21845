"""Pairing by nearest match against plain greedy choice over all pairs."""

from __future__ import annotations

import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.operators import compare, pairing
from tidewell.operators.compare import Contract, Tolerance, compare_tables, differ

SCHEMA = "a string, b double, c decimal(20,12), d timestamp_ntz, e int"


def tables(spark, n: int, seed: int):
    rnd = random.Random(seed)

    def row():
        return (rnd.choice(["x", "y", None, "z"]), rnd.choice([1.0, 1.0000005, 2.5, None, float("nan"), float("inf"), -1.0, 1e12, 1e12 + 500, 0.0, -0.0000004]), rnd.choice([Decimal("1.000000000001"), Decimal("1.000000000002"), Decimal("-3"), None]), None, rnd.randint(0, 3))

    make = lambda key: spark.createDataFrame([(i, *row()) for i in range(n)], f"{key} long, {SCHEMA}")
    return make("__e"), make("__a")


@pytest.mark.parametrize(("seed", "tolerance"), [(1, Tolerance()), (2, Tolerance(absolute=0.0, relative=1e-6, number=1e-12)), (3, Tolerance(absolute=1e-6, relative=0.0)), (4, Tolerance(absolute=0.0, relative=0.0, number=1e-11))])
def test_equals_greedy_choice(spark, seed, tolerance):
    e, a = tables(spark, 14, seed)
    names, kinds = ["a", "b", "c", "d", "e"], {f.name: f.dataType for f in e.schema}
    compare.checkpoint_dir(spark)
    found = pairing.nearest_pairs(e, a, names, kinds, tolerance, differ, lambda df: df.checkpoint())
    got = {(r["__e"], r["__a"], r["__wrong"]) for r in found.collect()}
    both = e.crossJoin(a.select("__a", *[F.col(n).alias(f"o_{n}") for n in names]))
    wrong = sum((differ(F.col(n), F.col(f"o_{n}"), kinds[n], tolerance).cast("int") for n in names), F.lit(0))
    edges = both.select(wrong.alias("w"), pairing.priority(names, F.col, lambda n: F.col(f"o_{n}")).alias("p"), "__e", "__a").collect()
    want, used_e, used_a = set(), set(), set()
    for w, _, x, y in sorted(map(tuple, edges)):
        if 2 * w <= len(names) and x not in used_e and y not in used_a:
            want.add((x, y, w))
            used_e.add(x)
            used_a.add(y)
    assert got == want and len(want) > 5


def test_no_switch_by_size(spark):
    """Floats within the tolerance are no difference, however many rows there are."""
    rows = spark.range(1500).select((F.col("id") % 7).alias("k"), (F.col("id") / 8.0).alias("v"))
    report = compare_tables(rows, rows.withColumn("v", F.col("v") + 1e-9), Contract())
    assert report.verdict == "PASS" and report.checks["set_diff"] == {"only_expected": 0, "only_actual": 0}


def test_columns_are_named_beyond_a_thousand_rows(spark):
    rows = spark.range(1001).select(F.col("id").cast("string").alias("k"), (F.col("id") * 3).alias("v"), F.lit("s").alias("t"))
    report = compare_tables(rows, rows.withColumn("t", F.lit("S")), Contract())
    assert [(c.scope, c.columns, c.count, c.hint) for c in report.clusters] == [("columns", ("T",), 1001, "case_only")]


def test_crowd_of_alike_rows(spark):
    """Every row shares a value with every other: they are paired slot by slot, not all with all."""
    rows = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    began = time.time()
    report = compare_tables(rows, rows.withColumn("v", F.col("v") + 10_000), Contract())
    assert [(c.columns, c.count) for c in report.clusters] == [(("V",), 4000)] and time.time() - began < 120


def test_infinity_and_nan_are_not_near(spark):
    rows = spark.createDataFrame([(1, float("inf")), (2, float("nan"))], "k int, v double")
    other = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, v double")
    assert compare_tables(rows, other, Contract(keys=("k",))).checks["column_mismatches"] == {"V": 2}
    assert compare_tables(rows, rows, Contract(keys=("k",))).verdict == "PASS"


def test_cells_are_built_once_as_long_as_nobody_leaves(spark):
    """All rows differ in two of five columns, so the first two looks take nobody; once all have left, nothing more is asked."""
    rows = spark.range(200).select(F.col("id").alias("__e"), F.col("id").alias("k"), (F.col("id") * 7).alias("v"), (F.col("id") % 3).alias("m"), F.lit("a").alias("s"), F.lit("b").alias("t"))
    other = rows.withColumnRenamed("__e", "__a").withColumn("s", F.lit("A")).withColumn("t", F.lit("B"))
    compare.checkpoint_dir(spark)
    stored = []

    def checkpoint(df):
        stored.append(tuple(df.columns))
        return df.checkpoint()

    names = ["k", "v", "m", "s", "t"]
    found = pairing.nearest_pairs(rows, other, names, {f.name: f.dataType for f in rows.schema}, Tolerance(), differ, checkpoint)
    assert sorted(map(tuple, found.collect())) == [(i, i, 2) for i in range(200)]
    assert stored.count(("token", "n")) == 1 and not any("__v0" in columns for columns in stored)
