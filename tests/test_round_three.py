"""Work that grew in one task or in pairs, results that hung on the order of rows, and models that left rows out."""

from __future__ import annotations

import random
import time
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tidewell.functions import exact, scalar
from tidewell.operators import checks, joins, order
from tidewell.plans import queries

C = F.col


def test_names_with_a_common_beginning_are_not_all_compared(spark):
    names = spark.range(8000).select("id", F.format_string("Supplier#%09d", "id").alias("t"))
    began = time.time()
    assert joins.fuzzy_join(names, names, ("t", "t"), 1).count() == 8000 * 35 and time.time() - began < 60


@pytest.mark.parametrize("limit", [0, 60, 50_000])
def test_short_and_long_texts_meet(spark, limit, monkeypatch):
    monkeypatch.setattr(joins, "WRITTEN", limit, raising=False)
    texts = ["", "a", "ab", "abc", "abcd", "abcde", "abXcde", "bcde", "abcdefgh", "abdefghi", "zzabcdefgh", "abcdefghijklmnopq", "abcdefghijklmnoq", "bcdefghijklmnopqr"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for k in (1, 2):
        every = df.crossJoin(df.select(C("t").alias("u"))).filter(F.levenshtein("t", "u") <= k).collect()
        assert sorted(map(tuple, every)) == sorted((r.t, r.Right_t) for r in joins.fuzzy_join(df, df, ("t", "t"), k).collect())


def test_blocks_stay_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(order, "BLOCK", 100, raising=False)
    df = spark.range(5000).select("id", (C("id") % 7).cast("double").alias("v"))
    held, blocks = order._in_blocks(df, [C("id").asc()])
    assert blocks == 50 and held.groupBy("__block").count().agg(F.max("count")).first()[0] < 400
    got = {r.id: r.run for r in order.running_total(df, "v", "run", ["id"]).collect()}
    assert all(got[i] == sum(j % 7 for j in range(i + 1)) for i in (0, 99, 2500, 4999)) and len(got) == 5000


def test_a_running_total_does_not_hang_on_the_order_of_rows(spark, tmp_path):
    rows = [(1, 1, float(p)) for p in (3, 1, 2)] + [(2, 1, 5.0)]
    found = []
    for i, part in enumerate((rows, rows[::-1])):
        items = spark.createDataFrame(part, "l_orderkey long, l_linenumber int, l_extendedprice double").coalesce(1)
        items.withColumn("l_shipdate", F.lit("1995-01-01").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/{i}/lineitem.parquet")
        joined = queries.w5_one_huge_group(spark, f"{tmp_path}/{i}").select("l_orderkey", (C("run") * 1e10).alias("run"))
        found.append(sorted((r.l_orderkey, round(r.run)) for r in joined.collect()))
    assert found == [[(1, 1), (1, 3), (1, 6), (2, 11)]] * 2


def test_the_log_deals_its_table_over_as_many_tasks_as_there_are(spark, tmp_path, monkeypatch):
    spark.range(40).select(C("id").alias("l_orderkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(C("id").alias("o_orderkey"), C("id").alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    seen, plain = [], checks.reconcile
    monkeypatch.setattr(checks, "reconcile", lambda real, shadow: seen.append(shadow) or plain(real, shadow))
    assert queries.c24_run_log(spark, str(tmp_path)).count() == 2
    assert "RoundRobinPartitioning(5)" not in seen[0]._jdf.queryExecution().toString() and "REBALANCE" in seen[0]._jdf.queryExecution().toString()


def _small_and_large(rnd) -> float:
    kind = rnd.randint(0, 5)
    n = rnd.choice([-1, 1]) * rnd.randint(0, 10 ** rnd.randint(1, 9))
    return [n / 1e4, n / 1e13, n / 1e15, n * 1e9, rnd.uniform(-1, 1), float(n)][kind]


@pytest.mark.parametrize("name", ["+", "-", "*", "/", "%"])
def test_other_units_give_the_double_nearest_to_the_exact_result(spark, name):
    rnd = random.Random(name)
    rows = [(_small_and_large(rnd), _small_and_large(rnd)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("s", F.lit(None).cast("double"))
    with localcontext() as c:
        c.prec = 200
        for r in df.select("a", "b", scalar._by_other_units(C("a"), C("b"), name, C("s")).alias("x"), C("a").cast("string").alias("t"), C("b").cast("string").alias("u")).filter("x is not null").collect():
            p, q = Decimal(r.t), Decimal(r.u)
            want = {"+": p + q, "-": p - q, "*": p * q}[name] if name in "+-*" else p / q if name == "/" else p - q * int(p / q)
            assert r.x == float(want), (r, want)


def test_small_and_large_numbers_need_no_decimals(spark, monkeypatch):
    monkeypatch.setattr(exact, "work_out", lambda *_: F.lit(None).cast("double"))
    df = spark.createDataFrame([(1.2345e-9, 0.07, 21.0)], "x double, d double, q double")
    got = df.select(scalar.add(df, C("x"), F.lit(1e-13)), scalar.modulo(df, C("x"), F.lit(7e-13)), scalar.divide(df, F.lit(1), C("x")), scalar.multiply(df, C("d"), F.lit(1e-7)), scalar.multiply(df, C("q"), F.lit(3e13)), scalar.round_to(df, C("x"), "1e-12")).first()
    assert list(got) == [1.2346e-9, 4e-13, 1 / 1.2345e-9, 7e-9, 6.3e14, 1.235e-9]


def test_costly_rules_are_spread_over_tasks(spark, tmp_path):
    part = spark.range(100).select(C("id").alias("p_partkey"), (C("id") % 50).cast("int").alias("p_size"), F.lit("b").alias("p_brand"))
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert queries.f7_null_text_and_number_rules(spark, str(tmp_path)).rdd.getNumPartitions() >= 8
