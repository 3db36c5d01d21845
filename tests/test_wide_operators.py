"""Operators that once held a group, a table of pairs or a block in one place, against plain loops."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tidewell.operators import joins, order, rows

C = F.col


def test_fold_is_linear_and_right(spark):
    n = 60_000
    df = spark.range(n).select(F.lit(1).alias("g"), "id", (C("id") % 13 - 5).cast("double").alias("v"))
    step = lambda before, row: F.least(F.lit(100.0), F.greatest(F.lit(-20.0), F.coalesce(before, F.lit(0.0)) + row["v"]))
    began = time.time()
    got = [r.b for r in order.fold(df, "b", "double", step, ["v"], ["id"], ["g"]).orderBy("id").collect()]
    want, now = [], 0.0
    for i in range(n):
        now = min(100.0, max(-20.0, now + i % 13 - 5))
        want.append(now)
    assert got == want and time.time() - began < 90


def test_update_in_place(spark):
    """Row-1 is new, Row+1 is old."""
    data = [("a", 1, 5), ("a", 2, 1), ("a", 3, None), ("a", 4, 7), ("b", 1, 2)]
    df = spark.createDataFrame(data, "g string, i int, v int").repartition(3)
    step = lambda before, row, after: F.coalesce(before, F.lit(100)) + F.coalesce(row["v"], F.lit(0)) + F.coalesce(after, F.lit(-1))
    got = {(r.g, r.i): r.v for r in order.update_in_place(df, "v", step, ["v"], ["i"], ["g"]).collect()}
    want = {}
    for g in "ab":
        before, mine = 100, [r for r in data if r[0] == g]
        for j, (_, i, v) in enumerate(mine):
            after = mine[j + 1][2] if j + 1 < len(mine) else None
            before = before + (v or 0) + (-1 if after is None else after)
            want[g, i] = before
    assert got == want and order.update_in_place(df, "v", step, ["v"], ["i"], ["g"]).columns == df.columns


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentiles(spark, share):
    rnd = random.Random(3)
    data = [(g, rnd.choice([None, rnd.uniform(-9, 9), 1.5])) for g in [*range(20), None] for _ in range(g or 3)] + [(99, None)]
    df = spark.createDataFrame(data, "g int, v double").repartition(5)
    got = {r.g: r.p for r in order.percentiles(df, "v", share, "p", ["g"]).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.lit(share)).alias("p")).collect()}
    assert got.keys() == want.keys() and all(got[g] == want[g] or abs(got[g] - want[g]) < 1e-12 for g in want)
    big = spark.range(100_001).select((C("id") * 7 % 100_001).alias("v"))
    assert order.percentiles(big, "v", share, "p").first().p == pytest.approx(share * 100_000)


def edits(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(now[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
        last = now
    return last[-1]


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_fuzzy_join_equals_all_pairs(spark, k, monkeypatch):
    monkeypatch.setattr(joins, "PARTS", 2)
    rnd = random.Random(k)
    words = ["", "a", "ab", None, "é\N{GRINNING FACE}x"] + ["".join(rnd.choices("abc", k=rnd.randint(0, 9))) for _ in range(60)]
    left = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, t string")
    right = spark.createDataFrame([(i, "".join(rnd.choices("abc", k=rnd.randint(0, 9))) if i % 3 else rnd.choice(words)) for i in range(60)], "id int, t string")
    got = sorted((r.id, r.Right_id, r.distance) for r in joins.fuzzy_join(left, right, ("t", "t"), k).collect())
    want = sorted((x.id, y.id, d) for x in left.collect() for y in right.collect() if x.t is not None and y.t is not None and (d := edits(x.t, y.t)) <= k)
    assert got == want and len(want) > 3


@pytest.mark.parametrize("whole", [False, True])
def test_find_replace_from_a_table_equals_a_loop(spark, whole):
    rnd = random.Random(2)
    pairs = [(i, "".join(rnd.choices("abcdé$.", k=rnd.randint(0, 6))) or None, rnd.choice(["X", "$1", "\\", None, ""])) for i in range(10_000)]
    texts = [None, "", "a", "abc.d", "zzz"] + ["".join(rnd.choices("abcdé$. z", k=rnd.randint(1, 12))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lookup = spark.createDataFrame(pairs, "nth int, old string, new string").repartition(3)
    got = {r.i: r.t for r in rows.find_replace_from(df, "t", lookup, "old", "new", "nth", whole).collect()}
    for i, t in enumerate(texts):
        want = t
        for _, old, new in pairs:
            if t and old and (t == old if whole else old in t):
                want = (new or "") if whole else t.replace(old, new or "")
                break
        assert got[i] == want, (t, got[i], want)


def test_a_final_newline_is_no_whole_match(spark):
    df = spark.createDataFrame([("abc\n",), ("abc",)], "t string")
    assert [r.t for r in rows.find_replace(df, "t", [("abc", "x")], whole=True).collect()] == ["abc\n", "x"]
