"""Arithmetic on any doubles against Python's decimals."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, getcontext, localcontext

import pytest
from pyspark.sql import functions as F

from tidewell.functions import scalar

C = F.col


def pairs() -> list[tuple[float, float]]:
    rnd, out = random.Random(1), []
    for _ in range(700):
        out.append((round(rnd.uniform(-1e3, 1e3), rnd.randint(8, 13)), round(rnd.uniform(-1e3, 1e3), rnd.randint(8, 13))))
    for _ in range(700):
        out.append((rnd.uniform(-1, 1) * 10 ** rnd.randint(-30, 30), rnd.uniform(-1, 1) * 10 ** rnd.randint(-30, 30)))
    for _ in range(300):
        out.append((float(f"{rnd.randint(-99, 99)}e{rnd.randint(-40, 40)}"), float(f"{rnd.randint(-99, 99)}e{rnd.randint(-40, 40)}")))
    odd = [0.0, -0.0, 1e-11, -1e-11, 0.1, 1e20, -1e20, 1e308, 5e-324, 1.7976931348623157e308, 9007199254740993.0, 1e22, 123456789012345678.0, 1e-300]
    return out + [(a, b) for a in odd for b in odd]


def plain(d: Decimal) -> float | None:
    return None if abs(float(d)) == float("inf") else float(d) + 0.0


def slow(name: str, a: float, b: float) -> float | None:
    x, y = Decimal(repr(a)), Decimal(repr(b))
    with localcontext() as c:
        c.prec = 40 if name == "%" else 900
        if name in "/%" and not y:
            return None
        try:
            return plain({"+": lambda: x + y, "-": lambda: x - y, "*": lambda: x * y, "/": lambda: x / y, "%": lambda: x % y}[name]())
        except ArithmeticError:
            return None


def to_step(a: float, step: str) -> float:
    with localcontext() as c:
        c.prec = 900
        s = Decimal(step)
        return plain((Decimal(repr(a)) / s).quantize(Decimal(1), ROUND_HALF_UP) * s)


@pytest.mark.parametrize(("name", "function"), [("+", scalar.add), ("-", scalar.subtract), ("*", scalar.multiply), ("/", scalar.divide), ("%", scalar.modulo)])
def test_every_result_is_the_nearest_double(spark, name, function):
    rows = pairs()
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r.r for r in df.select(function(df, C("a"), C("b")).alias("r")).collect()]
    texts = {x: t for x, t in df.select(F.explode(F.array("a", "b")).alias("x")).select("x", F.col("x").cast("string")).collect()}
    known = lambda x: len(texts[x]) >= 18 or Decimal(texts[x]) == Decimal(repr(x))  # noqa: E731  not what only this Java writes
    assert sum(known(a) and known(b) for a, b in rows) > len(rows) - 40
    wrong = [(a, b, g, w) for (a, b), g in zip(rows, got, strict=True) if (w := slow(name, a, b)) != g and not (name == "%" and w is None) and known(a) and known(b)]
    assert not wrong, (len(wrong), wrong[:5])


@pytest.mark.parametrize("step", ["1", "0.01", "1e-10", "0.25", "3", "1e-15", "7e5", "0.05"])
def test_multiples(spark, step):
    values = [x for p in pairs() for x in p][::3] + [1.005, 2.5, -2.5, 1e-11, 0.5, 1e30, 123456.785, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = [r.r for r in df.select(scalar.round_to(df, C("a"), step).alias("r")).collect()]
    wrong = [(v, g, w) for v, g in zip(values, got, strict=True) if (w := to_step(v, step)) != g]
    assert not wrong, (len(wrong), wrong[:5])


def test_whole_numbers_above_and_below(spark):
    df = spark.createDataFrame([(1e-11,), (-1e-11,), (2.0,), (2.9999999999999996,), (1e30,), (None,)], "a double")
    assert [tuple(r) for r in df.select(scalar.ceiling(df, C("a")), scalar.floor(df, C("a"))).collect()] == [(1, 0), (0, -1), (2, 2), (3, 2), (None, None), (None, None)]


def test_text_against_numbers_to_the_last_digit(spark):
    getcontext().prec = 60
    texts = ["0.00000000001", "-0.00000000001", "0", "-0.0", "1e-11", "1E-11", "+5", "12345678901234567890.5", "0.1", "0.10000000000000000000000000000000000000000001", ".5", "5.", "x", "", None, "1e400", "-3", "3", "1e2", "100"]
    numbers = [0.0, 1e-11, 0.1, 5.0, 1.2345678901234567e19, -3.0, 100.0, 0.5, None]
    df = spark.createDataFrame([(t, n) for t in texts for n in numbers], "t string, n double")
    left, right = scalar.compared(df, C("t"), C("n"))
    back, zero = scalar.compared(df, C("n"), C("t"))
    for r in df.select("t", "n", (left > right).alias("above"), (left == right).alias("same"), (back < zero).alias("below")).collect():
        if r.n is None or r.t in (None, "x", ""):
            assert r.above is None and r.same is None
        else:
            x, y = Decimal(r.t), Decimal(repr(r.n))
            assert (r.above, r.same, r.below) == (x > y, x == y, y < x), r
