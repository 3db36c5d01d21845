from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import dates, scalar
from tidewell.functions.types import Field, coerce_in, family, to_number, to_text, type_of

C = F.col


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([(1,)], "id int")


def value(df, column):
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "number"), [(" 12.50 ", 12.5), ("1,200.50", None), ("", None), ("abc", None), ("1d", None), ("NaN", None), ("-.5", -0.5), ("3.", 3.0), ("1e3", 1000.0), ("1e999", None), (None, None), ("\t7\n", 7.0)])
def test_number_text(one, text, number):
    assert value(one, to_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(("x", "kind", "text"), [(12.0, "double", "12"), (1e7, "double", "10000000"), (2.675, "double", "2.675"), (-0.0, "double", "0"), (1e21, "double", "1000000000000000000000"), (1e-7, "double", "0.0000001"), (True, "boolean", "True"), (5, "int", "5"), ("a", "string", "a"), (None, "double", None)])
def test_text_of_values(one, x, kind, text):
    column = F.lit(x).cast(kind)
    assert value(one, to_text(column, type_of(one, column))) == text


@pytest.mark.parametrize(("x", "field", "out"), [
    (2.5, Field("", "Int32"), 3), (-2.5, Field("", "Int32"), -3), (300, Field("", "Byte"), None), (255, Field("", "Byte"), 255), ("1.5", Field("", "Int64"), 2), ("x", Field("", "Int64"), None), (3e9, Field("", "Int32"), None), (True, Field("", "Int16"), 1),
    (1.005, Field("", "FixedDecimal", 19, 2), Decimal("1.01")), ("12.345", Field("", "FixedDecimal", 19, 1), Decimal("12.3")), ("é€abc", Field("", "String", 3), "é€a"), ("abc", Field("", "V_String", 2), "abc"), (12.0, Field("", "String", 9), "12"),
    ("yes", Field("", "Bool"), True), ("F", Field("", "Bool"), False), ("2", Field("", "Bool"), True), ("0", Field("", "Bool"), False), ("maybe", Field("", "Bool"), None), (7, Field("", "Bool"), True),
    ("2024-02-29", Field("", "Date"), dt.date(2024, 2, 29)), ("2026-02-30", Field("", "Date"), None), ("2024-02-29 10:11:12", Field("", "DateTime"), dt.datetime(2024, 2, 29, 10, 11, 12)), ("2024-02-29", Field("", "DateTime"), dt.datetime(2024, 2, 29)), ("25:00:00", Field("", "Time"), None), ("23:59:01", Field("", "Time"), "23:59:01"), ("31/02/2026", Field("", "Date"), None), ("kept", Field(""), "kept"),
])
def test_coercion(one, x, field, out):
    assert value(one, coerce_in(one, F.lit(x), field)) == out


def test_unsupported_type():
    with pytest.raises(ValueError, match="SpatialObj"):
        Field("x", "SpatialObj").spark_type()


def test_families():
    assert [family(k) for k in (T.LongType(), T.DecimalType(9, 2), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType())] == ["number", "number", "float", "string", "date", "timestamp", "bool"]


def test_exact_decimals(one):
    assert value(one, scalar.multiply(one, F.lit(4094.9), F.lit(0.95))) == 3890.155
    assert value(one, scalar.floor(one, scalar.multiply(one, F.lit(4.35), F.lit(100)))) == 435
    assert value(one, scalar.round_to(one, F.lit(2.675), "0.01")) == 2.68
    assert value(one, scalar.round_to(one, F.lit(-2.5))) == -3
    assert value(one, scalar.round_to(one, F.lit(12), 5)) == 10
    assert value(one, scalar.round_to(one, F.lit(1.0), 0)) is None
    assert value(one, scalar.power(one, F.lit(1.15), 2)) == 1.3225
    assert value(one, scalar.power(one, F.lit(0), 0)) == 1 and value(one, scalar.power(one, F.lit(0.0), -1)) is None
    assert value(one, scalar.power(one, F.lit(-2.0), 0.5)) is None and abs(value(one, scalar.power(one, F.lit(2.0), 0.5)) - 2**0.5) < 1e-12
    assert value(one, scalar.divide(one, F.lit(1), F.lit(0))) is None and value(one, scalar.divide(one, F.lit(7), F.lit(2))) == 3.5
    assert value(one, scalar.modulo(one, F.lit(-7), F.lit(3))) == -1 and value(one, scalar.modulo(one, F.lit(5), F.lit(0))) is None
    assert value(one, scalar.add(one, F.lit(0.1), F.lit(0.2))) == 0.3
    assert type_of(one, scalar.add(one, F.lit(1), F.lit(2))) == T.LongType()


@pytest.mark.parametrize(("a", "b", "product"), [(0.1234567, 2.0, 0.2469134), (1.0, 0.0000001, 1e-7), (3e13, 2.0, 6e13), (1e200, 1e200, None), (1e20, 0.5, 5e19), (1e-12, 1e-12, 1e-24), (4094.9, 0.95, 3890.155)])
def test_products_keep_their_digits(one, a, b, product):
    found = value(one, scalar.multiply(one, F.lit(a), F.lit(b)))
    assert found == product or abs(found - product) <= 2e-16 * product


def test_numbers_of_any_size(one):
    assert value(one, scalar.divide(one, F.lit(1.0), F.lit(0.0000001))) == 1e7 and abs(value(one, scalar.divide(one, F.lit(1e-9), F.lit(3.0))) / (1e-9 / 3) - 1) < 1e-15
    assert value(one, scalar.power(one, F.lit(1e12), 4)) == 1e48 and value(one, scalar.power(one, F.lit(1e200), 2)) is None and value(one, scalar.power(one, F.lit(1.1), 3)) == 1.331
    assert value(one, scalar.modulo(one, F.lit(1e13), F.lit(7.0))) == 1e13 % 7 and value(one, scalar.round_to(one, F.lit(1e25), 5)) == 1e25
    big = F.lit(2**62).cast("bigint")
    assert value(one, scalar.add(one, big, big)) is None and value(one, scalar.multiply(one, big, F.lit(4))) is None
    assert value(one, scalar.add(one, F.lit(float("nan")), F.lit(1.0))) is None


@pytest.mark.parametrize("x", [1e-20, 1e40, 1.5e300, 123456789.125, 1.234567890123456e-5, -2.5e-8, 9007199254740993.0])
def test_text_of_doubles_is_exact(one, x):
    text = value(one, to_text(F.lit(x), T.DoubleType()))
    assert text == format(Decimal(repr(x)).normalize(), "f") and float(text) == x


@pytest.mark.parametrize(("x", "places", "text"), [(2.675, 2, "2.68"), (-1.0, 1, "-1.0"), (1e40, 2, "1" + "0" * 40 + ".00"), (7, 3, "7.000"), (0.5, 0, "1")])
def test_text_with_decimals(one, x, places, text):
    assert value(one, scalar.to_string(one, F.lit(x), places)) == text


def test_null_rules(one):
    null = F.lit(None).cast("int")
    assert value(one, scalar.iif(null > 1, "a", "b")) == "b"
    assert value(one, scalar.if_chain((null > 1, 1), (F.lit(True), 2))) == 2 and value(one, scalar.if_chain((F.lit(False), 1))) is None
    assert value(one, scalar.add(one, null, F.lit(1))) is None
    assert value(one, scalar.smallest(null, F.lit(3), F.lit(2))) == 2 and value(one, scalar.largest(null, null)) is None
    assert value(one, scalar.is_empty(F.lit(""))) and value(one, scalar.is_empty(F.lit(None).cast("string"))) and not value(one, scalar.is_empty(F.lit(" ")))
    assert value(one, F.lit(1).isin(2, None)) is None


def test_conditions(one):
    assert value(one, scalar.condition(one, F.lit("0"))) is False and value(one, scalar.condition(one, F.lit(2.5))) is True
    with pytest.raises(TypeError):
        scalar.condition(one, F.current_date())
    with pytest.raises(Exception, match="not a condition"):
        value(one, scalar.condition(one, F.lit("abc")))


@pytest.mark.parametrize(("column", "out"), [
    (lambda: scalar.contains(F.lit("Hello"), "LL"), True), (lambda: scalar.contains(F.lit("Hello"), "LL", ignore_case=False), False), (lambda: scalar.starts_with(F.lit("Hello"), "he"), True), (lambda: scalar.ends_with(F.lit("Hello"), "LO", ignore_case=False), False),
    (lambda: scalar.substring(F.lit("abcdef"), 2), "cdef"), (lambda: scalar.substring(F.lit("abcdef"), -3, 2), "ab"), (lambda: scalar.substring(F.lit("abcdef"), 1, -1), ""), (lambda: scalar.left(F.lit("abc"), -1), ""), (lambda: scalar.right(F.lit("abc"), 2), "bc"), (lambda: scalar.right(F.lit("abc"), -2), ""),
    (lambda: scalar.pad_left(F.lit("7"), 3, "0x"), "007"), (lambda: scalar.pad_left(F.lit("abcdef"), 3, "0"), "abcdef"), (lambda: scalar.pad_right(F.lit("a"), 3, "-"), "a--"), (lambda: scalar.pad_left(F.lit("a"), 3, ""), None),
    (lambda: scalar.trim(F.lit("  a\tb \n")), "a\tb"), (lambda: scalar.trim_left(F.lit("\t a ")), "a "), (lambda: scalar.trim_right(F.lit(" a\n")), " a"), (lambda: scalar.title_case(F.lit("don't  STOP\téa")), "Don't  Stop\tÉa"),
    (lambda: scalar.replace(F.lit("a.b.c"), ".", "$"), "a$b$c"), (lambda: scalar.regex_match(F.lit("xABCx"), "abc"), True), (lambda: scalar.regex_match(F.lit("xABCx"), "abc", ignore_case=False), False), (lambda: scalar.regex_replace(F.lit("A1 B2"), r"([a-z])(\d)", "$2$1"), "1A 2B"),
])
def test_text_functions(one, column, out):
    assert value(one, column()) == out


def test_text_meets_numbers(one):
    a, b = scalar.compared(one, F.lit("10"), F.lit(9))
    assert value(one, a > b) is True
    a, b = scalar.compared(one, F.lit("x"), F.lit(9))
    assert value(one, a > b) is None
    assert value(one, scalar.join_text(one, F.lit("n="), F.lit(12.0))) == "n=12"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(("a", "n", "unit", "out"), [("2024-01-31", 1, "months", "2024-02-29"), ("2024-02-29", 1, "year", "2025-02-28"), ("2024-01-01", 36, "hours", "2024-01-02 12:00:00"), ("2024-01-01", 2, "weeks", "2024-01-15"), ("2024-03-31", -1, "month", "2024-02-29")])
def test_date_add(one, a, n, unit, out):
    assert str(value(one, dates.date_add(one, at(a), n, unit))).removesuffix(" 00:00:00") == out


def test_dates_stay_dates(one):
    day = F.lit("2024-01-31").cast("date")
    assert value(one, dates.date_add(one, day, 1, "month")) == dt.date(2024, 2, 29)
    assert value(one, dates.date_add(one, day, 1, "hour")) == dt.datetime(2024, 1, 31, 1)
    assert value(one, dates.to_date(one, F.lit("2024-01-31 23:00:00"))) == dt.date(2024, 1, 31)
    with pytest.raises(ValueError, match="fortnight"):
        dates.date_add(one, day, 1, "fortnight")


@pytest.mark.parametrize(("a", "b", "unit", "out"), [("2024-01-03 23:00:00", "2024-01-01", "days", 2), ("2024-01-01", "2024-01-03", "days", -2), ("2023-02-28", "2023-01-31", "months", 1), ("2023-02-27", "2023-01-31", "months", 0), ("2024-02-29", "2020-02-29", "years", 4), ("2024-02-28", "2020-02-29", "years", 3), ("2023-01-31", "2023-02-28", "months", 0), ("2024-01-01 00:00:59", "2024-01-01", "minutes", 0), ("2024-01-01", "2024-01-15", "week", -2)])
def test_date_diff(one, a, b, unit, out):
    assert value(one, dates.date_diff(one, at(a), at(b), unit)) == out


@pytest.mark.parametrize(("text", "tokens", "out"), [("3/8/2024", "%d/%m/%Y", "2024-08-03 00:00:00"), ("31/02/2026", "%d/%m/%Y", "None"), ("03 Aug 69", "%d %b %y", "1969-08-03 00:00:00"), ("03 Aug 68", "%d %b %y", "2068-08-03 00:00:00"), ("2024-060", "%Y-%j", "2024-02-29 00:00:00"), ("x", "%Y", "None")])
def test_date_parse(one, text, tokens, out):
    assert str(value(one, dates.date_parse(F.lit(text), tokens))) == out


def test_date_format(one):
    assert value(one, dates.date_format(one, at("2024-02-29 01:02:03"), "%Y%m%d at %H:%M:%S, %b %j")) == "20240229 at 01:02:03, Feb 060"
    with pytest.raises(ValueError, match="%q"):
        dates.date_format(one, at("2024-02-29"), "%q")
