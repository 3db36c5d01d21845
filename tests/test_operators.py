from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import scalar
from tidewell.functions.types import Field, to_number
from tidewell.operators import joins, order, rows, summarize
from tidewell.operators.rows import Formula, Pick
from tidewell.operators.summarize import Agg

C = F.col


def got(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


@pytest.fixture(scope="module")
def sales(spark):
    data = [(1, "Ann Lee Smith", "WEST", "10.005", 2), (2, "Bo", None, "abc", 3), (3, "Bo", "EAST", "1,200.50", None), (4, None, "EAST", "7", 1), (5, None, None, None, None), (4, None, "EAST", "7", 1)]
    return spark.createDataFrame(data, "id int, customer string, region string, amount string, qty int")


def test_select(sales):
    out = rows.select(sales, [Pick("CUSTOMER", "name", "String", 6), Pick("gone"), Pick("qty", type="V_String"), Pick("amount", keep=False)], others=True)
    assert out.columns == ["name", "qty", "id", "region"]
    assert out.filter("id = 1").first().name == "Ann Le" and out.schema["qty"].dataType == T.StringType()


def test_filter_sends_null_to_false(sales):
    both = rows.split(sales, C("region") != "WEST")
    assert [r[0] for r in got(both.true, "id")] == [3, 4, 4] and [r[0] for r in got(both.false, "id")] == [1, 2, 5]


def test_a_filter_that_loses_nulls_is_noticed(sales):
    """Mutation: the negated condition alone is not the false side."""
    wrong = sales.filter(~(C("region") != "WEST"))
    assert wrong.count() != rows.split(sales, C("region") != "WEST").false.count()


def test_formulas_see_stored_values(sales):
    out = rows.formulas(sales, Formula(Field("n", "Int32"), to_number(C("amount"))), Formula(Field("n2", "Double"), lambda t: scalar.multiply(t, C("n"), F.lit(2))), Formula(Field("qty", "V_String"), lambda t: C("qty") + 1))
    assert out.columns == [*sales.columns, "n", "n2"] and out.columns.index("qty") == 4
    assert [(r.n, r.n2) for r in out.orderBy("id").select("n", "n2").collect()] == [(10, 20.0), (None, None), (None, None), (7, 14.0), (7, 14.0), (None, None)]


def test_cleansing(spark):
    df = spark.createDataFrame([(" a\t\tb  cé 1! ", None, 1), (None, None, None)], "t string, u string, n int")
    r = rows.cleanse(df, ["t", "u", "n"], blank_for_null=True, zero_for_null=True, double_spaces=True, trim=True, digits=True, punctuation=True, case="title").collect()
    assert [tuple(x) for x in r] == [("A B Cé ", "", 1), ("", "", 0)]
    assert rows.cleanse(df, ["t"], all_spaces=True, letters=True).first().t == "1!"


def test_regex(spark):
    df = spark.createDataFrame([("AB-12",), ("ab-3 ab-4",), ("none",), (None,)], "sku string")
    parsed = rows.regex_parse(df, "sku", r"([a-z]+)-(\d+)", [Field("family", "V_String"), Field("item", "Int32")])
    assert [tuple(r)[1:] for r in parsed.collect()] == [("AB", 12), ("ab", 3), (None, None), (None, None)]
    assert [r.sku for r in rows.regex_substitute(df, "sku", r"([a-z]+)-(\d)", "$2$1", copy_unmatched=False).collect()] == ["1AB2", "3ab 4ab", None, None]
    assert [r.sku for r in rows.regex_substitute(df, "sku", "zz", "").collect()] == ["AB-12", "ab-3 ab-4", "none", None]
    assert [r.hit for r in rows.regex_test(df, "sku", "AB", "hit").collect()] == [True, True, False, None]
    assert [r.w for r in rows.regex_tokens(df, "sku", r"\d", "w").collect()] == ["1", "2", "3", "4"]


def test_transpose_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)], "sku string, east double, west double")
    assert sorted(got(rows.transpose(df, ["sku"])), key=str) == sorted([("a", "east", 1.0), ("a", "west", None), ("b", "east", None), ("b", "west", 2.0)], key=str)
    mixed = rows.transpose(df.withColumn("n", F.lit(3)), ["sku"], ["east", "n"])
    assert {r.Value for r in mixed.collect()} == {"1", None, "3"}
    assert rows.transpose(df, ["sku"], []).count() == 0


def test_cross_tab(spark):
    df = spark.createDataFrame([("s", "E-1", 1), ("s", "E-1", 2), ("s", "w", None), ("t", "zz", 5), (None, "w", 4)], "sku string, wh string, qty int")
    out = rows.cross_tab(df, ["sku"], "wh", "qty", "sum", headers=["E-1", "w", "none"])
    assert out.columns == ["sku", "E_1", "w", "none"]
    assert sorted(got(out), key=str) == sorted([("s", 3.0, None, None), ("t", None, None, None), (None, None, 4.0, None)], key=str)
    assert rows.cross_tab(df, ["sku"], "wh", "qty", "count").columns == ["sku", "E_1", "w", "zz"]
    counted = {r.sku: r for r in rows.cross_tab(df, ["sku"], "wh", "qty", "count").collect()}
    assert counted["t"].E_1 is None and counted["s"].E_1 == 2  # a missing combination is NULL, never 0
    assert rows.cross_tab(df, ["sku"], "wh", "qty", "concat", headers=["E-1"]).filter("sku = 's'").first().E_1 == "1,2"


def test_text_and_names(spark):
    df = spark.createDataFrame([("a,b,c",), ("x",), (None,)], "t string")
    assert got(rows.text_to_columns(df, "t", ",", 2, "p").drop("t")) == [("a", "b,c"), ("x", None), (None, None)]
    assert got(rows.text_to_columns(df, "t", ",", 2, "p", extra="drop").drop("t"))[0] == ("a", "b")
    assert [r.t for r in rows.text_to_rows(df, "t", ",").collect()] == ["a", "b", "c", "x", None]
    assert [r.t for r in rows.find_replace(df, "t", [("A", "$1"), ("x", "y")], ignore_case=True).collect()] == ["$1,b,c", "y", None]
    assert rows.rename(spark.createDataFrame([(1, 2)], ["custId", "a b"]), rows.upper_snake).columns == ["CUST_ID", "A_B"]
    with pytest.raises(ValueError, match="one name"):
        rows.rename(spark.createDataFrame([(1, 2)], ["a b", "a-b"]), rows.upper_snake)


@pytest.fixture(scope="module")
def steps(spark):
    data = [("u", 1, 10.0), ("u", 2, None), ("u", 3, 5.0), ("w", 1, 1.0), ("w", 2, 2.0), (None, 1, 4.0), (None, 2, 6.0)]
    return spark.createDataFrame(data, "g string, s int, v double")


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_order_does_not_depend_on_partitions(steps, parts):
    dealt = steps.repartition(parts, "s")
    run = order.running_total(dealt, "v", "run", ["s"], ["g"])
    assert got(run.select("g", "s", "run"), "g", "s") == [(None, 1, 4.0), (None, 2, 10.0), ("u", 1, 10.0), ("u", 2, None), ("u", 3, None), ("w", 1, 1.0), ("w", 2, 3.0)]
    assert got(order.record_id(dealt, "rid", ["-g", "s"], 5).select("rid", "g", "s"), "rid") == [(5, "w", 1), (6, "w", 2), (7, "u", 1), (8, "u", 2), (9, "u", 3), (10, None, 1), (11, None, 2)]
    firsts = order.unique(dealt, ["g"], ["-s"])
    assert sorted(map(str, got(firsts.unique.select("g", "s")))) == sorted(map(str, [("u", 3), ("w", 2), (None, 2)])) and firsts.duplicates.count() == 4


def test_sample(steps):
    pick = lambda mode, n, by=("g",): sorted((str(r.g), r.s) for r in order.sample(steps, mode, n, ["g", "s"] if not by else ["s"], list(by)).collect())
    assert pick("first", None) == [("None", 1), ("u", 1), ("w", 1)] and pick("last", 0) == [] and pick("last", 1) == [("None", 2), ("u", 3), ("w", 2)]
    assert pick("skip", 1) == [("None", 2), ("u", 2), ("u", 3), ("w", 2)] and pick("one_in_n", 2) == [("None", 1), ("u", 1), ("u", 3), ("w", 1)]
    assert pick("first", 2, ()) == [("None", 1), ("None", 2)] and pick("last", 1, ()) == [("w", 2)] and len(pick("one_in_n", 3, ())) == 3


def test_neighbours(steps):
    by = (["s"], ["g"])
    out = steps.select("g", "s", order.neighbour(steps, "v", -1, *by).alias("a"), order.neighbour(steps, "v", -1, *by, outside="zero").alias("b"), order.neighbour(steps, "v", 2, *by, outside="nearest").alias("c"))
    assert got(out.filter("g = 'u'"), "s") == [("u", 1, None, 0.0, 5.0), ("u", 2, 10.0, 10.0, 5.0), ("u", 3, None, None, 5.0)]


def test_fold(steps):
    step = lambda before, r: F.when(r["v"].isNull(), 0.0).otherwise(F.coalesce(before, F.lit(0.0)) + r["v"])
    assert got(order.fold(steps, "bal", "double", step, ["v"], ["s"], ["g"]).select("g", "s", "bal").filter("g is not null"), "g", "s") == [("u", 1, 10.0), ("u", 2, 0.0), ("u", 3, 5.0), ("w", 1, 1.0), ("w", 2, 3.0)]


def test_tiles_and_ties(steps):
    assert [r.t for r in order.tile_records(steps, 2, "t", ["s"], ["g"]).orderBy("g", "s").collect()] == [1, 2, 1, 1, 2, 1, 2]
    assert [r.t for r in order.tile_sum(steps, 2, "v", "t", ["s"], ["g"]).filter("g = 'w'").orderBy("s").collect()] == [1, 2]
    assert [r.t for r in order.tile_manual(steps, "v", [2, 5], "t").orderBy("g", "s").collect()] == [2, 3, 3, None, 2, 1, 1]
    assert order.has_ties(steps, ["g"]) and not order.has_ties(steps, ["g", "s"])


def test_join_three_ways(spark, sales):
    people = spark.createDataFrame([("Bo", 1, "x"), ("bo", 2, "y"), (None, 3, "z"), ("Cy", 4, "w")], "customer string, id int, tier string")
    j = joins.join(sales, people, [("CUSTOMER", "customer")])
    assert j.inner.columns == [*sales.columns, "Right_customer", "Right_id", "tier"]
    assert sorted(r.id for r in j.inner.collect()) == [2, 3]
    assert sorted(r.id for r in j.left.collect()) == [1, 4, 4, 5] and sorted(r.id for r in j.right.collect()) == [2, 3, 4]
    text = joins.join(sales, people.withColumn("k", C("id").cast("string")), [("id", "k")])
    assert (text.inner.count(), text.left.count(), text.right.count()) == (0, 6, 4)
    with pytest.raises(ValueError, match="absent"):
        joins.join(sales, people, [("absent", "id")])


def test_unions(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, n string"), spark.createDataFrame([("y", 2.0, 2)], "N string, z double, k int")
    named = joins.union_by_name(a, b)
    assert named.columns == ["k", "n", "z"] and got(named, "k") == [(1, "x", None), (2, "y", 2.0)]
    placed = joins.union_by_position(a, spark.createDataFrame([(7,)], "q int"), spark.createDataFrame([(8, "w", True)], "q int, r string, s boolean"))
    assert placed.columns == ["k", "n"] and got(placed, "k") == [(1, "x"), (7, None), (8, "w")]


def test_small_side_is_checked(spark):
    with pytest.raises(ValueError, match="more than 3"):
        joins.append_fields(spark.range(2), spark.range(4).toDF("x"), max_rows=3)


def test_summarize(spark, steps):
    s = summarize.summarize(steps, ["g"], Agg("sum", "v"), Agg("avg", "v"), Agg("count", out="n"), Agg("count_non_null", "v", "m"), Agg("first", "v", "f", ("s",)), Agg("last", "v", "l", ("s",)), Agg("concat", "v", "c", ("s",), "; "))
    assert got(s.filter("g = 'u'")) == [("u", 15.0, 7.5, 3, 2, 10.0, 5.0, "10; 5")]
    nulls = spark.createDataFrame([("a", None, 2), ("a", None, 1)], "g string, v decimal(9,2), s int")
    out = summarize.summarize(nulls, ["g"], Agg("sum", "v"), Agg("concat", "v", "c", ("s",)), Agg("count_distinct", "v", "d"))
    assert got(out) == [("a", None, "", 0)] and out.schema["sum_v"].dataType == T.DecimalType(9, 2)
    assert summarize.summarize(steps.limit(0), [], Agg("count")).count() == 0 and summarize.summarize(steps, [], Agg("count")).first()[0] == 7
    with pytest.raises(ValueError, match="order_by"):
        summarize.aggregate(steps, Agg("last", "v"))


def test_last_is_not_max(steps):
    """Mutation: the last value by order differs from the largest."""
    last = summarize.summarize(steps, ["g"], Agg("last", "v", "x", ("s",))).filter("g = 'u'").first().x
    assert last == 5.0 != summarize.summarize(steps, ["g"], Agg("max", "v", "x")).filter("g = 'u'").first().x


def test_every_operator_takes_an_empty_table(steps):
    none = steps.limit(0)
    for df in (
        rows.select(none, [Pick("g")]), rows.split(none, C("s") > 1).false, rows.transpose(none, ["g"], ["v"]), rows.cross_tab(none, ["g"], "s", "v", headers=["1"]), order.record_id(none, "r", ["s"]), order.sample(none, "last", 2, ["s"], ["g"]),
        order.unique(none, ["g"], ["s"]).unique, order.running_total(none, "v", "r", ["s"], ["g"]), joins.join(none, steps, [("g", "g")]).inner, summarize.summarize(none, ["g"], Agg("sum", "v")), rows.cross_tab(none, ["g"], "s", "v"),
    ):
        assert df.count() == 0


def test_sums_of_any_size(spark):
    df = spark.createDataFrame([("a", 1e20, 10**18), ("a", 1.0, 10**18), ("b", 0.1, None), ("b", 0.2, 5), ("c", 1e308, 1), ("c", 1e308, 1)], "g string, x double, n long")
    found = {r.g: (r.s, r.m, r.n) for r in summarize.summarize(df, ["g"], Agg("sum", "x", "s"), Agg("avg", "x", "m"), Agg("sum", "n", "n")).collect()}
    assert found == {"a": (1e20, 5e19, 2e18), "b": (0.3, 0.15, 5.0), "c": (None, None, 2.0)}


def test_cross_tab_keeps_order_and_null_headers(spark):
    df = spark.createDataFrame([(1, "a", "k", "z"), (2, "a", "k", "b"), (3, "a", None, "n"), (4, "b", "", None), (5, "b", "k", "x")], "at int, g string, h string, v string")
    found = {r.g: (r["_"], r.k) for r in rows.cross_tab(df, ["g"], "h", "v", "concat", order_by=["at"]).collect()}
    assert found == {"a": ("n", "z,b"), "b": ("", "x")}
