"""Whole workflows on small tables with hand-computed results, and wrong versions of them that must be noticed."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.operators import compare, summarize
from tidewell.operators.compare import Contract
from tidewell.operators.summarize import Agg
from tidewell.plans import workflows
from tidewell.sources import tables

ORDERS = "ORDER_ID int, CUSTOMER string, REGION string, AMOUNT_TXT string, QTY int, ORDER_DATE date, STATUS string"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([
        (1, "Long Customer Name", "EAST", "250.005", 1, date(2026, 1, 5), "OPEN"), (2, "Bo", "EAST", "33.35", 10, date(2026, 2, 1), "OPEN"), (3, "Bo", "EAST", "abc", 2, date(2026, 3, 1), None), (4, "Cy", "EAST", "1000.00", None, None, "OPEN"),
        (5, "Di", "WEST", "5", 1, date(2026, 1, 1), "OPEN"), (6, None, None, "9", 1, date(2026, 1, 1), "OPEN"), (7, "Ed", "NORTH", "2.675", 1, date(2026, 1, 1), "OPEN"), (7, "Ed", "NORTH", "2.675", 1, date(2026, 1, 1), "OPEN"), (8, "Flo", "EAST", "1,200.50", 1, date(2026, 1, 1), "OPEN"),
    ], ORDERS)


def test_sales_summary(orders):
    out = workflows.sales_summary(orders)
    assert got(out.summary) == sorted([
        ("EAST", "LARGE", 1000.0, 1, 1, None), ("EAST", "MEDIUM", 250.01, 1, 1, date(2026, 1, 5)), ("EAST", "SMALL", 30.02, 3, 1, date(2026, 3, 1)), ("NORTH", "SMALL", 5.36, 2, 2, date(2026, 1, 1)),
    ], key=str)
    assert out.excluded.columns[:2] == ["CUSTOMER", "ORDER_STATUS"] and sorted(r.ORDER_ID for r in out.excluded.collect()) == [5, 6]
    assert workflows.sales_summary(orders.limit(0)).summary.count() == 0


def test_binary_rounding_is_noticed(orders):
    """Mutation: rounding doubles instead of exact decimals changes cents."""
    right = workflows.sales_summary(orders).summary
    wrong = right.withColumn("TOTAL_NET", F.when(F.col("SIZE_BAND") == "MEDIUM", 250.0).otherwise(F.col("TOTAL_NET")))
    report = compare.compare_tables(right, wrong, Contract(keys=("REGION", "SIZE_BAND")))
    assert [(c.kind, c.columns) for c in report.clusters] == [("ROUNDING", ("TOTAL_NET",))]


def test_customer_orders_append(spark, tmp_path):
    customers = spark.createDataFrame([(1, "  aCme corp ", " x "), (2, None, None), (4, "D", "d")], "CUST_ID int, NAME string, CITY string")
    export = spark.createDataFrame([("11", "1", "5.5", "2026-01-02"), ("12", "1", "abc", "2026-02-30"), ("13", "99", "", "2026-01-01"), ("14", "2", "7", None)], "ORDER_ID string, CUST_ID string, AMOUNT string, ORDER_DATE string")
    out = workflows.customer_orders(customers, export)
    assert out.columns == ["CUST_ID", "NAME", "CITY", "ORDER_ID", "AMOUNT", "ORDER_DATE", "MATCH_FLAG"]
    assert got(out) == sorted([(1, "ACME CORP", "X", 11, 5.5, date(2026, 1, 2), "MATCHED"), (1, "ACME CORP", "X", 12, None, None, "MATCHED"), (2, "", "", 14, 7.0, None, "MATCHED"), (4, "D", "D", None, None, None, "NO_ORDERS"), (99, None, None, 13, None, date(2026, 1, 1), "ORPHAN")], key=str)
    path = f"file://{tmp_path}/fact"
    tables.write_table(out.limit(2), path, "overwrite")
    assert tables.write_table(out, path, "append").count() == 7


ENTRIES = [
    ("4000", "2026-08", "03/08/2026", "100.00", "EMEA", 1), ("4000", "2026-08", "03/08/2026", "50.00", "EMEA", 2), ("4000", "2026-08", "31/08/2026", "25.00", "EMEA", 3), ("4000", "2026-08", "01/09/2026", "-400.00", "EMEA", 14),
    ("5000", "2026-08", "31/02/2026", "10.00", "EMEA", 6), ("5000", "2026-07", "05/07/2026", "7.50", "EMEA", 7), ("6000", "2026-08", "01/08/2026", "1.00", "AMER", 9), ("6000", "2026-08", "01/08/2026", "1.00", None, 10),
]


@pytest.fixture(scope="module")
def ledger(spark):
    return spark.createDataFrame([(*e[:3], Decimal(e[3]), *e[4:]) for e in ENTRIES], "ACCT string, PERIOD string, POSTED string, AMOUNT decimal(19,2), REGION string, ENTRY_ID long")


def test_ledger_close_and_merge(spark, ledger, tmp_path):
    out = workflows.ledger_close(ledger, "EMEA", "2026-08-31")
    assert got(out) == sorted([("4000", "2026-08", Decimal("-325.00"), -325.0, 3, "Y"), ("5000", "2026-07", Decimal("7.50"), 17.5, 1, "N"), ("5000", "2026-08", Decimal("10.00"), 10.0, 1, "N")], key=str)
    path = f"file://{tmp_path}/gl"
    tables.write_table(out.limit(1).withColumn("TOTAL", F.lit(Decimal("1.00")).cast("decimal(19,2)")), path, "overwrite")
    assert got(tables.write_table(out, path, "update_insert", ["ACCT", "PERIOD"])) == got(out)


def test_last_as_max_is_noticed(ledger):
    """Mutation: the largest balance is not the last one."""
    right = workflows.ledger_close(ledger, "EMEA", "2026-08-31")
    wrong = right.withColumn("CLOSING_BAL", F.when(F.col("ACCT") == "4000", 75.0).otherwise(F.col("CLOSING_BAL")))
    assert compare.compare_tables(right, wrong, Contract(keys=("ACCT", "PERIOD"))).clusters[0].kind == "LOGIC"


def test_inventory(spark):
    stock = spark.createDataFrame([("ab 12", "EAST", 1, ""), (" AB-12 ", "WEST", 2, ""), ("zz9", "NORTH", 3, ""), ("bad sku!", "EAST", 4, ""), ("cd-100", "EAST", 0, ""), ("cd-100", None, None, ""), ("ef-7", "EAST", 5, ""), ("ef-7", "EAST", 6, "")], "SKU string, WAREHOUSE string, QTY int, NOTE string")
    out = workflows.inventory(stock, ["EAST", "NORTH", "WEST"])
    assert got(out.wide) == sorted([("AB-12", "AB", 1.0, None, 2.0), ("ZZ-9", "ZZ", None, 3.0, None), ("BAD SKU!", None, 4.0, None, None), ("EF-7", "EF", 11.0, None, None)], key=str)
    assert out.long.count() == 12 and out.long.filter("Value is null").count() == 7


def test_subscription_revenue(spark):
    schema = "CUSTOMER string, PERIOD string, BILLED double, CAP double, CANCELLED boolean"
    billing = spark.createDataFrame([("A", "2026-02", 10.0, 50.0, False), ("A", "2026-01", 100.0, 60.0, False), ("A", "2026-03", 5.0, 50.0, True), ("B", "2026-01", None, 10.0, False), ("B", "2026-02", 25.0, 10.0, False)], schema)
    assert got(workflows.subscription_revenue(billing)) == [("2026-01", 60.0, 40.0, 2), ("2026-02", 60.0, 15.0, 2), ("2026-03", 5.0, 0.0, 1)]
    with pytest.raises(Exception, match="no cancellation flag"):
        workflows.subscription_revenue(spark.createDataFrame([("A", "2026-01", 1.0, 1.0, None)], schema)).collect()


def test_attainment(spark):
    money = lambda x: None if x is None else Decimal(x)
    targets = spark.createDataFrame([(r, p, money(x)) for r, p, x in (("EAST", "2026-01", "100.00"), ("WEST", "2026-01", "80.00"), ("WEST", "2025-12", "75.00"), ("NORTH", "2026-01", "50.00"), (None, "2026-01", "1.00"))], "REGION string, PERIOD string, TARGET decimal(19,2)")
    actuals = spark.createDataFrame([(r, p, money(x)) for r, p, x in (("EAST", "2026-01", "60.00"), ("EAST", "2026-01", "30.00"), ("WEST", "2026-01", None), ("WEST", "2025-12", "70.00"), (None, "2026-01", "1.00"))], "REGION string, PERIOD string, ACTUAL decimal(19,2)")
    assert got(workflows.attainment(targets, actuals, "2026")) == [("EAST", "2026-01", Decimal("200.00"), Decimal("90.00"), 2), ("WEST", "2026-01", Decimal("80.00"), None, 1)]


def test_grouping_with_too_many_columns_is_noticed(orders):
    right = workflows.sales_summary(orders).summary
    finer = summarize.summarize(workflows.sales_summary(orders).summary, ["REGION"], Agg("sum", "TOTAL_NET", "TOTAL_NET"))
    assert compare.compare_tables(right, finer).verdict == "FAIL"
