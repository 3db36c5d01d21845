"""Registered queries over the driver's tables, each with the SQL that gives the same rows.

"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, scalar
from ..functions.types import Field, coerce_in, to_number
from ..operators import checks, compare, joins, order, rows, summarize
from ..operators.rows import Formula, Pick
from ..operators.summarize import Agg
from ..sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
C = F.col


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- flagship ---------------------------------------------------------------------------------------------------


@query("""
WITH priced AS (
  SELECT o_orderpriority, round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.95, 2) AS net FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderpriority AS priority, CASE WHEN net < 50000 THEN 'small' WHEN net < 150000 THEN 'middle' ELSE 'large' END AS band,
       CAST(sum(net) AS DOUBLE) AS total_net, count(*) AS n_orders FROM priced GROUP BY ALL""")
def p0_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, sequential formulas, banding, summary: the shape of a whole workflow."""
    orders = rows.split(table(spark, sf_dir, "orders"), C("o_orderstatus") != "P").true
    orders = rows.formulas(
        orders,
        Formula(Field("net", "Double"), lambda t: scalar.round_to(t, scalar.multiply(t, C("o_totalprice"), F.lit(0.95)), "0.01")),
        Formula(Field("band", "V_String"), lambda t: scalar.if_chain((C("net") < 50000, "small"), (C("net") < 150000, "middle"), otherwise="large")),
    )
    orders = rows.select(orders, [Pick("o_orderpriority", rename="priority"), Pick("band"), Pick("net")])
    return summarize.summarize(orders, ["priority", "band"], Agg("sum", "net", "total_net"), Agg("count", out="n_orders"))


flagship = p0_sales_summary

# ---- sources and sinks ------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,1))::DOUBLE AS price, CAST(o_orderdate AS DATE) AS day, left(o_orderpriority, 4) AS priority FROM orders")
def s1_declared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").select("o_orderkey", C("o_totalprice").alias("price"), C("o_orderdate").alias("day"), C("o_orderpriority").alias("priority"))
    out = tables.as_fields(raw, [Field("o_orderkey", "Int64"), Field("price", "FixedDecimal", 19, 1), Field("day", "Date"), Field("priority", "String", 4)])
    return out.withColumn("price", C("price").cast("double"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s2_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{tables.checkpoint_dir(spark)}/csv-{_unique()}"
    table(spark, sf_dir, "supplier").write.csv(path, header=True, escape='"')
    return tables.read_csv(spark, path, [Field("s_suppkey", "Int64"), Field("s_name", "V_String"), Field("s_nationkey", "Int32"), Field("s_acctbal", "Double")])


@query("SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS event_type, value FROM events")
def s3_typed_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes and reads NULL, empty text, doubles and whole-second time stamps."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.when(C("event_id") % 5 == 0, None).when(C("event_id") % 7 == 0, "").otherwise(C("event_type")).alias("event_type"), "value")
    whole = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    path = f"{tables.checkpoint_dir(spark)}/csv-{_unique()}"
    tables.write_typed_csv(whole, path)
    fields = [Field("event_id", "Int64"), Field("ts", "V_String"), Field("event_type", "V_String"), Field("value", "Double")]
    return tables.read_typed_csv(spark, path, fields).withColumn("ts", F.to_timestamp_ntz("ts", F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))


def _unique() -> str:
    import uuid

    return uuid.uuid4().hex


def _written(spark: SparkSession, sf_dir: str, mode: str, keys: list[str] = (), before=None, after=None) -> DataFrame:
    """Suppliers written first, then a changed part of them and some new ones in the given mode; read back."""
    folder = f"{tables.checkpoint_dir(spark)}/table-{_unique()}"
    supplier = table(spark, sf_dir, "supplier")
    tables.write_table(supplier, folder, "overwrite")
    changed = supplier.filter("s_suppkey % 3 = 0").select("s_suppkey", (C("s_acctbal") + 1000.0).alias("s_acctbal"), F.upper("s_name").alias("S_NAME"), F.lit("x").alias("unknown"))
    new = supplier.filter("s_suppkey % 4 = 0").select((C("s_suppkey") + 1_000_000).alias("s_suppkey"), "s_acctbal", C("s_name").alias("S_NAME"), F.lit("x").alias("unknown"))
    return tables.write_table(changed.union(new), folder, mode, list(keys), before, after)


_INCOMING = """incoming AS (SELECT s_suppkey, s_acctbal + 1000.0 AS s_acctbal, upper(s_name) AS s_name FROM supplier WHERE s_suppkey % 3 = 0
  UNION ALL SELECT s_suppkey + 1000000, s_acctbal, s_name FROM supplier WHERE s_suppkey % 4 = 0)"""


@query(f"WITH {_INCOMING} SELECT s_suppkey, s_acctbal, s_name AS \"S_NAME\", 'x' AS unknown FROM incoming")
def s6_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "overwrite")


@query(f"WITH {_INCOMING} SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM incoming")
def s7_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "append")


@query(f"WITH {_INCOMING} SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey, s_acctbal FROM incoming")
def s8_truncate_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "truncate_append")


_MERGED = f"""{_INCOMING} SELECT t.s_suppkey, coalesce(i.s_name, t.s_name) AS s_name, t.s_nationkey, coalesce(i.s_acctbal, t.s_acctbal) AS s_acctbal
  FROM target t LEFT JOIN incoming i ON t.s_suppkey = i.s_suppkey
  UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM incoming WHERE s_suppkey NOT IN (SELECT s_suppkey FROM target)"""


@query(f"WITH target AS (SELECT * FROM supplier), {_MERGED}")
def s9_update_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "update_insert", ["s_suppkey"])


@query("SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1")
def s10_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.repeated_keys(table(spark, sf_dir, "orders"), ["o_custkey"])


@query(f"""WITH target AS (SELECT * FROM supplier WHERE s_nationkey <> 3), {_MERGED.replace('SELECT t.s_suppkey', 'SELECT * REPLACE (CASE WHEN s_acctbal < 0 THEN 0.0 ELSE s_acctbal END AS s_acctbal) FROM (SELECT t.s_suppkey')})""")
def s11_steps_before_and_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "merge", ["s_suppkey"], before=lambda t: t.filter("s_nationkey <> 3"), after=lambda t: t.withColumn("s_acctbal", F.when(C("s_acctbal") < 0, 0.0).otherwise(C("s_acctbal"))))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def s15_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = tables.sources(spark, sf_dir, ["orders"])
    return tables.snapshot(named["orders"].select("o_orderkey", "o_orderstatus"), "orders", f"{tables.checkpoint_dir(spark)}/stages-{_unique()}")


# ---- rows and columns -------------------------------------------------------------------------------------------


@query("SELECT left(p_name, 6) AS name, p_partkey, CAST(p_retailprice AS VARCHAR) IS NOT NULL AS has_price, p_brand, p_size FROM part")
def p1_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("has_price", C("p_retailprice").isNotNull())
    return rows.select(part, [Pick("P_NAME", rename="name", type="String", size=6), Pick("p_partkey"), Pick("has_price", type="Bool"), Pick("p_type", keep=False), Pick("p_retailprice", keep=False), Pick("absent")], others=True)


@query("SELECT c_custkey, (c_acctbal > 0 AND c_mktsegment = 'BUILDING') AS side FROM customer")
def p2_filter_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = rows.split(table(spark, sf_dir, "customer"), (C("c_acctbal") > 0) & (C("c_mktsegment") == "BUILDING"))
    return both.true.select("c_custkey", F.lit(True).alias("side")).union(both.false.select("c_custkey", F.lit(False)))


@query("SELECT event_id FROM events WHERE CASE WHEN event_id % 3 = 0 THEN NULL ELSE value > 10 END IS NOT TRUE")
def p2_null_goes_to_false(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.split(table(spark, sf_dir, "events"), F.when(C("event_id") % 3 != 0, C("value") > 10)).false.select("event_id")


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,2))), 2) AS net, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(net AS DOUBLE) AS net, CAST(round(net * (1 + CAST(l_tax AS DECIMAL(6,2))), 2) AS DOUBLE) AS gross FROM a""")
def p3_formulas_in_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    out = rows.formulas(
        items,
        Formula(
            Field("net", "Double"), lambda t: scalar.round_to(t, C("raw"), "0.01"),
            (("rate", lambda t: scalar.subtract(t, F.lit(1), C("l_discount"))), ("raw", lambda t: scalar.multiply(t, C("l_extendedprice"), C("rate")))),
        ),
        Formula(
            Field("gross", "Double"), lambda t: scalar.round_to(t, C("raw"), "0.01"),
            (("rate", lambda t: scalar.add(t, F.lit(1), C("l_tax"))), ("raw", lambda t: scalar.multiply(t, C("net"), C("rate")))),
        ),
    )
    return out.select("l_orderkey", "l_linenumber", "net", "gross")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def p4_sort_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.sort(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"]).limit(25)


@query("SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 99 AS rid, o_orderkey FROM orders")
def p5_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.record_id(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "rid", ["o_orderdate", "o_orderkey"], start=100).drop("o_orderdate")


_RANKED = "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders"


@query(f"SELECT o_custkey, o_orderkey FROM ({_RANKED}) WHERE n = 1")
def p6_first_of_each_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.unique(table(spark, sf_dir, "orders"), ["o_custkey"], ["-o_orderdate", "o_orderkey"]).unique.select("o_custkey", "o_orderkey")


@query(f"SELECT o_custkey, o_orderkey FROM ({_RANKED}) WHERE n > 1")
def p6_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.unique(table(spark, sf_dir, "orders"), ["o_custkey"], ["-o_orderdate", "o_orderkey"]).duplicates.select("o_custkey", "o_orderkey")


def _sampled(spark: SparkSession, sf_dir: str, mode: str, n: int, group_by: list[str]) -> DataFrame:
    return order.sample(table(spark, sf_dir, "events").select("event_id", "ts", "user_id"), mode, n, ["ts", "event_id"], group_by).select("event_id", "user_id")


_EVENTS = "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS m, row_number() OVER (ORDER BY ts, event_id) AS k FROM events"


@query(f"SELECT event_id, user_id FROM ({_EVENTS}) WHERE n <= 2")
def p7_first_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "first", 2, ["user_id"])


@query(f"SELECT event_id, user_id FROM ({_EVENTS}) WHERE m <= 2")
def p7_last_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "last", 2, ["user_id"])


@query(f"SELECT event_id, user_id FROM ({_EVENTS}) WHERE n > 1")
def p7_skip_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "skip", 1, ["user_id"])


@query(f"SELECT event_id, user_id FROM ({_EVENTS}) WHERE (k - 1) % 10 = 0")
def p7_one_in_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "one_in_n", 10, [])


@query(r"""SELECT doc_id, upper(trim(regexp_replace(regexp_replace(replace(replace(replace(text, chr(9), ' '), chr(13), ' '), chr(10), ' '), ' {2,}', ' ', 'g'), '[!-/:-@\[-`{-~]+', '', 'g'), ' ' || chr(10) || chr(9))) AS text FROM documents WHERE lang = 'en' AND NOT regexp_matches(text, '[^\x00-\x7F]')""")
def p8_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter((C("lang") == "en") & ~C("text").rlike(r"[^\x00-\x7F]")).select("doc_id", "text")
    clean = rows.cleanse(docs, ["text"], blank_for_null=True, double_spaces=True, punctuation=True, case="upper")
    return rows.cleanse(clean, ["text"], trim=True)


@query(r"""SELECT event_id, CASE WHEN regexp_matches(event_type, '^([a-z]+)_?([a-z]*)') THEN regexp_extract(event_type, '^([a-z]+)_?([a-z]*)', 1) END AS head,
CASE WHEN regexp_matches(event_type, '^([a-z]+)_?([a-z]*)') THEN regexp_extract(event_type, '^([a-z]+)_?([a-z]*)', 2) END AS tail FROM events""")
def p9_regex_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rows.regex_parse(events, "event_type", "^([a-z]+)_?([a-z]*)", [Field("head", "V_String"), Field("tail", "V_String")], ignore_case=False).drop("event_type")


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '#[0-9]$') THEN regexp_replace(p_brand, 'Brand#([0-9])', 'B-\1', 'g') END AS brand FROM part")
def p10_regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(C("p_brand").rlike("#[0-9]$"), C("p_brand")).alias("brand"))
    return rows.regex_substitute(part, "brand", r"Brand#(\d)", "B-$1", copy_unmatched=False, ignore_case=False)


@query("SELECT p_partkey, regexp_matches(lower(p_type), 'steel|brass') AS metal FROM part")
def p11_regex_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.regex_test(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", "STEEL|BRASS", "metal").drop("p_type")


@query("SELECT p_partkey, unnest(regexp_extract_all(p_name, '[a-z]+')) AS word FROM part")
def p12_regex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.regex_tokens(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "[a-z]+", "word").drop("p_name")


@query("SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS shown, CAST(o_orderdate AS DATE)::TIMESTAMP AS parsed FROM orders")
def p13_text_and_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = rows.time_to_text(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "%d/%m/%Y", "shown")
    return rows.text_to_time(orders, "shown", "%d/%m/%Y", "parsed").drop("o_orderdate")


@query("""SELECT l_orderkey, l_linenumber, u.name AS "Name", u.value AS "Value" FROM lineitem,
LATERAL (VALUES ('l_quantity', l_quantity), ('l_discount', l_discount), ('l_tax', CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END)) u(name, value)""")
def p14_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", F.when(C("l_linenumber") != 1, C("l_tax")).alias("l_tax"))
    return rows.transpose(items, ["l_orderkey", "l_linenumber"])


@query("""SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS "1_URGENT",
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '5-LOW') AS DOUBLE) AS "5_LOW", CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = 'none') AS DOUBLE) AS none
FROM orders GROUP BY o_orderstatus""")
def p15_cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.cross_tab(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority", "o_totalprice", "sum", headers=["1-URGENT", "5-LOW", "none"])


@query("""SELECT l_shipmode_month AS month, nullif(count(*) FILTER (l_returnflag = 'A'), 0) AS "A", nullif(count(*) FILTER (l_returnflag = 'N'), 0) AS "N", nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS "R"
FROM (SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmode_month, l_returnflag FROM lineitem) GROUP BY 1""")
def p15_cross_tab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_returnflag", "l_orderkey")
    return rows.cross_tab(items, ["month"], "l_returnflag", "l_orderkey", "count")


@query("SELECT p_partkey, upper(p_name) AS u_p_name, upper(p_type) AS u_p_type FROM part")
def p19_multi_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.multi_field(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), ["p_name", "p_type"], F.upper, "u_").drop("p_name", "p_type")


@query("SELECT p_partkey, split_part(p_type, ' ', 1) AS t1, CASE WHEN p_type LIKE '% %' THEN substr(p_type, instr(p_type, ' ') + 1) END AS t2 FROM part")
def p20_text_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.text_to_columns(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", " ", 2, "t").drop("p_type")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name FROM part")
def p20_text_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.text_to_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", " ")


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' WHEN contains(c_mktsegment, 'MACH') THEN replace(c_mktsegment, 'MACH', 'mach') ELSE c_mktsegment END AS c_mktsegment FROM customer")
def p21_find_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    whole = rows.find_replace(customer, "c_mktsegment", [("BUILDING", "B")], whole=True)
    return rows.find_replace(whole, "c_mktsegment", [("MACH", "mach"), ("zzz", "y")])


@query('SELECT s_suppkey AS "S_SUPPKEY", s_nationkey AS "S_NATIONKEY", s_acctbal AS "S_ACCTBAL" FROM supplier')
def p22_dynamic_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.rename(rows.select_types(table(spark, sf_dir, "supplier"), "number"), rows.upper_snake)


@query("SELECT c_custkey, ntile(5) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)::INTEGER AS tile FROM customer")
def p23_tile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return order.tile_records(customer, 5, "tile", ["c_acctbal", "c_custkey"], ["c_nationkey"]).select("c_custkey", "tile")


@query("""SELECT o_orderkey, CAST(greatest(1, least(4, ceil(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) * 4.0
/ sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey)))) AS INTEGER) AS tile FROM orders""")
def p23_tile_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.tile_sum(table(spark, sf_dir, "orders"), 4, "o_totalprice", "tile", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", "tile")


@query("SELECT p_partkey, CASE WHEN p_retailprice <= 950 THEN 1 WHEN p_retailprice <= 1200 THEN 2 ELSE 3 END AS tile FROM part")
def p23_tile_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.tile_manual(table(spark, sf_dir, "part"), "p_retailprice", [950, 1200], "tile").select("p_partkey", "tile")


@query()
def p24_random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.random_sample(table(spark, sf_dir, "lineitem"), 0.1, 7)


# ---- joins and unions -------------------------------------------------------------------------------------------


@query("SELECT c.c_custkey, c_name, o_orderkey, o_totalprice FROM customer c JOIN orders ON c.c_custkey = o_custkey")
def j1_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks = [Pick("c_custkey"), Pick("c_name"), Pick("o_orderkey"), Pick("o_totalprice")]
    return joins.join(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), [("c_custkey", "o_custkey")], picks, others=False).inner


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def j2_left_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 200000")
    return joins.join(table(spark, sf_dir, "customer"), large, [("c_custkey", "o_custkey")]).left.select("c_custkey", "c_name")


@query("SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def j3_right_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys match nothing and stay on their side."""
    some = table(spark, sf_dir, "customer").filter("c_nationkey < 12")
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", F.when(C("o_orderkey") % 5 != 0, C("o_custkey")))
    return joins.join(some, orders, [("c_custkey", "o_custkey")]).right.select("o_orderkey")


@query('SELECT c_custkey, c_name, c_nationkey, c_custkey AS "Right_c_custkey", c_name AS "Right_c_name", c_nationkey AS "Right_c_nationkey" FROM customer')
def j1_colliding_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.join(customer, customer, [("c_nationkey", "c_nationkey"), ("c_custkey", "c_custkey")]).inner


@query("SELECT c_custkey, c_name FROM customer")
def j4_text_never_matches_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.join(customer, customer.select(C("c_custkey").cast("string").alias("key")), [("c_custkey", "key")]).left


_KEYS = "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS k FROM orders"


@query(f"SELECT o_orderkey FROM ({_KEYS}) WHERE k IS NULL OR k IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def j10_null_safe_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(C("o_orderkey") % 9 != 0, C("o_custkey")).alias("k"))
    known = table(spark, sf_dir, "customer").filter("c_nationkey < 12").select("c_custkey").union(table(spark, sf_dir, "customer").select(F.lit(None).cast("long")))
    return joins.join_null_safe(orders, known, [("k", "c_custkey")], "left_semi").select("o_orderkey")


@query("SELECT s_suppkey, r_regionkey, r_name FROM supplier, region")
def j6_append_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.append_fields(table(spark, sf_dir, "supplier").select("s_suppkey"), table(spark, sf_dir, "region"))


@query("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def j7_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run for each nation, as one grouped job."""
    return joins.batch(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), lambda t: summarize.summarize(t, ["n_name"], Agg("count", out="customers")), [("c_nationkey", "n_nationkey")])


@query("SELECT c_custkey, CASE WHEN c_acctbal > 1000 THEN c_acctbal / pow(2, ceil(log2(c_acctbal / 1000))) ELSE c_acctbal END AS c_acctbal FROM customer")
def j8_iterate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halve balances until none is above 1,000."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    halve = lambda t: t.withColumn("c_acctbal", F.when(C("c_acctbal") > 1000, C("c_acctbal") / 2).otherwise(C("c_acctbal")))
    return joins.iterate(customer, halve, lambda t: t.filter("c_acctbal > 1000").isEmpty(), 40)


@query("SELECT a.s_name, b.s_name AS \"Right_s_name\", levenshtein(a.s_name, b.s_name)::INTEGER AS distance FROM supplier a JOIN supplier b ON left(a.s_name, 17) = left(b.s_name, 17) AND levenshtein(a.s_name, b.s_name) <= 1")
def j9_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select("s_name")
    return joins.fuzzy_match(names, names, ("s_name", "s_name"), lambda c: F.substring(c, 1, 17), 1)


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier")
def u1_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(C("c_custkey").alias("key"), C("c_name").alias("name"), C("c_acctbal").alias("balance"))
    return joins.union_by_name(a, table(spark, sf_dir, "supplier").select(C("s_nationkey").alias("nation"), C("s_name").alias("NAME"), C("s_suppkey").alias("key")))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def u2_union_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.union_by_position(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


@query("SELECT o_custkey AS key FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000")
def u3_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(C("o_custkey").alias("key")).intersect(table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select("c_custkey"))


# ---- windows ----------------------------------------------------------------------------------------------------


@query("SELECT event_id, lag(value) OVER w AS before, coalesce(lead(value, 2) OVER w, CASE WHEN lead(event_id, 2) OVER w IS NULL THEN 0.0 END) AS after_next FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def w1_other_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    by = (["ts", "event_id"], ["user_id"])
    return events.withColumns({"before": order.neighbour(events, "value", -1, *by), "after_next": order.neighbour(events, "value", 2, *by, outside="zero")}).select("event_id", "before", "after_next")


@query("SELECT event_id, coalesce(lag(value) OVER w, first_value(value) OVER w) AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def w1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.withColumn("before", order.neighbour(events, "value", -1, ["ts", "event_id"], ["user_id"], outside="nearest")).select("event_id", "before")


@query("""SELECT o_orderkey, CASE WHEN max(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) OVER w = 0 THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) END AS run
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def w2_running_total_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("price", F.when(C("o_orderkey") % 50 != 0, C("o_totalprice")))
    return order.running_total(orders, "price", "run", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", "run")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT event_id, user_id, n, least(CAST(v AS DOUBLE), 100.0) AS balance FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, least(CASE WHEN e.event_id % 11 = 0 THEN 0.0 ELSE f.balance END + CAST(e.v AS DOUBLE), 100.0) FROM e JOIN f ON e.user_id = f.user_id AND e.n = f.n + 1)
SELECT event_id, round(balance, 6) AS balance FROM f""")
def w3_capped_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balance with a cap and resets: each row needs the row before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", C("value").cast("decimal(18,2)").cast("double").alias("value"))
    step = lambda before, r: F.least(F.when(before.isNull() | (r["event_id"] % 11 == 0), F.lit(0.0)).otherwise(before) + r["value"], F.lit(100.0))
    return order.fold(events, "balance", "double", step, ["event_id", "value"], ["ts", "event_id"], ["user_id"]).select("event_id", F.round("balance", 6).alias("balance"))


@query("SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS run FROM orders")
def w5_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.running_total(table(spark, sf_dir, "orders"), "o_totalprice", "run", ["o_orderdate", "o_orderkey"], ["o_custkey"], null="skip").select("o_orderkey", "run")


@query("SELECT user_id, max(value) AS peak, count(*) AS n FROM events GROUP BY user_id")
def p17_python_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas function for each group, with a declared schema."""
    def peak(pdf):
        import pandas as pd

        return pd.DataFrame({"user_id": [pdf.user_id.iloc[0]], "peak": [pdf.value.max()], "n": [len(pdf)]})

    return order.per_group(table(spark, sf_dir, "events").select("user_id", "value"), peak, "user_id long, peak double, n long", ["user_id"])


# ---- aggregates -------------------------------------------------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS price,
count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, min(l_shipdate) AS first_day, max(l_discount) AS discount FROM lineitem GROUP BY ALL""")
def a1_summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = summarize.summarize(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        Agg("sum", "l_quantity", "quantity"), Agg("avg", "l_extendedprice", "price"), Agg("count", out="n"), Agg("count_distinct", "l_suppkey", "suppliers"), Agg("min", "l_shipdate", "first_day"), Agg("max", "l_discount", "discount"),
    )
    return out.withColumn("price", F.round("price", 6))


@query("SELECT count(*) AS n FROM orders WHERE o_totalprice < 0 HAVING count(*) > 0")
def a1_nothing_gives_no_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.summarize(table(spark, sf_dir, "orders").filter("o_totalprice < 0"), [], Agg("count", out="n"))


@query("SELECT CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey END AS nation, CAST(sum(CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS positive, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS n_positive FROM customer GROUP BY 1")
def a2_null_groups_and_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.when(C("c_nationkey") % 4 != 0, C("c_nationkey")).alias("nation"), F.when(C("c_acctbal") > 0, C("c_acctbal")).alias("b"))
    return summarize.summarize(customer, ["nation"], Agg("sum", "b", "positive"), Agg("count_non_null", "b", "n_positive"))


@query("SELECT o_custkey, min_by(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS last_price FROM orders GROUP BY o_custkey")
def a6_first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ("o_orderdate", "o_orderkey")
    return summarize.summarize(table(spark, sf_dir, "orders"), ["o_custkey"], Agg("first", "o_orderstatus", "first_status", by), Agg("last", "o_totalprice", "last_price", by))


@query("SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY o_orderkey) AS priorities FROM orders GROUP BY o_custkey")
def a7_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.summarize(table(spark, sf_dir, "orders"), ["o_custkey"], Agg("concat", "o_orderpriority", "priorities", ("o_orderkey",), "|"))


@query("SELECT c_mktsegment, quantile_cont(c_acctbal, 0.5) AS middle FROM customer GROUP BY c_mktsegment")
def a9_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.summarize(table(spark, sf_dir, "customer"), ["c_mktsegment"], Agg("percentile", "c_acctbal", "middle"))


@query("""SELECT 's_acctbal' AS column_name, 0::BIGINT AS nulls, count(DISTINCT s_acctbal) AS distinct_values, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total, min(s_acctbal) AS low, max(s_acctbal) AS high, CAST(sum(CAST(abs(s_acctbal) AS DECIMAL(18,2))) AS DOUBLE) AS total_size, NULL::INTEGER AS shortest, NULL::INTEGER AS longest FROM supplier
UNION ALL SELECT 's_name', 0, count(DISTINCT s_name), NULL, NULL, NULL, NULL, min(length(s_name))::INTEGER, max(length(s_name))::INTEGER FROM supplier""")
def a10_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.column_profile(table(spark, sf_dir, "supplier").select("s_acctbal", "s_name")).drop("mean")


# ---- scalar functions -------------------------------------------------------------------------------------------


@query(r"""SELECT p_partkey, upper(left(p_name, 3)) AS l, right(p_name, 4) AS r, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded, substr(p_name, 3, 4) AS mid, length(p_name) AS n,
contains(lower(p_name), 'a') AS has_a, starts_with(p_type, 'promo') AS starts, replace(p_brand, 'Brand', 'B') AS brand, CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM part""")
def f1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, name = table(spark, sf_dir, "part"), C("p_name")
    return part.select(
        "p_partkey", F.upper(scalar.left(name, 3)).alias("l"), scalar.right(name, 4).alias("r"), scalar.pad_left(C("p_size").cast("string"), 5, "0").alias("padded"), scalar.substring(name, 2, 4).alias("mid"),
        F.length(name).cast("long").alias("n"), scalar.contains(name, "A").alias("has_a"), scalar.starts_with(C("p_type"), "promo", ignore_case=False).alias("starts"), scalar.replace(C("p_brand"), "Brand", "B").alias("brand"),
        scalar.iif(C("p_size") % 2 == 0, "even", "odd").alias("parity"),
    )


@query("""SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) / 5, 0) * 5 AS DOUBLE) AS fives, CAST(ceil(CAST(l_extendedprice AS DECIMAL(18,2))) AS BIGINT) AS up, CAST(floor(CAST(l_extendedprice AS DECIMAL(18,2))) AS BIGINT) AS down,
-l_linenumber % 3 AS rest, CAST(CAST(l_quantity AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(10,2)) AS DOUBLE) AS square, least(l_quantity, l_discount, l_tax) AS low FROM lineitem""")
def f2_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    price = C("l_extendedprice")
    return t.select(
        "l_orderkey", "l_linenumber", scalar.round_to(t, price, 5).alias("fives"), scalar.ceiling(t, price).alias("up"), scalar.floor(t, price).alias("down"), scalar.modulo(t, -C("l_linenumber"), F.lit(3)).cast("int").alias("rest"),
        scalar.power(t, C("l_quantity"), 2).alias("square"), scalar.smallest(C("l_quantity"), C("l_discount"), C("l_tax")).alias("low"),
    )


@query("""SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 MONTH AS TIMESTAMP) AS next_month, CAST(o_orderdate + INTERVAL 3 DAY AS TIMESTAMP) AS later, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS days,
strftime(o_orderdate, '%Y%m%d %H:%M') AS shown, CAST(o_orderdate AS DATE) AS day FROM orders""")
def f3_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders")
    at = C("o_orderdate")
    return t.select(
        "o_orderkey", dates.date_add(t, at, 1, "months").alias("next_month"), dates.date_add(t, at, 3, "days").alias("later"), dates.date_diff(t, at, F.lit("1995-01-01"), "days").alias("days"),
        dates.date_format(t, at, "%Y%m%d %H:%M").alias("shown"), dates.to_date(t, at).alias("day"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN CAST(event_id AS DOUBLE) WHEN event_id % 4 = 2 THEN NULL ELSE CAST(-event_id AS DOUBLE) / 2 END AS number,
CASE WHEN event_id % 4 = 1 THEN true WHEN event_id % 4 = 3 THEN true WHEN event_id % 4 = 2 THEN NULL END AS flag FROM events""")
def f4_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events")
    text = F.when(C("event_id") % 4 == 0, "").when(C("event_id") % 4 == 1, F.concat(F.lit(" "), C("event_id"), F.lit(".00 "))).when(C("event_id") % 4 == 2, F.concat(F.lit("1,"), C("event_id"))).otherwise((-C("event_id") / 2).cast("string"))
    t = t.select("event_id", text.alias("text"))
    return t.select("event_id", to_number(C("text")).alias("number"), coerce_in(t, C("text"), Field("flag", "Bool")).alias("flag"))


@query(r"""SELECT p_partkey, array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], ' ') AS title, trim(' ' || p_brand || ' ') AS trimmed, p_size % 3 = 0 OR p_size % 5 = 0 AS empty,
regexp_replace(p_brand, '([a-z]+)#([0-9]+)', '\2-\1') AS turned, rpad(left(p_type, 5), 8, '.') AS padded, CASE WHEN p_size > 30 THEN 'large' WHEN p_size > 10 THEN 'middle' END AS band, (p_size + 1) / 4.0::DOUBLE AS quarter FROM part""")
def f5_more_text_and_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part")
    text = F.when(C("p_size") % 3 == 0, "").when(C("p_size") % 5 != 0, C("p_brand"))
    return t.select(
        "p_partkey", scalar.title_case(C("p_name")).alias("title"), scalar.trim(F.concat(F.lit("\t "), C("p_brand"), F.lit("\n"))).alias("trimmed"), scalar.is_empty(text).alias("empty"),
        scalar.regex_replace(C("p_brand"), r"([a-z]+)#(\d+)", "$2-$1", ignore_case=False).alias("turned"), scalar.pad_right(scalar.left(C("p_type"), 5), 8, ".").alias("padded"),
        scalar.if_chain((C("p_size") > 30, "large"), (C("p_size") > 10, "middle")).alias("band"), scalar.divide(t, scalar.add(t, C("p_size"), F.lit(1)), F.lit(4)).alias("quarter"),
    )


# ---- comparison and checks --------------------------------------------------------------------------------------


def _altered(orders: DataFrame) -> DataFrame:
    """Orders with known changes: cents, cut text, NULLs, missing and new rows."""
    k = C("o_orderkey")
    changed = orders.withColumns({
        "o_totalprice": F.when(k % 13 == 0, C("o_totalprice") + 0.005).when(k % 17 == 0, C("o_totalprice") + 5).otherwise(C("o_totalprice")),
        "o_orderpriority": F.when(k % 19 == 0, F.substring("o_orderpriority", 1, 3)).otherwise(C("o_orderpriority")),
        "o_orderstatus": F.when(k % 23 != 0, C("o_orderstatus")),
    })
    return changed.filter(k % 29 != 0)


_CHANGED = """pairs AS (SELECT o_orderkey AS k, o_orderstatus IS NOT NULL AND o_orderkey % 23 = 0 AS s, o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 AS t, o_orderkey % 19 = 0 AND length(o_orderpriority) > 3 AS p FROM orders WHERE o_orderkey % 29 <> 0)"""


@query(f"""WITH {_CHANGED} SELECT 'o_custkey' AS column_name, 0::BIGINT AS mismatches UNION ALL SELECT 'o_orderstatus', count_if(s)::BIGINT FROM pairs UNION ALL SELECT 'o_totalprice', count_if(t)::BIGINT FROM pairs
UNION ALL SELECT 'o_orderdate', 0 UNION ALL SELECT 'o_orderpriority', count_if(p)::BIGINT FROM pairs""")
def c10_keyed_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return compare.mismatch_counts(orders, _altered(orders), ["o_orderkey"])


@query("""SELECT count(*) FILTER (d > 0) AS different_expected, coalesce(sum(d) FILTER (d > 0), 0)::BIGINT AS rows_expected, count(*) FILTER (d < 0) AS different_actual FROM
(SELECT l_orderkey, l_linenumber, q, sum(s) AS d FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, 1 AS s FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 31 = 0 THEN l_quantity + 1 ELSE l_quantity END, -1 FROM lineitem) GROUP BY ALL)""")
def c11_keyless_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    other = items.withColumn("l_quantity", F.when(C("l_orderkey") % 31 == 0, C("l_quantity") + 1).otherwise(C("l_quantity")))
    rest, n = compare.surplus(items, other), C("__surplus")
    return rest.agg(F.count_if(n > 0).alias("different_expected"), F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0)).cast("long").alias("rows_expected"), F.count_if(n < 0).alias("different_actual"))


@query(f"""WITH {_CHANGED}
SELECT 'NULL_SEMANTICS' AS kind, 'O_ORDERSTATUS' AS columns, count_if(s)::BIGINT AS count, 'columns' AS scope FROM pairs UNION ALL SELECT 'TRUNCATION', 'O_ORDERPRIORITY', count_if(p)::BIGINT, 'columns' FROM pairs
UNION ALL SELECT 'LOGIC', 'O_TOTALPRICE', count_if(t)::BIGINT, 'columns' FROM pairs UNION ALL SELECT 'LOGIC', '', count(*), 'rows' FROM orders WHERE o_orderkey % 29 = 0""")
def c1_compare_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of a whole comparison, as a table."""
    orders = table(spark, sf_dir, "orders")
    report = compare.compare_tables(orders, _altered(orders), compare.Contract(keys=("o_orderkey",)))
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count, c.scope) for c in report.clusters], "kind string, columns string, count long, scope string")


@query("SELECT o_custkey, o_totalprice, 0 AS surplus FROM orders WHERE false")
def c22_repeatability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that depends on no order leaves no difference."""
    run = lambda t: order.unique(t["orders"], ["o_custkey"], ["-o_orderdate", "o_orderkey"]).unique.select("o_custkey", "o_totalprice")
    return checks.repeatable(run, tables.sources(spark, sf_dir, ["orders"])).select("o_custkey", "o_totalprice", C("__surplus").cast("int").alias("surplus"))


@query("SELECT count(*) AS real_rows, count(*) AS shadow_rows, CASE WHEN count(*) FILTER (l_orderkey = 1) > 0 THEN 'FAIL_ROWS' ELSE 'PASS' END AS status FROM lineitem")
def c25_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    shadow = items.withColumn("l_tax", F.when(C("l_orderkey") == 1, C("l_tax") + 0.01).otherwise(C("l_tax")))
    return checks.reconcile(items, shadow).select("real_rows", "shadow_rows", "status")


@query("""WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
past AS (SELECT day, n, array_agg(n::DOUBLE) OVER (PARTITION BY dayofweek(day) ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS p FROM daily),
mid AS (SELECT *, list_median(p) AS median FROM past)
SELECT day, n, median, list_median([abs(x - median) FOR x IN p]) AS mad, coalesce(len(p), 0) >= 3 AND abs(n - median) > 3 * list_median([abs(x - median) FOR x IN p]) AS alert FROM mid""")
def c28_volume_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy(C("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return checks.volume_alerts(daily, "day", "n")


@query("SELECT count(*) AS before, count(*) FILTER (o_orderkey % 29 <> 0) AS after, 0::BIGINT AS new, count(*) FILTER (o_orderkey % 29 = 0) AS gone, count(*) FILTER (o_orderkey % 29 <> 0 AND (o_orderkey % 13 = 0 OR o_orderkey % 17 = 0)) AS changed FROM orders")
def c28_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return checks.changed_share(orders, _altered(table(spark, sf_dir, "orders")).select("o_orderkey", "o_totalprice"), ["o_orderkey"]).drop("share")


@query("SELECT max(ts) AS newest, max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR AS stale FROM events")
def c28_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.freshness(table(spark, sf_dir, "events"), "ts", "2024-01-31 00:00:00", 48).drop("age_hours")


_LOG = "SELECT event_type AS name, event_id AS checked_at, CASE WHEN value > 5 THEN 'PASS' ELSE 'FAIL_ROWS' END AS status, event_id % 10 = 0 AS period_end FROM events"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(C("event_type").alias("name"), C("event_id").alias("checked_at"), F.when(C("value") > 5, "PASS").otherwise("FAIL_ROWS").alias("status"), (C("event_id") % 10 == 0).alias("period_end"))


@query(f"""WITH log AS ({_LOG}), last AS (SELECT name, coalesce(max(checked_at) FILTER (status <> 'PASS'), -1) AS bad FROM log GROUP BY name)
SELECT log.name, count(*) FILTER (checked_at > bad) AS streak, coalesce(bool_or(period_end) FILTER (checked_at > bad), false) AS period_end, count(*) FILTER (checked_at > bad) >= 3 AND coalesce(bool_or(period_end) FILTER (checked_at > bad), false) AS ready
FROM log JOIN last ON log.name = last.name GROUP BY log.name""")
def c27_clean_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.clean_streak(_log(spark, sf_dir), 3)


@query("SELECT event_id FROM events WHERE value <= 5 AND ts > TIMESTAMP '2024-01-05 00:00:00'")
def c26_new_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("event_id", C("ts").alias("checked_at"), F.when(C("value") > 5, "PASS").otherwise("FAIL_ROWS").alias("status"))
    return checks.new_failures(log, "2024-01-05 00:00:00").select("event_id")


@query("""WITH p AS (SELECT CAST(ts AS DATE) AS run, count(*) AS n, count_if(event_id % 20 = 0) AS nulls, count(DISTINCT CASE WHEN event_id % 20 <> 0 THEN user_id END) AS d FROM events GROUP BY 1)
SELECT run, nulls > 0 AND abs(nulls / n - avg(nulls / n) OVER w) > 0.05 AS null_drift, abs(d - avg(d) OVER w) > greatest(0.05 * avg(d) OVER w, 1.0) AS distinct_drift FROM p WINDOW w AS (ORDER BY run ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""")
def c28_profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(C("event_id") % 20 != 0, C("user_id"))
    daily = table(spark, sf_dir, "events").groupBy(C("ts").cast("date").alias("run")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(user.isNull()).alias("nulls"), F.count_distinct(user).alias("distinct_values"), F.min(user).cast("double").alias("low"), F.max(user).cast("double").alias("high"))
    return checks.profile_drift(daily.withColumn("column_name", F.lit("user_id"))).select("run", (C("null_drift") & (C("nulls") > 0)).alias("null_drift"), "distinct_drift")


_ALTERED = """altered AS (SELECT o_orderkey AS k, o_orderkey % 29 <> 0 AS there FROM orders)"""


@query(f"""WITH {_ALTERED}, n AS (SELECT count(*) AS e, count_if(there) AS a FROM altered), {_CHANGED}
SELECT 'rows expected' AS name, e::VARCHAR AS value FROM n UNION ALL SELECT 'rows actual', a::VARCHAR FROM n UNION ALL SELECT 'only expected', (e - a)::VARCHAR FROM n UNION ALL SELECT 'only actual', '0'
UNION ALL SELECT 'counts', CASE WHEN e = a THEN 'PASS' ELSE 'FAIL' END FROM n UNION ALL SELECT 'verdict', CASE WHEN e = a AND (SELECT count_if(s OR t OR p) FROM pairs) = 0 THEN 'PASS' ELSE 'FAIL' END FROM n""")
def c19_checks_and_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, one-sided rows and the verdict of a comparison by key."""
    orders = table(spark, sf_dir, "orders")
    r = compare.compare_tables(orders, _altered(orders), compare.Contract(keys=("o_orderkey",)))
    counts, alone = r.checks["counts"], r.checks["set_diff"]
    found = [("rows expected", counts["expected"]), ("rows actual", counts["actual"]), ("only expected", alone["only_expected"]), ("only actual", alone["only_actual"]), ("counts", counts["verdict"]), ("verdict", r.verdict)]
    return spark.createDataFrame([(k, str(v)) for k, v in found], "name string, value string")


@query("SELECT 'LOGIC' AS kind, 'O_ORDERKEY' AS columns, 2 * count(*)::BIGINT AS count, 'rows' AS scope FROM orders WHERE o_orderkey % 7 = 0")
def c8_repeated_keys_in_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat on the actual side alone; their rows are set aside, all others are the same."""
    orders = table(spark, sf_dir, "orders")
    r = compare.compare_tables(orders, orders.union(orders.filter("o_orderkey % 7 = 0")), compare.Contract(keys=("o_orderkey",)))
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count, c.scope) for c in r.clusters if c.scope == "rows"], "kind string, columns string, count long, scope string")


@query("SELECT 'LOGIC' AS kind, 'S_ACCTBAL' AS columns, count(*)::BIGINT AS count, 'columns' AS scope FROM supplier WHERE s_suppkey % 3 = 0")
def c12_rows_paired_without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus rows of two tables without keys, paired by their nearest match: one column differs."""
    supplier = table(spark, sf_dir, "supplier")
    other = supplier.withColumn("s_acctbal", F.when(C("s_suppkey") % 3 == 0, C("s_acctbal") + 7).otherwise(C("s_acctbal")))
    r = compare.compare_tables(supplier, other)
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count, c.scope) for c in r.clusters], "kind string, columns string, count long, scope string")


@query(f"""WITH {_CHANGED}, wide AS (SELECT count_if(o_orderkey % 17 = 0 AND o_orderkey % 13 <> 0)::BIGINT AS n FROM orders WHERE o_orderkey % 29 <> 0)
SELECT 'o_custkey' AS column_name, 0::BIGINT AS mismatches UNION ALL SELECT 'o_orderstatus', count_if(s)::BIGINT FROM pairs UNION ALL SELECT 'o_totalprice', n FROM wide UNION ALL SELECT 'o_orderdate', 0 UNION ALL SELECT 'o_orderpriority', count_if(p)::BIGINT FROM pairs""")
def c13_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a tolerance of one, half cents are no difference."""
    orders = table(spark, sf_dir, "orders")
    return compare.mismatch_counts(orders, _altered(orders), ["o_orderkey"], compare.Tolerance(absolute=1.0))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0 OR o_custkey % 2 = 0")
def c14_normalized_columns_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose keys a normalized comparison finds equal: none is left over, so all rows come back."""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0 OR o_custkey % 2 = 0")
    padded = orders.withColumn("o_orderpriority", F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("  ")))
    r = compare.compare_tables(orders, padded, compare.Contract(keys=("o_orderkey",), normalizations=("trim:O_ORDERPRIORITY", "upper:O_ORDERPRIORITY")))
    return orders.select("o_orderkey", "o_custkey").filter(F.lit(r.verdict == "PASS"))


@query("SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-03 00:00:00' OR ts >= TIMESTAMP '2024-01-04 12:00:00'")
def c30_outside_the_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.outside_overlap(table(spark, sf_dir, "events"), "ts", "2024-01-03 00:00:00", "2024-01-04 12:00:00").select("event_id")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s5_output_to_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{tables.checkpoint_dir(spark)}/file-{_unique()}"
    tables.write_file(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return tables.read_parquet(spark, path)


@query("""SELECT l_orderkey, l_linenumber, CAST(CAST(l_discount AS DECIMAL(9,2)) * CAST(0.0000001 AS DECIMAL(8,7)) AS DOUBLE) AS small, l_quantity * 3e13 AS large, CAST(CAST(l_tax AS DECIMAL(9,2)) + CAST(l_discount AS DECIMAL(9,2)) AS DOUBLE) AS total FROM lineitem""")
def f6_numbers_of_any_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select("l_orderkey", "l_linenumber", scalar.multiply(t, C("l_discount"), F.lit(0.0000001)).alias("small"), scalar.multiply(t, C("l_quantity"), F.lit(3e13)).alias("large"), scalar.add(t, C("l_tax"), C("l_discount")).alias("total"))


# ---- verdicts over several tables, seams, logs, matching, versions --------------------------------------------------


def _named(spark: SparkSession, found: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in found], "name string, value string")


@query("""SELECT 'actual lacks O_CLERK_CODE' AS problem FROM orders HAVING count(*) > 0 UNION ALL SELECT 'actual has O_NEW too' FROM orders HAVING count(*) > 0
UNION ALL SELECT 'tables: O_CUSTKEY is ' || CASE WHEN typeof(min(o_custkey)) IN ('BIGINT', 'INTEGER') THEN 'number' ELSE 'string' END || ', not string' FROM orders""")
def c2_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and new columns and another type family, found before any row is read."""
    orders = table(spark, sf_dir, "orders")
    other = orders.withColumn("o_custkey", C("o_custkey").cast("string")).withColumn("o_new", F.lit(1))
    r = compare.compare_tables(orders.withColumn("o_clerk_code", C("o_orderkey")), other)
    return spark.createDataFrame([(p,) for p in r.checks["schema"]], "problem string")


@query("""SELECT 'o_orderkey' AS column_name, 0::BIGINT AS nulls_expected, 0::BIGINT AS nulls_actual UNION ALL SELECT 'o_orderstatus', 0, count_if(o_orderkey % 23 = 0)::BIGINT FROM orders WHERE o_orderkey % 29 <> 0
UNION ALL SELECT 'o_totalprice', 0, 0""")
def c3_counts_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, names = table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus", "o_totalprice"]
    r = compare.compare_tables(orders.select(*names), _altered(orders).select(*names), compare.Contract(keys=("o_orderkey",)))
    found = r.checks["column_counts"]
    return spark.createDataFrame([(n, found[n.upper()][0]["nulls"], found[n.upper()][1]["nulls"]) for n in names], "column_name string, nulls_expected long, nulls_actual long")


@query("SELECT 'repeats' AS name, CASE WHEN count(*) > count(DISTINCT o_custkey) THEN 'compared without keys' ELSE 'by key' END AS value FROM orders UNION ALL SELECT 'verdict', 'PASS'")
def c4_keys_repeat_in_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat in the expected table identify nothing: the tables are compared as multisets."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    r = compare.compare_tables(orders, orders.repartition(5), compare.Contract(keys=("o_custkey",)))
    return _named(spark, [("repeats", "compared without keys" if "keys_not_unique" in r.checks else "by key"), ("verdict", r.verdict)])


@query("SELECT 'NULL_SEMANTICS' AS kind, 'O_ORDERSTATUS' AS columns, count(*)::BIGINT AS count, 'NULL in a required column' AS note FROM orders WHERE o_orderkey % 23 = 0 AND o_orderkey % 29 <> 0")
def c5_null_where_none_may_be(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    r = compare.compare_tables(orders, _altered(orders), compare.Contract(keys=("o_orderkey",), required=("o_orderstatus",)))
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count, c.note) for c in r.clusters if c.note == "NULL in a required column"], "kind string, columns string, count long, note string")


@query("""WITH t AS (SELECT s_suppkey AS k, s_acctbal AS v, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier), u AS (SELECT t.v, x.v AS w FROM t JOIN t x ON x.n = (SELECT count(*) FROM t) + 1 - t.n)
SELECT 'ORDERING' AS kind, 'V' AS columns, count_if(v <> w)::BIGINT AS count FROM u""")
def c16_values_in_another_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values on other keys, in a column whose order is not promised."""
    t = order.record_id(table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("k"), C("s_acctbal").alias("v")), "n", ["k"])
    back = order.record_id(t, "m", ["-k"])
    other = t.select("k", "n").join(back.select(C("v"), C("m").alias("n")), "n").select("k", "v")
    r = compare.compare_tables(t.select("k", "v"), other, compare.Contract(keys=("k",), any_order=("v",)))
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count) for c in r.clusters], "kind string, columns string, count long")


@query("""SELECT 'LOGIC' AS kind, 'O_TOTALPRICE' AS columns, 'price' AS suspect UNION ALL SELECT 'NULL_SEMANTICS', 'O_ORDERSTATUS', 'status' UNION ALL SELECT 'LOGIC', '', 'filter'
UNION ALL SELECT 'TRUNCATION', 'O_ORDERPRIORITY', NULL FROM orders WHERE o_orderkey % 19 = 0 AND o_orderkey % 29 <> 0 AND length(o_orderpriority) > 3 HAVING count(*) > 0""")
def c18_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last step that can explain each cluster."""
    orders = table(spark, sf_dir, "orders")
    steps = [{"name": "read", "writes": ("o_totalprice", "o_orderstatus")}, {"name": "filter", "moves_rows": True}, {"name": "price", "writes": ("o_totalprice",)}, {"name": "status", "writes": ("o_orderstatus",)}]
    r = compare.compare_tables(orders, _altered(orders), compare.Contract(keys=("o_orderkey",)), lineage=steps)
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.suspect) for c in r.clusters], "kind string, columns string, suspect string")


@query("""WITH d AS (SELECT count_if(o_orderkey % 29 = 0) AS gone FROM orders)
SELECT 'orders' AS name, CASE WHEN gone > 0 THEN 'FAIL' ELSE 'PASS' END AS value FROM d UNION ALL SELECT 'nation', 'PASS' UNION ALL SELECT 'region', 'FAIL' UNION ALL SELECT 'chain', 'FAIL' UNION ALL SELECT 'first failing', CASE WHEN gone > 0 THEN 'orders' ELSE 'region' END FROM d
UNION ALL SELECT 'drift', 'False'""")
def c21_chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stages: one with other rows, one the same, one that was never made; the chain is as bad as its worst."""
    t = {n: table(spark, sf_dir, n) for n in ("nation", "orders", "region")}
    made = {"nation": t["nation"].repartition(3), "orders": _altered(t["orders"])}
    r = checks.check_chain(t, made, {"orders": compare.Contract(keys=("o_orderkey",)), "nation": compare.Contract(keys=("n_nationkey",))}, finals=["region"])
    return _named(spark, [*((n, x.verdict) for n, x in r.stages.items()), ("chain", r.verdict), ("first failing", r.first_failing), ("drift", r.drift)])


@query("""SELECT 'O_ORDERSTATUS is NULL in ' || count_if(o_orderkey % 23 = 0)::VARCHAR || ' rows' AS problem FROM orders WHERE o_orderkey % 29 <> 0 UNION ALL SELECT 'O_MISSING is missing' UNION ALL SELECT 'O_ORDERPRIORITY is string, not number'
UNION ALL SELECT 'keys o_custkey repeat' FROM orders WHERE o_orderkey % 29 <> 0 HAVING count(*) > count(DISTINCT o_custkey)""")
def c23_seam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps the next stage from reading a table."""
    needed = {"O_ORDERSTATUS": ("string", False), "O_MISSING": ("string", True), "O_ORDERPRIORITY": ("number", True), "O_TOTALPRICE": ("float", False)}
    found = checks.check_seam(_altered(table(spark, sf_dir, "orders")), needed, ["o_custkey"])
    return spark.createDataFrame([(p,) for p in found], "problem string")


@query("""SELECT 'lineitem' AS name, count(*) AS real_rows, count(*) AS shadow_rows, 'PASS' AS status FROM lineitem UNION ALL SELECT 'orders', count(*), count_if(o_orderkey % 29 <> 0)::BIGINT, CASE WHEN count_if(o_orderkey % 29 = 0) > 0 THEN 'FAIL_COUNT' ELSE 'PASS' END FROM orders""")
def c24_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reconciliations in one log."""
    path = f"{tables.checkpoint_dir(spark)}/log-{_unique()}"
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for name, real, shadow in (("lineitem", items, items.hint("rebalance", "l_orderkey")), ("orders", orders, orders.filter("o_orderkey % 29 <> 0"))):
        checks.log_result(checks.reconcile(real, shadow), path, name, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    return spark.read.parquet(path).select("name", "real_rows", "shadow_rows", "status")


@query("""WITH wanted AS (SELECT DISTINCT event_type AS wanted_name FROM events), tables(t, n) AS (VALUES ('event_log', 3), ('users', 1))
SELECT wanted_name, t AS table_name, n / 3.0::DOUBLE AS overlap, 1::BIGINT AS rank FROM wanted, tables WHERE n = 3""")
def c29_table_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each kind of event the table that has its fields."""
    kinds = table(spark, sf_dir, "events").select(C("event_type").alias("wanted_name")).distinct()
    wanted = kinds.withColumn("column_name", F.explode(F.array(F.lit("event_id"), F.lit("ts"), F.lit("User_Id"))))
    events = table(spark, sf_dir, "events")
    known = checks.catalog(spark, {"event_log": events, "users": events.select("user_id")})
    return checks.match_tables(wanted, known).select("wanted_name", "table_name", "overlap", C("rank").cast("long").alias("rank"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def c31_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was overwritten and brought back to the version before."""
    path, orders = f"{tables.checkpoint_dir(spark)}/rollback-{_unique()}", table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    tables.write_table(orders, path, "overwrite")
    before = tables.current_version(spark, path)
    tables.write_table(orders.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0)), path, "overwrite")
    tables.restore(spark, path, before)
    return tables.read_table(spark, path)


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size IN (1, 2, 3, 5, 7) END AS among, p_size % 3 <> 0 AND p_size > 10 AS as_number, p_size::VARCHAR || '/' || p_brand AS joined, p_size % 2 = 1 AS as_condition FROM part""")
def f7_null_text_and_number_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN with NULL, text compared with a number, `+` with text, numeric text as a condition."""
    # Rows of few bytes are read by few tasks, and these rules are costly by row.
    t = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand").repartition(4 * spark.sparkContext.defaultParallelism)
    t = t.withColumn("text", F.when(C("p_size") % 3 == 0, "none").otherwise(F.concat(F.lit(" "), C("p_size").cast("string"), F.lit(".0"))))
    t = t.withColumn("odd", (C("p_size") % 2).cast("string"))
    a, b = scalar.compared(t, C("text"), F.lit(10))
    among = F.when(C("p_size") % 4 != 0, C("p_size")).isin(1, 2, 3, 5, 7)
    return t.select("p_partkey", among.alias("among"), scalar.true(a > b).alias("as_number"), scalar.join_text(t, C("p_size"), F.concat(F.lit("/"), C("p_brand"))).alias("joined"), scalar.condition(t, C("odd")).alias("as_condition"))


@query("SELECT 'live' AS name, o_orderkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT 'back', o_orderkey, CAST(o_totalprice AS DOUBLE) FROM orders")
def c31_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shadow becomes the live table, and the old one is there to go back to after two more cycles."""
    folder = f"{tables.checkpoint_dir(spark)}/swap-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", C("o_totalprice").cast("double").alias("price"))
    live, shadow = f"{folder}/live", f"{folder}/shadow"
    tables.write_table(orders, live, "overwrite")
    tables.write_table(orders.filter("o_orderkey % 5 != 0"), shadow, "overwrite")
    tables.swap_tables(spark, live, shadow)
    now = tables.read_table(spark, live)
    tables.expire(spark, shadow, 2)
    tables.swap_tables(spark, live, shadow)
    return joins.union_by_name(now.withColumn("name", F.lit("live")), tables.read_table(spark, live).withColumn("name", F.lit("back")))


@query("SELECT 'LOGIC' AS kind, 'O_ORDERPRIORITY' AS columns, count(*)::BIGINT AS count, 'columns' AS scope FROM orders WHERE o_orderkey % 2 = 0")
def c12_many_rows_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above for half of all orders, whose prices moved within the tolerance too: pairing has no limit."""
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    other = orders.withColumn("o_orderpriority", F.when(C("o_orderkey") % 2 == 0, "none").otherwise(C("o_orderpriority"))).withColumn("o_totalprice", C("o_totalprice") + F.when(C("o_orderkey") % 2 == 0, 1e-9).otherwise(0.0))
    r = compare.compare_tables(orders, other)
    return spark.createDataFrame([(c.kind, ",".join(c.columns), c.count, c.scope) for c in r.clusters], "kind string, columns string, count long, scope string")


_TINY = "CAST(l_extendedprice * 100 AS BIGINT)"


@query(f"""SELECT l_orderkey, l_linenumber, 1::BIGINT AS above, 0::BIGINT AS below, 1::BIGINT AS text_above, CAST({_TINY} + 1 AS DOUBLE) / 1e13 AS more, CAST({_TINY} * 3 AS DOUBLE) / 1e13 AS thrice, 1e13 / CAST({_TINY} AS DOUBLE) AS inverse,
CAST({_TINY} % 7 AS DOUBLE) / 1e13 AS rest, CAST(({_TINY} + 5) // 10 AS DOUBLE) / 1e12 AS nearest FROM lineitem""")
def f6_tiny_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in units of 1e-13: nothing is lost at any number of places."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.round(C("l_extendedprice") * 100).cast("double") / 1e13).alias("x"))
    x, unit = C("x"), F.lit(1e-13)
    text, zero = scalar.compared(items, F.lit("0.0000000000001"), F.lit(0.0))
    return items.select(
        "l_orderkey", "l_linenumber", scalar.ceiling(items, x).alias("above"), scalar.floor(items, x).alias("below"), (text > zero).cast("long").alias("text_above"), scalar.add(items, x, unit).alias("more"),
        scalar.multiply(items, x, F.lit(3)).alias("thrice"), scalar.divide(items, F.lit(1), x).alias("inverse"), scalar.modulo(items, x, F.lit(7e-13)).alias("rest"), scalar.round_to(items, x, "1e-12").alias("nearest"),
    )


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS v, row_number() OVER w AS n, lead(CAST(value AS DECIMAL(18,2))) OVER w AS nxt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT event_id, user_id, n, least(CAST(v + coalesce(nxt, 0) AS DOUBLE), 500.0) AS value FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, least(f.value + CAST(e.v + coalesce(e.nxt, 0) AS DOUBLE), 500.0) FROM e JOIN f ON e.user_id = f.user_id AND e.n = f.n + 1)
SELECT event_id, round(value, 6) AS value FROM f""")
def w4_update_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column rewritten row by row: the row before has its new value already, the row after still its old one."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", C("value").cast("double").alias("value"))
    step = lambda before, row, after: F.least(F.coalesce(before, F.lit(0.0)) + row["value"] + F.coalesce(after, F.lit(0.0)), F.lit(500.0))
    return order.update_in_place(events, "value", step, ["value"], ["ts", "event_id"], ["user_id"]).select("event_id", F.round("value", 6).alias("value"))


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, sum(CAST(l_extendedprice * 100 AS HUGEINT)) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(n AS DOUBLE) / 1e12 AS run FROM u""")
def w5_one_huge_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in one group, values of 12 places: summed in blocks, no digit lost. The smaller of two rows with equal keys is
    first; the SQL leaves that open."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", (F.round(C("l_extendedprice") * 100).cast("double") / 1e12).alias("x"))
    return order.running_total(items, "x", "run", ["l_shipdate", "l_orderkey", "l_linenumber", "x"]).select("l_orderkey", "l_linenumber", "run")


@query("""WITH u AS (SELECT l_returnflag, sum(CAST(l_extendedprice * 100 AS HUGEINT)) AS n FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, CAST(n AS DOUBLE) / 1e13 AS total, count(*)::BIGINT AS n FROM u JOIN lineitem USING (l_returnflag) GROUP BY ALL""")
def a2_sum_of_any_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Huge numbers that cancel out, and tiny ones: the sum has every digit."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.round(C("l_extendedprice") * 100).cast("double") / 1e13).alias("x"), F.when(C("l_linenumber") % 2 == 0, 1e20).otherwise(-1e20).alias("huge"))
    both = items.select("l_returnflag", "x", F.lit(1).alias("one")).union(items.select("l_returnflag", "huge", F.lit(0))).union(items.select("l_returnflag", -C("huge"), F.lit(0)))
    return summarize.summarize(both, ["l_returnflag"], Agg("sum", "x", "total"), Agg("sum", "one", "n"))


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY l_returnflag")
def a9_percentile_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.percentiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.9, "p90", ["l_returnflag"]).select("l_returnflag", F.round("p90", 6).alias("p90"))


@query("""WITH n AS (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 <> 0), p AS (SELECT a.s_suppkey AS x, b.s_suppkey AS y, levenshtein(a.s_name, b.s_name) AS d FROM n a, supplier b)
SELECT x, y, d::INTEGER AS distance FROM p WHERE d <= 1""")
def j9_fuzzy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of names at most one edit apart, without a blocking key."""
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = joins.fuzzy_join(names.filter("s_suppkey % 3 != 0"), names, ("s_name", "s_name"), 1)
    return found.select(C("s_suppkey").alias("x"), C("Right_s_suppkey").alias("y"), "distance")


@query("""WITH pairs AS (SELECT r_regionkey * 100 AS nth, substr(r_name, 1, 4) AS old, 'r' || r_regionkey AS new FROM region UNION ALL SELECT 1000 + n_nationkey, n_name, '<' || n_nationkey || '>' FROM nation),
texts AS (SELECT n_nationkey, n_name || ' of ' || r_name AS t FROM nation JOIN region ON n_regionkey = r_regionkey),
first AS (SELECT n_nationkey, t, arg_min(old, nth) AS old, arg_min(new, nth) AS new FROM texts JOIN pairs ON contains(t, old) GROUP BY ALL)
SELECT n_nationkey, replace(t, old, new) AS t FROM first""")
def p21_replace_from_a_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with the first of a table's pairs that it contains."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    pairs = region.select((C("r_regionkey") * 100).alias("nth"), F.substring("r_name", 1, 4).alias("old"), F.concat(F.lit("r"), "r_regionkey").alias("new")).union(nation.select(1000 + C("n_nationkey"), "n_name", F.concat(F.lit("<"), "n_nationkey", F.lit(">"))))
    texts = nation.join(region, C("n_regionkey") == C("r_regionkey")).select("n_nationkey", F.concat("n_name", F.lit(" of "), "r_name").alias("t"))
    return rows.find_replace_from(texts, "t", pairs, "old", "new", "nth")
