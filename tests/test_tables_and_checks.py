from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.functions.types import Field
from tidewell.operators import checks, compare
from tidewell.operators.compare import Cluster, Contract, Tolerance, compare_tables
from tidewell.sources import tables
from tidewell.streaming.writes import stream_into

C = F.col


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture
def target(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.write_table(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, n string, v double"), path, "overwrite")
    return path


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([(2, 9.0, "x"), (3, 7.0, "y"), (None, 5.0, "z")], "K int, v double, extra string")


@pytest.mark.parametrize(("mode", "keys", "out"), [
    ("append", [], [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0), (2, None, 9.0), (3, None, 7.0), (None, None, 5.0)]),
    ("truncate_append", [], [(2, None, 9.0), (3, None, 7.0), (None, None, 5.0)]),
    ("update_insert", ["k"], [(1, "a", 1.0), (2, "b", 9.0), (None, "n", 0.0), (3, None, 7.0), (None, None, 5.0)]),
    ("merge", [], [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0), (2, None, 9.0), (3, None, 7.0), (None, None, 5.0)]),
])
def test_write_modes(spark, target, incoming, mode, keys, out):
    done = tables.write_table(incoming, target, mode, keys)
    assert done.columns == ["k", "n", "v"] and rows_of(done) == sorted(map(str, out)) == rows_of(tables.read_table(spark, target))


def test_overwrite_takes_the_new_schema_and_can_be_undone(spark, target, incoming):
    before = tables.current_version(spark, target)
    assert tables.write_table(incoming, target, "overwrite").columns == ["K", "v", "extra"]
    tables.restore(spark, target, before)
    assert tables.read_table(spark, target).columns == ["k", "n", "v"]


def test_steps_and_repeated_keys(spark, target, incoming):
    done = tables.write_table(incoming, target, "merge", ["k"], before=lambda t: t.filter("k = 1"), after=lambda t: t.withColumn("n", F.lit("z")))
    assert {r.n for r in done.collect()} == {"z"} and done.count() == 4
    with pytest.raises(ValueError, match="repeat"):
        tables.write_table(incoming.union(incoming), target, "merge", ["k"])
    with pytest.raises(ValueError, match="unknown"):
        tables.write_table(incoming, target, "upsert")


def test_typed_csv(spark, tmp_path):
    data = [("a \"q\", b\nc", 1.5, True, dt.date(2024, 2, 29)), ("", 1e-7, False, None), (None, None, None, None), ("\\n", 1e10, True, dt.date(1999, 1, 1))]
    df = spark.createDataFrame(data, "t string, v double, b boolean, d date")
    tables.write_typed_csv(df, f"{tmp_path}/x")
    fields = [Field("t", "V_String"), Field("v", "Double"), Field("b", "Bool"), Field("d", "Date")]
    assert tables.fields_of_json(tables.fields_json(fields)) == fields
    assert rows_of(tables.read_typed_csv(spark, f"{tmp_path}/x", fields)) == rows_of(df)
    with pytest.raises(Exception, match="no number"):
        tables.write_typed_csv(spark.createDataFrame([(float("inf"),)], "v double"), f"{tmp_path}/y")


def test_fields_that_do_not_fit_leave_the_schema(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert tables.as_fields(df, [Field("b", "Int32")]).columns == ["a"] and tables.empty(spark, [Field("b", "Int32")]).count() == 0


def test_stream_into_a_table(spark, tmp_path):
    spark.range(50).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").select("id", (C("id") * 2).alias("v"))
    stream_into(stream, f"file://{tmp_path}/out", "merge", f"{tmp_path}/cp", ["id"]).awaitTermination()
    assert tables.read_table(spark, f"file://{tmp_path}/out").count() == 50


# ---- comparison -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark):
    k = C("id")
    return spark.range(300).select(k.alias("k"), (k * 1.25).alias("amt"), F.concat(F.lit("name "), k).alias("nm"), F.when(k % 7 != 0, k % 3).alias("c"), (k * 2).cast("decimal(12,2)").alias("d")).cache()


def changed(table, column, value, test):
    return table.withColumn(column, F.when(test, value).otherwise(C(column)))


MUTATIONS = [
    ("ROUNDING", "amt", lambda: C("amt") + 0.004), ("LOGIC", "amt", lambda: C("amt") + 5), ("TRUNCATION", "nm", lambda: F.lit("nam")), ("NULL_SEMANTICS", "nm", lambda: F.lit(None)), ("LOGIC", "nm", lambda: F.concat("nm", F.lit(" "))), ("LOGIC", "nm", lambda: F.upper("nm")), ("NULL_SEMANTICS", "c", lambda: F.lit(None)), ("LOGIC", "d", lambda: C("d") + 1), ("ROUNDING", "d", lambda: (C("d") + 0.01).cast("decimal(12,2)")),
]


@pytest.mark.parametrize(("kind", "column", "value"), MUTATIONS)
@pytest.mark.parametrize("keys", [("k",), ()])
def test_wrong_values_fail_with_their_class(table, kind, column, value, keys):
    report = compare_tables(table, changed(table, column, value(), C("k").isin(4, 5, 8)), Contract(keys=keys))
    assert report.verdict == "FAIL" and [(c.kind, c.columns, c.count, c.scope) for c in report.clusters] == [(kind, (column.upper(),), 3, "columns")]


def test_hints_and_types(spark, table):
    space = compare_tables(table, changed(table, "nm", F.concat("nm", F.lit("  ")), C("k") < 3), Contract(keys=("k",)))
    case = compare_tables(table, changed(table, "nm", F.upper("nm"), C("k") < 3), Contract(keys=("k",)))
    assert (space.clusters[0].hint, case.clusters[0].hint) == ("whitespace_only", "case_only")
    a, b = (spark.createDataFrame(x, "k int, t string") for x in ([(1, "+2"), (2, "1.50")], [(1, "2.0"), (2, "01.5")]))
    assert compare_tables(a, b, Contract(keys=("k",))).clusters[0].kind == "TYPE"
    assert compare_tables(table, changed(table, "nm", F.concat("nm", F.lit("  ")), C("k") < 3), Contract(keys=("k",), normalizations=("trim:NM",))).verdict == "PASS"


def test_equal_tables_pass_in_any_order(table):
    for keys in (("k",), ()):
        report = compare_tables(table, table.repartition(5, "c"), Contract(keys=keys))
        assert report.verdict == "PASS" and not report.clusters


def test_rows_on_one_side_and_repeated_keys(table):
    report = compare_tables(table, table.filter("k != 9").union(table.filter("k = 4")), Contract(keys=("k",)))
    assert {(c.scope, c.sides, c.count) for c in report.clusters} == {("rows", ("expected",), 1), ("rows", ("actual",), 2)} and report.verdict == "FAIL"
    twice = compare_tables(table.union(table.filter("k = 4")), table, Contract(keys=("k",)))
    assert twice.verdict == "FAIL" and "keys_not_unique" in twice.checks and twice.clusters[0].sides == ("expected",)


def test_schema_stops_the_comparison(table):
    for other in (table.drop("nm"), table.withColumn("amt", C("amt").cast("string")), table.select("amt", "k", "nm", "c", "d")):
        report = compare_tables(table, other)
        assert report.verdict == "FAIL" and report.clusters[0].scope == "schema" and set(report.checks) == {"schema"}


def test_tolerances(spark):
    a, b = spark.createDataFrame([(1, 1.0)], "k int, v double"), spark.createDataFrame([(1, 1.0 + 5e-7)], "k int, v double")
    assert compare_tables(a, b, Contract(keys=("k",))).verdict == "PASS" and compare_tables(a, b).verdict == "PASS"
    assert compare_tables(a, b, Contract(keys=("k",)), Tolerance(absolute=1e-8)).verdict == "FAIL"
    t = lambda x: spark.createDataFrame([(1, x)], "k int, x timestamp_ntz")
    one, two = t(dt.datetime(2024, 1, 1, 0, 0, 0, 1000)), t(dt.datetime(2024, 1, 1, 0, 0, 0, 1999))
    assert compare_tables(one, two, Contract(keys=("k",)), Tolerance(timestamps="microsecond")).verdict == "FAIL" and compare_tables(one, two, Contract(keys=("k",))).verdict == "PASS"


def test_ordering(table):
    other = changed(changed(table, "c", F.lit(2), C("k") == 4), "c", F.lit(1), C("k") == 5)
    report = compare_tables(table, other, Contract(keys=("k",), any_order=("c",)))
    assert [(c.kind, c.columns) for c in report.clusters] == [("ORDERING", ("C",))]


def test_required_columns(table):
    report = compare_tables(table, changed(table, "nm", F.lit(None), C("k") == 1), Contract(keys=("k",), required=("nm", "c")))
    assert report.checks["nullability"] == "FAIL" and any("C is NULL" in a for a in report.advice)


def test_approvals(table):
    other = changed(table, "amt", C("amt") + 0.004, C("k") == 4)
    ok = {"table": "t", "class": "ROUNDING", "columns": ["AMT"]}
    run = lambda accepted, approvals, actual=other: compare_tables(table, actual, Contract(keys=("k",)), accepted=accepted, approvals=approvals, name="t").verdict
    assert run(("ROUNDING",), (ok,)) == "PASS_WITH_ACCEPTED_DIFF"
    assert run((), (ok,)) == run(("ROUNDING",), ()) == run(("ROUNDING",), ({**ok, "columns": ["NM"]},)) == run(("ROUNDING",), ({**ok, "table": "u"},)) == "FAIL"
    missing = {"table": "t", "class": "LOGIC", "columns": []}
    assert run(("LOGIC",), (missing,), table.filter("k != 3")) == "FAIL"
    for kind in ("UNKNOWN", "GOLDEN_DATA"):
        assert compare.judge([Cluster(kind, ("A",), 1, "columns")], (kind,), ({"table": None, "class": kind, "columns": ["A"]},)) == "FAIL"


def test_suspects(table):
    steps = [{"name": "load", "moves_rows": True}, {"name": "price", "writes": ["amt"]}, {"name": "only", "moves_rows": True}]
    report = compare_tables(table, changed(table.filter("k != 9"), "amt", C("amt") + 5, C("k") == 1), Contract(keys=("k",)), lineage=steps)
    assert {(c.scope, c.suspect) for c in report.clusters} == {("columns", "price"), ("rows", "only")}


def test_empty_tables(table):
    none = table.limit(0)
    assert compare_tables(none, none, Contract(keys=("k",))).verdict == "PASS" and compare_tables(none, none).verdict == "PASS"
    assert compare_tables(table, none, Contract(keys=("k",))).verdict == "FAIL" and compare_tables(none, table).verdict == "FAIL"


# ---- checks -----------------------------------------------------------------------------------------------------


def test_chain(table):
    bad = changed(table, "amt", C("amt") + 5, C("k") == 1)
    keys = {n: Contract(keys=("k",)) for n in "abc"}
    inner = checks.check_chain({"a": table, "b": table, "c": table}, {"a": table, "b": bad, "c": bad}, keys, finals=["c"])
    assert (inner.verdict, inner.first_failing, inner.drift) == ("FAIL", "b", False)
    last = checks.check_chain({"a": table, "c": table}, {"a": table, "c": bad}, keys, finals=["c"])
    assert (last.first_failing, last.drift) == ("c", True)
    assert checks.check_chain({"a": table}, {}, keys, finals=[]).verdict == "FAIL" and checks.worst([]) == "FAIL"


def test_repeatability(table):
    assert checks.repeatable(lambda t: t["x"].groupBy("c").count(), {"x": table}).isEmpty()
    dealt = lambda t: t["x"].select("k", F.spark_partition_id().alias("p"))
    assert not checks.repeatable(dealt, {"x": table}).isEmpty()


def test_seam(table):
    assert checks.check_seam(table, {"k": ("number", False), "nm": ("string", False)}, ["k"]) == []
    wrong = checks.check_seam(table, {"zz": ("number", True), "nm": ("date", True), "c": ("number", False)}, ["c"])
    assert len(wrong) == 4


def test_reconciliation(spark, table, tmp_path):
    status = lambda other: checks.reconcile(table, other).first().status
    assert status(table.repartition(3)) == "PASS" and status(table.limit(3)) == "FAIL_COUNT" and status(changed(table, "c", F.lit(9), C("k") == 4)) == "FAIL_ROWS"
    # two rows repeated against two others repeated: sums tell them apart where xor would not
    a, b = table.filter("k in (1, 2)"), table.filter("k in (3, 4)")
    assert checks.reconcile(a.union(a), b.union(b)).first().status == "FAIL_ROWS"
    checks.log_result(checks.reconcile(table, table.limit(3)), f"{tmp_path}/log", "t", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    checks.log_result(checks.reconcile(table, table), f"{tmp_path}/log", "t", F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    log = spark.read.parquet(f"{tmp_path}/log")
    assert checks.new_failures(log, None).count() == 1 and checks.new_failures(log, "2024-01-02 00:00:00").count() == 0


def test_streak(spark):
    log = spark.createDataFrame([("t", 1, "PASS", True), ("t", 2, "FAIL_ROWS", False), ("t", 3, "PASS", True), ("t", 4, "PASS", False), ("u", 1, "PASS", False)], "name string, checked_at int, status string, period_end boolean")
    assert {(r.name, r.streak, r.ready) for r in checks.clean_streak(log, 2).collect()} == {("t", 2, True), ("u", 1, False)}


def test_monitoring(spark, table):
    daily = spark.range(70).select(F.date_add(F.lit("2024-01-01").cast("date"), C("id").cast("int")).alias("d"), F.when(C("id") == 60, 900).otherwise(100 + C("id") % 5).alias("n"))
    assert [str(r.d) for r in checks.volume_alerts(daily, "d", "n").filter("alert and n = 900").collect()] == ["2024-03-01"]
    assert checks.freshness(daily, "d", "2024-03-11 00:00:00", 48).first().stale is False and checks.freshness(daily.limit(0), "d", "2024-03-11 00:00:00", 48).first().stale
    moved = checks.changed_share(table, changed(table.filter("k > 2"), "c", F.lit(9), C("k") == 5), ["k"]).first()
    assert (moved.new, moved.gone, moved.changed) == (0, 3, 1)
    profiles = spark.createDataFrame([(r, "c", 100, 50 if r == 9 else 1, 10, 0.0, 99.0 if r == 8 else 5.0) for r in range(10)], "run int, column_name string, rows int, nulls int, distinct_values int, low double, high double")
    out = {r.run: r for r in checks.profile_drift(profiles).collect()}
    assert out[9].null_drift and not out[5].null_drift and out[8].range_drift and not out[7].range_drift
    assert checks.outside_overlap(daily, "d", "2024-01-01", "2024-01-11").count() == 60


def test_matching(spark, table):
    known = checks.catalog(spark, {"SALES_ORDERS": table, "OTHER": table.select("k"), "TMP": table})
    wanted = spark.createDataFrame([("ORDERS", c) for c in ("k", "amt", "nm", "missing")], "wanted_name string, column_name string")
    best = checks.match_tables(wanted, known, excluded=["TMP"]).collect()
    assert [(r.table_name, r.overlap, r.score) for r in best] == [("SALES_ORDERS", 0.75, 0.7)]


def test_comparison_bears_any_number(spark):
    rows = [(1, 1e30, None), (2, float("nan"), 1.5), (3, 1e-20, 2.5), (4, float("inf"), 3.5)]
    a = spark.createDataFrame(rows, "k int, x double, y double")
    nothing = a.withColumn("x", F.lit(float("nan")))
    for t in (a, nothing):
        assert compare_tables(t, t, Contract(keys=("k",))).verdict == "PASS" and compare_tables(t, t).verdict == "PASS"
    assert compare_tables(a, nothing, Contract(keys=("k",))).verdict == "FAIL"


def test_append_writes_its_own_rows_only(spark, tmp_path):
    table = str(tmp_path / "t")
    first = tables.write_table(spark.range(1000), table, "overwrite")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    both = tables.write_table(spark.range(5), table, "append")
    new = [p for p in (tmp_path / "t").rglob("*.parquet") if p not in before]
    assert first.count() == 1000 and both.count() == tables.read_table(spark, table).count() == 1005
    assert sum(spark.read.parquet(str(p)).count() for p in new) == 5 and all(p.stat().st_mtime_ns == t for p, t in before.items())
    old = tables.current_version(spark, table).split(",")[0]
    tables.restore(spark, table, old)
    assert tables.read_table(spark, table).count() == 1000


def test_a_second_writer_is_an_error(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.write_table(spark.range(3), table, "overwrite")
    with pytest.raises(RuntimeError, match="meanwhile"):
        tables._commit(spark, table, ["v-x"], tables.latest(spark, table)._replace(number=99))
    assert tables.read_table(spark, table).count() == 3


def test_a_reader_always_sees_a_version(spark, tmp_path):
    import threading

    table, done, seen = str(tmp_path / "t"), threading.Event(), set()
    tables.write_table(spark.range(1), table, "overwrite")

    def look():
        while not done.is_set():
            seen.add(tables.current_version(spark, table) is not None)

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(30):
        now = tables.latest(spark, table)
        tables._commit(spark, table, now.parts, now)
    done.set()
    reader.join()
    assert seen == {True}
