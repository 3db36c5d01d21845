"""Table commits: crashes, two writers, repeated batches, many appends, cutover."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tidewell.sources import tables
from tidewell.streaming.writes import stream_into


def test_a_half_written_version_stops_nobody(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.write_table(spark.range(3), table, "overwrite")
    for number, text in ((2, ""), (3, "v0-unknown")):  # writers that died while they wrote
        (tmp_path / "t" / f"CURRENT-{number:012d}").write_text(text)
    (tmp_path / "t" / ".commit-dead").write_text("v0-x")
    assert tables.read_table(spark, table).count() == 3
    assert tables.write_table(spark.range(2), table, "append").count() == 5
    assert tables.write_table(spark.range(1), table, "update_insert", ["id"]).count() == 5 and tables.latest(spark, table).number == 5


def test_two_writers_at_once(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.write_table(spark.range(1), table, "overwrite")
    before, results = tables.latest(spark, table), []

    def commit(i: int) -> None:
        try:
            tables._commit(spark, table, [f"v0-{i}"], before)
            results.append(i)
        except RuntimeError:
            pass

    writers = [threading.Thread(target=commit, args=(i,)) for i in range(8)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(results) == 1 and tables.latest(spark, table).parts == (f"v0-{results[0]}",)
    assert not list((tmp_path / "t").glob(".commit-*"))


def test_a_batch_is_written_once(spark, tmp_path):
    table = str(tmp_path / "t")
    for batch in (0, 1, 1, 0, 2):
        tables.write_table(spark.range(10), table, "append", batch=("stream", batch))
    assert tables.read_table(spark, table).count() == 30
    tables.write_table(spark.range(1), table, "append", batch=("other", 0))
    tables.write_table(spark.range(1), table, "append")
    assert tables.write_table(spark.range(10), table, "append", batch=("stream", 2)).count() == 32


def test_a_stream_that_starts_again_repeats_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: stream_into(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), str(tmp_path / "t"), "append", str(tmp_path / "check"))
    stream().awaitTermination()
    (tmp_path / "check" / "commits" / "0").unlink()  # it died after the write, before it could say so
    (tmp_path / "check" / "commits" / ".0.crc").unlink(missing_ok=True)
    stream().awaitTermination()
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 5


def test_many_appends_stay_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FANOUT", 3)
    table = str(tmp_path / "t")
    for i in range(14):
        tables.write_table(spark.range(i, i + 1, 1, 1), table, "append")
    assert sorted(r.id for r in tables.read_table(spark, table).collect()) == list(range(14))
    assert len(tables.latest(spark, table).parts) <= 5


def test_cutover_and_back(spark, tmp_path):
    live, shadow = str(tmp_path / "live"), str(tmp_path / "shadow")
    tables.write_table(spark.range(3), live, "overwrite")
    tables.write_table(spark.range(10, 14), shadow, "overwrite")
    ids = lambda t: sorted(r.id for r in tables.read_table(spark, t).collect())
    tables.swap_tables(spark, live, shadow)
    assert ids(live) == [10, 11, 12, 13] and ids(shadow) == [0, 1, 2]
    tables.write_table(spark.range(14, 15), live, "append")
    assert ids(live) == [10, 11, 12, 13, 14] and ids(shadow) == [0, 1, 2]
    tables.roll_back(spark, live)
    assert ids(live) == [10, 11, 12, 13]
    for cycle in range(3):
        tables.write_table(spark.range(cycle), live, "overwrite")
    tables.expire(spark, live)
    tables.expire(spark, shadow)
    assert ids(live) == [0, 1] and ids(shadow) == [0, 1, 2]  # the shadow still needs what was live
    with pytest.raises(ValueError):
        tables.swap_tables(spark, live, str(tmp_path / "none"))


def test_merge_reads_the_target_once(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (None, "n", 3.0)], "k int, s string, v double")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, s string")
    out = tables.merged(target, new, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a", 1.0), (2, "B", None), (3, "C", None), (None, "n", 3.0), (None, "N", None)], key=str)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Scan ExistingRDD") == 2
    same = spark.createDataFrame([(2, None)], "k int, v double")
    assert {tuple(r) for r in tables.merged(target, same, ["K"]).collect()} == {(1, "a", 1.0), (2, "b", None), (None, "n", 3.0)}
    assert tables.merged(target, target.filter(F.lit(False)), ["k"]).count() == 3
