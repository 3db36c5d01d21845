"""Checks built on the comparison: stages of a pipeline, repeatability, seams, reconciliation, monitoring, matching."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.types import family
from .compare import Contract, Report, compare_tables, surplus
from .summarize import table_hash

VERDICTS = ("PASS", "PASS_WITH_ACCEPTED_DIFF", "FAIL")


def worst(verdicts: list[str]) -> str:
    """The worst of several verdicts; none at all is no pass."""
    return max(verdicts, key=VERDICTS.index) if verdicts else "FAIL"


# ---- pipelines --------------------------------------------------------------------------------------------------


@dataclass
class ChainReport:
    verdict: str
    stages: dict[str, Report]
    first_failing: str | None
    drift: bool  # every stage alone is right, and a final table still differs


def check_chain(expected: dict[str, DataFrame], actual: dict[str, DataFrame], contracts: dict[str, Contract], finals: list[str], **options) -> ChainReport:
    """Every stage's table against what it should be, in order. A stage without a table fails."""
    stages: dict[str, Report] = {}
    for name, table in expected.items():
        if name not in actual:
            stages[name] = Report("FAIL", {"missing": name}, [])
        else:
            stages[name] = compare_tables(table, actual[name], contracts.get(name, Contract()), name=name, **options)
    failing = [n for n, r in stages.items() if r.verdict == "FAIL"]
    return ChainReport(worst([r.verdict for r in stages.values()]), stages, failing[0] if failing else None, bool(failing) and set(failing) <= set(finals))


def repeatable(run: Callable[[dict[str, DataFrame]], DataFrame], inputs: dict[str, DataFrame], partitions: int = 7) -> DataFrame:
    """Rows that a second run over the same inputs, dealt out differently, gives more or less often: none if the run
    depends on no order."""
    again = {k: v.repartition(partitions + i) for i, (k, v) in enumerate(inputs.items())}
    return surplus(run(inputs), run(again))


def check_seam(produced: DataFrame, needed: dict[str, tuple[str, bool]], keys: list[str] = ()) -> list[str]:
    """What keeps a stage from reading a table: missing columns, other type families, NULLs where none may be
    (`needed`: column → family and whether it may be NULL), repeated keys."""
    known = {f.name.upper(): f for f in produced.schema}
    out = [f"{c} is missing" for c in needed if c.upper() not in known]
    out += [f"{c} is {family(known[c.upper()].dataType)}, not {k}" for c, (k, _) in needed.items() if c.upper() in known and family(known[c.upper()].dataType) != k]
    strict = [c for c, (_, null) in needed.items() if not null and c.upper() in known]
    if strict:
        counts = produced.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(strict)]).first()
        out += [f"{c} is NULL in {counts[f'n{i}']} rows" for i, c in enumerate(strict) if counts[f"n{i}"]]
    if keys and not [k for k in keys if k.upper() not in known] and not produced.groupBy(*keys).count().filter("count > 1").isEmpty():
        out.append(f"keys {', '.join(keys)} repeat")
    return out


def outside_overlap(df: DataFrame, loaded: str, begin: str, end: str) -> DataFrame:
    """Rows that were not loaded in the time when both sides may have read different states."""
    at = F.col(f"`{loaded}`")
    return df.filter(at.isNull() | (at < F.lit(begin).cast("timestamp_ntz")) | (at >= F.lit(end).cast("timestamp_ntz")))


# ---- reconciliation ---------------------------------------------------------------------------------------------


def reconcile(real: DataFrame, shadow: DataFrame) -> DataFrame:
    """One row: counts and hashes of both tables, and a status."""
    a, b = table_hash(real).toDF("real_rows", "real_hash"), table_hash(shadow.select(*real.columns)).toDF("shadow_rows", "shadow_hash")
    status = F.when(F.col("real_rows") != F.col("shadow_rows"), "FAIL_COUNT").when(F.col("real_hash") != F.col("shadow_hash"), "FAIL_ROWS").otherwise("PASS")
    return a.crossJoin(F.broadcast(b)).select("*", status.alias("status"))  # one row each


def log_result(results: DataFrame, table: str, name: str, at: Column) -> None:
    """Append results to a log table."""
    results.select(F.lit(name).alias("name"), at.alias("checked_at"), "*").write.mode("append").parquet(table)


def new_failures(log: DataFrame, seen: str | None) -> DataFrame:
    """Failed results after the last one seen."""
    failed = log.filter(F.col("status").startswith("FAIL"))
    return failed if seen is None else failed.filter(F.col("checked_at") > F.lit(seen).cast("timestamp_ntz"))


def clean_streak(log: DataFrame, needed: int) -> DataFrame:
    """For each name: results in a row that passed up to now, whether a period end is among them, and whether that
    is enough. The log has name, checked_at, status, period_end."""
    newest = Window.partitionBy("name").orderBy(F.desc("checked_at"))
    bad = F.max(F.when(F.col("status") != "PASS", 1).otherwise(0)).over(newest.rowsBetween(Window.unboundedPreceding, 0))
    run = log.withColumn("__bad", bad).groupBy("name").agg(F.count_if(F.col("__bad") == 0).alias("streak"), F.coalesce(F.max(F.when(F.col("__bad") == 0, F.col("period_end"))), F.lit(False)).alias("period_end"))
    return run.withColumn("ready", (F.col("streak") >= needed) & F.col("period_end"))


# ---- monitoring -------------------------------------------------------------------------------------------------


def volume_alerts(daily: DataFrame, day: str, value: str, history: int = 8, k: float = 3.0, group_by: list[str] = ()) -> DataFrame:
    """Each day against the median of the last `history` same weekdays before it: alert beyond k median absolute
    deviations. With fewer than three such days there is no alert."""
    over = Window.partitionBy(*group_by, F.dayofweek(day)).orderBy(day).rowsBetween(-history, -1)
    past = F.collect_list(F.col(value).cast("double")).over(over)
    middle = lambda a: F.when(F.size(a) % 2 == 1, F.get(F.sort_array(a), F.floor(F.size(a) / 2).cast("int"))).otherwise((F.get(F.sort_array(a), (F.size(a) / 2 - 1).cast("int")) + F.get(F.sort_array(a), (F.size(a) / 2).cast("int"))) / 2)
    rows = daily.withColumn("__past", past).withColumn("median", middle(F.col("__past")))
    rows = rows.withColumn("mad", middle(F.transform("__past", lambda x: F.abs(x - F.col("median")))))
    alert = (F.size("__past") >= 3) & (F.abs(F.col(value) - F.col("median")) > k * F.col("mad"))
    return rows.withColumn("alert", alert).drop("__past")


def profile_drift(profiles: DataFrame, runs: int = 30, tolerance: float = 0.05) -> DataFrame:
    """Each run's column profile against the runs before: share of NULLs, distinct values, range. The table has run,
    column_name, rows, nulls, distinct_values, low, high."""
    over = Window.partitionBy("column_name").orderBy("run").rowsBetween(-runs, -1)
    share = F.col("nulls") / F.greatest(F.col("rows"), F.lit(1))
    return profiles.select(
        "*", share.alias("null_share"),
        (F.abs(share - F.avg(share).over(over)) > tolerance).alias("null_drift"),
        (F.abs(F.col("distinct_values") - F.avg("distinct_values").over(over)) > F.greatest(tolerance * F.avg("distinct_values").over(over), F.lit(1.0))).alias("distinct_drift"),
        ((F.col("low") < F.min("low").over(over)) | (F.col("high") > F.max("high").over(over))).alias("range_drift"),
    )


def freshness(df: DataFrame, loaded: str, now: str, max_hours: float) -> DataFrame:
    """One row: the newest load, its age in hours, and whether that is too old; an empty table is."""
    newest = df.agg(F.max(F.col(f"`{loaded}`").cast("timestamp_ntz")).alias("newest"))
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3_600_000_000
    return newest.select("newest", age.alias("age_hours"), F.coalesce(age > max_hours, F.lit(True)).alias("stale"))


def changed_share(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys before and after, and how many are new, gone, changed; the share of the union that moved."""
    others = [c for c in before.columns if c not in keys]
    sign = lambda df, n: df.select(*keys, F.xxhash64(*[x for c in others for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]).alias(n))
    both = sign(before, "b").join(sign(after, "a"), keys, "full")
    counts = both.agg(F.count("b").alias("before"), F.count("a").alias("after"), F.count_if(F.col("b").isNull()).alias("new"), F.count_if(F.col("a").isNull()).alias("gone"), F.count_if(F.col("a") != F.col("b")).alias("changed"), F.count(F.lit(1)).alias("all"))
    return counts.select("before", "after", "new", "gone", "changed", ((F.col("new") + F.col("gone") + F.col("changed")) / F.greatest(F.col("all"), F.lit(1))).alias("share"))


# ---- matching ---------------------------------------------------------------------------------------------------


def catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return spark.createDataFrame([(t, c.upper()) for t, df in tables.items() for c in df.columns], "table_name string, column_name string")


def match_tables(wanted: DataFrame, catalog: DataFrame, top: int = 3, min_overlap: float = 0.5, excluded: list[str] = ()) -> DataFrame:
    """The catalog's best tables for each field list: 0.8 * share of fields found + 0.2 * Jaccard similarity of the
    names' words. `wanted` has wanted_name and column_name, one row a field."""
    fields = wanted.select("wanted_name", F.upper("column_name").alias("column_name")).distinct()
    sizes = fields.groupBy("wanted_name").agg(F.count(F.lit(1)).alias("size"))
    known = catalog.filter(~F.col("table_name").isin(list(excluded))).select("table_name", F.upper("column_name").alias("column_name")).distinct() if excluded else catalog.select("table_name", F.upper("column_name").alias("column_name")).distinct()
    found = fields.join(known, "column_name").groupBy("wanted_name", "table_name").agg(F.count(F.lit(1)).alias("found")).join(sizes, "wanted_name")
    words = lambda c: F.array_distinct(F.array_remove(F.split(F.upper(c), "[^A-Z0-9]+"), ""))
    a, b = words("wanted_name"), words("table_name")
    alike = F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    scored = found.withColumn("overlap", F.col("found") / F.col("size")).filter(F.col("overlap") >= min_overlap).withColumn("score", F.round(0.8 * F.col("overlap") + 0.2 * alike, 6))
    rank = F.row_number().over(Window.partitionBy("wanted_name").orderBy(F.desc("score"), "table_name"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= top).select("wanted_name", "table_name", "overlap", "score", "rank")
