"""Reading sources, typed CSV, the write modes of a table, snapshots.

A table is a folder of parts, each written whole and never changed. A version is a list of parts in a small numbered
file; the file with the highest number that is whole is the current one. No file is ever written again, so a reader
always meets a version, a write can read the state before it, a failed write leaves that state, an append writes its
own rows only, two writers can't lose each other's rows, and a version can be restored.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import asdict
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import Field, coerce, schema_of, to_text
from ..operators.rows import find, need

Change = Callable[[DataFrame], DataFrame]


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Where none is set, a fresh local one if the whole of Spark is one process, else
    an error, as executors on other machines would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


# ---- reading ----------------------------------------------------------------------------------------------------


def as_fields(df: DataFrame, fields: list[Field] | None) -> DataFrame:
    """The table with its columns converted to declared fields. If the names differ, the table's own schema stays."""
    if not fields or {f.name.lower() for f in fields} != {c.lower() for c in df.columns}:
        return df
    return df.select(*[coerce(F.col(f"`{n}`"), df.schema[n].dataType, f).alias(f.name) for f in fields for n in need(df, f.name)])


def empty(spark: SparkSession, fields: list[Field]) -> DataFrame:
    return spark.createDataFrame([], schema_of(fields))


def read_csv(spark: SparkSession, path: str, fields: list[Field] | None = None, delimiter: str = ",", header: bool = True, encoding: str = "UTF-8", limit: int | None = None) -> DataFrame:
    """All columns as text, then converted to the fields."""
    df = spark.read.csv(path, sep=delimiter, header=header, encoding=encoding, escape='"', multiLine=True, inferSchema=False)
    if fields and not header:
        df = df.toDF(*[f.name for f in fields])
    df = as_fields(df, fields)
    return df if limit is None else df.limit(limit)


def read_parquet(spark: SparkSession, *paths: str, fields: list[Field] | None = None) -> DataFrame:
    return as_fields(spark.read.parquet(*paths), fields)


def read_query(spark: SparkSession, url: str, query: str, fields: list[Field] | None = None, **options: str) -> DataFrame:
    """A database's query, run there as it is."""
    return as_fields(spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load(), fields)


# ---- typed CSV --------------------------------------------------------------------------------------------------


def read_typed_csv(spark: SparkSession, path: str, fields: list[Field]) -> DataFrame:
    r"""Header row, `\N` for NULL, nothing for empty text."""
    df = spark.read.csv(path, header=True, escape='"', multiLine=True, inferSchema=False)
    text = df.select(*[F.when(F.col(f"`{c}`") == "\\N", None).otherwise(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in df.columns])
    return as_fields(text, fields)


def write_typed_csv(df: DataFrame, path: str) -> None:
    """Plain decimals without exponent, true and false, `\\N` for NULL; an infinity or NaN is an error."""
    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            wrong = F.isnan(c) | (F.abs(c) == float("inf"))
            text = F.when(wrong, F.raise_error(F.lit(f"{f.name} has a value that is no number"))).otherwise(to_text(c, kind))
        else:
            text = c.cast("string") if isinstance(kind, T.BooleanType) else to_text(c, kind)
        out.append(F.coalesce(text, F.lit("\\N")).alias(f.name))
    df.select(*out).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_file(df: DataFrame, path: str, format: str = "parquet", **options) -> None:
    """The rows as they are, in place of what was there."""
    df.write.mode("overwrite").format(format).options(**options).save(path)


def fields_json(fields: list[Field]) -> str:
    return json.dumps([asdict(f) for f in fields])


def fields_of_json(text: str) -> list[Field]:
    return [Field(**f) for f in json.loads(text)]


# ---- versions ---------------------------------------------------------------------------------------------------


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Version(NamedTuple):
    """A state of a table: its parts (folders, those of another table with their whole path), the last batch of each
    stream that it holds, and the table it was swapped with, if any."""

    number: int
    parts: tuple[str, ...]
    batches: dict[str, int]
    partner: str | None


def _versions(spark: SparkSession, table: str) -> tuple[int, list[Version]]:
    """The highest number taken, and all whole versions, the newest first. What a dying writer left half-written counts as
    taken, but is no version."""
    fs, folder = _file(spark, table)
    names = [str(f.getPath().getName()) for f in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers, found = sorted((int(n.removeprefix("CURRENT-")) for n in names if n.startswith("CURRENT-")), reverse=True), []
    for number in numbers:
        stream = fs.open(_file(spark, f"{table}/CURRENT-{number:012d}")[1])
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        if text.endswith("\n"):
            parts, *more = text.splitlines()
            known = json.loads(more[0]) if more else {}
            found.append(Version(number, tuple(parts.split(",")), known.get("batches", {}), known.get("partner")))
    return max(numbers, default=0), found


def latest(spark: SparkSession, table: str) -> Version | None:
    return next(iter(_versions(spark, table)[1]), None)


def current_version(spark: SparkSession, table: str) -> str | None:
    """The parts of the current version, separated by commas."""
    found = latest(spark, table)
    return None if found is None else ",".join(found.parts)


def _commit(spark: SparkSession, table: str, parts: list[str] | tuple[str, ...], before: Version | None, batches: dict[str, int] | None = None, partner: str | None = None) -> None:
    """Make a state the current one: a new file with the next number. The file is written beside and takes its name at
    once, so it is whole or not there. If the current version is not `before` any more, or someone else takes the number,
    this write is an error and changes nothing. (On a store whose rename is no single step, like most object stores, two
    writers at the very same time can still lose one of them.)"""
    parts, (taken, found) = [p.removeprefix(f"{table}/") for p in parts], _versions(spark, table)
    if (found[0].number if found else 0) != (before.number if before else 0):
        raise RuntimeError(f"{table} was written by someone else meanwhile")
    jvm = spark.sparkContext._jvm
    fs, beside = _file(spark, f"{table}/.commit-{uuid.uuid4().hex}")
    fs.mkdirs(beside.getParent())
    stream = fs.create(beside, False)
    more = json.dumps({"batches": batches if batches is not None else before.batches if before else {}, "partner": partner or (before.partner if before else None)})
    stream.write(bytearray(f"{','.join(parts)}\n{more}\n".encode()))
    stream.close()
    name = fs.makeQualified(_file(spark, f"{table}/CURRENT-{taken + 1:012d}")[1])
    try:
        if fs.getScheme() == "file":  # a local rename would overwrite; a link to a taken name is an error
            local = lambda p: jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(name), local(beside))
            fs.delete(beside, False)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), name, none)
    except Exception as e:
        fs.delete(beside, False)
        if "AlreadyExists" in str(e):
            raise RuntimeError(f"{table} was written by someone else meanwhile") from e
        raise


def restore(spark: SparkSession, table: str, version: str) -> None:
    """Make earlier parts the current ones again."""
    _commit(spark, table, version.split(","), latest(spark, table))


def _place(table: str, part: str) -> str:
    return part if "/" in part else f"{table}/{part}"


def read_version(spark: SparkSession, table: str, version: str) -> DataFrame:
    return spark.read.parquet(*[_place(table, part) for part in version.split(",")])


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    version = current_version(spark, table)
    return None if version is None else read_version(spark, table, version)


def swap_tables(spark: SparkSession, live: str, shadow: str) -> None:
    """Cutover: each table gets the other's current rows, without copying any; what was live is the shadow now and can be
    swapped back. The live table changes first; after a failure between the two, the shadow still has its rows."""
    a, b = latest(spark, live), latest(spark, shadow)
    if a is None or b is None:
        raise ValueError("both tables must have been written")
    _commit(spark, live, [_place(shadow, p) for p in b.parts], a, b.batches, shadow)
    _commit(spark, shadow, [_place(live, p) for p in a.parts], b, a.batches, live)


def roll_back(spark: SparkSession, table: str) -> None:
    """The rows of the version before the current one become current again."""
    _, found = _versions(spark, table)
    if len(found) < 2:
        raise ValueError(f"{table} has no earlier version")
    _commit(spark, table, found[1].parts, found[0], found[1].batches)


def expire(spark: SparkSession, table: str, cycles: int = 2) -> list[str]:
    """Keep the current version and the `cycles` before it; delete older version files, and the parts in the table's folder
    that neither a version kept nor one of its partner needs. Returns the parts deleted. Run it when no reader is at an older one."""
    fs, folder = _file(spark, table)
    _, found = _versions(spark, table)
    kept, old = found[: cycles + 1], found[cycles + 1 :]
    needed = {_place(table, p) for v in kept for p in v.parts}
    for partner in {v.partner for v in found if v.partner}:
        needed |= {_place(partner, p) for v in _versions(spark, partner)[1] for p in v.parts}
    for v in old:
        fs.delete(_file(spark, f"{table}/CURRENT-{v.number:012d}")[1], False)
    gone = sorted({p for v in old for p in v.parts if "/" not in p and f"{table}/{p}" not in needed})
    for part in gone:
        fs.delete(_file(spark, f"{table}/{part}")[1], True)
    return gone


# ---- write modes ------------------------------------------------------------------------------------------------


def fitted(incoming: DataFrame, target: T.StructType) -> DataFrame:
    """Columns by name in the target's order and types; what the target lacks goes, what comes not is NULL."""
    return incoming.select(*[(F.col(f"`{n}`").try_cast(f.dataType) if (n := find(incoming, f.name)) else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    names = need(df, *keys)
    known = df.filter(" and ".join(f"`{k}` is not null" for k in names))
    return known.groupBy(*[F.col(f"`{k}`") for k in names]).count().filter("count > 1")


def merged(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with equal keys get the incoming values of all other shared columns; the rest is inserted. A NULL key
    matches nothing. Keys must not repeat among the incoming rows."""
    keys = need(target, *keys)
    new = fitted(incoming, target.schema)
    shared = [f.name for f in target.schema if f.name not in keys and find(incoming, f.name)]
    source = new.select(*[F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(new.columns)], F.lit(True).alias("__new"))
    value = {c: F.col(f"__v{i}") for i, c in enumerate(new.columns)}
    both = target.withColumn("__old", F.lit(True)).join(source, [F.col(f"`{k}`") == value[k] for k in keys], "full")
    old, fresh = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    return both.select(*[F.when(fresh if c in shared else ~old, value[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in target.columns])


def state_after(target: DataFrame | None, incoming: DataFrame, mode: str, keys: list[str] = (), before: Change | None = None, after: Change | None = None) -> DataFrame:
    """The table after a write. Modes: overwrite, append, truncate_append, update_insert (or merge); the last without
    keys appends. `before` changes the target first, `after` the result. Without a target all modes give the incoming
    table."""
    if target is not None and before is not None:
        target = before(target)
    if target is None or mode == "overwrite":
        out = incoming
    elif mode == "truncate_append":
        out = fitted(incoming, target.schema)
    elif mode == "append" or mode in ("update_insert", "merge") and not keys:
        out = target.union(fitted(incoming, target.schema))
    elif mode in ("update_insert", "merge"):
        if not repeated_keys(incoming, list(keys)).isEmpty():
            raise ValueError(f"the keys {', '.join(keys)} repeat among the incoming rows; which of them wins is undefined")
        out = merged(target, incoming, list(keys))
    else:
        raise ValueError(f"unknown write mode {mode}")
    return after(out) if after is not None else out


FANOUT = 16  # parts of one size that are merged into one of the next


def _merged_parts(spark: SparkSession, table: str, parts: list[str]) -> list[str]:
    """The parts after an append: each time the last FANOUT are of one size they become one larger part, so that a table of n
    appends has about as many parts as n has digits, and a row is rewritten as often."""
    size = lambda part: int(part.split("-")[0][1:] or 0) if "/" not in part else -1
    while len(parts) >= FANOUT and len({size(p) for p in parts[-FANOUT:]}) == 1 and size(parts[-1]) >= 0:
        tail = parts[-FANOUT:]
        part = f"v{size(tail[0]) + 1}-{uuid.uuid4().hex}"
        spark.read.parquet(*[_place(table, p) for p in tail]).write.parquet(f"{table}/{part}")  # small files are read together
        parts = [*parts[:-FANOUT], part]
    return parts


def write_table(incoming: DataFrame, table: str, mode: str, keys: list[str] = (), before: Change | None = None, after: Change | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
    """Write a new version of a table and make it the current one; returns it as read back. An append without other
    steps writes the new rows alone, as one more part. `batch` names a stream and its batch: one that the table holds
    already is not written again."""
    spark = incoming.sparkSession
    part, old = f"v0-{uuid.uuid4().hex}", latest(spark, table)
    batches = dict(old.batches) if old else {}
    if batch is not None:
        if batches.get(batch[0], -1) >= batch[1]:
            return read_version(spark, table, ",".join(old.parts))
        batches[batch[0]] = batch[1]
    target = None if old is None else read_version(spark, table, ",".join(old.parts))
    appends = mode == "append" or mode in ("update_insert", "merge") and not keys
    if target is not None and appends and before is None and after is None:
        fitted(incoming, target.schema).write.parquet(f"{table}/{part}")
        parts = _merged_parts(spark, table, [*old.parts, part])
    else:
        state_after(target, incoming, mode, list(keys), before, after).write.parquet(f"{table}/{part}")
        parts = [part]
    _commit(spark, table, parts, old, batches)
    return read_version(spark, table, ",".join(parts))


def in_key_order(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """For display or export: by keys, or by all columns, NULL first."""
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in (need(df, *keys) if keys else df.columns)])


def snapshot(df: DataFrame, stage: str, folder: str) -> DataFrame:
    """A stage's rows kept as Parquet, and read back."""
    df.write.mode("overwrite").parquet(f"{folder}/{stage}")
    return df.sparkSession.read.parquet(f"{folder}/{stage}")


def sources(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables by logical name; another folder gives the same pipeline other data."""
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
