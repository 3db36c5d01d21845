"""Joins with three outputs, unions, and their relatives. How a join runs is Spark's choice."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import comb
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import is_number
from .rows import Pick, find, need, select


class Joined(NamedTuple):
    """Matching pairs, and each side's rows without a partner."""

    inner: DataFrame
    left: DataFrame
    right: DataFrame


def _prefixed(left: DataFrame, right: DataFrame) -> list[str]:
    taken = {c.lower() for c in left.columns}
    out = []
    for c in right.columns:
        name = c
        while name.lower() in taken:
            name = f"Right_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _comparable(a: T.DataType, b: T.DataType) -> bool:
    return is_number(a) == is_number(b) and isinstance(a, T.StringType) == isinstance(b, T.StringType)


def join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], picks: list[Pick] | None = None, others: bool = True) -> Joined:
    """Equal keys, exact and case-sensitive; NULL matches nothing, nor does text match a number.

    Pairs have the left columns, then the right ones, those with a taken name as `Right_<name>`; `picks` is applied
    after that. The single sides keep their own columns. A missing key column is an error.
    """
    lk, rk = need(left, *(a for a, _ in on)), need(right, *(b for _, b in on))
    names = _prefixed(left, right)
    new = dict(zip(right.columns, names, strict=True))
    renamed = right.toDF(*names)
    if not all(_comparable(left.schema[a].dataType, right.schema[b].dataType) for a, b in zip(lk, rk, strict=True)):
        nothing = left.limit(0).crossJoin(renamed.limit(0))
        return Joined(select(nothing, picks, others) if picks else nothing, left, right)
    probe = right.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(rk)])
    own = left.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(lk)])

    def equal(a: list[Column], b: list[Column]) -> Column:
        return reduce(lambda x, y: x & y, (x == y for x, y in zip(a, b, strict=True)))

    keys = [F.col(f"__k{i}") for i in range(len(on))]
    inner = left.join(renamed, equal([left[f"`{k}`"] for k in lk], [renamed[f"`{new[k]}`"] for k in rk]), "inner")
    only_left = left.join(probe, equal([F.col(f"`{k}`") for k in lk], keys), "left_anti")
    only_right = right.join(own, equal([F.col(f"`{k}`") for k in rk], keys), "left_anti")
    return Joined(select(inner, picks, others) if picks else inner, only_left, only_right)


def join_null_safe(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str) -> DataFrame:
    """A `left_semi` or `left_anti` join in which NULL equals NULL."""
    lk, rk = need(left, *(a for a, _ in on)), need(right, *(b for _, b in on))
    probe = right.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(rk)])
    return left.join(probe, reduce(lambda x, y: x & y, (F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(lk))), how)


def append_fields(target: DataFrame, source: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Every target row with every source row. The source is counted first and must be small, as it is sent to all
    executors."""
    n = source.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"more than {max_rows} rows to append to every row")
    return target.crossJoin(F.broadcast(source.toDF(*_prefixed(target, source))))


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Columns in the order of their first appearance, by name without regard to case; what a table lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b.toDF(*[find(a, c) or c for c in b.columns]), allowMissingColumns=True), tables)


def union_by_position(*tables: DataFrame) -> DataFrame:
    """The first table's columns; shorter tables are filled with NULL, longer ones cut."""
    first = tables[0]
    out = first
    for t in tables[1:]:
        columns = [F.col(f"`{c}`") for c in t.columns[: len(first.columns)]]
        columns += [F.lit(None).cast(first.schema[i].dataType) for i in range(len(columns), len(first.columns))]
        out = out.union(t.select(*[c.alias(n) for c, n in zip(columns, first.columns, strict=True)]))
    return out


def batch(df: DataFrame, control: DataFrame, function: Callable[[DataFrame], DataFrame], on: list[tuple[str, str]] | None = None) -> DataFrame:
    """A function over the rows paired with each control row, all at once: joined on keys, or with every control row."""
    return function(join(df, control, on).inner if on else append_fields(df, control))


def iterate(df: DataFrame, step: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame], bool], max_steps: int) -> DataFrame:
    """A step repeated until `done` or at most `max_steps` times; each result is checkpointed, so that no lineage
    grows and `done` recomputes nothing."""
    from ..sources.tables import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    for _ in range(max_steps):
        df = step(df).checkpoint()
        if done(df):
            break
    return df


def fuzzy_match(left: DataFrame, right: DataFrame, on: tuple[str, str], block: Callable[[Column], Column], max_distance: int) -> DataFrame:
    """Pairs of texts with at most `max_distance` edits among those with an equal blocking key. Approximate: texts
    whose keys differ are not compared."""
    (a,), (b,) = need(left, on[0]), need(right, on[1])
    names = _prefixed(left, right)
    l, r = left.withColumn("__block", block(F.col(f"`{a}`"))), right.toDF(*names)  # noqa: E741
    other = dict(zip(right.columns, names, strict=True))[b]
    pairs = l.join(r.withColumn("__block", block(F.col(f"`{other}`"))), "__block")
    distance = F.levenshtein(F.col(f"`{a}`"), F.col(f"`{other}`"))
    return pairs.withColumn("distance", distance).filter(F.col("distance") <= max_distance).drop("__block")


def fuzzy_join(left: DataFrame, right: DataFrame, on: tuple[str, str], max_distance: int) -> DataFrame:
    """All pairs of rows whose texts are at most `max_distance` edits apart, with `distance`; NULL matches nothing.

    Two short texts that are near have a text in common that is left of each when up to max_distance characters are taken away, so they
    meet by what can be left of them; a beginning or end that many share doesn't bring these together. Of longer texts too
    much can be left: cut into max_distance + 1 segments, one has a segment that no edit touches, and that is found in the other
    at most max_distance places away, so they meet by (length, number of the segment, segment). What has met is then tested. Each
    different text is looked up once, however many rows have it; what many texts share is dealt out by a hash of the text.
    """
    k, names, short = max_distance, _prefixed(left, right), _short(max_distance)
    (a,), (b,) = need(left, on[0]), need(right, on[1])
    renamed = right.toDF(*names)
    other = dict(zip(right.columns, names, strict=True))[b]
    cut = lambda n, i: F.floor(n * i / (k + 1)).cast("int")  # noqa: E731  where segment i of a text of n characters begins
    mine = left.select(F.col(f"`{a}`").alias("__x")).filter("__x is not null").distinct()
    theirs = renamed.select(F.col(f"`{other}`").alias("__y")).filter("__y is not null").distinct()
    key = lambda n, i, text: F.struct(n.cast("int").alias("n"), i.cast("int").alias("i"), F.xxhash64(text).alias("s"))
    none = F.array().cast("array<struct<n:int,i:int,s:bigint>>")
    rests = lambda text: F.transform(_left_of(text, k), lambda v: key(F.lit(-1), F.lit(-1), v))
    segments = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: key(F.length("__y"), i, F.substring("__y", cut(F.length("__y"), i) + 1, cut(F.length("__y"), i + 1) - cut(F.length("__y"), i))))
    indexed = theirs.select("__y", F.inline(F.when(F.length("__y") <= short, rests(F.col("__y"))).otherwise(segments))).withColumn("part", F.pmod(F.xxhash64("__y"), F.lit(PARTS)).cast("int"))

    def looked_for(n: Column) -> Column:
        def around(i: Column) -> Column:
            size, begin = cut(n, i + 1) - cut(n, i), cut(n, i)
            places = F.filter(F.sequence(begin - k, begin + k), lambda p: (p >= 0) & (p + size <= F.length("__x")))
            return F.transform(places, lambda p: key(n, i, F.substring("__x", p + 1, size)))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), around))

    lengths = F.filter(F.sequence(F.greatest(F.length("__x") - k, F.lit(0)), F.length("__x") + k), lambda n: n > short)
    wanted = F.concat(F.when(F.length("__x") - k <= short, rests(F.col("__x"))).otherwise(none), F.flatten(F.transform(lengths, looked_for)))
    asked = mine.select("__x", F.inline(F.array_distinct(wanted)))
    often = indexed.groupBy("n", "i", "s").agg(F.count(F.lit(1)).alias("__many")).filter(F.col("__many") > PARTS * PARTS).select("n", "i", "s", F.lit(PARTS).alias("__parts"))
    dealt = asked.join(often, ["n", "i", "s"], "left").withColumn("part", F.explode(F.when(F.col("__parts").isNotNull(), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(-1)))))
    stored = indexed.join(often, ["n", "i", "s"], "left").withColumn("part", F.when(F.col("__parts").isNull(), -1).otherwise(F.col("part")))
    # What is small in bytes may meet often, so it is not put together in few tasks.
    by = [int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "n", "i", "s", "part"]
    met = dealt.select("__x", "n", "i", "s", "part").repartition(*by).join(stored.select("__y", "n", "i", "s", "part").repartition(*by), ["n", "i", "s", "part"]).select("__x", "__y").distinct()
    near = met.withColumn("distance", F.levenshtein("__x", "__y", k)).filter("distance >= 0")
    # Small tables may have many pairs, so these are spread before they multiply.
    pairs = left.join(near, F.col(f"`{a}`") == F.col("__x")).repartition(4 * left.sparkSession.sparkContext.defaultParallelism)
    return pairs.join(renamed, F.col("__y") == F.col(f"`{other}`")).select(*[F.col(f"`{c}`") for c in [*left.columns, *names]], "distance")


def _left_of(text: Column, k: int) -> Column:
    """All that can be left of a text when up to k characters are taken away, itself included."""

    def less(v: Column) -> Column:
        taken = F.transform(F.sequence(F.lit(1), F.length(v)), lambda i: F.concat(F.substring(v, F.lit(1), i - 1), F.substring(v, i + 1, F.length(v))))
        return F.when(F.length(v) > 0, taken).otherwise(F.array().cast("array<string>"))

    if k == 0:
        return F.array(text)
    return F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.array(text), lambda known, _: F.array_distinct(F.concat(known, F.flatten(F.transform(known, less)))))


def _short(k: int) -> int:
    """The greatest length of which all that can be left has at most `WRITTEN` characters in all."""
    n = 0
    while k and (n + 1) * sum(comb(n + 1, j) for j in range(k + 1)) <= WRITTEN:
        n += 1
    return n if k else 2**31 - 1


WRITTEN = 50_000
PARTS = 32  # into which what more than PARTS * PARTS texts share is dealt
