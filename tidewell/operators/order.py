"""Operators that depend on an order. A table has none, so each takes `order_by`: columns that order all rows of a
group without ties (add a key). NULL comes first in ascending and last in descending order; text is ordered by code
point."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact
from .rows import need
from .summarize import exact_sum


class Firsts(NamedTuple):
    """The first row of each key, and the others."""

    unique: DataFrame
    duplicates: DataFrame


def ordering(df: DataFrame, order_by: list[str]) -> list[Column]:
    """Sort columns; a leading `-` means descending."""
    out = []
    for item in order_by:
        (name,) = need(df, item.removeprefix("-"))
        column = F.col(f"`{name}`")
        out.append(column.desc_nulls_last() if item.startswith("-") else column.asc_nulls_first())
    return out


def backwards(df: DataFrame, order_by: list[str]) -> list[Column]:
    out = []
    for item in order_by:
        (name,) = need(df, item.removeprefix("-"))
        column = F.col(f"`{name}`")
        out.append(column.asc_nulls_first() if item.startswith("-") else column.desc_nulls_last())
    return out


def has_ties(df: DataFrame, order_by: list[str], group_by: list[str] = ()) -> bool:
    keys = need(df, *group_by, *(c.removeprefix("-") for c in order_by))
    return not df.groupBy(*[F.col(f"`{k}`") for k in keys]).count().filter("count > 1").isEmpty()


def sort(df: DataFrame, order_by: list[str]) -> DataFrame:
    return df.orderBy(*ordering(df, order_by))


def _over(df: DataFrame, group_by: list[str], order_by: list[str]):
    return Window.partitionBy(*[F.col(f"`{c}`") for c in need(df, *group_by)]).orderBy(*ordering(df, order_by))


# ---- numbering --------------------------------------------------------------------------------------------------


def record_id(df: DataFrame, name: str, order_by: list[str], start: int = 1, first: bool = True) -> DataFrame:
    """Rows numbered from `start` in order, over any number of partitions.

    Rows are range-sorted; each partition's rows are numbered from what the partitions before it hold (one number a
    partition, found by a first pass over the sorted rows, which are kept in the shared checkpoint folder so that
    both passes see the same partitions).
    """
    ordered = df.orderBy(*ordering(df, order_by)).select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    from ..sources.tables import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    held = ordered.checkpoint()
    counts = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    number = (F.col("__before") + F.col("__at") + start).cast("bigint").alias(name)
    rest = [F.col(f"`{c}`") for c in df.columns]
    return held.join(F.broadcast(before), "__part").select(*([number, *rest] if first else [*rest, number]))  # one row a partition


def tile_records(df: DataFrame, n: int, out: str, order_by: list[str], group_by: list[str] = ()) -> DataFrame:
    """Tiles of equally many rows within each group."""
    return df.withColumn(out, F.ntile(n).over(_over(df, group_by, order_by)))


def tile_sum(df: DataFrame, n: int, column: str, out: str, order_by: list[str], group_by: list[str] = ()) -> DataFrame:
    """Tiles of about equal sums of a column without negative values. A group whose sum is 0 is one tile, the first."""
    run = _sums_so_far(df, column, order_by, group_by, whole=True)
    share = F.try_divide(F.col("__run") * n, F.col("__whole"))
    return run.withColumn(out, F.greatest(F.lit(1), F.least(F.lit(n), F.coalesce(F.ceil(share), F.lit(1)))).cast("int")).drop("__run", "__whole", "__null")


def tile_manual(df: DataFrame, column: str, cuts: list[float], out: str) -> DataFrame:
    """1 up to the first cut, 2 up to the second, and so on; NULL for NULL."""
    value = F.col(f"`{column}`")
    chain = F.when(value.isNull(), None)
    for i, cut in enumerate(sorted(cuts)):
        chain = chain.when(value <= cut, i + 1)
    return df.withColumn(out, chain.otherwise(len(cuts) + 1))


# ---- picking rows -----------------------------------------------------------------------------------------------


def unique(df: DataFrame, keys: list[str], order_by: list[str]) -> Firsts:
    """The first row of each key in order, and all later ones. NULL keys are one key; text is case-sensitive."""
    numbered = df.withColumn("__n", F.row_number().over(_over(df, keys, order_by)))
    return Firsts(numbered.filter("__n = 1").drop("__n"), numbered.filter("__n > 1").drop("__n"))


def sample(df: DataFrame, mode: str, n: int | None, order_by: list[str], group_by: list[str] = ()) -> DataFrame:
    """The `first` or `last` n rows, all but the first n (`skip`), or one in n (`one_in_n`), of each group."""
    n = 1 if n is None else n
    if mode in ("first", "last") and not group_by:
        return df.orderBy(*(ordering if mode == "first" else backwards)(df, order_by)).limit(max(n, 0))
    over = _over(df, group_by, order_by)
    if mode == "last":
        over = Window.partitionBy(*[F.col(f"`{c}`") for c in need(df, *group_by)]).orderBy(*backwards(df, order_by))
    at = F.col("__n")
    keep = {"first": at <= n, "last": at <= n, "skip": at > n, "one_in_n": (at - 1) % max(n, 1) == 0}[mode]
    if not group_by:
        return record_id(df, "__n", order_by).filter(keep).drop("__n")
    return df.withColumn("__n", F.row_number().over(over)).filter(keep).drop("__n")


# ---- rows that see other rows -----------------------------------------------------------------------------------


def neighbour(df: DataFrame, column: str, offset: int, order_by: list[str], group_by: list[str] = (), outside: str = "null") -> Column:
    """Another row's value: `offset` -1 is the row before. Outside the group: `null`, `zero` (0 or empty text) or
    `nearest` (the group's first or last row's)."""
    (name,) = need(df, column)
    over, kind, value = _over(df, group_by, order_by), df.schema[name].dataType, F.col(f"`{name}`")
    shifted = F.lag if offset < 0 else F.lead
    if outside == "null":
        return shifted(value, abs(offset)).over(over)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(over)
    there = place + offset >= 1 if offset < 0 else place + offset <= F.count(F.lit(1)).over(whole)
    if outside == "zero":
        fill = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind)
    else:
        fill = (F.first_value(value) if offset < 0 else F.last_value(value)).over(whole)
    return F.when(there, shifted(value, abs(offset)).over(over)).otherwise(fill)


BLOCK = 250_000  # rows of a block, about


def _in_blocks(df: DataFrame, by: list[Column]) -> tuple[DataFrame, int]:
    """Rows range-sorted into blocks, one a partition, with the number `__block`; and how many there are. Their number follows the
    rows, which are counted first, so that a block, and a task that works on it, stays of one size."""
    n = max(-(-df.count() // BLOCK), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__block", F.spark_partition_id()).checkpoint(), n


def _sums_so_far(df: DataFrame, column: str, order_by: list[str], group_by: list[str], whole: bool = False) -> DataFrame:
    """`df` with `__run`, the exact sum of a column up to each row of its group, NULL counting as nothing; `__null`, whether there
    has been a NULL; and with `whole` the group's sum `__whole`.

    Rows are range-sorted by group and order into blocks, one a partition, so one huge group is spread over many. A block
    sums its own rows, and starts from what the group's earlier blocks add up to. Only groups that reach over a border have such
    a start, so there are fewer starts than blocks.
    """
    from ..sources.tables import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    (name,) = need(df, column)
    value, groups = F.col(f"`{name}`"), [F.col(f"`{g}`") for g in need(df, *group_by)]
    named = df.select("*", *[g.alias(f"__g{i}") for i, g in enumerate(groups)])
    keys = [F.col(f"__g{i}") for i in range(len(groups))]
    held, blocks = _in_blocks(named, [*[k.asc_nulls_first() for k in keys], *ordering(df, order_by)])
    sums = exact.windows(value.cast("double"))
    parts = {n: w for n, w in sums.items()} | {"odd": F.when(exact.beyond(value.cast("double")), value.cast("double")), "null": value.isNull().cast("int")}
    add = dict.fromkeys(parts, F.sum)  # a window that 10^10 rows can't fill is an error rather than a wrong sum
    of_block = held.groupBy(*keys, "__block").agg(*[add[n](p).alias(f"__p_{n}") for n, p in parts.items()], F.count(F.when(exact.beyond(value.cast("double")), 1)).alias("__p_many"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    named_parts = [*parts, "many"]
    starts = of_block.select(*keys, "__block", *[(add.get(n, F.sum))(f"__p_{n}").over(before).alias(f"__s_{n}") for n in named_parts], F.row_number().over(Window.partitionBy(*keys).orderBy("__block")).alias("__nth"))
    starts = starts.filter("__nth > 1").drop("__nth")
    starts = starts.select(F.col("__block").alias("__b"), *[k.alias(f"__h{i}") for i, k in enumerate(keys)], *[f"__s_{n}" for n in named_parts])
    on = [F.col("__block") == F.col("__b"), *[k.eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)]]
    rows = held.repartitionById(blocks, F.col("__block")).join(F.broadcast(starts), on, "left")  # fewer rows than blocks; one block a task
    over = Window.partitionBy("__block", *keys).orderBy(*ordering(df, order_by)).rowsBetween(Window.unboundedPreceding, 0)

    kinds = {n: kind for n, (_, _, kind) in exact.WINDOWS.items()}

    def joined(n: str, p: Column) -> Column:
        own, start = (x.cast(kinds[n]) if n in kinds else x for x in (add.get(n, F.sum)(p).over(over), F.col(f"__s_{n}")))
        return F.when(start.isNull(), own).when(own.isNull(), start).otherwise(start + own)

    many = joined("many", F.when(exact.beyond(value.cast("double")), F.lit(1)))
    windows = {n: joined(n, p) for n, p in parts.items()}
    done = rows.select(*[F.col(f"`{c}`") for c in df.columns], *keys, *[w.alias(f"__w_{n}") for n, w in windows.items()], F.coalesce(many, F.lit(0)).alias("__w_many"))
    run = exact.total(*(F.col(f"__w_{n}") for n in "hmls"))
    done = done.withColumn("__run", F.when(F.col("__w_many") > 0, run + F.coalesce("__w_odd", F.lit(0.0))).otherwise(run)).withColumn("__null", F.col("__w_null") > 0)
    if whole:
        each = held.groupBy(*keys).agg(exact_sum(value, df.schema[name].dataType).alias("__whole")).select("__whole", *[k.alias(f"__h{i}") for i, k in enumerate(keys)])
        each = each.withColumn("__one", F.lit(1))
        done = done.withColumn("__two", F.lit(1)).join(each, [F.col("__one") == F.col("__two"), *[k.eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)]] if keys else [F.col("__one") == F.col("__two")], "left")
    return done.select(*[F.col(f"`{c}`") for c in df.columns], "__run", "__null", *(["__whole"] if whole else []))


def running_total(df: DataFrame, column: str, out: str, order_by: list[str], group_by: list[str] = (), null: str = "poison") -> DataFrame:
    """The sum so far, as the double nearest to the exact one. A NULL makes its own and all later totals of the group NULL
    (`poison`), or counts as nothing (`skip`). One group may hold most rows: it is summed in blocks."""
    run = _sums_so_far(df, column, order_by, group_by)
    total = F.col("__run") if null == "skip" else F.when(~F.col("__null"), F.col("__run"))
    columns = [F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()]
    return run.select(*columns, total.alias(out))


def fold(
    df: DataFrame,
    out: str,
    kind: str,
    step: Callable[[Column, Column], Column],
    columns: list[str],
    order_by: list[str],
    group_by: list[str],
    initial: Column | None = None,
) -> DataFrame:
    """A value that each row makes of the row before it, in group order: `step(before, row)` with `row` a struct of
    `columns`. `before` is `initial` (NULL) on a group's first row. Values are gathered in chunks, so time grows with the rows;
    a group is held in one task's memory. For sums and what can be seen from a fixed distance, use the functions above."""
    names, group, order = need(df, *columns), need(df, *group_by), need(df, *(c.removeprefix("-") for c in order_by))
    if any(c.startswith("-") for c in order_by):
        raise ValueError("fold works in ascending order")
    keep = [c for c in df.columns if c not in group]
    row = F.struct(*[F.col(f"`{c}`") for c in order], *[F.col(f"`{c}`") for c in keep if c not in order])
    start = (initial if initial is not None else F.lit(None)).cast(kind)
    by = [F.col(f"`{c}`") for c in group]
    rows = df.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("__rows"))

    def chunk(done: Column, at: Column) -> Column:
        def next_value(values: Column, r: Column) -> Column:
            before = F.when(F.size(values) > 0, F.element_at(values, -1)).otherwise(done["last"])
            return F.concat(values, F.array(step(before, F.struct(*[r[c].alias(c) for c in names])).cast(kind)))

        own = F.aggregate(F.slice("__rows", at * CHUNK + 1, CHUNK), F.array().cast(f"array<{kind}>"), next_value)
        return F.get(F.transform(F.array(own), lambda x: F.struct(F.element_at(x, -1).alias("last"), F.concat(done["all"], F.array(x)).alias("all"))), F.lit(0))

    empty = F.struct(start.alias("last"), F.array().cast(f"array<array<{kind}>>").alias("all"))
    values = F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((F.size("__rows") - 1) / CHUNK).cast("int")), empty, chunk)["all"])
    folded = rows.withColumn("__values", values).select(*by, F.explode_outer(F.arrays_zip(F.col("__rows").alias("row"), F.col("__values").alias("value"))).alias("__x"))
    return folded.select(*[F.col(f"`{c}`") if c in group else F.col("__x.row")[c].alias(c) for c in df.columns], F.col("__x.value").alias(out))


CHUNK = 256  # values gathered before they are put to the others


def update_in_place(df: DataFrame, column: str, step: Callable[[Column, Column, Column], Column], columns: list[str], order_by: list[str], group_by: list[str]) -> DataFrame:
    """A column rewritten row by row: `step(before, row, after)` sees the new value of the row before, its own row's old values
    (a struct of `columns`), and the old value of the row after; NULL outside the group. Its place and type stay."""
    (name,) = need(df, column)
    kind = df.schema[name].dataType.simpleString()
    ahead = df.withColumn("__after", neighbour(df, name, 1, order_by, group_by))
    done = fold(ahead, "__new", kind, lambda before, row: step(before, row, row["__after"]), [*columns, "__after"], order_by, group_by)
    return done.select(*[F.col("__new").alias(c) if c == name else F.col(f"`{c}`") for c in df.columns])


def percentiles(df: DataFrame, column: str, share: float, out: str, group_by: list[str] = ()) -> DataFrame:
    """A row for each group with the exact percentile of a number, between neighbours in proportion; NULLs don't count. Found by
    rank: rows are range-sorted into blocks, blocks counted, and only the two rows that are asked for are taken; so a group of any
    size needs no buffer."""
    from ..sources.tables import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    (name,) = need(df, column)
    groups = need(df, *group_by)
    keys = [F.col(f"__g{i}") for i in range(len(groups))]
    plain = df.select(*[F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(groups)], F.col(f"`{name}`").cast("double").alias("__v"))
    held, blocks = _in_blocks(plain.filter("__v is not null"), [*[k.asc_nulls_first() for k in keys], F.col("__v").asc()])
    ahead = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy(*keys, "__block").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(*keys, "__block", "__n", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"), F.sum("__n").over(Window.partitionBy(*keys)).alias("__all"))
    at = F.lit(share) * (F.col("__all") - 1)
    wanted = counts.select(*keys, "__block", "__ahead", at.alias("__at"), F.floor(at).alias("__low"), F.ceil(at).alias("__high"))
    wanted = wanted.join(counts.select(*[k.alias(f"__h{i}") for i, k in enumerate(keys)], F.col("__block").alias("__b"), "__n"), [F.col("__block") == F.col("__b"), *[k.eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)]])
    inside = lambda x: (F.col(x) >= F.col("__ahead")) & (F.col(x) < F.col("__ahead") + F.col("__n"))
    wanted = wanted.filter(inside("__low") | inside("__high")).select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__block").alias("__c"), "__ahead", "__at", "__low", "__high")
    rows = held.repartitionById(blocks, F.col("__block")).withColumn("__i", F.row_number().over(Window.partitionBy("__block", *keys).orderBy("__v")) - 1)
    rows = rows.join(wanted, [F.col("__block") == F.col("__c"), *[k.eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]]).withColumn("__i", F.col("__i") + F.col("__ahead"))
    rows = rows.filter("__i = __low or __i = __high").withColumn("__part", F.col("__at") - F.col("__low"))
    low, high, part = F.min("__v"), F.max("__v"), F.max("__part")
    value = F.when(low == high, low).otherwise((1 - part) * low + part * high)
    found = rows.groupBy(*keys).agg(value.alias("__value")).select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)], "__value")
    if not keys:
        return found.select(F.col("__value").alias(out))
    every = plain.select(*keys).distinct()  # groups of NULLs alone too
    return every.join(found, [k.eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left").select(*[k.alias(g) for k, g in zip(keys, groups, strict=True)], F.col("__value").alias(out))


def per_group(df: DataFrame, function: Callable, schema: str | T.StructType, group_by: list[str]) -> DataFrame:
    """Any pandas function from a group's rows to rows of `schema`."""
    return df.groupBy(*[F.col(f"`{c}`") for c in need(df, *group_by)]).applyInPandas(function, schema)
