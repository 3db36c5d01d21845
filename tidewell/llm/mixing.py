"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Sources are dealt into streams, each with an integer weight; D is the sum of the weights. Block k of a stream with
weight a may be placed from slot floor(k*D/a) on and must be placed before slot ceil((k+1)*D/a). Earliest deadline
first fills one slot after another; after T slots every stream has had less than one block more or less than T*a/D.
The windows repeat every D slots, so one period is scheduled on the driver (D depends on the weights alone) and
every block finds its slot by arithmetic, without a pass in slot order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1000


def period(weights: list[int]) -> list[list[int]]:
    """For each stream the slots of its blocks in one period of sum(weights) slots."""
    total = sum(weights)
    placed: list[list[int]] = [[] for _ in weights]
    for slot in range(total):
        ready = [(-(-(len(placed[i]) + 1) * total // a), i) for i, a in enumerate(weights) if len(placed[i]) * total // a <= slot]
        placed[min(ready)[1]].append(slot)
    return placed


def _row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; columns of map type have none."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain, *[c.isNull() for c in plain])


def _order(id_col: str, row: Column) -> Column:
    return F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("row "), row)))


def mix(docs: DataFrame, weights: dict[str, int], other_weight: int, block_docs: int = 16, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All rows and columns of `docs`, with stream, block, slot and place (in the block); sorting by slot and place
    gives the mixture.

    Each source in `weights` is a stream; all others, null included, share one stream named `other`. A stream's rows
    are taken in the order of the md5 of their id (without one: of a hash of the row), rows of one id in the order of
    that hash, `block_docs` a block; the last block may be short. So equal rows alone can change places when a task runs
    again. Once a stream
    has run out its slots stay empty and the others go on in proportion. No row is dropped or repeated; repeated rows
    and ids keep a place each. Texts are not read but for the hash. An empty table gives no rows. Columns named like a
    result or like the helpers `__s`, `__o`, `__tie`, `__hi`, `__lo` are replaced.

    Row numbers are the sums of counts over buckets of the md5 (16 to a power that follows the number of rows, in
    two levels) plus the number within the bucket, so no task holds a whole stream.
    """
    names, numbers = [*weights, "other"], [*weights.values(), other_weight]
    total, slots = sum(numbers), period(numbers)
    results = ("stream", "block", "slot", "place")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results])
    digits = max(0, math.ceil(math.log(max(1, docs.count() / ROWS_PER_BUCKET), 16)))
    upper = digits // 2
    known = F.create_map(*[x for i, n in enumerate(weights) for x in (F.lit(n), F.lit(i))]) if weights else None
    stream = F.coalesce(known[F.col(source_col)], F.lit(len(weights))) if weights else F.lit(0)
    rows = docs.withColumns({"__s": stream, "__o": _order(id_col, _row_hash(docs)), "__tie": _row_hash(docs)}).withColumns({"__hi": F.substring("__o", 1, upper), "__lo": F.substring("__o", upper + 1, digits - upper)})

    counts = rows.groupBy("__s", "__hi", "__lo").agg(F.count(F.lit(1)).alias("n"))
    within = F.sum("n").over(Window.partitionBy("__s", "__hi").orderBy("__lo")) - F.col("n")
    low = counts.withColumn("low", within)
    above = counts.groupBy("__s", "__hi").agg(F.sum("n").alias("n"))
    high = above.select("__s", "__hi", (F.sum("n").over(Window.partitionBy("__s").orderBy("__hi")) - F.col("n")).alias("high"))
    before = low.join(high, ["__s", "__hi"]).select("__s", "__hi", "__lo", (F.col("low") + F.col("high")).alias("__before"))

    number = F.row_number().over(Window.partitionBy("__s", "__hi", "__lo").orderBy("__o", "__tie")) - 1
    rank = rows.withColumn("__n", number).join(before, ["__s", "__hi", "__lo"]).withColumn("__rank", F.col("__before") + F.col("__n"))
    block = F.expr(f"__rank div {block_docs}")
    pattern = F.array(*[F.array(*[F.lit(x).cast("long") for x in s]) for s in slots])
    weight = F.array(*[F.lit(a).cast("long") for a in numbers])
    placed = rank.withColumn("block", block).withColumns({"__a": F.get(weight, F.col("__s")), "__p": F.get(pattern, F.col("__s"))})
    slot = F.expr(f"(block div __a) * {total} + get(__p, cast(block % __a as int))")
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], F.get(F.array(*map(F.lit, names)), F.col("__s")).alias("stream"), "block", slot.alias("slot"), F.expr(f"__rank % {block_docs}").alias("place"))


def in_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` in the order of the mixture: written files follow it, in name order and row by row."""
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*columns)


def mix_sql(weights: dict[str, int], other_weight: int, block_docs: int) -> str:
    """The same rows in SQL over `documents`, with the period as a table of values."""
    names, numbers = [*weights, "other"], [*weights.values(), other_weight]
    values = ", ".join(f"('{n}', {a}, {k}, {slot})" for n, a, s in zip(names, numbers, period(numbers), strict=True) for k, slot in enumerate(s))
    listed = ", ".join(f"'{n}'" for n in weights)
    return f"""
    WITH period(stream, weight, k, first_slot) AS (VALUES {values}),
    numbered AS (
      SELECT doc_id, CASE WHEN source IN ({listed}) THEN source ELSE 'other' END AS stream,
             md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
    ranked AS (SELECT doc_id, stream, row_number() OVER (PARTITION BY stream ORDER BY o) - 1 AS r FROM numbered)
    SELECT doc_id, r.stream, r // {block_docs} AS block, (r // {block_docs} // weight) * {sum(numbers)} + first_slot AS slot, r % {block_docs} AS place
    FROM ranked r JOIN period p ON r.stream = p.stream AND (r // {block_docs}) % weight = k"""
