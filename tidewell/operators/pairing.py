"""Rows of two tables paired by nearest match: fewest differing columns first, at least half of them equal.

A greedy matching, spread over the cluster. Pairs that differ in d columns are looked for after all with fewer have
been taken, so what is left has none with fewer. Two rows that differ in at most d columns agree in one of any d + 1: each
expected row asks with its d + 1 rarest values, and meets the actual rows that have one of these within tolerance.
Values are told apart by cells: those within tolerance are in the same cell or in neighbouring ones, on a scale that
stretches with the tolerance. All meetings are then tested value by value.

A value that many rows share is dealt into slots of about `SLOT` rows. A row meets one slot at first, then twice as many
each time, and only as long as it has no partner; so a crowd of alike rows is paired off without meeting all of itself.
Rows that are each other's first choice leave as a pair, and the rest choose again.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import is_number

SLOT = 64  # actual rows that a row meets at once under a shared value


def _scale(size: Column, absolute: float, relative: float) -> Column:
    """A size on a scale where values within tolerance are less than 1 apart; the tolerance is not zero."""
    if not relative:
        stretched = size / absolute
    elif not absolute:
        stretched = F.log(size) / relative
    else:
        stretched = F.log1p(size * (relative / absolute)) / relative
    return stretched / 1.1


def _float_cells(x: Column, absolute: float, relative: float) -> tuple[Column, Column]:
    """With a relative tolerance alone, signs are apart and zero is near zero only; numbers too large for the scale are
    further apart than the tolerance, so they are their own cells."""
    place = _scale(F.abs(x), absolute, relative) * (F.signum(x) if absolute else 1.0)
    sign = F.lit("") if absolute else F.when(x > 0, "+").otherwise("-")
    number = F.when((F.abs(x) < float("inf")) & (F.abs(place) < 9e18) & (F.lit(bool(absolute)) | (x != 0)), F.floor(place))
    return F.coalesce(F.concat(sign, number.cast("string")), (x + 0.0).cast("string")), F.transform(F.when(number.isNotNull(), F.array(number - 1, number + 1)), lambda n: F.concat(sign, n.cast("string")))


def _cells(value: Column, kind: T.DataType, tolerance) -> tuple[Column, Column | None]:
    """A value's cell, and the neighbouring cells if any: texts. NULL has a cell of its own, and so have NaN and infinities."""
    near: Column | None = None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x = value.cast("double")
        if tolerance.absolute or tolerance.relative:
            cell, near = _float_cells(x, tolerance.absolute, tolerance.relative)
        else:
            cell = (x + 0.0).cast("string")
    elif is_number(kind) and tolerance.number:
        number = F.floor(F.try_divide(value.cast("decimal(38,18)") if not isinstance(kind, T.DecimalType) else value, F.lit(Decimal(str(tolerance.number)))))
        number = number.try_cast("decimal(38,0)")
        near = F.when(number.isNotNull(), F.array((number - 1).cast("string"), (number + 1).cast("string")))
        cell = F.coalesce(number.cast("string"), value.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        cell = F.date_trunc(tolerance.timestamps, value).cast("string")
    elif isinstance(kind, T.BinaryType):
        cell = F.hex(value)
    else:
        cell = value.cast("string")
    return F.coalesce(F.concat(F.lit("="), cell), F.lit("null")), None if near is None else F.transform(near, lambda c: F.concat(F.lit("="), c))


def priority(names: list[str], e: Callable[[str], Column], a: Callable[[str], Column]) -> Column:
    """Among equally near pairs the smallest goes first: a hash of both rows."""
    return F.xxhash64(*[c for n in names for c in (e(n), e(n).isNull(), a(n), a(n).isNull())])


def nearest_pairs(expected: DataFrame, actual: DataFrame, names: list[str], kinds: dict[str, T.DataType], tolerance, differ: Callable, checkpoint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(`__e`, `__a`, `__wrong`) for tables of `names` with row numbers `__e` and `__a`; no row is in two pairs. Where no
    value is shared by more than SLOT actual rows, this is the greedy choice by (`__wrong`, `priority`, `__e`, `__a`)."""
    renamed = actual.select("__a", *[F.col(f"`{n}`").alias(f"__v{i}") for i, n in enumerate(names)])
    wrong = reduce(lambda p, q: p + q, (differ(F.col(f"`{n}`"), F.col(f"__v{i}"), kinds[n], tolerance).cast("int") for i, n in enumerate(names)))
    order = F.struct(priority(names, lambda n: F.col(f"`{n}`"), lambda n: F.col(f"__v{names.index(n)}")).alias("p"), "__e", "__a")
    found, built, left = None, None, not (expected.isEmpty() or renamed.isEmpty())
    for allowed in range(len(names) // 2 + 1):
        if not left:
            break
        if built is None:  # else nobody has left since, and all counts hold
            built = _tokens(expected, renamed, names, kinds, tolerance, checkpoint)
        ranked, theirs = built
        mine = _asked(ranked, allowed)
        first, many = 0, 1
        slots = _most_slots(mine)
        while first < slots:
            asked = mine.filter(F.col("slots") > first).withColumn("i", F.explode(F.sequence(F.lit(first), F.least(F.lit(first + many), F.col("slots").cast("int")) - 1)))
            asked = asked.select("__e", "token", F.pmod(F.col("own") + F.col("i"), F.col("slots")).alias("slot"))
            met = asked.join(theirs, ["token", "slot"]).select("__e", "__a").distinct()
            tested = met.join(expected, "__e").join(renamed, "__a").withColumn("__wrong", wrong).filter(F.col("__wrong") <= allowed)
            pairs = _matched(checkpoint(tested.select("__e", "__a", "__wrong", order.alias("__order"))), checkpoint)
            first, many = first + many, 2 * many
            if pairs is None:
                continue
            found, built = pairs if found is None else found.unionByName(pairs), None
            expected = checkpoint(expected.join(pairs, "__e", "left_anti"))
            left = not expected.isEmpty()
            if not left:
                break
            renamed = checkpoint(renamed.join(pairs, "__a", "left_anti"))
            left = not renamed.isEmpty()
            if not left:
                break
            mine = checkpoint(mine.join(pairs, "__e", "left_anti"))
            slots = _most_slots(mine)
            if first < slots:
                theirs = checkpoint(theirs.join(pairs, "__a", "left_anti"))
    return found if found is not None else expected.select("__e", F.lit(0).cast("long").alias("__a"), F.lit(0).alias("__wrong")).limit(0)


def _asked(ranked: DataFrame, allowed: int) -> DataFrame:
    """The rarest allowed + 1 cells of each expected row, as far as actual rows have them."""
    rare = ranked.select("__e", F.explode(F.slice("x", 1, allowed + 1)).alias("x")).filter("x.n > 0")
    return rare.select("__e", "x.token", _slots(F.col("x.n")).alias("slots")).withColumn("own", F.pmod(F.xxhash64("__e"), F.col("slots")))


def _slots(n: Column) -> Column:
    return F.ceil(n / SLOT)


def _most_slots(mine: DataFrame) -> int:
    return mine.agg(F.max("slots").alias("n")).first().n or 0


def _tokens(expected: DataFrame, actual: DataFrame, names: list[str], kinds: dict, tolerance, checkpoint: Callable) -> tuple[DataFrame, DataFrame]:
    """The cells of each expected row, those that fewest actual rows have first, as many as are ever asked for; and all
    cells of the actual rows with their slots."""

    def listed(i: int, value: Column, kind: T.DataType, around: bool) -> Column:
        cell, near = _cells(value, kind, tolerance)
        cells = F.array(cell) if near is None or not around else F.concat(F.array(cell), F.coalesce(near, F.array().cast("array<string>")))
        return F.transform(cells, lambda c: F.xxhash64(F.lit(i), c))

    theirs = actual.select("__a", F.explode(F.concat(*[listed(i, F.col(f"__v{i}"), kinds[n], True) for i, n in enumerate(names)])).alias("token"))
    counts = checkpoint(theirs.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    mine = expected.select("__e", F.explode(F.concat(*[listed(i, F.col(f"`{n}`"), kinds[n], False) for i, n in enumerate(names)])).alias("token"))
    ranked = mine.join(counts, "token", "left").groupBy("__e").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))), 1, len(names) // 2 + 1).alias("x"))
    dealt = theirs.join(counts, "token").select("__a", "token", F.pmod(F.xxhash64("__a"), _slots(F.col("n"))).alias("slot"))
    return checkpoint(ranked), checkpoint(dealt)


def _matched(edges: DataFrame, checkpoint: Callable) -> DataFrame | None:
    """Pairs that are the first choice of both sides, again and again until no edge is left."""
    found = None
    while not edges.isEmpty():
        mine = edges.groupBy("__e").agg(F.min("__order").alias("o")).select(F.col("o.__e").alias("__e"), F.col("o.__a").alias("__a"))
        theirs = edges.groupBy("__a").agg(F.min("__order").alias("o")).select(F.col("o.__e").alias("__e"), F.col("o.__a").alias("__a"))
        pairs = checkpoint(edges.select("__e", "__a", "__wrong").join(mine, ["__e", "__a"]).join(theirs, ["__e", "__a"]))
        found = pairs if found is None else found.unionByName(pairs)
        edges = checkpoint(edges.join(pairs, "__e", "left_anti").join(pairs, "__a", "left_anti"))
    return found
