"""Grouped aggregates with fixed result types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact
from ..functions.types import is_number, to_text
from .rows import need


@dataclass(frozen=True)
class Agg:
    """An action on a column, and the name of the result.

    Actions: sum, avg, count, count_non_null, count_distinct, min, max, first, last, concat, percentile. `order_by`
    orders the rows for first, last and concat, without ties.
    """

    action: str
    column: str | None = None
    out: str | None = None
    order_by: tuple[str, ...] = ()
    separator: str = ","
    share: float = 0.5

    @property
    def name(self) -> str:
        return self.out or f"{self.action}_{self.column or 'rows'}"


def exact_sum(column: Column, kind: T.DataType) -> Column:
    """The double nearest to the exact sum, in whatever order and parts it is worked out. Doubles of few places are
    summed as integers, others as decimals in four windows by size; where one of them is 1e22 and more, or below 1e-21, or 10^10 of them fill a window, the sum is one
    of doubles."""
    if isinstance(kind, T.IntegralType):
        return F.sum(column.cast("decimal(20,0)")).cast("double")
    if isinstance(kind, T.DecimalType):
        return F.coalesce(F.try_sum(column).cast("double"), F.sum(column.cast("double")))
    return exact.summed(column.cast("double"))


def aggregate(df: DataFrame, a: Agg) -> Column:
    """Sum and avg are exact decimals stored as doubles, the sum of a decimal column stays its type; NULLs don't
    count, and all NULL gives NULL. First and last may be NULL. Concat skips NULL and gives empty text for nothing."""
    if a.action == "count":
        return F.count(F.lit(1)).alias(a.name)
    (name,) = need(df, a.column)
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    order = F.struct(*[F.col(f"`{c}`") for c in need(df, *a.order_by)]) if a.order_by else None
    if a.action in ("first", "last", "concat") and order is None:
        raise ValueError(f"{a.action} needs order_by")
    if a.action in ("sum", "avg") and not is_number(kind):
        raise TypeError(f"{a.action} of {kind.simpleString()}")
    if a.action == "sum":
        out = F.try_sum(column).try_cast(kind) if isinstance(kind, T.DecimalType) else exact.finite(exact_sum(column, kind))
    elif a.action == "avg":
        out = exact.finite(F.try_divide(exact_sum(column, kind), F.count(column).cast("double")))
    elif a.action == "count_non_null":
        out = F.count(column)
    elif a.action == "count_distinct":
        out = F.count_distinct(column)
    elif a.action in ("min", "max"):
        out = getattr(F, a.action)(column)
    elif a.action in ("first", "last"):
        out = (F.min_by if a.action == "first" else F.max_by)(column, order)
    elif a.action == "concat":
        entries = F.collect_list(F.when(column.isNotNull(), F.struct(order.alias("o"), to_text(column, kind).alias("v"))))
        out = F.array_join(F.transform(F.array_sort(entries), lambda e: e["v"]), a.separator)
    elif a.action == "percentile":
        out = F.percentile(column, F.lit(a.share))
    else:
        raise ValueError(f"unknown action {a.action}")
    return out.alias(a.name)


def summarize(df: DataFrame, group_by: list[str], *aggs: Agg) -> DataFrame:
    """One row a group, NULL being one. Without groups: one row, but none for a table without rows."""
    columns = [aggregate(df, a) for a in aggs]
    if group_by:
        by = [F.col(f"`{c}`") for c in need(df, *group_by)]
        return df.groupBy(*by).agg(*columns) if columns else df.select(*by).distinct()
    return df.agg(*columns, F.count(F.lit(1)).alias("__rows")).filter("__rows > 0").drop("__rows")


def table_hash(df: DataFrame) -> DataFrame:
    """n_rows and row_hash: a sum over the rows' hashes, so repeated rows count and order doesn't."""
    values = []
    for c in df.columns:
        values += [F.col(f"`{c}`"), F.col(f"`{c}`").isNull()]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*values).cast("decimal(38,0)")), F.lit(0)).alias("row_hash"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row for each column: nulls, distinct values; sum, min, max, avg and sum of sizes of numbers; shortest and
    longest text. One pass over the table."""
    parts = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        number, text = is_number(f.dataType), isinstance(f.dataType, T.StringType)
        value = c.cast("double") if number else F.lit(None).cast("double")
        size = F.length(c) if text else F.lit(None).cast("int")
        total = exact_sum(c, f.dataType) if number else F.lit(None).cast("double")
        total_size = exact_sum(F.abs(c), f.dataType) if number else F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count_if(c.isNull()).alias("nulls"), F.count_distinct(c).alias("distinct_values"), total.alias("total"),
            F.min(value).alias("low"), F.max(value).alias("high"), F.try_divide(total, F.count(value).cast("double")).alias("mean"), total_size.alias("total_size"), F.min(size).alias("shortest"), F.max(size).alias("longest"),
        ))
    return df.agg(F.array(*parts).alias("x")).select(F.inline("x"))
