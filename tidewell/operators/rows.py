"""Operators that work row by row or change a table's columns. None of them shuffles, but for the pivot."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, scalar
from ..functions.types import NATURAL_SIZES, Field, coerce, is_number, to_number, to_text, type_of


class Split(NamedTuple):
    """The rows for which a condition is true, and all others."""

    true: DataFrame
    false: DataFrame


def find(df: DataFrame, name: str) -> str | None:
    """A column by exact name, else by name without regard to case."""
    if name in df.columns:
        return name
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def need(df: DataFrame, *names: str) -> list[str]:
    found = [find(df, n) for n in names]
    missing = [n for n, f in zip(names, found, strict=True) if f is None]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return found


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# ---- select, filter, formula ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pick:
    """One line of a selection: a column, and optionally another name, type, size or scale; or that it goes."""

    name: str
    rename: str | None = None
    type: str | None = None
    size: int | None = None
    scale: int | None = None
    keep: bool = True


def select(df: DataFrame, picks: Iterable[Pick], others: bool = False) -> DataFrame:
    """Listed columns in order, renamed and converted; then, if `others`, all unlisted ones in their order.

    A missing column is skipped. A new type without size has its natural size and no source scale. A size without
    a type applies to the type the column has.
    """
    out, listed = [], set()
    for p in picks:
        name = find(df, p.name)
        if name is None:
            continue
        listed.add(name)
        if not p.keep:
            continue
        column, kind = _c(name), df.schema[name].dataType
        if p.type:
            size = p.size if p.size is not None else NATURAL_SIZES.get(p.type)
            column = coerce(column, kind, Field(name, p.type, size, p.scale))
        elif p.size is not None and isinstance(kind, T.StringType):
            column = F.substring(column, 1, p.size)
        out.append(column.alias(p.rename or name))
    out += [_c(c) for c in df.columns if others and c not in listed]
    return df.select(*out)


def split(df: DataFrame, condition: Column) -> Split:
    """Rows where the condition is true; rows where it is false or NULL."""
    test = scalar.true(scalar.condition(df, condition))
    return Split(df.filter(test), df.filter(~test))


@dataclass(frozen=True)
class Formula:
    """A field and the expression for it: a Column, or a function of the table so far. `parts` are values it builds
    on: columns by name, each seeing those before it, that are there for this expression only. A value that is used
    more than once is then worked out once, in generated code; nested in the expression it would be bound by a lambda."""

    field: Field
    expression: Column | Callable[[DataFrame], Column]
    parts: tuple[tuple[str, Callable[[DataFrame], Column]], ...] = ()


def formulas(df: DataFrame, *steps: Formula) -> DataFrame:
    """One after another: each sees what the earlier ones stored. An existing column keeps its place (and, without a
    type, its own type); a new one is appended."""
    for s in steps:
        before = df.columns
        taken = [n for n, _ in s.parts if find(df, n)]
        if taken:
            raise ValueError(f"parts have names of columns: {', '.join(taken)}")
        for n, part in s.parts:
            df = df.withColumn(n, part(df))
        value = s.expression(df) if callable(s.expression) else s.expression
        name = find(df, s.field.name) or s.field.name
        kind = type_of(df, value)
        value = coerce(value, kind, s.field) if s.field.type or name not in df.columns else value.try_cast(df.schema[name].dataType)
        df = df.withColumn(name, value)
        if s.parts:
            df = df.select(*[_c(c) for c in df.columns if c in before or c == name])
    return df


def multi_field(df: DataFrame, columns: list[str], expression: Callable[[Column], Column], prefix: str | None = None) -> DataFrame:
    """The same expression over several columns, in place or as new columns with a prefix."""
    names = need(df, *columns)
    return df.withColumns({(prefix or "") + n: expression(_c(n)) for n in names})


# ---- cleansing --------------------------------------------------------------------------------------------------

PUNCTUATION = r"[!-/:-@\[-`{-~]"


def cleanse(
    df: DataFrame,
    columns: list[str],
    blank_for_null: bool = False,
    zero_for_null: bool = False,
    double_spaces: bool = False,
    all_spaces: bool = False,
    trim: bool = False,
    letters: bool = False,
    digits: bool = False,
    punctuation: bool = False,
    case: str | None = None,
) -> DataFrame:
    """Options apply in the order of the parameters; zero to numbers only, all others but that to text only."""
    out = {}
    for name in need(df, *columns):
        column, kind = _c(name), df.schema[name].dataType
        if is_number(kind) and zero_for_null:
            column = F.coalesce(column, F.lit(0).cast(kind))
        if isinstance(kind, T.StringType):
            if blank_for_null:
                column = F.coalesce(column, F.lit(""))
            if double_spaces:
                column = F.regexp_replace(F.regexp_replace(column, r"[\t\r\n]+", " "), " {2,}", " ")
            if all_spaces:
                column = F.regexp_replace(column, r"(?U)\s+", "")
            if trim:
                column = scalar.trim(column)
            for wanted, pattern in ((letters, r"\p{L}+"), (digits, r"\p{Nd}+"), (punctuation, PUNCTUATION + "+")):
                if wanted:
                    column = F.regexp_replace(column, pattern, "")
            if case:
                column = {"upper": F.upper, "lower": F.lower, "title": scalar.title_case}[case](column)
        out[name] = column
    return df.withColumns(out)


# ---- regular expressions, dates ---------------------------------------------------------------------------------


def regex_parse(df: DataFrame, column: str, pattern: str, fields: list[Field], ignore_case: bool = True) -> DataFrame:
    """A new column for each capture group, NULL where the pattern is not found; no row is dropped. A group that took
    no part in a match is empty text."""
    (name,) = need(df, column)
    pattern = ("(?i)" if ignore_case else "") + pattern
    found = _c(name).rlike(pattern)
    parts = {f.name: coerce(F.when(found, F.regexp_extract(_c(name), pattern, i + 1)), T.StringType(), f) for i, f in enumerate(fields)}
    return df.withColumns(parts)


def regex_substitute(df: DataFrame, column: str, pattern: str, replacement: str, copy_unmatched: bool = True, ignore_case: bool = True) -> DataFrame:
    """All matches in place, `$1` for groups; without a match the text stays if `copy_unmatched`, else it is NULL."""
    (name,) = need(df, column)
    pattern = ("(?i)" if ignore_case else "") + pattern
    return df.withColumn(name, F.when(_c(name).rlike(pattern), F.regexp_replace(_c(name), pattern, replacement)).otherwise(_c(name) if copy_unmatched else None))


def regex_test(df: DataFrame, column: str, pattern: str, out: str, ignore_case: bool = True) -> DataFrame:
    (name,) = need(df, column)
    return df.withColumn(out, scalar.regex_match(_c(name), pattern, ignore_case))


def regex_tokens(df: DataFrame, column: str, pattern: str, out: str) -> DataFrame:
    """A row for each match; rows without a match go."""
    (name,) = need(df, column)
    return df.withColumn(out, F.explode(F.regexp_extract_all(_c(name), F.lit(pattern), F.lit(0))))


def text_to_time(df: DataFrame, column: str, tokens: str, out: str) -> DataFrame:
    (name,) = need(df, column)
    return df.withColumn(out, dates.date_parse(_c(name), tokens))


def time_to_text(df: DataFrame, column: str, tokens: str, out: str) -> DataFrame:
    (name,) = need(df, column)
    return df.withColumn(out, dates.date_format(df, _c(name), tokens))


# ---- shape ------------------------------------------------------------------------------------------------------


def transpose(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Keys, Name, Value: one row for each row and data column, NULLs kept. Values of different types become text."""
    keys = need(df, *keys)
    columns = need(df, *columns) if columns is not None else [c for c in df.columns if c not in keys]
    if not columns:
        return df.select(*map(_c, keys), F.lit("").alias("Name"), F.lit("").alias("Value")).limit(0)
    kinds = {df.schema[c].dataType for c in columns}
    same = len(kinds) == 1
    values = [_c(c).alias(c) if same else to_text(_c(c), df.schema[c].dataType).alias(c) for c in columns]
    return df.select(*map(_c, keys), *values).unpivot(keys, columns, "Name", "Value")


def header_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", text) or "_"


MAX_HEADERS = 10_000


def cross_tab(df: DataFrame, group_by: list[str], header: str, data: str, method: str = "sum", headers: list[str] | None = None, separator: str = ",", order_by: list[str] | None = None) -> DataFrame:
    """One row a group and one column a header, named with everything but ASCII letters, digits and `_` as `_`.

    `headers` freezes the columns; others are dropped. A group without rows for a header has NULL there, counts
    too; a header that is NULL or empty is the column `_`. Without `headers` the distinct names are read first, sorted;
    more than `MAX_HEADERS` are an error. Counts are longs, sums and averages doubles. `concat` joins values in the
    order of `order_by`, columns without ties, or of the values where that is not given.
    """
    group, (head, value) = need(df, *group_by), need(df, header, data)
    from .summarize import exact_sum

    kind = df.schema[value].dataType
    if kind == T.StringType() and method in ("sum", "avg"):
        v_text, kind = _c(value), T.DoubleType()
        df = df.withColumn(value, to_number(v_text))
    named = df.withColumn("__head", F.coalesce(F.nullif(F.regexp_replace(to_text(_c(head), df.schema[head].dataType), "[^A-Za-z0-9_]", "_"), F.lit("")), F.lit("_")))
    if headers is None:
        headers = sorted(r[0] for r in named.select("__head").distinct().limit(MAX_HEADERS + 1).collect())
        if len(headers) > MAX_HEADERS:
            raise ValueError(f"more than {MAX_HEADERS} headers; name those wanted")
    else:
        headers = list(dict.fromkeys(map(header_name, headers)))
    v = _c(value)
    how = {
        "sum": lambda: exact_sum(v, kind),
        "avg": lambda: F.try_divide(exact_sum(v, kind), F.count(v).cast("double")),
        "count": lambda: F.count(F.lit(1)),
        "count_non_null": lambda: F.count(v),
        "count_distinct": lambda: F.count_distinct(v),
        "min": lambda: F.min(v),
        "max": lambda: F.max(v),
        "concat": lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(*[_c(c) for c in need(df, *(order_by or []))], to_text(v, kind).alias("__text"))))), lambda e: e["__text"]), separator),
    }[method]
    if not headers:
        return named.groupBy(*map(_c, group)).agg(F.lit(1).alias("__none")).drop("__none")
    return named.groupBy(*map(_c, group)).pivot("__head", headers).agg(how())


def text_to_columns(df: DataFrame, column: str, delimiter: str, n: int, root: str, extra: str = "last") -> DataFrame:
    """`root1` to `root<n>`; further parts stay in the last column (`last`) or are dropped (`drop`)."""
    (name,) = need(df, column)
    parts = F.split(_c(name), re.escape(delimiter), n if extra == "last" else -1)
    return df.withColumns({f"{root}{i + 1}": F.get(parts, F.lit(i)) for i in range(n)})


def text_to_rows(df: DataFrame, column: str, delimiter: str) -> DataFrame:
    """A row for each part; a row with NULL stays."""
    (name,) = need(df, column)
    return df.withColumn(name, F.explode_outer(F.split(_c(name), re.escape(delimiter))))


def find_replace(df: DataFrame, column: str, pairs: list[tuple[str, str]], whole: bool = False, ignore_case: bool = False) -> DataFrame:
    """The first pair that is found replaces: the whole value, or every occurrence inside it."""
    (name,) = need(df, column)
    text = _c(name)
    out = None
    for old, new in pairs:
        flags = "(?i)" if ignore_case else ""
        quoted = flags + re.escape(old)
        test = text.rlike(rf"{flags}\A{re.escape(old)}\z") if whole else text.rlike(quoted)
        value = F.lit(new) if whole else F.regexp_replace(text, quoted, new.replace("\\", "\\\\").replace("$", "\\$"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return df if out is None else df.withColumn(name, out.otherwise(text))


GRAM = 4  # characters by which texts find the pairs that may be in them


def find_replace_from(df: DataFrame, column: str, lookup: DataFrame, find: str, value: str, order_by: str, whole: bool = False) -> DataFrame:
    """As `find_replace` with a table of pairs, however many: the first pair by `order_by` (without ties) that is found replaces the
    whole value, or every occurrence inside it. NULL and empty things to find are found nowhere; a NULL value counts as empty.

    Texts and pairs meet by equality, or by the first characters of what is to be found; each different text is looked up
    once.
    """
    (name,) = need(df, column)
    pairs = lookup.select(*[_c(n).alias(a) for n, a in zip(need(lookup, find, value, order_by), ("__old", "__to", "__nth"), strict=True)]).filter("__old != ''")
    firsts = pairs.groupBy("__old").agg(F.min(F.struct("__nth", F.coalesce("__to", F.lit("")).alias("__to"))).alias("__p")).select("__old", "__p.__nth", "__p.__to")
    if whole:
        found = firsts.select(F.col("__old").alias("__text"), F.col("__to").alias("__new"))
    else:
        texts = df.select(_c(name).alias("__text")).filter("__text != ''").distinct()
        lengths = F.sequence(F.lit(1), F.least(F.lit(GRAM), F.length("__text")))
        grams = F.array_distinct(F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), F.length("__text") - n + 1), lambda i: F.substring("__text", i, n)))))
        met = texts.select("__text", F.explode(grams).alias("__gram")).join(firsts.withColumn("__gram", F.substring("__old", 1, GRAM)), "__gram")
        best = met.filter(F.col("__text").contains(F.col("__old"))).groupBy("__text").agg(F.min(F.struct("__nth", "__old", "__to")).alias("__p"))
        found = best.select("__text", F.replace("__text", F.col("__p.__old"), F.col("__p.__to")).alias("__new"))
    return df.join(found, _c(name) == F.col("__text"), "left").select(*[F.coalesce("__new", _c(c)).alias(c) if c == name else _c(c) for c in df.columns])


def rename(df: DataFrame, how: Callable[[str], str]) -> DataFrame:
    """All columns by a rule; two columns that get one name are an error."""
    names = [how(c) for c in df.columns]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"two columns get one name: {names}")
    return df.toDF(*names)


def upper_snake(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9]+", "_", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name))).strip("_").upper()


def select_types(df: DataFrame, *types: str) -> DataFrame:
    """The columns of some kinds: `number`, `text`, `date`, `bool`."""
    kinds = {"number": T.NumericType, "text": T.StringType, "date": (T.DateType, T.TimestampType, T.TimestampNTZType), "bool": T.BooleanType}
    return df.select(*[_c(f.name) for f in df.schema if any(isinstance(f.dataType, kinds[t]) for t in types)])


def random_value(seed: int, below: int | None = None) -> Column:
    """A random double from 0 to 1, or a whole number from 0 up to, without, `below`; never part of a comparison."""
    value = F.rand(seed)
    return value if below is None else F.floor(value * below).cast("int")


def outputs(df: DataFrame, n: int = 3) -> tuple[DataFrame, ...]:
    """The same rows for several consumers, computed once: kept in memory, and on disk where that is short."""
    kept = df.persist()
    return (kept,) * n


def random_sample(df: DataFrame, share: float, seed: int) -> DataFrame:
    """A random share of the rows: fixed for one seed and layout of the data, and never part of a comparison."""
    return df.sample(share, seed)


