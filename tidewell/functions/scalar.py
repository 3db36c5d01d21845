"""Scalar functions with fixed rules for NULL, rounding and text, as Spark columns.

Functions whose result depends on a column's type take the DataFrame first. Arithmetic is exact decimal, stored to a
double once, for doubles of any size and number of places; a result that no double can hold is NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exact
from .types import finite, is_number, number_text, to_number, to_text, trim_space, type_of


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---- conditions -------------------------------------------------------------------------------------------------


def true(condition: Column) -> Column:
    """A condition with NULL as false."""
    return F.coalesce(condition, F.lit(False))


def condition(df: DataFrame, column: Column) -> Column:
    """A boolean, number or numeric text as a condition; other types are an error, text that is no number too."""
    kind = type_of(df, column)
    if isinstance(kind, T.BooleanType):
        return column
    if is_number(kind):
        return column != 0
    if isinstance(kind, T.StringType):
        wrong = column.isNotNull() & to_number(column).isNull()
        return F.when(wrong, F.raise_error(F.concat(F.lit("not a condition: "), column)).cast("boolean")).otherwise(to_number(column) != 0)
    raise TypeError(f"a {kind.simpleString()} is not a condition")


def iif(test: Column, yes, no=None) -> Column:
    return F.when(true(test), _col(yes)).otherwise(_col(no))


def if_chain(*branches: tuple[Column, object], otherwise=None) -> Column:
    """IF, ELSEIF ... ELSE: the first branch whose condition is true."""
    out = F.when(true(branches[0][0]), _col(branches[0][1]))
    for test, value in branches[1:]:
        out = out.when(true(test), _col(value))
    return out.otherwise(_col(otherwise))


def is_empty(text: Column) -> Column:
    """NULL or the empty text; blanks are not empty."""
    return text.isNull() | (text == "")


# ---- arithmetic -------------------------------------------------------------------------------------------------


def _wide(*kinds: T.DataType) -> str:
    """The widest of the operands: int, decimal or double; text counts as a double."""
    if any(isinstance(k, (T.FloatType, T.DoubleType, T.StringType)) for k in kinds):
        return "double"
    return "decimal" if any(isinstance(k, T.DecimalType) for k in kinds) else "int"


def _number(x: Column, kind: T.DataType) -> Column:
    return to_number(x) if isinstance(kind, T.StringType) else x.cast("int") if isinstance(kind, T.BooleanType) else x


SMALL = (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)


def _once(df: DataFrame, value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that it may name often: a column of the table goes in as it is; anything else is worked out
    once and bound to a name, as nested expressions would otherwise be repeated at every level."""
    if str(value).removeprefix("Column<'").removesuffix("'>") in df.columns:
        return use(value)
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _plain(value: Column) -> Column:
    """As `finite`, for use inside other expressions: NaN is above all numbers, so one comparison finds all three."""
    return F.when(F.abs(value) < float("inf"), value)


WHOLE = 9.0e15  # doubles up to here hold every whole number


def _units(value: Column, kind: T.DataType, places: int) -> tuple[Column, Column]:
    """A double as a whole number of units of so many places, and whether that is just what it is: both are doubles,
    and dividing whole numbers rounds once, so the check and results below are exact without decimals."""
    units = F.rint(value.cast("double") * 10.0**places)
    if isinstance(kind, SMALL):
        return units, F.lit(True)
    return units, (F.abs(units) <= WHOLE) & (units / 10.0**places == value.cast("double"))


FINE, COARSE, SURE = 1e15, 1e9, 1e15  # units a whole number has, numbers a unit has, and the most units, of 15 digits, that stand for one double


def _fine(value: Column) -> tuple[Column, Column]:
    """As `_units`, for numbers of up to 15 places that are at most 1."""
    units = F.rint(value.cast("double") * FINE)
    return units, (F.abs(units) <= SURE) & (units / FINE == value.cast("double"))


def _coarse(value: Column) -> tuple[Column, Column]:
    """As `_units`, for multiples of 10^9."""
    units = F.rint(value.cast("double") / COARSE)
    return units, (F.abs(units) <= SURE) & (units * COARSE == value.cast("double"))


def _by_other_units(x: Column, y: Column, name: str, slow: Column) -> Column:
    """What units of a few places can't do, in fine or coarse ones: a whole number below 2^53 divided or multiplied by a power of
    ten up to 10^22 is rounded once. `slow` is for the rest."""
    (u, u_fine), (v, v_fine) = _fine(x), _fine(y)
    if name != "*":
        result = {"+": u + v, "-": u - v, "%": F.try_mod(u, v), "/": F.try_divide(u, v)}[name]
        return F.when(true(u_fine & v_fine), (result if name == "/" else result / FINE) + 0.0).otherwise(slow)
    kinds = lambda c: {4: _units(c, T.DoubleType(), 4), 15: _fine(c), -9: _coarse(c)}
    a, b, out = kinds(x), kinds(y), None
    for i, j in ((15, 4), (4, 15), (4, -9), (-9, 4)):
        (u, u_fits), (v, v_fits) = a[i], b[j]
        value = u * v / 10.0 ** (i + j) if i + j > 0 else u * v * 10.0 ** -(i + j)
        fits = true(u_fits & v_fits & (F.abs(u * v) <= WHOLE))
        out = F.when(fits, value + 0.0) if out is None else out.when(fits, value + 0.0)
    return out.otherwise(slow)


def _exactly(df: DataFrame, a: Column, b: Column, name: str) -> Column:
    """Whole units where both numbers have few places, which gives the same result faster, else decimal parts."""
    kinds = [type_of(df, a), type_of(df, b)]
    places = 4 if name == "*" else 6
    plain = {"+": lambda x, y: x + y, "-": lambda x, y: x - y, "*": lambda x, y: x * y, "%": F.try_mod, "/": F.try_divide}[name]
    divisor = {"*": 100_000_000.0, "/": 1.0}.get(name, 1_000_000.0)

    def use(x: Column, y: Column) -> Column:
        (u, u_fits), (v, v_fits) = (_units(c, k, places) for c, k in zip((x, y), kinds, strict=True))
        units = plain(u, v)
        few = u_fits & v_fits if name in "/%" else u_fits & v_fits & (F.abs(units) <= WHOLE)
        slow = exact.work_out(name, [x, y], kinds)
        rest = _by_other_units(x, y, name, slow) if all(isinstance(k, (T.DoubleType, *SMALL)) for k in kinds) else slow
        return F.when(true(few), units / divisor + 0.0).otherwise(rest)  # + 0.0: no negative zero

    bind = lambda c, k, f: f(c) if isinstance(k, SMALL) else _once(df, c, f)
    return bind(a, kinds[0], lambda x: bind(b, kinds[1], lambda y: use(x, y)))


def _arithmetic(df: DataFrame, a: Column, b: Column, name: str) -> Column:
    """Whole numbers and decimals as they are, NULL where the result is too large; with a double among them, exact
    decimals stored to a double once."""
    ka, kb = type_of(df, a), type_of(df, b)
    a, b = _number(a, ka), _number(b, kb)
    tried = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "%": F.try_mod}[name]
    wide = _wide(ka, kb)
    if wide == "int":
        return tried(a.cast("bigint"), b.cast("bigint"))
    if wide == "decimal":
        return tried(a, b)
    return _exactly(df, a, b, name)


def add(df: DataFrame, a: Column, b: Column) -> Column:
    return _arithmetic(df, a, b, "+")


def subtract(df: DataFrame, a: Column, b: Column) -> Column:
    return _arithmetic(df, a, b, "-")


def multiply(df: DataFrame, a: Column, b: Column) -> Column:
    return _arithmetic(df, a, b, "*")


def divide(df: DataFrame, a: Column, b: Column) -> Column:
    """Never an integer division; by zero gives NULL. The double nearest to the quotient."""
    return _exactly(df, _number(a, type_of(df, a)), _number(b, type_of(df, b)), "/")


def modulo(df: DataFrame, a: Column, b: Column) -> Column:
    """The dividend's sign; by zero gives NULL."""
    return _arithmetic(df, a, b, "%")


def join_text(df: DataFrame, a: Column, b: Column) -> Column:
    """`+` where either side is text: both as text; NULL if either is."""
    return F.concat(to_text(a, type_of(df, a)), to_text(b, type_of(df, b)))


def to_string(df: DataFrame, x: Column, places: int | None = None) -> Column:
    """Text of a value; with `places`, of a number with so many decimals, halves away from zero."""
    kind = type_of(df, x)
    if places is None:
        return to_text(x, kind)
    value = _number(x, kind)
    whole = F.concat(to_text(value, T.DoubleType() if isinstance(kind, T.StringType) else kind), F.lit("." + "0" * places if places else ""))
    return F.coalesce(value.try_cast(f"decimal(38,{places})").cast("string"), whole)  # what is too large has no decimals


def round_to(df: DataFrame, x: Column, multiple: str | int = 1) -> Column:
    """The nearest multiple, halves away from zero, on exact decimals, as a double; multiple 0 gives NULL."""
    if Decimal(str(multiple)) == 0:
        return F.lit(None).cast("double")
    value = _number(x, type_of(df, x))
    kind, step = type_of(df, value), abs(Decimal(str(multiple)))
    size = step * 10**8

    def near(v: Column) -> Column:
        slow = exact.work_out(step, [v], [kind])
        fine = step * 10**15
        if isinstance(kind, T.DoubleType) and size != int(size) and fine == int(fine):
            units, fits = _fine(v)
            rest, one = F.abs(units) % float(fine), float(fine)
            return F.when(true(fits), F.signum(units) * (F.abs(units) - rest + F.when(2 * rest >= one, one).otherwise(0.0)) / FINE + 0.0).otherwise(slow)
        if size != int(size) or size > 10**15:
            return slow
        units, fits = _units(v, kind, 8)
        rest, one = F.abs(units) % float(size), float(size)
        fast = F.signum(units) * (F.abs(units) - rest + F.when(2 * rest >= one, one).otherwise(0.0)) / 100_000_000.0 + 0.0
        return F.when(true(fits), fast).otherwise(slow)

    return _once(df, value, near)


def absolute(x: Column) -> Column:
    return F.abs(x)


def _to_whole(df: DataFrame, x: Column, rounded: Callable[[Column], Column]) -> Column:
    """A double is between the same whole numbers as its decimal text, so no decimal is needed."""
    value = _number(x, type_of(df, x))
    if isinstance(type_of(df, value), (T.DoubleType, T.FloatType)):
        return F.when(F.abs(value) < 9.2e18, rounded(value)).cast("bigint")
    return rounded(value).try_cast("bigint")


def ceiling(df: DataFrame, x: Column) -> Column:
    return _to_whole(df, x, F.ceil)


def floor(df: DataFrame, x: Column) -> Column:
    return _to_whole(df, x, F.floor)


def power(df: DataFrame, base: Column, exponent: int | float | Column) -> Column:
    """Exact products for exponents 0 to 4 as far as 38 digits hold them, else a double; undefined or too large gives
    NULL."""
    base = _number(base, type_of(df, base))
    b, e = base.cast("double"), _col(exponent).cast("double")
    undefined = ((b == 0) & (e < 0)) | ((b < 0) & (e != F.floor(e)))
    out = F.when(~undefined, finite(F.pow(b, e)))
    if isinstance(exponent, int) and 0 <= exponent <= 4:
        if exponent == 0:
            return F.when(base.isNotNull(), F.lit(1.0))
        x = base.try_cast({1: "decimal(38,18)", 2: "decimal(18,9)", 3: "decimal(12,6)", 4: "decimal(8,4)"}[exponent])
        product = x
        for _ in range(exponent - 1):
            product = product * x
        return F.when(true(x.cast("double") == b), product.cast("double")).otherwise(out)
    return out


def smallest(*columns: Column) -> Column:
    """NULL only if all are."""
    return F.least(*columns) if len(columns) > 1 else columns[0]


def largest(*columns: Column) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


# ---- text -------------------------------------------------------------------------------------------------------


def _folded(ignore_case: bool, *texts: Column) -> list[Column]:
    return [F.lower(t) for t in texts] if ignore_case else list(texts)


def contains(text: Column, part, ignore_case: bool = True) -> Column:
    a, b = _folded(ignore_case, text, _col(part))
    return a.contains(b)


def starts_with(text: Column, part, ignore_case: bool = True) -> Column:
    a, b = _folded(ignore_case, text, _col(part))
    return a.startswith(b)


def ends_with(text: Column, part, ignore_case: bool = True) -> Column:
    a, b = _folded(ignore_case, text, _col(part))
    return a.endswith(b)


def substring(text: Column, start: int, length: int | None = None) -> Column:
    """`start` counts from 0; negative starts and lengths are 0."""
    start = max(start, 0)
    return F.substring(text, start + 1, 2**31 - 1 - start if length is None else max(length, 0))


def left(text: Column, n: int) -> Column:
    return F.substring(text, 1, max(n, 0))


def right(text: Column, n: int) -> Column:
    return F.right(text, F.lit(max(n, 0)))


def pad_left(text: Column, n: int, fill: str) -> Column:
    """Longer text stays as it is; only the first character of `fill` counts, and none gives NULL."""
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, fill[0])) if fill else F.lit(None).cast("string")


def pad_right(text: Column, n: int, fill: str) -> Column:
    return F.when(F.length(text) >= n, text).otherwise(F.rpad(text, n, fill[0])) if fill else F.lit(None).cast("string")


def trim(text: Column) -> Column:
    return trim_space(text)


def trim_left(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+", "")


def trim_right(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+$", "")


def title_case(text: Column) -> Column:
    """The first character of every white-space-separated word in upper case, the rest in lower case."""
    parts = F.regexp_extract_all(text, F.lit(r"(?U)\S+|\s+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**31 - 1)))), "")


def replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new)) if old else text


def regex_match(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Whether the pattern is found anywhere. The dialect is Java's."""
    return text.rlike(("(?i)" if ignore_case else "") + pattern)


def regex_replace(text: Column, pattern: str, replacement: str, ignore_case: bool = True) -> Column:
    return F.regexp_replace(text, ("(?i)" if ignore_case else "") + pattern, replacement)


# ---- comparison -------------------------------------------------------------------------------------------------


def compared(df: DataFrame, a: Column, b: Column) -> tuple[Column, Column]:
    """Both sides ready for a comparison: text meets a number as a number, digit by digit, NULL if it is none. The pair
    then is how they stand to each other, and 0."""
    ka, kb = type_of(df, a), type_of(df, b)
    if isinstance(ka, T.StringType) and is_number(kb):
        return exact.order(number_text(a), F.when(b == b, b).cast("string")), F.lit(0)
    if is_number(ka) and isinstance(kb, T.StringType):
        return exact.order(F.when(a == a, a).cast("string"), number_text(b)), F.lit(0)
    return a, b
