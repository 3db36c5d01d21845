"""Field types and the conversion of columns to them.

A field has a name, one of the types below, and for text and decimals a size and scale. Conversions never fail: what
can't be read becomes NULL, text of fixed size is cut, integers and decimals round half away from zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field types and the Spark types that hold them. Byte is unsigned, so a short holds it.
INTEGERS = {"Byte": T.ShortType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType()}
RANGES = {"Byte": (0, 255), "Int16": (-(2**15), 2**15 - 1), "Int32": (-(2**31), 2**31 - 1), "Int64": (-(2**63), 2**63 - 1)}
TEXTS = ("String", "WString", "V_String", "V_WString")
FIXED_TEXTS = ("String", "WString")
FLOATS = ("Float", "Double")
# Sizes that a type has when none is given.
NATURAL_SIZES = {"Bool": 1, "Byte": 1, "Int16": 2, "Int32": 4, "Int64": 8, "Float": 4, "Double": 8, "Date": 10, "Time": 8, "DateTime": 19, "FixedDecimal": 19}
DEFAULT_SCALE = 6
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPACE = r"(?U)^\s+|\s+$"


@dataclass(frozen=True)
class Field:
    name: str
    type: str | None = None
    size: int | None = None
    scale: int | None = None

    def spark_type(self) -> T.DataType | None:
        """None for a field without type, which keeps its column's."""
        if self.type is None:
            return None
        if self.type in INTEGERS:
            return INTEGERS[self.type]
        if self.type == "FixedDecimal":
            return T.DecimalType(min(38, self.size or NATURAL_SIZES["FixedDecimal"]), self.scale or 0)
        known = {"Bool": T.BooleanType(), "Date": T.DateType(), "DateTime": T.TimestampNTZType(), "Time": T.StringType(), "Blob": T.BinaryType()}
        known |= dict.fromkeys(TEXTS, T.StringType()) | dict.fromkeys(FLOATS, T.DoubleType())
        if self.type not in known:
            raise ValueError(f"field type {self.type} is not supported")
        return known[self.type]


def schema_of(fields: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.spark_type() or T.StringType()) for f in fields])


def type_of(df: DataFrame, column: Column) -> T.DataType:
    return df.select(column).schema[0].dataType


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def finite(column: Column) -> Column:
    """A double, or NULL for what no plain number can show."""
    for odd in ("nan", "inf", "-inf"):  # each names the column once
        column = F.nullif(column, F.lit(float(odd)))
    return column


def trim_space(column: Column) -> Column:
    """White space of every kind off both ends."""
    return F.regexp_replace(column, SPACE, "")


def number_text(column: Column) -> Column:
    """Trimmed text that is a plain decimal number, else NULL."""
    text = trim_space(column)
    return F.when(text.rlike(NUMBER), text)


def to_number(column: Column) -> Column:
    """Plain decimal text as a double, else NULL."""
    return finite(number_text(column).try_cast("double"))


def exact(column: Column, kind: T.DataType, scale: int = 10) -> Column:
    """A number or plain decimal text as decimal(38, scale); doubles enter by their shortest text."""
    if isinstance(kind, T.StringType):
        column = number_text(column)
    elif isinstance(kind, T.BooleanType):
        column = column.cast("int")
    return column.try_cast(f"decimal(38,{scale})")


def plain(column: Column) -> Column:
    """Decimal text without trailing zeros of the fraction."""
    text = F.regexp_replace(F.regexp_replace(column, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(text == "-0", "0").otherwise(text)


def _plain_double(text: Column) -> Column:
    """A double's shortest text without its exponent; every digit stays."""
    sign, digits = F.when(text.startswith("-"), "-").otherwise(""), F.regexp_replace(F.regexp_replace(text, "E.*$|[-.]", ""), "0+$", "")
    power = F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
    whole = F.rpad(digits, F.greatest(power + 1, F.length(digits)), F.lit("0"))
    large = F.concat(F.substring(whole, F.lit(1), power + 1), F.when(F.length(whole) > power + 1, F.concat(F.lit("."), F.substring(whole, power + 2, F.length(whole)))).otherwise(""))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    return F.when(~text.contains("E"), plain(text)).otherwise(F.concat(sign, F.when(power >= 0, large).otherwise(small)))


def to_text(column: Column, kind: T.DataType) -> Column:
    """Text of a value: whole numbers without fraction, no exponents, True and False, ISO dates."""
    if isinstance(kind, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _plain_double(finite(column).cast("string"))
    if isinstance(kind, T.DecimalType):
        return plain(column.cast("string")) if kind.scale else column.cast("string")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return column.cast("string")


def coerce(column: Column, kind: T.DataType, field: Field) -> Column:
    """`column`, of Spark type `kind`, as a value of `field`."""
    to, text = field.type, isinstance(kind, T.StringType)
    if to is None:
        return column
    target = field.spark_type()
    if to in TEXTS:
        out = to_text(column, kind)
        return F.substring(out, 1, field.size) if to in FIXED_TEXTS and field.size is not None else out
    if to == "Bool":
        if isinstance(kind, T.BooleanType):
            return column
        if is_number(kind):
            return column != 0
        if not text:
            return F.lit(None).cast(target)
        word = F.lower(trim_space(column))
        return F.when(number_text(column).isNotNull(), to_number(column) != 0).when(word.isin("true", "t", "y", "yes"), True).when(word.isin("false", "f", "n", "no"), False)
    if to in INTEGERS:
        if not (text or is_number(kind) or isinstance(kind, T.BooleanType)):
            return F.lit(None).cast(target)
        if isinstance(kind, T.IntegralType):
            value = column
        else:
            value = F.round(exact(column, kind), 0)
        low, high = RANGES[to]
        return F.when(value.cast("decimal(38,0)").between(low, high), value).try_cast(target)
    if to == "FixedDecimal":
        if text:
            return number_text(column).try_cast(target)
        return (column.cast("int") if isinstance(kind, T.BooleanType) else column).try_cast(target) if is_number(kind) or isinstance(kind, T.BooleanType) else F.lit(None).cast(target)
    if to in FLOATS:
        if text:
            return to_number(column)
        return finite(column.cast("int").cast("double") if isinstance(kind, T.BooleanType) else column.cast("double")) if is_number(kind) or isinstance(kind, T.BooleanType) else F.lit(None).cast(target)
    if to in ("Date", "DateTime", "Time"):
        if text and to == "Time":
            return F.date_format(F.try_to_timestamp(column, F.lit("HH:mm:ss")), "HH:mm:ss")
        if text:
            day = F.try_to_timestamp(F.when(F.length(column) <= 10, column), F.lit("yyyy-MM-dd"))
            moment = F.coalesce(day, F.try_to_timestamp(column, F.lit("yyyy-MM-dd HH:mm:ss")))
            return moment.cast("timestamp_ntz").cast(target)
        if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return F.date_format(column, "HH:mm:ss") if to == "Time" else column.cast("timestamp_ntz").cast(target)
        return F.lit(None).cast(target)
    return column.cast(target)


def coerce_in(df: DataFrame, column: Column, field: Field) -> Column:
    return coerce(column, type_of(df, column), field)


# Families in which two columns' types are compared.
def family(kind: T.DataType) -> str:
    for types, name in (
        ((T.DecimalType, T.IntegralType), "number"), ((T.FloatType, T.DoubleType), "float"), ((T.StringType, T.CharType, T.VarcharType), "string"),
        ((T.DateType,), "date"), ((T.TimestampType, T.TimestampNTZType), "timestamp"), ((T.BooleanType,), "bool"), ((T.BinaryType,), "binary"),
    ):
        if isinstance(kind, types):
            return name
    return f"other:{kind.typeName()}"
