"""Decimal arithmetic on any doubles, whatever their size and number of places.

A double stands for its shortest decimal text: a whole number of at most 19 digits times a power of ten. Sums, products,
remainders and multiples are worked out on such pairs exactly, quotients to more than 35 digits; the result is written as
decimal text and read as a double, which rounds once. What no double can hold is NULL, as is division by zero.

The formulas are SQL text, put together once: as thousands of calls to build a column each they took longer to plan than to
run. A name is given to what a formula needs more than once, so that trees stay small.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = "decimal(38,0)"


class Parts(NamedTuple):
    """A number m * 10^e, as SQL: m a decimal without places, e an int."""

    m: str
    e: str


def _let(name: str, values: dict[str, str], body: str) -> str:
    """`body`, in which `name.key` stands for a value that is worked out once."""
    fields = ", ".join(f"'{k}', {v}" for k, v in values.items())
    return f"get(transform(array(named_struct({fields})), {name} -> {body}), 0)"


def _whole(x: int | str) -> str:
    return f"CAST({x} AS {WHOLE})"


def _power(k: int | str) -> str:
    """10^k for k from 0 to 37."""
    return f"CAST(concat('1', repeat('0', {k})) AS {WHOLE})"


def _sign(x: str) -> str:
    return f"CAST(signum({x}) AS INT)"


def _digits(m: str) -> str:
    return f"length(CAST(abs({m}) AS STRING))"


def _nearest(m: str, e: str) -> str:
    """The double nearest to m * 10^e, maybe infinite; m is a whole number, as a decimal or as text."""
    return f"try_cast(concat(CAST({m} AS STRING), 'E', CAST({e} AS STRING)) AS DOUBLE)"


def _parts(text: str, also: dict[str, str]) -> str:
    """A struct of m and e, of a plain decimal text, with or without exponent, of at most 38 digits."""
    power = f"coalesce(try_cast(regexp_extract({text}, '[eE]([+-]?[0-9]+)$', 1) AS INT), 0)"
    places = "IF(contains(h.head, '.'), regexp_replace(substring_index(h.head, '.', -1), '0+$', ''), '')"
    more = "".join(f", '{k}', {v}" for k, v in also.items())
    done = f"named_struct('m', try_cast(concat(substring_index(h.head, '.', 1), i.places) AS {WHOLE}), 'e', h.power - length(i.places){more})"
    return _let("h", {"head": f"substring_index(lower({text}), 'e', 1)", "power": power}, _let("i", {"places": places}, done))


def _shortest() -> str:
    """The parts `p` of a double `p.v` by its shortest text: Java before version 19 may write a digit or two more than needed. (It
    also writes a few others with as many digits, but not the nearest such text, like 4.9E-324; these stay.)"""
    found = []
    for by in (2, 1):
        low, near = _whole(f"(p.m - p.m % {10**by}) / {10**by}"), _whole(f"round(p.m, -{by}) / {10**by}")
        found += [(near, by), (_whole(f"{low} + IF({near} = {low}, {_sign('p.m')}, 0)"), by)]
    shorter = ", ".join(f"named_struct('m', {m}, 'e', p.e + {by})" for m, by in found)
    same = "named_struct('m', p.m, 'e', p.e)"
    return f"IF({_digits('p.m')} >= 17, coalesce(get(filter(array({shorter}), c -> {_nearest('c.m', 'c.e')} = p.v), 0), {same}), {same})"


def _add(a: Parts, b: Parts) -> str:
    swap = f"{a.e} < {b.e}"
    ends = {"hm": f"IF({swap}, {b.m}, {a.m})", "he": f"greatest({a.e}, {b.e})", "lm": f"IF({swap}, {a.m}, {b.m})", "le": f"least({a.e}, {b.e})"}
    # Beyond 36 places only the sign of the lower number matters, if it has one.
    near = {"d": "least(q.he - q.le, 36)", "m": f"IF(q.he - q.le > 36, {_whole('signum(q.lm)')}, q.lm)"}
    # The lower number's digits beyond the 18th place stay text behind those of the sum.
    turn = f"r.rest <> 0 AND t.top <> 0 AND {_sign('r.rest')} <> {_sign('t.top')}"
    sign = f"IF({_sign('w.top')} < 0 OR w.top = 0 AND {_sign('z.m')} < 0, '-', '')"
    text = f"concat({sign}, CAST(abs(w.top) AS STRING), lpad(CAST(w.rest AS STRING), r.k, '0'))"
    signs = {"top": _whole(f"IF(t.turn, t.top - {_sign('t.top')}, t.top)"), "rest": _whole(f"abs(IF(t.turn, r.rest + {_sign('t.top')} * {_power('r.k')}, r.rest))")}
    top = _whole(f"q.hm * {_power(18)} + {_whole(f'(z.m - r.rest) / {_power('r.k')}')}")
    wide = _let("r", {"k": "greatest(z.d - 18, 1)", "rest": f"z.m % {_power('greatest(z.d - 18, 1)')}"}, _let("t", {"top": top}, _let("t", {"top": "t.top", "turn": turn}, _let("w", signs, _nearest(text, "q.he - z.d")))))
    plain = _nearest(_whole(f"q.hm * {_power('z.d')} + z.m"), "q.he - z.d")
    chosen = f"CASE WHEN q.hm = 0 THEN {_nearest('q.lm', 'q.le')} WHEN q.lm = 0 THEN {_nearest('q.hm', 'q.he')} WHEN z.d <= 18 THEN {plain} ELSE {wide} END"
    return _let("q", ends, _let("z", near, chosen))


def _subtract(a: Parts, b: Parts) -> str:
    return _add(a, Parts(_whole(f"-{b.m}"), b.e))


def _multiply(a: Parts, b: Parts) -> str:
    return _nearest(_whole(f"{a.m} * {b.m}"), f"{a.e} + {b.e}")


def _divide(a: Parts, b: Parts) -> str:
    sizes = {}
    for n, x in (("x", a), ("y", b)):  # both with 19 digits
        more = f"(19 - {_digits(x.m)})"
        sizes |= {f"{n}m": _whole(f"abs({x.m}) * {_power(more)}"), f"{n}e": f"{x.e} - {more}"}
    one, two = {"n": _whole(f"f.xm * {_power(18)}"), "r": _whole(f"f.xm * {_power(18)} % f.ym")}, {"n": _whole(f"g.r * {_power(18)}"), "r": _whole(f"g.r * {_power(18)} % f.ym")}
    quotient = lambda v: f"CAST({_whole(f'({v}.n - {v}.r) / f.ym')} AS STRING)"
    text = f"concat(IF({_sign(a.m)} * {_sign(b.m)} < 0, '-', ''), {quotient('g')}, lpad({quotient('h')}, 18, '0'), IF(h.r = 0, '0', '1'))"
    done = _let("f", sizes, _let("g", one, _let("h", two, _nearest(text, "f.xe - f.ye - 37"))))
    return f"CASE WHEN {b.m} = 0 THEN NULL WHEN {a.m} = 0 THEN 0D ELSE {done} END"


def _rest(a: Parts, b: Parts) -> Parts:
    """Of the sizes, for a quotient below 10^72: the remainder at the smaller of the two exponents."""
    m, n, k = f"abs({a.m})", f"abs({b.m})", f"({a.e} - {b.e})"
    r = f"({m} % {n})"
    for j in range(0, 72, 18):
        r = _whole(f"{r} * {_power(f'greatest(0, least({k} - {j}, 18))')} % {n}")
    below = f"IF({k} < -19, {m}, {m} % {_whole(f'{n} * {_power(f'least(-{k}, 19)')}')})"
    return Parts(_whole(f"IF({k} >= 0, {r}, {below})"), f"least({a.e}, {b.e})")


def _modulo(a: Parts, b: Parts) -> str:
    """The dividend's sign. A quotient of more than 40 digits is NULL."""
    digits = f"{_digits(a.m)} + {a.e} - {_digits(b.m)} - {b.e}"
    rest = _rest(a, b)
    return f"CASE WHEN {b.m} = 0 THEN NULL WHEN {a.m} = 0 THEN 0D WHEN {digits} > 40 THEN NULL ELSE {_nearest(_whole(f'{rest.m} * {_sign(a.m)}'), rest.e)} END"


def _to_multiple(a: Parts, step: Decimal) -> str:
    """The nearest multiple of a step that is not 0 and has at most 18 digits, halves away from zero."""
    _, digits, exponent = abs(step).as_tuple()
    size = int("".join(map(str, digits)))
    if size >= 10**18:
        raise ValueError("a step has at most 18 digits")
    s = Parts(_whole(size), f"({exponent})")
    k = f"({a.e} - {s.e})"
    change = f"IF(2 * r.m >= {s.m}, {s.m} - r.m, -r.m)"
    above = _add(a, Parts(_whole(f"{_sign(a.m)} * {change}"), s.e))
    unit = _whole(f"{s.m} * {_power(f'greatest(0, least(-{k}, 19))')}")
    below = _nearest(_whole(f"{_sign(a.m)} * (abs({a.m}) - r.m + IF(2 * r.m >= {unit}, {unit}, {_whole(0)}))"), a.e)
    # A step of less than its last digit changes nothing.
    chosen = f"CASE WHEN {k} > 72 THEN {_nearest(a.m, a.e)} WHEN {k} >= 0 THEN {above} WHEN {k} < -19 THEN 0D ELSE {below} END"
    return _let("r", {"m": _rest(a, s).m}, chosen)


OPERATIONS: dict[str, Callable[[Parts, Parts], str]] = {"+": _add, "-": _subtract, "*": _multiply, "/": _divide, "%": _modulo}


@lru_cache(maxsize=256)
def _formula(name: str | Decimal) -> str:
    """An operation on the parts of two numbers, or rounding to a step, as a function in SQL."""
    a, b = Parts("p[0].m", "p[0].e"), Parts("p[1].m", "p[1].e")
    result = _to_multiple(a, name) if isinstance(name, Decimal) else OPERATIONS[name](a, b)
    return f"p -> {_finite(result)}"


def _finite(result: str) -> str:
    """NULL for what no double holds; no negative zero."""
    return _let("o", {"x": result}, "IF(abs(o.x) < CAST('Infinity' AS DOUBLE), o.x + 0D, NULL)")


PARTS, SHORTEST = f"s -> {_parts('s.t', {'v': 's.v'})}", f"p -> {_shortest()}"


def mapped(items: Column, function: str) -> Column:
    return F.call_function("transform", items, F.expr(function))


def finite(value: Column) -> Column:
    """A double, or NULL for NaN and infinities; a long expression is named once."""
    return F.get(mapped(F.array(value), "o -> IF(abs(o) < CAST('Infinity' AS DOUBLE), o, NULL)"), F.lit(0))


def work_out(name: str | Decimal, values: list[Column], kinds: list[T.DataType]) -> Column:
    """An operation (`+ - * / %`) on two numbers, or a number rounded to a multiple of a decimal step."""

    def named(x: Column, kind: T.DataType) -> Column:
        return F.struct(x.cast("string").alias("t"), (x if isinstance(kind, T.DoubleType) else F.lit(None)).cast("double").alias("v"))

    split = mapped(mapped(F.array(*map(named, values, kinds)), PARTS), SHORTEST)
    return F.get(mapped(F.array(split), _formula(name)), F.lit(0))


def order(a: Column, b: Column) -> Column:
    """-1, 0 or 1 as one plain decimal text is below, equal to or above another, to the last digit of either."""

    def keyed(text: Column) -> tuple[Column, Column]:
        head = F.regexp_replace(F.substring_index(F.lower(text), "e", 1), "[+-]", "")
        power = F.coalesce(F.regexp_extract(text, "[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
        places = F.when(head.contains("."), F.length(F.substring_index(head, ".", -1))).otherwise(0)
        digits = F.regexp_replace(F.replace(head, F.lit("."), F.lit("")), "^0+", "")
        sign = F.when(digits == "", 0).when(F.ltrim(text).startswith("-"), -1).otherwise(1)
        return sign, F.struct((F.length(digits) + power - places).alias("size"), F.regexp_replace(digits, "0+$", "").alias("digits"))

    (s, x), (t, y) = keyed(a), keyed(b)
    size = F.when(x < y, -1).when(x > y, 1).otherwise(0)
    return F.when(a.isNull() | b.isNull(), None).when(s != t, F.signum(s - t).cast("int")).otherwise(s * size)


# ---- sums -------------------------------------------------------------------------------------------------------

#: Sizes of doubles with a decimal type that holds each of them, and the sum of 10^9 of them, without losing a digit. (37
#: digits: the sum of two has 38, while Spark would cut the last digit of a sum that needs 39.)
WINDOWS = {"h": (1e10, 1e22, "decimal(37,6)"), "m": (1.0, 1e10, "decimal(37,16)"), "l": (1e-11, 1.0, "decimal(37,28)"), "s": (1e-21, 1e-11, "decimal(37,37)")}


def windows(value: Column) -> dict[str, Column]:
    """A double as a decimal of the window for its size; NULL in all others."""
    size = F.abs(value)
    return {n: F.when((size >= low) & (size < high), value.try_cast(kind)) for n, (low, high, kind) in WINDOWS.items()}


def units(value: Column) -> tuple[Column, Column]:
    """Whether a double is a whole number of ten-thousandths below 10^9, and that number; most are, and sum as integers."""
    near = F.rint(value * 10_000.0)
    return (F.abs(near) <= 1e13) & (near / 10_000.0 == value), near.cast("long")


def beyond(value: Column) -> Column:
    """Whether a double is in no window: 1e22 and more, or less than 1e-21, but not 0."""
    return (value != 0) & ~((F.abs(value) >= 1e-21) & (F.abs(value) < 1e22))


def _split() -> str:
    """Four sums as a whole number, what is left down to the 28th place, and what is below."""
    rests = [f"(x.{n} % {_whole(1)})" for n in "hml"]
    whole = _whole(" + ".join(_whole(f"try_subtract(x.{n}, {r})") for n, r in zip("hml", rests, strict=True)))
    cut = f"(x.s % CAST('{Decimal(1).scaleb(-28):f}' AS DECIMAL(38,38)))"
    part = " + ".join(f"CAST({r} AS DECIMAL(33,28))" for r in [*rests, f"try_subtract(x.s, {cut})"])
    over = f"CAST(y.part % {_whole(1)} AS DECIMAL(33,28))"
    done = f"named_struct('whole', {_whole(f'y.whole + {_whole(f'y.part - {over}')}')}, 'part', {over}, 'cut', {cut})"
    return f"x -> {_let('y', {'whole': whole, 'part': f'CAST({part} AS DECIMAL(33,28))'}, done)}"


def _one_sign() -> str:
    """The whole and the fraction with one sign; the fraction and what is below it as parts."""
    turn = "CAST(CASE WHEN x.whole > 0 AND x.part < 0 THEN 1 WHEN x.whole < 0 AND x.part > 0 THEN -1 ELSE 0 END AS DECIMAL(1,0))"
    part, cut = _parts("CAST(CAST(x.part + z.turn AS DECIMAL(33,28)) AS STRING)", {}), _parts("CAST(x.cut AS STRING)", {})
    return f"x -> {_let('z', {'turn': turn}, f"named_struct('whole', {_whole('x.whole - z.turn')}, 'part', {part}, 'cut', {cut})")}"


def _written() -> str:
    """The nearest double. What is left below the 28th place only tells above from below, beside a whole number: one more digit does."""
    signs = {"negative": "x.whole < 0 OR x.part.m < 0", "digits": _whole(f"abs(x.part.m) * {_power('x.part.e + 28')}")}
    less = {"less": "x.cut.m <> 0 AND (x.cut.m < 0) <> n.negative"}
    digits = f"CAST({_whole(f'CASE WHEN l.less AND n.digits = 0 THEN {_power(28)} - 1 WHEN l.less THEN n.digits - 1 ELSE n.digits END')} AS STRING)"
    size = f"CAST({_whole('abs(x.whole) - IF(l.less AND n.digits = 0, 1, 0)')} AS STRING)"
    text = f"concat(IF(n.negative, '-', ''), {size}, lpad({digits}, 28, '0'), CASE WHEN x.cut.m = 0 THEN '0' WHEN l.less THEN '9' ELSE '1' END)"
    long = _let("n", signs, _let("l", less, _nearest(text, "-29")))
    return f"x -> {_finite(f'IF(x.whole = 0, {_add(Parts("x.part.m", "x.part.e"), Parts("x.cut.m", "x.cut.e"))}, {long})')}"


SPLIT, ONE_SIGN, WRITTEN = _split(), _one_sign(), _written()


def total(h: Column, m: Column, l: Column, s: Column) -> Column:  # noqa: E741
    """The double nearest to the sum of four windows' sums; NULL counts as nothing."""
    h, m, l, s = (F.coalesce(x, F.lit(Decimal(0)).cast(WINDOWS[n][2])) for n, x in zip("hmls", (h, m, l, s), strict=True))  # noqa: E741
    few = l.cast("decimal(26,16)")
    plain = (m.try_cast("decimal(36,16)") + few).cast("double")
    held = F.array(F.struct(h.alias("h"), m.alias("m"), l.alias("l"), s.alias("s")))
    exactly = F.get(mapped(mapped(mapped(held, SPLIT), ONE_SIGN), WRITTEN), F.lit(0))
    return F.when((h == 0) & (s == 0) & (few == l) & plain.isNotNull(), plain + 0.0).otherwise(exactly)


#: Bits of a number of units that are summed apart, so that no sum of 10^11 of them overflows.
HALF = 26


def _finish() -> str:
    """The sum from what `sums` gathers; one of doubles where a window's sum is too large or a double is in no window."""
    zero = lambda n, kind: f"coalesce(t.{n}, CAST(0 AS {kind}))"
    units = f"CAST({zero('high', 'BIGINT')} AS DECIMAL(19,0)) * {1 << HALF} + CAST({zero('low', 'BIGINT')} AS DECIMAL(19,0))"
    kinds = {n: kind for n, (_, _, kind) in WINDOWS.items()}
    values = {n: zero(n, kind) for n, kind in kinds.items()} | {"m": f"try_cast({zero('m', kinds['m'])} + try_cast(({units}) * 0.0001BD AS {kinds['m']}) AS {kinds['m']})"}
    full = " OR ".join([f"t.seen & {2 << i} <> 0 AND t.{n} IS NULL" for i, n in enumerate(WINDOWS)] + ["t.seen & 1 <> 0 AND (t.high IS NULL OR t.low IS NULL)", "v.m IS NULL", "t.seen & 32 <> 0"])
    plain = "CAST(try_cast(v.m AS DECIMAL(36,16)) + CAST(v.l AS DECIMAL(26,16)) AS DOUBLE)"
    fast = f"v.h = 0 AND v.s = 0 AND CAST(v.l AS DECIMAL(26,16)) = v.l AND {plain} IS NOT NULL"
    slow = f"get(transform(transform(transform(array(v), {SPLIT}), {ONE_SIGN}), {WRITTEN}), 0)"
    return "t -> " + _let("v", values, f"CASE WHEN t.seen IS NULL THEN NULL WHEN {full} THEN t.plain WHEN {fast} THEN {plain} + 0D ELSE {slow} END")


FINISH = _finish()


def summed(value: Column) -> Column:
    """The sum of doubles: those of few places are summed as integers in two halves, others as decimals by size; `seen` has a bit
    for each kind there is, so a sum that is NULL although it had values is known to be too large."""
    few, near = units(value)
    others = windows(F.when(~few, value))
    seen = F.when(few, 1)
    for i, w in enumerate(others.values()):
        seen = seen.when(w.isNotNull(), 2 << i)
    gathered = [F.try_sum(F.when(few, F.shiftright(near, HALF))).alias("high"), F.try_sum(F.when(few, near.bitwiseAND(F.lit((1 << HALF) - 1)))).alias("low")]
    gathered += [F.try_sum(w).alias(n) for n, w in others.items()]
    gathered += [F.bit_or(seen.when(value.isNotNull(), 32)).alias("seen"), F.sum(value).alias("plain")]
    return F.get(mapped(F.array(F.struct(*gathered)), FINISH), F.lit(0))
