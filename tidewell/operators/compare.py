"""Comparison of two tables: schema, counts, NULLs, aggregates and rows, with a strict verdict.

All counts and tests run in Spark over all rows: one aggregation over each table, and one over the joined pairs (or
the surplus rows) that finds, for every column, the number of differing values and which explanations hold for all
of them. Only these few numbers and a bounded number of example rows reach the driver. Keyless tables are compared
as multisets; surplus rows are then paired by their nearest match.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import NUMBER, family, is_number
from ..sources.tables import checkpoint_dir
from .pairing import nearest_pairs
from .summarize import exact_sum

# Classes of differences in the order in which they are listed; those that no approval covers.
CLASSES = ("GOLDEN_DATA", "ORDERING", "NULL_SEMANTICS", "ROUNDING", "TRUNCATION", "TYPE", "LOGIC", "UNKNOWN")
NEVER_APPROVED = {"GOLDEN_DATA", "UNKNOWN"}
NORMALIZATIONS = {"trim": F.trim, "upper": F.upper}


@dataclass(frozen=True)
class Tolerance:
    """Floats differ if by more than absolute + relative * the larger size; exact numbers if by more than `number`;
    time stamps are cut to `timestamps` (second, millisecond, microsecond). A difference of up to `rounding` is one
    of rounding."""

    absolute: float = 1e-6
    relative: float = 1e-9
    number: float = 0.0
    timestamps: str = "millisecond"
    rounding: float = 0.01


@dataclass(frozen=True)
class Contract:
    """What is promised about a table: keys, columns that are never NULL, columns whose values may come in another
    order, normalizations like `trim:NAME`, and optionally its columns with their families."""

    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    any_order: tuple[str, ...] = ()
    normalizations: tuple[str, ...] = ()
    columns: tuple[tuple[str, str], ...] = ()


@dataclass
class Cluster:
    """Differences with one explanation. scope: schema, rows, columns, or synthetic (a failed check nothing explains)."""

    kind: str
    columns: tuple[str, ...]
    count: int
    scope: str
    sides: tuple[str, ...] = ()
    hint: str | None = None
    note: str | None = None
    suspect: str | None = None
    examples: list[dict] = field(default_factory=list)


@dataclass
class Report:
    verdict: str
    checks: dict
    clusters: list[Cluster]
    advice: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# ---- values -----------------------------------------------------------------------------------------------------


def _apart(a: Column, b: Column) -> Column:
    """How far two numbers are apart: on decimals, or on doubles where these are too large for that."""
    x, y = a.try_cast("decimal(28,10)"), b.try_cast("decimal(28,10)")
    return F.coalesce(F.abs(x - y).cast("double"), F.abs(a.cast("double") - b.cast("double")))


def differ(a: Column, b: Column, kind: T.DataType, tolerance: Tolerance) -> Column:
    """Whether two values of a column differ; NULL equals NULL only, NaN equals NaN."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        room = F.lit(tolerance.absolute) + F.lit(tolerance.relative) * F.greatest(F.abs(a), F.abs(b))
        near = (a == b) | ((F.abs(a - b) <= room) & (room < float("inf")))
    elif is_number(kind):
        near = a == b if not tolerance.number else _apart(a, b) <= F.lit(tolerance.number)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        near = F.date_trunc(tolerance.timestamps, a) == F.date_trunc(tolerance.timestamps, b)
    else:
        near = a == b
    return F.when(a.isNull() | b.isNull(), a.isNull() != b.isNull()).otherwise(~near)


def _explanations(a: Column, b: Column, kind: T.DataType, tolerance: Tolerance) -> dict[str, Column]:
    """For two differing values, whether each explanation holds."""
    both = a.isNotNull() & b.isNotNull()
    out = {"NULL_SEMANTICS": a.isNull() != b.isNull()}
    if is_number(kind):
        out["ROUNDING"] = both & (_apart(a, b) <= F.lit(str(tolerance.rounding)).cast("decimal(18,10)"))
    if isinstance(kind, T.StringType):
        short, long = F.when(F.length(a) < F.length(b), a).otherwise(b), F.when(F.length(a) < F.length(b), b).otherwise(a)
        rest = F.substring(long, F.length(short) + 1, F.length(long))
        out["TRUNCATION"] = both & (F.length(a) != F.length(b)) & long.startswith(short) & (F.regexp_replace(rest, r"(?U)\s+", "") != "")
        number = lambda x: F.when(x.rlike(NUMBER), x.try_cast("decimal(38,10)"))
        day = lambda x: F.to_timestamp_ntz(F.when(x.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(x, F.lit(" 00:00:00"))).when(x.rlike(r"^\d{4}-\d\d-\d\d[ T]00:00(:00(\.0+)?)?$"), F.concat(F.substring(x, 1, 10), F.lit(" 00:00:00"))), F.lit("yyyy-MM-dd HH:mm:ss"))
        same_day = (F.length(a) == 10) != (F.length(b) == 10)
        out["TYPE"] = both & (F.coalesce(number(a) == number(b), F.lit(False)) | (same_day & F.coalesce(day(a) == day(b), F.lit(False))))
        out["whitespace_only"] = both & (F.regexp_replace(a, r"(?U)\s+", "") == F.regexp_replace(b, r"(?U)\s+", ""))
        out["case_only"] = both & (F.lower(a) == F.lower(b))
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def _measures(name: str, kind: T.DataType, e: Column, a: Column, tolerance: Tolerance) -> Column:
    """Of one column over all pairs: differing values, explanations that hold for all of them, sums of both sides."""
    d = differ(e, a, kind, tolerance)
    parts = [F.count_if(d).alias("differ")]
    parts += [F.coalesce(F.bool_and(F.when(d, x)), F.lit(False)).alias(k) for k, x in _explanations(e, a, kind, tolerance).items()]
    if is_number(kind):
        for side, v in (("e", e), ("a", a)):
            x = F.when(F.abs(v) < float("inf"), v) if isinstance(kind, (T.DoubleType, T.FloatType)) else v  # `finite` nests deeper than generated code can
            parts += [exact_sum(x, kind).alias(f"sum_{side}"), F.sum(F.abs(x.cast("double"))).alias(f"size_{side}"), F.min(x).cast("double").alias(f"min_{side}"), F.max(x).cast("double").alias(f"max_{side}"), F.count(x).alias(f"n_{side}")]
    elif isinstance(kind, T.StringType):
        for side, v in (("e", e), ("a", a)):
            parts += [F.min(F.length(v)).alias(f"min_{side}"), F.max(F.length(v)).alias(f"max_{side}"), F.count(v).alias(f"n_{side}")]
    return F.struct(*parts).alias(name)


def _aggregates_differ(m: dict, kind: T.DataType, tolerance: Tolerance) -> list[str]:
    """The aggregates of a column that differ by more than the values' tolerances can add up to."""
    if "n_e" not in m:
        return []
    exact = not isinstance(kind, (T.DoubleType, T.FloatType))
    absolute, relative = (tolerance.number, 0.0) if exact else (tolerance.absolute, tolerance.relative)
    absolute, relative = (0.0, 0.0) if isinstance(kind, T.StringType) else (absolute, relative)
    out = []

    def far(x, y, room) -> bool:
        return (x is None) != (y is None) or x is not None and abs(x - y) > room

    for which in ("min", "max"):
        x, y = m[f"{which}_e"], m[f"{which}_a"]
        if far(x, y, absolute + relative * max(abs(x or 0), abs(y or 0))):
            out.append(which)
    if "sum_e" in m:
        n, size = max(m["n_e"], m["n_a"]), max(m["size_e"] or 0, m["size_a"] or 0)
        room = n * absolute + (relative + 1e-15) * size
        if far(m["sum_e"], m["sum_a"], room):
            out += ["sum"]
        if m["n_e"] and m["n_a"] and abs(m["sum_e"] / m["n_e"] - m["sum_a"] / m["n_a"]) > room / n:
            out += ["avg"]
    return out


def _kind_of(m: dict, kind: T.DataType) -> tuple[str, str | None]:
    """The first class that explains all differences of a column, and a hint."""
    for name in ("NULL_SEMANTICS", "ROUNDING", "TRUNCATION", "TYPE"):
        if m.get(name):
            return name, None
    return "LOGIC", next((h for h in ("whitespace_only", "case_only") if m.get(h)), None)


# ---- the comparison ---------------------------------------------------------------------------------------------


def _prepared(df: DataFrame, contract: Contract) -> DataFrame:
    rules = {}
    for rule in contract.normalizations:
        how, _, column = rule.partition(":")
        rules.setdefault(column.upper(), []).append(NORMALIZATIONS[how])
    return df.select(*[reduce(lambda x, f: f(x), rules.get(c.upper(), []), _c(c)).alias(c.upper()) for c in df.columns])


def check_schema(expected: DataFrame, actual: DataFrame, contract: Contract) -> list[str]:
    """Names in upper case, their order, and type families."""
    def described(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name.upper(), family(f.dataType)) for f in df.schema]

    e, a = described(expected), described(actual)
    wanted = [(n.upper(), k) for n, k in contract.columns]
    out = []
    for label, x, y in (("expected", e, wanted), ("actual", a, wanted), ("tables", e, a)):
        if label != "tables" and not wanted:
            continue
        names_x, names_y = [n for n, _ in x], [n for n, _ in y]
        out += [f"{label}: {n} is missing" for n in names_y if n not in names_x] if label != "tables" else [f"actual lacks {n}" for n in names_x if n not in names_y]
        out += [f"{label}: {n} is not expected" for n in names_x if n not in names_y] if label != "tables" else [f"actual has {n} too" for n in names_y if n not in names_x]
        if sorted(names_x) == sorted(names_y) and names_x != names_y:
            out.append(f"{label}: other order of columns")
        types = dict(y)
        out += [f"{label}: {n} is {k}, not {types[n]}" for n, k in x if n in types and types[n] != k]
    return out


class _Comparison:
    def __init__(self, expected: DataFrame, actual: DataFrame, contract: Contract, tolerance: Tolerance, examples: int) -> None:
        self.contract, self.tolerance, self.examples = contract, tolerance, examples
        self.expected, self.actual = _prepared(expected, contract), _prepared(actual, contract)
        self.kinds = {f.name: f.dataType for f in self.expected.schema}
        self.keys = [k.upper() for k in contract.keys]
        self.checks: dict = {}
        self.clusters: list[Cluster] = []
        self.advice: list[str] = [f"normalized: {n}" for n in contract.normalizations]
        self.evidence: dict[str, set[str]] = {}
        self.keyless = not self.keys

    def _profile(self, df: DataFrame) -> dict:
        columns = [F.count(F.lit(1)).alias("rows")]
        columns += [F.count_if(_c(c).isNull()).alias(f"n{i}") for i, c in enumerate(self.kinds)]
        columns += [F.approx_count_distinct(_c(c)).alias(f"d{i}") for i, c in enumerate(self.kinds)]  # a detail, never a verdict: exact ones would multiply the table
        r = df.agg(*columns).first()
        return {"rows": r["rows"], "columns": {c: {"nulls": r[f"n{i}"], "distinct": r[f"d{i}"]} for i, c in enumerate(self.kinds)}}

    def run(self) -> None:
        e, a = self._profile(self.expected), self._profile(self.actual)
        self.profile = e
        self.checks["counts"] = {"expected": e["rows"], "actual": a["rows"], "verdict": "PASS" if e["rows"] == a["rows"] else "FAIL"}
        self.checks["column_counts"] = {c: (e["columns"][c], a["columns"][c]) for c in self.kinds}
        if self.keys:
            repeated = self.expected.groupBy(*map(_c, self.keys)).count().filter("count > 1")
            if not repeated.isEmpty():
                self.keyless = True
                self.checks["keys_not_unique"] = [r.asDict() for r in repeated.limit(self.examples).collect()]
                self.advice.append("the keys repeat in the expected table; compared without keys")
        self._nulls(e, a)
        (self._without_keys if self.keyless else self._by_key)()

    def _nulls(self, e: dict, a: dict) -> None:
        wrong = []
        for c in map(str.upper, self.contract.required):
            if e["columns"][c]["nulls"]:
                self.advice.append(f"{c} is NULL in {e['columns'][c]['nulls']} expected rows although it is required")
            elif a["columns"][c]["nulls"]:
                wrong.append(c)
                self.clusters.append(Cluster("NULL_SEMANTICS", (c,), a["columns"][c]["nulls"], "columns", note="NULL in a required column"))
        self.evidence["nullability"] = set(wrong)
        self.checks["nullability"] = "FAIL" if wrong else "PASS"

    def _by_key(self) -> None:
        keys = list(map(_c, self.keys))
        repeated = self.actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
        once = self.actual.alias("x").join(repeated.alias("y"), reduce(lambda p, q: p & q, (F.col(f"x.`{k}`").eqNullSafe(F.col(f"y.`{k}`")) for k in self.keys)), "left_anti")
        extra = repeated.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("keys")).first()
        if extra.n:
            self.clusters.append(Cluster("LOGIC", tuple(self.keys), extra.n, "rows", ("actual",), note=f"{extra['keys']} keys repeat in actual"))
        others = [c for c in self.kinds if c not in self.keys]
        renamed = once.select(*[_c(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], *[_c(c).alias(f"__a{i}") for i, c in enumerate(others)])
        on = reduce(lambda p, q: p & q, (_c(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)))
        pairs = self.expected.join(renamed, on)
        found = self._measured(pairs, {c: (_c(c), F.col(f"__a{i}")) for i, c in enumerate(others)})
        self._judge_columns(found, pairs, {c: f"__a{i}" for i, c in enumerate(others)})
        only = {}
        for side, mine, theirs in (("expected", self.expected, self.actual), ("actual", self.actual, self.expected)):
            alone = mine.alias("x").join(theirs.select(*keys).alias("y"), reduce(lambda p, q: p & q, (F.col(f"x.`{k}`").eqNullSafe(F.col(f"y.`{k}`")) for k in self.keys)), "left_anti")
            only[side] = self._alone(alone, side)
        self.checks["set_diff"] = {"only_expected": only["expected"], "only_actual": only["actual"], "repeated_actual": extra.n}

    def _alone(self, rows: DataFrame, side: str) -> int:
        """A cluster for rows on one side only, with the columns that are NULL in all of them but not everywhere."""
        filled = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(_c(c)).alias(f"c{i}") for i, c in enumerate(self.kinds)]).first()
        if filled.n:
            null = tuple(c for i, c in enumerate(self.kinds) if not filled[f"c{i}"] and self.profile["columns"][c]["nulls"] < self.profile["rows"])
            examples = [r.asDict() for r in rows.limit(self.examples).collect()]
            self.clusters.append(Cluster("NULL_SEMANTICS" if null else "LOGIC", null, filled.n, "rows", (side,), note=f"rows only in {side}", examples=examples))
        return filled.n

    def _measured(self, pairs: DataFrame, sides: dict[str, tuple[Column, Column]]) -> dict[str, dict]:
        if not sides:
            return {}
        row = pairs.agg(*[_measures(f"m{i}", self.kinds[c], e, a, self.tolerance) for i, (c, (e, a)) in enumerate(sides.items())]).first()
        return {c: row[f"m{i}"].asDict() for i, c in enumerate(sides)}

    def _judge_columns(self, found: dict[str, dict], pairs: DataFrame, other: dict[str, str]) -> None:
        differing = {c: m for c, m in found.items() if m["differ"]}
        self.checks["column_mismatches"] = {c: m["differ"] for c, m in differing.items()}
        self.evidence["column_mismatches"] = set(differing)
        off = {c: bad for c, m in found.items() if (bad := _aggregates_differ(m, self.kinds[c], self.tolerance))}
        self.checks["aggregates"] = "FAIL" if off else "PASS"
        self.checks["aggregate_mismatches"] = off
        self.evidence["aggregates"] = set(off)
        any_order = {c.upper() for c in self.contract.any_order}
        ordering = bool(differing) and set(differing) <= any_order and all(self._same_bag(c) for c in differing)
        groups: dict[tuple, list[str]] = {}
        for c, m in differing.items():
            kind, hint = ("ORDERING", None) if ordering else _kind_of(m, self.kinds[c])
            groups.setdefault((kind, hint), []).append(c)
        for (kind, hint), columns in groups.items():
            count = max(differing[c]["differ"] for c in columns)
            wrong = reduce(lambda p, q: p | q, (differ(_c(c), F.col(other[c]), self.kinds[c], self.tolerance) for c in columns))
            rows = pairs.filter(wrong).select(*map(_c, self.keys), *[x for c in columns for x in (_c(c).alias(f"expected {c}"), F.col(other[c]).alias(f"actual {c}"))])
            self.clusters.append(Cluster(kind, tuple(sorted(columns)), count, "columns", hint=hint, examples=[r.asDict() for r in rows.limit(self.examples).collect()]))

    def _same_bag(self, column: str) -> bool:
        return surplus(self.expected.select(_c(column)), self.actual.select(_c(column))).isEmpty()

    def _without_keys(self) -> None:
        rest = surplus(self.expected, self.actual)
        n = rest.agg(*[F.coalesce(F.sum(F.when(F.col("__surplus") * s > 0, F.abs("__surplus"))), F.lit(0)).alias(k) for k, s in (("e", 1), ("a", -1))]).first()
        self.checks["set_diff"] = {"only_expected": n.e, "only_actual": n.a}
        self._whole_aggregates()
        paired = (0, 0)
        if n.e and n.a and len(self.kinds) > 1:
            paired = self._pair(rest)
        for side, sign, count, done in (("expected", 1, n.e, paired[0]), ("actual", -1, n.a, paired[1])):
            if count > done:
                examples = [r.asDict() for r in rest.filter(F.col("__surplus") * sign > 0).limit(self.examples).collect()]
                self.clusters.append(Cluster("LOGIC", (), count - done, "rows", (side,), note=f"rows only in {side}", examples=examples))

    def _whole_aggregates(self) -> None:
        def one(df: DataFrame) -> dict:
            parts = [_measures(f"m{i}", k, _c(c), _c(c), self.tolerance) for i, (c, k) in enumerate(self.kinds.items())]
            row = df.agg(*parts).first()
            return {c: row[f"m{i}"].asDict() for i, c in enumerate(self.kinds)}

        e, a = one(self.expected), one(self.actual)
        off = {}
        for c, k in self.kinds.items():
            both = {key: (a[c][key] if key.endswith("_a") else v) for key, v in e[c].items()}
            if bad := _aggregates_differ(both, k, self.tolerance):
                off[c] = bad
        self.checks["aggregates"] = "FAIL" if off else "PASS"
        self.checks["aggregate_mismatches"] = off
        self.evidence["aggregates"] = set(off)

    def _pair(self, rest: DataFrame) -> tuple[int, int]:
        """Pairs surplus rows by the fewest differing columns, if at least half agree; how many, on either side."""
        names = list(self.kinds)
        checkpoint_dir(rest.sparkSession)
        each = rest.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("__surplus"))))
        numbered = each.select(F.monotonically_increasing_id().alias("__id"), F.col("__surplus") > 0, *map(_c, names)).toDF("__id", "__mine", *names).checkpoint()
        mine = numbered.filter("__mine").drop("__mine").withColumnRenamed("__id", "__e")
        theirs = numbered.filter("not __mine").drop("__mine").withColumnRenamed("__id", "__a")
        pairs = nearest_pairs(mine, theirs, names, self.kinds, self.tolerance, differ, lambda df: df.checkpoint())
        n = pairs.count()
        if n:
            renamed = theirs.select("__a", *[_c(c).alias(f"__a{i}") for i, c in enumerate(names)])
            both = mine.join(pairs, "__e").join(renamed, "__a")
            checks = {k: self.checks[k] for k in ("aggregates", "aggregate_mismatches")}
            evidence = self.evidence["aggregates"]
            self.keys, keys = [], self.keys
            before = len(self.clusters)
            self._judge_columns(self._measured(both, {c: (_c(c), F.col(f"__a{i}")) for i, c in enumerate(names)}), both, {c: f"__a{i}" for i, c in enumerate(names)})
            self.keys = keys
            self.checks |= checks
            self.evidence["aggregates"] = evidence
            for cluster in self.clusters[before:]:
                cluster.note, cluster.sides = "rows paired by nearest match", ("expected", "actual")
            within = n if len(self.clusters) == before else 0
            if within:  # all pairs agree within the tolerances
                self.checks["set_diff"] = {k: v - within for k, v in self.checks["set_diff"].items()}
        return n, n


def surplus(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Different rows with how many more the expected (positive) or the actual table (negative) has of each."""
    both = expected.withColumn("__surplus", F.lit(1).cast("long")).unionByName(actual.withColumn("__surplus", F.lit(-1).cast("long")))
    return both.groupBy(*map(_c, expected.columns)).agg(F.sum("__surplus").alias("__surplus")).filter("__surplus != 0")


# ---- verdict ----------------------------------------------------------------------------------------------------


def _failed(name: str, value) -> bool:
    if name in ("nullability", "aggregates"):
        return value != "PASS"
    if name == "counts":
        return value["verdict"] != "PASS"
    if name == "set_diff":
        return bool(value["only_expected"] or value["only_actual"])
    return name in ("schema", "column_mismatches") and bool(value)


def _unexplained(c: _Comparison) -> list[str]:
    """Failed checks that no cluster answers for. Clusters about rows answer for row counts on their own side, and
    without keys for aggregates, as surplus rows move these; all else needs a cluster that names the columns."""
    sides = {s for x in c.clusters for s in x.sides}
    named = {n for x in c.clusters if x.scope == "columns" for n in x.columns}
    moved = c.keyless and any(x.scope == "rows" for x in c.clusters)
    out = []
    for name, value in c.checks.items():
        if not _failed(name, value):
            continue
        if name == "counts":
            ok = ("expected" if value["expected"] > value["actual"] else "actual") in sides
        elif name == "set_diff":
            ok = {s for s in ("expected", "actual") if value[f"only_{s}"]} <= sides
        else:
            columns = c.evidence.get(name, set())
            ok = bool(columns) and columns <= named or moved and name == "aggregates"
        if not ok:
            out.append(name)
    return out


def judge(clusters: list[Cluster], accepted: tuple[str, ...] = (), approvals: tuple[dict, ...] = (), name: str | None = None) -> str:
    """PASS without clusters; PASS_WITH_ACCEPTED_DIFF if each is about named columns, of an accepted class that can be
    approved, and approved for this table, class and all its columns; else FAIL."""
    def approved(c: Cluster) -> bool:
        if c.kind in NEVER_APPROVED or c.kind not in accepted or c.scope != "columns" or not c.columns:
            return False
        return any(a.get("table") == name and a.get("class") == c.kind and {x.upper() for x in c.columns} <= {x.upper() for x in a.get("columns", ())} for a in approvals)

    if not clusters:
        return "PASS"
    return "PASS_WITH_ACCEPTED_DIFF" if all(map(approved, clusters)) else "FAIL"


def compare_tables(
    expected: DataFrame,
    actual: DataFrame,
    contract: Contract = Contract(),  # noqa: B008
    tolerance: Tolerance = Tolerance(),  # noqa: B008
    accepted: tuple[str, ...] = (),
    approvals: tuple[dict, ...] = (),
    name: str | None = None,
    lineage: list[dict] | None = None,
    examples: int = 5,
) -> Report:
    """Compare two tables. `lineage` lists the steps that made the actual one, in order, each with `name`, `writes`
    (columns) and `moves_rows`; the last that can explain a cluster is its suspect."""
    wrong = check_schema(expected, actual, contract)
    if wrong:
        cluster = Cluster("TYPE", (), len(wrong), "schema", note="; ".join(wrong))
        return Report("FAIL", {"schema": wrong}, [cluster])
    c = _Comparison(expected, actual, contract, tolerance, examples)
    c.checks["schema"] = []
    c.run()
    for check in _unexplained(c):
        c.clusters.append(Cluster("UNKNOWN", tuple(sorted(c.evidence.get(check, ()))), 1, "synthetic", hint=f"{check} failed with no difference in rows"))
    for cluster in c.clusters:
        for step in reversed(lineage or []):
            if cluster.scope == "rows" and step.get("moves_rows") or cluster.scope == "columns" and {x.upper() for x in step.get("writes", ())} & set(cluster.columns):
                cluster.suspect = step["name"]
                break
    c.clusters.sort(key=lambda x: (CLASSES.index(x.kind), x.columns, x.note or ""))
    return Report(judge(c.clusters, accepted, approvals, name), c.checks, c.clusters, c.advice)


def mismatch_counts(expected: DataFrame, actual: DataFrame, keys: list[str], tolerance: Tolerance = Tolerance()) -> DataFrame:  # noqa: B008
    """For two tables with unique keys: a row for each other column, with its differing values, as a table."""
    others = [c for c in expected.columns if c not in keys]
    right = actual.select(*[_c(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[_c(c).alias(f"__a{i}") for i, c in enumerate(others)])
    pairs = expected.join(right, reduce(lambda p, q: p & q, (_c(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys))))
    counts = [F.struct(F.lit(c).alias("column_name"), F.count_if(differ(_c(c), F.col(f"__a{i}"), expected.schema[c].dataType, tolerance)).alias("mismatches")) for i, c in enumerate(others)]
    return pairs.agg(F.array(*counts).alias("x")).select(F.inline("x"))
