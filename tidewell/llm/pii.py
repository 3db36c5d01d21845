"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select. DataFrame functions only.

Four base rules (email, ip, card, phone) are exact and their spans always stay. More generators propose spans that the rules
miss: cards side by side, phones without a country code, addresses with a written-out at. All proposals get features of format
and context in small whole numbers. What lies in a base span of its kind is a right proposal, what has a rule's form but
fails its check (parts, checksum, digits) is a wrong one, and of the others nothing is known: so the trees learn the
rules' formats and contexts, and find them where the rules can't match.
Proposals with equal features are counted over the whole table; the trees grow on these counts, one aggregation a
level for all nodes, features and bins. Thresholds for each kind come from feature combinations held out.

Everything happens within a document's row, so nothing is shuffled but the counts. Regular expressions use possessive
repeats, which Java runs in a loop: texts of any length are safe.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_AT, _DOT = r"\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?", r"(?:\.|\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?)"

# kind, whether it is the kind's base rule, what a text must contain (None: anything), pattern. The base patterns match what the
# greedy rules match, but start only where these can: a shorter start meets the same end. Card: runs of 14 digits and more.
GENERATORS = (
    (0, True, "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"),
    (1, True, None, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    (2, True, None, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+"),
    (3, True, "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    (0, False, None, rf"(?<!{_LOCAL}){_LOCAL}++{_AT}{_HOST}++(?:{_DOT}{_HOST}++)++"),
    (2, False, None, r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])"),
    (3, False, None, r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
GATES = {4: r"[\[({]\x20?(?:at|AT|@)"}
HINTS = r"(?i)(?:mail|contact|write to|tel|phone|fax|call|mobile|card|visa|iban|account|\bip|host|server|address)\W*\z"
DOUBTS = r"(?i)(?:token|secret|key|hash|isbn|issn|order|invoice|serial|version|release|build|page|section|\bid|\bno|\bnr)\W*\z"
CONTEXT = 24  # characters of the text before that give context

TREES, DEPTH, RATE, RIDGE = 8, 3, 0.5, 1.0
PRECISION, LEAST, UNTRIED = 0.9, 0.5, 0.9  # thresholds: share of right proposals, lowest score, score without held-out rows
FEATURES = ("kind", "digits", "checksum", "parts", "letter_before", "letter_after", "groups", "longest", "different", "ending", "hint", "sign_before")


@dataclass
class Model:
    """Trees as nested (feature, bin, low, high) or leaf numbers; a threshold for each kind (above 1: nothing)."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, zero: Column, join: Callable[[Column, Column], Column], size: int = 64) -> Column:
    """For each entry all entries before it joined, by way of blocks, so that long arrays stay cheap."""

    def scan(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda b: F.aggregate(F.slice(v, b * size + 1, size), zero, join))
        ahead = _let(blocks, lambda bs: F.transform(bs, lambda _, b: F.aggregate(F.slice(bs, 1, b), zero, join)))

        def at(a: Column) -> Column:
            return F.transform(v, lambda _, i: join(F.get(a, F.floor(i / size).cast("int")), F.aggregate(F.slice(v, i - i % size + 1, i % size), zero, join)))

        return _let(ahead, at)

    return F.when(F.size(values) > 0, _let(values, scan)).otherwise(F.transform(values, lambda _: zero))


def _luhn(digits: Column) -> Column:
    def term(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), term) % 10 == 0


def _bins(c: Column) -> Column:
    """A proposal's features as small whole numbers, in the order of FEATURES."""
    n = F.length(c["digits"])
    groups = F.regexp_extract_all(c["text"], F.lit("[0-9]++"), F.lit(0))
    before, after = F.right(c["left"], F.lit(1)), F.substring(c["right"], 1, 1)
    ending = F.regexp_extract(c["text"], r"([A-Za-z]{2,24})\z", 1)
    most = lambda x, top: F.least(x, F.lit(top)).cast("int")
    return F.array(
        c["kind"], most(n, 20),
        F.when((c["kind"] == 2) & n.between(13, 19), F.when(_luhn(c["digits"]), 1).otherwise(0)).otherwise(2),
        F.when(c["kind"] == 1, F.when(c["ok"], 1).otherwise(0)).otherwise(2),
        before.rlike(r"[\p{L}0-9_]").cast("int"), after.rlike(r"[\p{L}0-9_]").cast("int"),
        most(F.size(groups), 8), most(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), 20),
        most(F.size(F.array_distinct(F.split(c["digits"], ""))), 10), F.when(c["kind"] == 0, most(F.length(ending), 20)).otherwise(0),
        F.when(c["left"].rlike(HINTS), 2).when(c["left"].rlike(DOUBTS), 1).otherwise(0), F.when(before.rlike(r"[=:\"'/#]"), 1).otherwise(0),
    )


def _pieces(kind: int, is_rule: bool, gaps: Column, offset: Column) -> Callable[[Column, Column], Column]:
    """A match with the texts between it and its neighbours; `offset` is what the pieces of other generators add up to."""
    return lambda text, i: F.struct(F.lit(kind).alias("kind"), F.lit(is_rule).alias("rule"), offset.alias("offset"), text.alias("text"), F.get(gaps, i).alias("gap"), F.get(gaps, i + 1).alias("next"))


def _placed(piece: Column, ahead: Column) -> Column:
    start = ahead - piece["offset"] + F.length(piece["gap"])
    return F.struct(
        piece["kind"].alias("kind"), start.alias("start"), (start + F.length(piece["text"])).alias("end"), piece["rule"].alias("rule"), piece["text"].alias("text"),
        F.right(piece["gap"], F.lit(CONTEXT)).alias("left"), F.substring(piece["next"], 1, 8).alias("right"), F.regexp_replace(piece["text"], "[^0-9]", "").alias("digits"),
    )


def _checked(c: Column) -> Column:
    """With `ok`: whether it is a base span."""
    n = F.length(c["digits"])
    passes = F.when(c["kind"] == 0, True).when(c["kind"] == 1, c["text"].rlike(rf"\A{_PART}\.{_PART}\.{_PART}\.{_PART}\z")).when(c["kind"] == 2, F.when(n.between(14, 19), _luhn(c["digits"])).otherwise(False)).otherwise(n.between(10, 15))
    names = ("kind", "start", "end", "rule", "text", "left", "right", "digits")
    return F.struct(*[c[x].alias(x) for x in names], (c["rule"] & passes).alias("ok"))


def _proposals(docs: DataFrame, text_col: str) -> DataFrame:
    """`docs` with `__all`: every proposal with its kind, start and end in code points, features, whether it is a base span
    (`ok`), and its label: 1 in a base span of its kind, 0 if it has a rule's form but fails its check, else null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found, gaps, pieces, offset = {}, {}, [], F.lit(0)
    none = F.array().cast("array<string>")
    for i, (kind, is_rule, part, pattern) in enumerate(GENERATORS):
        gate = text.contains(part) if part else text.rlike(GATES[i]) if i in GATES else F.lit(True)
        f, g = F.col(f"__f{i}"), F.col(f"__g{i}")
        found[f"__f{i}"] = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        gaps[f"__g{i}"] = F.when(F.size(f) > 0, F.split(text, pattern, -1)).otherwise(none)
        pieces.append(F.transform(f, _pieces(kind, is_rule, g, offset)))
        offset = offset + F.when(F.size(f) > 0, F.length(text) - F.length(F.get(g, F.size(f)))).otherwise(0)
    work = docs.withColumns(found).withColumns(gaps).withColumn("__pieces", F.concat(*pieces)).drop(*found, *gaps)
    ahead = _before(F.transform("__pieces", lambda p: F.length(p["gap"]) + F.length(p["text"])), F.lit(0), lambda a, b: a + b)
    work = work.withColumn("__placed", F.zip_with("__pieces", ahead, _placed)).drop("__pieces")
    # a run of more digits than any card or phone has is its own proof
    work = work.withColumn("__checked", F.filter(F.transform("__placed", _checked), lambda c: c["ok"] | (c["kind"] < 2) | (F.length(c["digits"]) <= 19))).drop("__placed")
    sort = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["end"]).alias("minus"), (~c["ok"]).alias("no"), c["rule"].alias("rule"), _bins(c).alias("f"))
    work = work.withColumn("__ranked", F.array_sort(F.transform("__checked", sort))).drop("__checked")
    far = lambda c, end: c["kind"].cast("long") * (1 << 32) + end  # noqa: E731  kinds come one after another, so none reaches into the next
    reach = _before(F.transform("__ranked", lambda c: F.when(c["no"], F.lit(0).cast("long")).otherwise(far(c, -c["minus"]))), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))
    named = lambda c, e: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["minus"]).alias("end"), (~c["no"]).alias("ok"), F.when(~c["no"] | (e >= far(c, -c["minus"])), 1).when(c["rule"], 0).alias("label"), c["f"].alias("f"))
    return work.withColumn("__all", F.zip_with("__ranked", reach, named)).drop("__ranked")


# ---- trees ------------------------------------------------------------------------------------------------------


def tree_value(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, cut, low, high = tree
    return F.when(F.get(f, F.lit(feature)) <= cut, tree_value(low, f)).otherwise(tree_value(high, f))


def score(model: Model, f: Column) -> Column:
    total = F.lit(model.base)
    for tree in model.trees:
        total = total + tree_value(tree, f)
    return 1.0 / (1.0 + F.exp(-total))


def _node(splits: dict[int, tuple[int, int] | None], f: Column, depth: int) -> Column:
    """Number of the node at `depth` that a row falls into; -1 where the tree has ended."""
    node = F.lit(1)
    for level in range(depth):
        chain = F.lit(-1)
        for k in range(1 << level, 2 << level):
            if splits.get(k):
                feature, cut = splits[k]
                chain = F.when(node == k, 2 * k + F.when(F.get(f, F.lit(feature)) <= cut, 0).otherwise(1)).otherwise(chain)
        node = chain
    return node


def _best(rows: list, total_g: float, total_h: float) -> tuple[float, int, int] | None:
    """The split with the greatest gain over histograms of one node: (gain, feature, bin)."""
    part = lambda g, h: g * g / (h + RIDGE)
    out = None
    for feature in sorted({r.feature for r in rows}):
        g = h = 0.0
        mine = sorted((r.bin, r.g, r.h) for r in rows if r.feature == feature)
        for cut, dg, dh in mine[:-1]:
            g, h = g + dg, h + dh
            gain = part(g, h) + part(total_g - g, total_h - h) - part(total_g, total_h)
            if gain > 1e-3 and (out is None or gain > out[0] + 1e-9):
                out = (gain, feature, cut)
    return out


def _grow(rows: DataFrame, model: Model) -> tuple | float:
    """One tree. `rows` has the features f, the share of right proposals y and a weight w."""
    p = score(model, F.col("f"))
    sized = rows.select("f", (F.col("w") * (p - F.col("y"))).alias("g"), (F.col("w") * p * (1 - p)).alias("h"))
    splits: dict[int, tuple[int, int] | None] = {}
    leaves: dict[int, float] = {}
    for depth in range(DEPTH + 1):
        at = sized.withColumn("node", _node(splits, F.col("f"), depth)).filter("node > 0")
        bins = at.select("node", "g", "h", F.posexplode("f").alias("feature", "bin"))
        if depth == DEPTH:
            bins = bins.filter("feature = 0")
        found = bins.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        for k in {r.node for r in found}:
            mine = [r for r in found if r.node == k]
            g, h = (math.fsum(getattr(r, x) for r in mine if r.feature == 0) for x in ("g", "h"))
            best = _best(mine, g, h) if depth < DEPTH else None
            splits[k] = best[1:] if best else None
            leaves[k] = -RATE * g / (h + RIDGE)
        if not any(splits.get(k) for k in range(1 << depth, 2 << depth)):
            break

    def built(k: int):
        return (*splits[k], built(2 * k), built(2 * k + 1)) if splits.get(k) else leaves.get(k, 0.0)

    return built(1)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds from all labelled proposals of `docs`, counted by their features. Without right proposals the model
    selects nothing. All combinations are learned from; each weighs by the logarithm of its count, so copies of one text
    don't rule."""
    each = _proposals(docs.select(F.col(f"`{text_col}`").alias("text")), "text").select(F.explode_outer("__all").alias("c")).filter("c.label is not null").select("c.f", F.col("c.label").alias("y"))  # outer: no filter on the whole expression is pushed down
    counted = each.groupBy("f").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n"))
    rows = stored(counted.select("f", (F.col("good") / F.col("n")).alias("y"), (1 + F.log("n")).alias("w"), (F.pmod(F.xxhash64("f"), F.lit(4)) == 0).alias("held")), "features")
    sums = rows.filter("not held").agg(F.coalesce(F.sum(F.col("w") * F.col("y")), F.lit(0.0)).alias("good"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("n")).first()
    if not sums.good:
        return Model()
    model = Model(base=math.log((sums.good + 0.5) / (sums.n - sums.good + 0.5)))
    for _ in range(TREES):
        tree = _grow(rows.filter("not held"), model)
        if isinstance(tree, float):
            break
        model.trees.append(tree)
    tried = rows.filter("held").groupBy(F.col("f")[0].alias("kind"), F.floor(score(model, F.col("f")) * 1000).alias("s")).agg(F.sum(F.col("w") * F.col("y")).alias("good"), F.sum("w").alias("n")).collect()
    thresholds = []
    for kind in range(len(KINDS)):
        good = n = 0.0
        best, mine = UNTRIED, sorted(((r.s / 1000, r.good, r.n) for r in tried if r.kind == kind and r.s >= 1000 * LEAST), reverse=True)
        for i, (s, more, many) in enumerate(mine):
            good, n = good + more, n + many
            if good >= PRECISION * n:
                best = s if i + 1 < len(mine) else LEAST
        thresholds.append(best)
    model.thresholds = tuple(thresholds)
    return model


def find(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns with kinds, starts, ends and base (whether a base rule found it): all spans by start, then kind.

    Offsets are code points, end exclusive. Base spans always stay. Other proposals stay if their score reaches their
    kind's threshold and no span that stays covers them. Null and empty texts have no spans; whole texts are searched;
    repeated rows are each searched alike; an empty table gives no rows; columns named like a result are replaced, as are
    helpers whose names begin with two underscores.
    """
    results = ("kinds", "starts", "ends", "base")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row") if keep else F.lit(0).alias("__row"), F.col(f"`{text_col}`").alias("__text"))
    proposed = _proposals(source, "__text")
    limit = F.array(*map(F.lit, model.thresholds))
    chosen = F.filter("__all", lambda c: c["ok"] | (score(model, c["f"]) >= F.get(limit, c["kind"])))
    order = F.array_sort(F.transform("__chosen", lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("minus"), (~c["ok"]).alias("no"), c["kind"].alias("kind"))))
    reach = _before(F.transform("__sorted", lambda c: -c["minus"]), F.lit(0), lambda a, b: F.greatest(a, b))
    left = F.filter(F.zip_with("__sorted", "__reach", lambda c, e: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), (-c["minus"]).alias("end"), (~c["no"]).alias("ok"), (c["no"] & (e >= -c["minus"])).alias("gone"))), lambda c: ~c["gone"])
    done = proposed.withColumn("__chosen", chosen).withColumn("__sorted", order).withColumn("__reach", reach).withColumn("__left", F.array_sort(left))
    named = F.array(*map(F.lit, KINDS))
    columns = {"kinds": lambda c: F.get(named, c["kind"]), "starts": lambda c: c["start"], "ends": lambda c: c["end"], "base": lambda c: c["ok"]}
    return done.select(*[F.col(f"__row.`{c}`").alias(c) for c in keep], *[F.transform("__left", f).alias(n) for n, f in columns.items()])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, their hash, and all spans joined."""
    each = F.transform(F.arrays_zip("kinds", "starts", "ends", "base"), lambda s: F.struct(s["kinds"].alias("kind"), s["base"].alias("base"), F.concat_ws(":", s["kinds"], s["starts"], s["ends"]).alias("t")))
    rows = found.withColumn("__each", each)
    is_base = lambda kind: lambda s: s["base"] & (s["kind"] == kind)
    counts = [F.size(F.filter("__each", is_base(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    joined = lambda a: F.array_join(F.transform(a, lambda s: s["t"]), ",")
    return rows.select(F.col(f"`{id_col}`"), *counts, F.sha2(joined(F.filter("__each", lambda s: s["base"])), 256).alias("base_sha256"), joined(F.col("__each")).alias("spans"))
