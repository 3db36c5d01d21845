"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams that any match must contain. Every slice of
documents gets an inverted index of the trigrams that some rule asks for; a rule's query is answered by
intersecting and uniting postings, and only the documents it leaves are searched with the expression itself. Rules
without mandatory trigrams (`hex`) search all documents. The index is local to a slice: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from re import _constants as rc
from re import _parser

import numpy as np
from pyspark.sql import DataFrame

from .textmap import map_texts

# The rules, in the order in which kinds are listed; and what a match must have to count.
BASE_RULES = {
    "assign": (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]{24,}", lambda m: True),  # maximal runs of 24 and more: shorter runs can't match
}
MORE_RULES = {
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", lambda m: True),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", lambda m: True),
    "google": (r"AIza[0-9A-Za-z_-]{35,}", lambda m: True),
    "stripe": (r"[sr]k_live_[0-9A-Za-z]{16,}", lambda m: True),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", lambda m: True),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", lambda m: True),
    "login": (r"(?a)://[^\s:/@]{1,64}:[^\s:/@]{1,64}@", lambda m: True),
}
MAX_STRINGS = 32  # alternatives that are multiplied out before a query settles for what it has

# A query is True (no condition), a trigram, or ("and" | "or", frozenset of queries).


def _join(kind: str, parts: list) -> object:
    parts = set(parts)
    if kind == "and":
        parts.discard(True)
        return (kind, frozenset(parts)) if len(parts) > 1 else next(iter(parts), True)
    return True if True in parts or not parts else (kind, frozenset(parts)) if len(parts) > 1 else next(iter(parts))


def _needs(strings: set[str]) -> object:
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _literals(item: tuple) -> set[str] | None:
    """The strings that a simple item matches, if they are few."""
    op, arg = item
    if op is rc.LITERAL:
        return {chr(arg).lower()}
    if op is rc.IN and all(k in (rc.LITERAL, rc.RANGE) for k, _ in arg):
        chars = {chr(c).lower() for k, v in arg for c in ([v] if k is rc.LITERAL else range(v[0], v[1] + 1))}
        return chars if len(chars) <= 6 else None
    return None


def trigram_query(pattern: str) -> object:
    """What every match of `pattern` contains, over ASCII-lower-cased trigrams."""

    def walk(items) -> tuple[set[str] | None, object]:
        """All strings matched (None: too many), and the query."""
        exact: set[str] | None = {""}
        run, needs = {""}, []
        for op, arg in items:
            query: object = True
            if op is rc.SUBPATTERN:
                some, query = walk(arg[3])
            elif op is rc.BRANCH:
                both = [walk(x) for x in arg[1]]
                some = set().union(*(s for s, _ in both)) if all(s is not None for s, _ in both) else None
                query = _join("or", [q for _, q in both])
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
                low, high, inner = arg
                some, query = walk(inner)
                if (low, high) == (0, 1) and some is not None:
                    some, query = some | {""}, True
                elif low != high or low > 1 or some is None:
                    some, query = None, query if low else True
            else:
                some = _literals((op, arg))
            if some is not None and len(run) * len(some) <= MAX_STRINGS:
                run = {a + b for a in run for b in some}
                exact = None if exact is None else {a + b for a in exact for b in some}
                continue
            needs += [_needs(run), query]
            run, exact = (some or {""}), None
        needs.append(_needs(run))
        return exact, _join("and", needs)

    return walk(_parser.parse(pattern))[1]


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class Index:
    """Postings of the wanted trigrams over a list of texts."""

    def __init__(self, texts: list[str], table: np.ndarray, names: list[str]) -> None:
        lowered = [t.encode("utf-8", "replace").lower() for t in texts]
        data = np.frombuffer(b"".join(lowered), np.uint8)
        ends = np.cumsum([len(x) for x in lowered])
        self.all, self.lists = set(range(len(texts))), {}
        if len(data) < 3:
            return
        ids = np.zeros(len(data) - 2, np.uint8)
        for a in range(0, len(ids), 1 << 20):
            part = data[a : a + (1 << 20) + 2].astype(np.int32)
            ids[a : a + (1 << 20)] = table[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
        at = np.flatnonzero(ids)
        doc = np.searchsorted(ends, at, "right")
        inside = at + 2 < ends[doc]  # not across two texts
        pairs = np.unique(ids[at[inside]].astype(np.int64) << 32 | doc[inside])
        for k, d in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True):
            self.lists.setdefault(names[k - 1], set()).add(d)

    def find(self, query: object) -> set[int]:
        if query is True:
            return self.all
        if isinstance(query, str):
            return self.lists.get(query, set())
        parts = sorted((self.find(q) for q in query[1]), key=len)
        return set.intersection(*parts) if query[0] == "and" else set.union(*parts)


def scan(docs: DataFrame, base: dict = BASE_RULES, more: dict = MORE_RULES, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns with `kinds`, `starts`, `ends` (one entry a span, by start, then kind as listed) and n_base.

    Offsets are code points, end exclusive. Matches are leftmost and non-overlapping within a kind; those that fail
    the rule's condition are dropped. Null and empty texts have no spans; texts of any length are searched whole; repeated
    rows are each searched alike; an empty table gives no rows. Columns named like a result are replaced.
    """
    rules = {**base, **more}

    def start() -> Callable:
        compiled = {k: (re.compile(p), ok, trigram_query(p)) for k, (p, ok) in rules.items()}
        names = sorted(set().union(*(trigrams_of(q) for _, _, q in compiled.values())))
        if len(names) > 254:
            raise ValueError("more than 254 trigrams; pass fewer rules at once")
        table = np.zeros(1 << 24, np.uint8)
        for k, g in enumerate(names):
            b = g.encode()
            if len(b) == 3:
                table[b[0] << 16 | b[1] << 8 | b[2]] = k + 1

        def step(texts: list[str | None]) -> dict:
            whole = [t or "" for t in texts]
            index = Index(whole, table, names)
            spans: list[list] = [[] for _ in whole]
            for order, (_, (expression, ok, query)) in enumerate(compiled.items()):
                for i in index.find(query):
                    spans[i] += [(m.start(), order, m.end()) for m in expression.finditer(whole[i]) if ok(m)]
            listed = list(compiled)
            for s in spans:
                s.sort()
            return {
                "kinds": [[listed[o] for _, o, _ in s] for s in spans],
                "starts": [[a for a, _, _ in s] for s in spans],
                "ends": [[e for _, _, e in s] for s in spans],
            }

        return step

    return map_texts(docs, start, "kinds array<string>, starts array<int>, ends array<int>", text_col, keep)


def digest(scanned: DataFrame, id_col: str = "doc_id", base: dict = BASE_RULES) -> DataFrame:
    """Counts of the base kinds and the joined spans."""
    from pyspark.sql import functions as F

    joined = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"]))
    listed = scanned.withColumn("all", joined)
    of_base = F.filter("all", lambda s: F.substring_index(s, ":", 1).isin(*base))
    counts = [(F.size("kinds") - F.size(F.array_remove("kinds", n))).cast("long").alias(f"n_{n}") for n in base]
    return listed.select(id_col, *counts, F.sha2(F.concat_ws(",", of_base), 256).alias("base_sha256"), F.concat_ws(",", "all").alias("spans"))


def brute_force(text: str | None) -> list[tuple[int, int, str]]:
    """Every rule over the whole text, for tests."""
    found = []
    for order, (name, (pattern, ok)) in enumerate({**BASE_RULES, **MORE_RULES}.items()):
        found += [(m.start(), order, name, m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return [(a, e, n) for a, _, n, e in sorted(found)]


__all__ = ["BASE_RULES", "MORE_RULES", "Index", "brute_force", "digest", "scan", "trigram_query", "trigrams_of"]
