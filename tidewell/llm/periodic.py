"""Periodic runs of words, found by Kruskal's algorithm over suffix classes in descending order of their LCP.

Within each document, words that start a repeated stretch are sorted by what follows them (rank doubling). Neighbours
in this order are edges with the length of their common beginning (LCP). Edges are taken from the longest LCP down
and unite classes of suffixes with union-find; a class keeps its positions in order. When two classes meet at an LCP
of L, a position of one and its new neighbour of the other, d words apart, have just L words in common: with d <= L
they are a stretch of d + L words with smallest period d that can't grow to the right. If it can't grow to the left
either, it is a run, and each run is met once. The smaller class goes into the larger, so a position moves at most a
logarithmic number of times.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textmap import map_texts

WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH, MIN_EXPONENT = 6, 4


def _shifted(ids: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([ids[by:], np.zeros(min(by, len(ids)), np.int64)])


def _grams(ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """A number for the n words from each position on and their text, in lexicographic order of these."""
    key, top, base = text, int(text[-1]) + 1, int(ids.max()) + 1
    for j in range(n):
        if top * base >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        key, top = key * base + _shifted(ids, j), top * base
    return key


def split_words(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as one Arrow column, and the number of the text of each."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edges = np.diff(np.concatenate([[False], solid]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[solid].tobytes())])
    return words, np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, "right")


class _Suffixes:
    """The positions whose next `least` words occur again in their text: sorted by what follows, with LCPs."""

    def __init__(self, ids: np.ndarray, text: np.ndarray, least: int) -> None:
        gram = _grams(ids, text, least)
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        new = np.concatenate([[True], gram[1:] != gram[:-1]])
        group = np.flatnonzero(new)[np.cumsum(new) - 1]  # where each one's group begins in the order
        rank = np.empty(len(ids), np.int64)
        rank[order] = group
        slots = np.flatnonzero(np.bincount(group, minlength=len(ids))[group] > 1)
        place = np.full(len(ids), -1, np.int32)  # of a position among the repeated ones
        place[order[slots]] = np.arange(len(slots))
        here, levels, h, at = order[slots], [], least, slots
        while True:
            levels.append((h, rank[here].astype(np.int32)))
            if not len(at):
                break
            moving = order[at]
            keys = rank[moving] * len(ids) + rank[np.minimum(moving + h, len(ids) - 1)]  # their next h words are within the text
            by = np.argsort(keys, kind="stable")
            keys, order[at] = keys[by], moving[by]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            group = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
            rank[order[at]] = group
            at = at[np.bincount(group, minlength=len(ids))[group] > 1]
            h *= 2
        order = order[slots]
        a, b = order[:-1], order[1:]
        same = levels[0][1][place[a]] == levels[0][1][place[b]]
        self.order, self.edges = order, np.flatnonzero(same)
        a, b = a[same], b[same]
        lcp = np.zeros(len(a), np.int64)
        for h, r in reversed(levels):
            p, q = place[a + lcp], place[b + lcp]
            lcp += h * ((p >= 0) & (q >= 0) & (r[p] == r[q]))
        for _ in range(least - 1):
            lcp += ids[a + lcp] == ids[b + lcp]
        self.lcp = lcp


def _runs(ids: np.ndarray, text: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows of start, length and period over the numbered words of all texts, each followed by a separator of its own."""
    least = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    suffixes = _Suffixes(ids, text, least)
    order, fewer, seeds = suffixes.order.tolist(), min_exponent - 1, []
    above: list[int] = list(range(len(order)))
    members: list = [None] * len(order)  # of a root: its positions in order; None while it is alone
    by = np.argsort(-suffixes.lcp, kind="stable")
    for x, lcp in zip(suffixes.edges[by].tolist(), suffixes.lcp[by].tolist(), strict=True):
        y = x + 1
        while above[x] != x:
            above[x] = x = above[above[x]]
        while above[y] != y:
            above[y] = y = above[above[y]]
        small, large = members[x] or [order[x]], members[y] or [order[y]]
        if len(small) > len(large):
            x, y, small, large = y, x, large, small
        last, many = -1, len(small)
        for i, p in enumerate(small):
            j = bisect_left(large, p)
            if j and (p - large[j - 1]) * fewer <= lcp and large[j - 1] > last:
                seeds.append((large[j - 1], p, lcp))
            if j < len(large) and (large[j] - p) * fewer <= lcp and (i + 1 == many or large[j] < small[i + 1]):
                seeds.append((p, large[j], lcp))
            last = p
        if 8 * many < len(large) or many == 1:
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        above[x], members[x], members[y] = y, None, large
    left, right, lcp = np.array(seeds, np.int64).reshape(-1, 3).T
    fits = (right - left + lcp >= min_length) & (ids[left - 1] != ids[right - 1])
    return np.stack([left, right - left + lcp, right - left], 1)[fits]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns with n_words, the runs (starts, lengths, periods, by start and period) and the collapsed text.

    A run is a stretch of at least `min_length` words and `min_exponent` (2 or more) times its smallest period that no
    neighbouring word extends. The collapsed text joins by one space the words that no run has after its first period.
    Null, empty and blank texts have no words, no runs and an empty collapsed text. Texts are searched whole; memory in
    a task follows a slice of texts or the longest one (times the logarithm of its longest repeat). Repeated rows are
    each searched alike; an empty table gives no rows; columns named like a result are replaced. Nothing is shuffled.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least one word and two periods")

    def start() -> Callable:
        def step(texts: list[str | None]) -> dict:
            words, text = split_words(texts)
            n_words = np.bincount(text, minlength=len(texts))
            first = np.concatenate([[0], np.cumsum(n_words + 1)])  # of each text's words, with its separator behind them
            at = np.arange(len(text)) + text
            codes = words.dictionary_encode().indices.to_numpy()
            ids = np.arange(int(first[-1])) + (int(codes.max()) + 1 if len(codes) else 0)  # separators differ from all
            ids[at] = codes
            owner = np.repeat(np.arange(len(texts)), n_words + 1)
            runs = _runs(ids, owner, min_length, min_exponent)
            change = np.zeros(len(ids) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(change)[at] == 0
            left = np.concatenate([[0], np.cumsum(np.bincount(text[kept], minlength=len(texts)))]).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), b" ")
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
            of = owner[runs[:, 0]]
            cuts = np.searchsorted(of, np.arange(1, len(texts)))
            parts = {k: np.split(c, cuts) for k, c in (("starts", runs[:, 0] - first[of]), ("lengths", runs[:, 1]), ("periods", runs[:, 2]))}
            return {"n_words": n_words, "collapsed": joined.cast(pa.string()).to_pylist(), **{k: [x.tolist() for x in v] for k, v in parts.items()}}

        return step

    out = "n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"
    return map_texts(docs, start, out, text_col, keep)


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with periodic ends in the texts that the id chooses: known repetitions to find.

    With h the crc32 of the id and g = h div 10: where h % 10 is 0, words from number a = g % n on become those of one
    period of 1 + (n - a) div (3 + g % 8) words, joined by spaces. Other texts, and all without an id or words, stay.
    """
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    chosen = docs.withColumns({"__g": F.when(h % 10 == 0, F.floor(h / 10)), "__words": F.when(h % 10 == 0, F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(WORD), F.lit(0)))})
    sized = chosen.withColumns({"__n": F.size("__words"), "__a": F.expr("__g % nullif(size(__words), 0)")}).withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    planted = F.array_join(F.expr("transform(__words, (w, i) -> if(i < __a, w, __words[cast(__a + (i - __a) % __p as int)]))"), " ")
    text = F.when(F.col("__n") > 0, planted).otherwise(F.col(f"`{text_col}`"))
    return sized.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_runs, the longest run (smallest start and period among equals) and hashes of all runs and of the rest."""
    runs = F.arrays_zip("starts", "lengths", "periods")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["lengths"].alias("l"), (-r["starts"]).alias("s"), (-r["periods"]).alias("p"))))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["starts"], r["lengths"], r["periods"]), F.lit("\n"))), "")
    return found.withColumn("__top", longest).select(
        F.col(f"`{id_col}`"), F.size("starts").cast("long").alias("n_runs"), (-F.col("__top.s")).alias("start"), F.col("__top.l").alias("length"), (-F.col("__top.p")).alias("period"),
        F.expr("1000 * __top.l div -__top.p").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
