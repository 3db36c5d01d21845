from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tidewell.llm import periodic


def slow_runs(words: list[str], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """Every period, every stretch; a stretch counts for its smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def slow_plant(doc_id: int | None, text: str | None) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def slow_digest(words: list[str]) -> tuple:
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def texts() -> list[str]:
    rnd = random.Random(11)
    out = ["a " * n for n in range(12)] + ["a b " * n + "a" for n in range(6)] + ["\x1ca\x85 b\tb\r\nb\x0bb b\x0cb", "x " * 5 + "y " + "x " * 7]
    for _ in range(150):
        words = [rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(0, 25))]
        for _ in range(rnd.randint(1, 3)):
            period = [rnd.choice("abcd") for _ in range(rnd.randint(1, 6))]
            words += (period * 8)[: rnd.randint(4, 40)] + [rnd.choice("abcd")]
        out.append(" ".join(words))
    fib, last = ["a"], ["b"]
    for _ in range(9):
        fib, last = fib + last, fib
    return [*out, " ".join(fib), " ".join(fib + fib + fib + fib + fib)]


@pytest.mark.parametrize("limits", [(6, 4), (1, 2), (2, 2), (9, 3)])
def test_runs_equal_brute_force(spark, limits):
    all_texts = texts()
    docs = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string").repartition(3)
    for r in periodic.find_runs(docs, *limits).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", all_texts[r.doc_id])
        assert r.n_words == len(words)
        assert list(zip(r.starts, r.lengths, r.periods, strict=True)) == slow_runs(words, *limits), all_texts[r.doc_id]


def test_query_form(spark, docs, rows, no_docs):
    found = periodic.digest(periodic.find_runs(periodic.plant(docs.select("doc_id", "text")), keep=["doc_id"]))
    got = sorted((tuple(r) for r in found.collect()), key=str)
    known = {}  # the long text is searched by brute force only as far as its planted end goes
    want = sorted(((r[0], *known.setdefault(r[1], slow_digest(slow_plant(r[0], r[1])))) if len(r[1] or "") < 9999 else None for r in rows), key=str)
    assert [g for g in got if g[0] != 64] == [w for w in want if w] and len(got) == len(rows)
    assert periodic.find_runs(no_docs).count() == 0 and periodic.find_runs(docs).columns == [*[c for c in docs.columns if c != "n_words"], "n_words", "starts", "lengths", "periods", "collapsed"]


def test_planted_texts(spark):
    rnd, rows = random.Random(5), []
    for i in range(400):
        rows.append((i, " ".join(rnd.choice(["in", "the", "on", "of", "ab", "ba"]) for _ in range(rnd.randint(0, 60)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in periodic.digest(periodic.find_runs(periodic.plant(docs), keep=["doc_id"])).collect()}
    assert got == {i: slow_digest(slow_plant(i, t)) for i, t in rows} and sum(g[0] > 0 for g in got.values()) > 10


def test_very_long_period(spark):
    text = " ".join(["w%d" % (i % 7000) for i in range(40_000)] + ["z"] * 30_000)
    (r,) = periodic.find_runs(spark.createDataFrame([(text,)], "text string")).collect()
    assert list(zip(r.starts, r.lengths, r.periods, strict=True)) == [(0, 40_000, 7000), (40_000, 30_000, 1)]
    assert r.collapsed.count(" ") == 7000
