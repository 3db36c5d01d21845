"""Language-model scores by a hierarchical Pitman-Yor model over words.

Three levels, each backing off to the next: a restaurant for every word as context (the word before), with all words
as dishes; one restaurant over all words, the parent of all contexts; a uniform base. Tables of a context's restaurant
are customers of the parent. Every word opens a restaurant as a context, and counts as a dish, however rare.

Seating is a Chinese-restaurant process sampled by Gibbs: in each sweep every customer of a dish gets up and sits down
again, given where all others sit, and the seating is kept from sweep to sweep. Predictive probabilities are averaged
over the last `KEPT` sweeps. A dish with a single customer has one table whatever happens and needs no sampling.

How the work is spread: pairs (context, word) are counted inside the tasks and dealt into buckets: by the word where
it is rare, else by the context, hot contexts over several buckets. A rare word is one below one in `ONE_IN` training
tokens. Pairs of a rare context meet once in the context's bucket, which counts its customers; those with a rare word
then go on to the word's. A bucket's seating is a few rows of packed arrays,
and a sweep is a map over such rows, without a shuffle. Restaurants are sampled side by side; one with many customers
is cut into shards of `SHARD`, which are sampled side by side too and see each other's tables as they were when the
sweep began, and a pair (or a parent's dish) with more customers than that is cut into parts with tables of their own.
Between sweeps only one number a common word goes to the driver and out again, and common words are at most `ONE_IN`.

A rare word in a rare context is seated given one table for each different word of that context, which is the least
it has; this weighs with the probability of a rare word. Its true tables are added up after the last sweep.

Scoring meets words and model in the same buckets; what follows a rare context is asked for in the context's bucket,
which sends rare words on with what it knows. Pairs that are at least one in `PAIR_IN` tokens, so at most as
many, are scored where the text is read, hence no bucket has a hot pair.
"""

from __future__ import annotations

import math
import pickle
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import drop, stored
from .textmap import ranges

ONE_IN, PAIR_IN = 1_000_000, 500_000
SWEEPS, KEPT = 5, 3
DISCOUNTS, STRENGTHS = (0.8, 0.75), (1.0, 1.0)  # of contexts, of the parent
SHARD = 2048
GROUP = 4_000_000  # customers in one row of seating: the more, the more of them numpy takes side by side
MANY, TRIES = 500, 8  # who wait at one step: above that, first tries are taken before the others
LONG = 1 / 8, 1  # shards: restaurants up to so many, and longer ones, are sampled apart
BUCKET_TOKENS = 4_000_000
HELD = 300_000  # different words a task counts before it forgets those seen once
CHUNK = 8192  # numbers in one packed array on its way to a bucket
TOGETHER = 1_000_000  # numbers of several slices that go to the buckets together, so that these get fewer and longer arrays
WORD_BITS, TEXT_BITS = 21, 16  # of the number of a common word, of a text's place in its slice
WORD_MASK = (1 << WORD_BITS) - 1


def _sent(spark, value):
    """A broadcast of a value with its classes, so that executors need no copy of this module."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def _received(shared):
    return pickle.loads(shared.value)  # noqa: S301  our own


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Random 64-bit numbers for whole numbers (splitmix64)."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


_BYTES = _scrambled(np.arange(1 << 40, (1 << 40) + 256))


def _words(texts: pa.Array | list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and the number of words of each text."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    split = pc.ascii_split_whitespace(texts)
    sizes, found = pc.list_value_length(split).to_numpy().astype(np.int64), split.flatten()
    empty = pc.binary_length(texts).to_numpy() == 0  # split into one empty word
    if empty.any():
        sizes[empty] = 0
        found = found.filter(pc.greater(pc.binary_length(found), 0))
    return found, sizes


def _hashes(found: pa.Array) -> np.ndarray:
    """Hashes of words: sums of a random number for each byte times an odd one for its place in the word."""
    length = pc.binary_length(found).to_numpy().astype(np.int64)
    if not len(length):
        return np.zeros(0, np.uint64)
    data = found.buffers()[2]
    begin = int(np.frombuffer(found.buffers()[1], np.int32)[found.offset])
    first = np.cumsum(length) - length
    values = _BYTES[np.frombuffer(data, np.uint8, int(length.sum()), begin)]
    values *= (_scrambled(np.arange(int(length.max()))) | np.uint64(1))[np.arange(len(values)) - np.repeat(first, length)]
    return np.add.reduceat(values, first)


def hashed(texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and the number of words of each text."""
    found, sizes = _words(texts)
    return _hashes(found), sizes


class Numbers:
    """Numbers of words: 0 is the end of a text, then the common words; any other word has a negative hash."""

    def __init__(self, common: list[bytes]) -> None:
        self.common = pa.array(common, pa.binary()).cast(pa.string())

    def flat(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens of the texts in a row: number of the context, of the word, and place of the text."""
        found, sizes = _words(texts)
        place = pc.index_in(found, value_set=self.common)
        numbers = pc.fill_null(place, -1).to_numpy().astype(np.int64) + 1
        numbers[numbers == 0] = (_hashes(found.filter(place.is_null())) | np.uint64(1 << 63)).view(np.int64)
        d = np.repeat(np.arange(len(texts)), sizes + 1)
        w = np.zeros(len(d), np.int64)
        w[np.arange(len(numbers)) + np.repeat(np.arange(len(texts)), sizes)] = numbers
        return np.concatenate([[0], w[:-1]]), w, d  # a text begins after the end of another


# ---- packed arrays ----------------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes: whole numbers by their differences, in the smallest type that holds them; all by planes
    of bytes."""
    import zstandard

    parts = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        kind = x.dtype
        if kind.kind == "i" and len(x):
            x = np.concatenate([x[:1], x[1:] - x[:-1]])
            least, most = int(x.min()), int(x.max())
            x = x.astype(next(d for d in (np.int8, np.int16, np.int32, kind) if np.iinfo(d).min <= least and most <= np.iinfo(d).max), copy=False)
        parts.append(struct.pack("<2s2sQ", kind.str[1:].encode(), x.dtype.str[1:].encode(), len(x)))
        planes = x.view(np.uint8).reshape(len(x), x.dtype.itemsize)
        parts += [np.ascontiguousarray(planes[:, i]).data for i in range(x.dtype.itemsize)]
    return zstandard.ZstdCompressor(1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, held, n = struct.unpack_from("<2s2sQ", raw, at)
        kind, held, at = np.dtype(kind.decode()), np.dtype(held.decode()), at + 12
        x = np.empty((n, held.itemsize), np.uint8)
        for i in range(held.itemsize):
            x[:, i] = np.frombuffer(raw, np.uint8, n, at + i * n)
        at += n * held.itemsize
        x = x.view(held).ravel()
        out.append(np.cumsum(x, dtype=kind) if kind.kind == "i" else x)
    return out


def _in_order(payloads: list[bytes], n: int) -> list[np.ndarray]:
    """Arrays sorted by the first two (or the first), of rows that are pieces of such arrays."""
    parts = sorted((x for x in map(unpack, payloads) if len(x[0])), key=lambda x: (x[0][0], x[1][0]))
    if not parts:
        return [np.zeros(0, np.int64)] * n
    x, y, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
    if (x[1:] < x[:-1]).any():  # of several buckets
        order = np.lexsort((y, x))
        x, y, rest = x[order], y[order], [z[order] for z in rest]
    return [x, y, *rest]


def _joined(payloads: list[bytes], n: int) -> list[np.ndarray]:
    if not payloads:
        return [np.zeros(0, np.int64)] * n
    return [np.concatenate(x) for x in zip(*map(unpack, payloads), strict=True)]


_ROW = "bucket int, kind int, id long, a long, b long, payload binary"
_NAMES = ["bucket", "kind", "id", "a", "b", "payload"]
# Kinds of rows: pairs with a common word, pairs with a rare one, seating of either, and sums for the driver.
COMMON, RARE, COMMON_SEATS, RARE_SEATS, OF_CONTEXT, OF_WORD, OF_ALL, ASKED, ASKED_RARE, TEXTS = range(10)
# Of rare contexts: their pairs with a common word, their customers, their seating and their tables under rare words;
# what is asked, what is answered, and what goes on to rare words.
CONTEXT, CONTEXT_STATS, CONTEXT_SEATS, CONTEXT_TABLES, ASKED_CONTEXT, ANSWER, ONWARD = range(10, 17)
SEATS = (COMMON_SEATS, RARE_SEATS, CONTEXT_SEATS)


def _row(bucket: int, kind: int, payload: bytes, id: int = 0, a: int = 0, b: int = 0) -> pa.RecordBatch:
    values = [bucket], [kind], [id], [a], [b], [payload]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=_NAMES)


def _sums(kind: int, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(ids), 10_000):
        x, y, z = (pa.array(v[i : i + 10_000].astype(np.int64)) for v in (ids, a, b))
        n = len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, kind, np.int32)), x, y, z, pa.nulls(n, pa.binary())], names=_NAMES)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)


class Buckets(NamedTuple):
    n: int
    spread: np.ndarray  # over how many buckets the pairs of a context go

    def of(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        own = _mix(u) + (w % self.spread[np.maximum(u, 0)]).astype(np.uint64)
        return (np.where(w < 0, _mix(w), own) % np.uint64(self.n)).astype(np.int32)

    def of_rare(self, x: np.ndarray) -> np.ndarray:
        return (_mix(x) % np.uint64(self.n)).astype(np.int32)


def _dealt(bucket: np.ndarray, kind: int, arrays: list[np.ndarray], id: int = 0) -> Iterator[pa.RecordBatch]:
    """Arrays cut by bucket; order within a bucket is kept."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")  # by radix, of 16 bits
    bucket, arrays = bucket[order], [x[order] for x in arrays]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        for i in range(begin, end, CHUNK):
            yield _row(int(bucket[begin]), kind, pack(*(x[i : min(i + CHUNK, end)] for x in arrays)), id)


class Held:
    """Arrays of several slices on their way to the buckets."""

    def __init__(self) -> None:
        self.parts, self.n = {}, 0

    def add(self, kind: int, bucket: np.ndarray, *arrays: np.ndarray) -> None:
        self.parts.setdefault(kind, []).append((bucket, *arrays))
        self.n += len(bucket)

    def dealt(self, id: int = 0) -> Iterator[pa.RecordBatch]:
        parts, self.parts, self.n = self.parts, {}, 0
        while parts:
            kind, held = parts.popitem()
            bucket, *arrays = (np.concatenate(x) for x in zip(*held, strict=True))
            del held
            yield from _dealt(bucket, kind, arrays, id)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _total(c: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(c, at) if len(at) else np.zeros(0, np.int64)


# ---- counting ---------------------------------------------------------------------------------------------------


def _common(texts: DataFrame, one_in: int) -> tuple[list[bytes], np.ndarray, int]:
    """Words that are at least about one in `one_in` tokens, the most frequent first; about how large a share each
    number has, and the number of words in all texts.

    A word that common is so in some task. Each task sends only its own common words, at most `one_in`; the sums of
    these decide, and by the same argument no more than `one_in` words remain.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            for a, b in ranges(batch.column(0)):
                found = pc.value_counts(_words(batch.column(0).slice(a, b - a))[0])
                total += pc.sum(found.field(1)).as_py() or 0
                held = pa.concat_tables([held, pa.table({"word": found.field(0), "n": found.field(1)})]).group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
                if len(held) > HELD:
                    held = held.filter(pc.greater(held.column("n"), 1 + total // (10 * one_in)))
        held = held.filter(pc.greater_equal(pc.multiply(held.column("n"), one_in), total)).combine_chunks()
        words, n = (held.column(c).to_pylist() for c in ("word", "n"))
        yield pa.RecordBatch.from_arrays([pa.array([*(w.encode() for w in words), None], pa.binary()), pa.array([*n, total], pa.int64())], names=["word", "n"])

    counts = stored(texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "common-words")
    total = next((r.n for r in counts.filter("word is null").collect()), 0)
    found = counts.filter(F.col("word").isNotNull() & (F.col("n") * one_in >= total)).toArrow()
    pairs = sorted(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    return [w for w, _ in pairs], np.array([0, *(n / max(1, total) for _, n in pairs)]), total


def _counted(texts: DataFrame, common: list[bytes], buckets: Buckets) -> DataFrame:
    """All pairs of the training texts by bucket, their seating before anybody sits, and sums for the driver."""
    shared = _sent(texts.sparkSession, (common, buckets))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, deal = _received(shared)
        numbers, held = Numbers(known), Held()
        for batch in batches:
            for a, b in ranges(batch.column(0)):
                u, w, _ = numbers.flat(batch.column(0).slice(a, b - a))
                under, inside, n = _pair_counts(w[u < 0], u[u < 0])
                held.add(CONTEXT, deal.of_rare(under), under, inside, n)
                u, w = u[u >= 0], w[u >= 0]
                rare = w < 0
                codes, n = np.unique((u[~rare] + 1) << WORD_BITS | w[~rare], return_counts=True)
                held.add(COMMON, deal.of((codes >> WORD_BITS) - 1, codes & WORD_MASK), codes, n)
                w, u, n = _pair_counts(u[rare], w[rare])
                held.add(RARE, deal.of_rare(w), w, u, n, np.zeros(len(w), np.int64))
                if held.n > TOGETHER:
                    yield from held.dealt()
        yield from held.dealt()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = _held(batches, (COMMON, RARE, CONTEXT))
        codes, c = _joined(held.pop(COMMON), 2)
        order = np.argsort(codes)
        codes, c = codes[order], c[order]
        at = _runs(codes)
        codes, c = codes[at], _total(c, at)
        yield from _dealt(np.full(len(codes), bucket), COMMON, [codes, c])
        u, w = (codes >> WORD_BITS) - 1, codes & WORD_MASK
        single, several = c == 1, c > 1  # no sampling moves the former
        n = int(w.max(initial=-1)) + 1
        yield from _sums(OF_WORD, np.arange(n), np.bincount(w, single, n), np.bincount(w, c, n))
        n = int(u.max(initial=-1)) + 1
        yield from _sums(OF_CONTEXT, np.arange(n), np.bincount(u, c, n), np.bincount(u[single], minlength=n))
        long = _long(c[several], u[several])
        for kind_of in range(len(LONG) + 1):
            mine, mine_c = codes[several][long == kind_of], c[several][long == kind_of]
            for a, b in _groups(mine_c, mine >> WORD_BITS):
                whole = mine_c[a:b]
                (code, cs), none = _parts(whole, mine[a:b]), np.zeros(0, np.int64)
                empty = np.zeros(len(cs), np.int64)
                yield _row(bucket, COMMON_SEATS, pack(code, cs, _parts(whole, whole)[0], empty, empty, none), a, kind_of, int(whole.sum()))
        yield from _dealt_contexts(bucket, _received(shared)[1], *_joined(held.pop(CONTEXT), 3))
        w, u, c, least = _joined(held.pop(RARE), 4)
        w, u, c = _merged(w, u, c)
        yield from _dealt(np.full(len(w), bucket), RARE, [w, u, c, np.zeros(len(w), np.int64)])

    def merge_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = _held(batches, (RARE,))
        w, u, c, least = _joined(held.pop(RARE), 4)
        order = np.lexsort((u, w))
        w, u, c, least = w[order], u[order], c[order], least[order]
        yield from _dealt(np.full(len(w), bucket), RARE, [w, u, c])
        inside, single = u >= 0, c == 1
        n = int(u.max(initial=-1)) + 1
        yield from _sums(OF_CONTEXT, np.arange(n), np.bincount(u[inside], c[inside], n), np.bincount(u[inside & single], minlength=n))
        at = _runs(w)
        tokens, fixed = _total(c, at), _total(single.astype(np.int64), at)
        yield from _sums(OF_ALL, np.array([0, 1]), np.array([tokens.sum(), (tokens == 1).sum()]), np.array([len(at), (tokens == 1).sum()]))
        dish = np.repeat(np.arange(len(at)), np.diff(at, append=len(w)))
        for a, b in _groups(tokens[tokens > 1], np.arange(int((tokens > 1).sum()))):
            mine = np.flatnonzero(tokens > 1)[a:b]
            rows = np.flatnonzero((dish >= mine[0]) & (dish <= mine[-1]) & (c > 1))
            rows = rows[np.lexsort((w[rows], u[rows]))]
            place, cs = _parts(c[rows], np.searchsorted(mine, dish[rows]))
            pieces, none = -(-tokens[mine] // SHARD), np.zeros(0, np.int64)
            empty, bare = np.zeros(len(cs), np.int64), np.zeros(int(pieces.sum()), np.int64)
            yield _row(bucket, RARE_SEATS, pack(_parts(c[rows], u[rows])[0], place, cs, empty, empty, none, w[at][mine], tokens[mine], fixed[mine], pieces, bare, none, _parts(c[rows], least[rows])[0], none, none))

    met = stored(texts.mapInArrow(count, _ROW).repartitionById(buckets.n, F.col("bucket")).mapInArrow(merge, _ROW), "met")
    rare = stored(met.filter(F.col("kind") == RARE).repartitionById(buckets.n, F.col("bucket")).mapInArrow(merge_rare, _ROW), "rare")
    return met.filter(F.col("kind") != RARE).unionByName(rare)


def _held(batches: Iterator[pa.RecordBatch], kinds: tuple[int, ...]) -> tuple[int, dict[int, list[bytes]]]:
    """All payloads of a bucket by kind."""
    held: dict[int, list[bytes]] = {k: [] for k in kinds}
    bucket = TaskContext.get().partitionId()
    for batch in batches:
        for of, kind, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1, 5)), strict=True):
            if of != bucket:
                raise RuntimeError("a bucket is not a partition")
            held[kind].append(payload)
    return bucket, held


def _merged(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs, each once, with the sums of their numbers."""
    order = np.lexsort((y, x))
    x, y, c = x[order], y[order], c[order]
    at = _runs(x, y)
    return x[at], y[at], _total(c, at)


def _pair_counts(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with their numbers; one may be there several times."""
    order = np.argsort(x)
    x, y = x[order], y[order]
    at = _runs(x, y)
    return x[at], y[at], np.diff(at, append=len(x))


def _dealt_contexts(bucket: int, deal: Buckets, u: np.ndarray, w: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rare contexts of a bucket: customers of each, pairs with common words and their seating, pairs with rare words
    on to the buckets of these, and sums for the driver."""
    u, w, c = _merged(u, w, c)
    at = _runs(u)
    words = np.diff(at, append=len(u))
    here = np.full(len(at), bucket)
    yield from _dealt(here, CONTEXT_STATS, [u[at], _total(c, at), KEPT * _total((c == 1).astype(np.int64), at)])
    rare = w < 0
    yield from _dealt(deal.of_rare(w[rare]), RARE, [w[rare], u[rare], c[rare], np.repeat(words, words)[rare]])
    elsewhere = np.repeat(_total((rare | (c == 1)).astype(np.int64), at), words)  # tables that are not sampled here
    u, w, c, elsewhere = u[~rare], w[~rare], c[~rare], elsewhere[~rare]
    yield from _dealt(np.full(len(u), bucket), CONTEXT, [u, w, c])
    ids, place = np.unique(w, return_inverse=True)
    yield from _sums(OF_WORD, ids, np.bincount(place, c == 1, len(ids)), np.bincount(place, c, len(ids)))
    u, w, elsewhere, c = u[c > 1], w[c > 1], elsewhere[c > 1], c[c > 1]
    for a, b in _groups(c, u):
        (of, cs), none = _parts(c[a:b], u[a:b]), np.zeros(0, np.int64)
        empty = np.zeros(len(cs), np.int64)
        yield _row(bucket, CONTEXT_SEATS, pack(of, _parts(c[a:b], w[a:b])[0], _parts(c[a:b], elsewhere[a:b])[0], cs, empty, empty, none))


def _long(c: np.ndarray, restaurant: np.ndarray) -> np.ndarray:
    """Of every row, how many of the lengths in `LONG` its restaurant (sorted) exceeds."""
    at = _runs(restaurant)
    return np.repeat(np.searchsorted(SHARD * np.array(LONG), _total(c, at)), np.diff(at, append=len(c)))


def _side_by_side(seats: DataFrame, rare_customers: int) -> DataFrame:
    """The seating before anybody sits, with the pairs of several buckets in one row each: the more restaurants are
    sampled side by side, the less each customer costs. Those of about one length are put together, so that they end
    together too; and so are pairs with a rare word, whatever the number of other groups."""
    customers = {r.a: r.n for r in seats.filter(F.col("kind") == COMMON_SEATS).groupBy("a").agg(F.sum("b").alias("n")).collect()}
    if sum(customers.values()) <= GROUP:
        customers = dict.fromkeys(customers, 0)
        many = dict.fromkeys(customers, 0)
    else:
        many = {k: -(-n // GROUP) for k, n in customers.items()}
    group, n_groups = F.lit(0), 0
    for k, n in sorted(many.items()):
        group = F.when(F.col("a") == k, n_groups + F.col("bucket") % max(1, n)).otherwise(group)
        n_groups += n
    n_groups, of_rare = max(1, n_groups), max(1, -(-2 * rare_customers // GROUP))  # these have the parent's customers too
    group = F.when(F.col("kind") == COMMON_SEATS, group).when(F.col("kind") == RARE_SEATS, n_groups + F.col("bucket") % of_rare).otherwise(F.col("bucket") % n_groups)
    n_groups += of_rare

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {COMMON_SEATS: [], RARE_SEATS: []}
        for batch in batches:
            for bucket, kind, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(5), strict=True):
                if kind in held:
                    held[kind].append(payload.as_py())
                else:
                    yield _row(bucket, kind, payload.as_py())
        group, none = TaskContext.get().partitionId(), np.zeros(0, np.int64)
        code, c, whole, *_ = _joined(held[COMMON_SEATS], 6)
        for a, b in _groups(c, code >> WORD_BITS):
            empty = np.zeros(b - a, np.int64)
            yield _row(group, COMMON_SEATS, pack(code[a:b], c[a:b], whole[a:b], empty, empty, none))
        if held[RARE_SEATS]:
            rare = [unpack(x) for x in held[RARE_SEATS]]
            before = np.cumsum([0, *(len(x[6]) for x in rare)])
            for x, n in zip(rare, before[:-1].tolist(), strict=True):
                x[1] = x[1] + n
            rare = [np.concatenate(x) for x in zip(*rare, strict=True)]
            order = np.argsort(rare[0], kind="stable")  # restaurants of several buckets meet
            for i in (0, 1, 2, 3, 4, 12):
                rare[i] = rare[i][order]
            yield _row(group, RARE_SEATS, pack(*rare))

    return seats.repartitionById(n_groups, group.cast("int")).sortWithinPartitions("bucket", "kind", "a", "id").mapInArrow(join, _ROW)


def _in_buckets(seats: DataFrame, buckets: Buckets) -> DataFrame:
    """The seating back in the buckets of its pairs, as far as scores need it."""
    shared = _sent(seats.sparkSession, buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = _received(shared)
        for batch in batches:
            for kind, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if kind == COMMON_SEATS:
                    code, _, _, _, kept, _ = unpack(payload.as_py())
                    yield from _dealt(to.of((code >> WORD_BITS) - 1, code & WORD_MASK), COMMON_SEATS, [code, kept])
                    continue
                u, place, _, _, kept, _, w, *_, had, has = unpack(payload.as_py())
                bucket = to.of_rare(w)
                had, has = had.reshape(KEPT, -1), has.reshape(KEPT, -1)
                for b in np.unique(bucket).tolist():
                    words, rows = np.flatnonzero(bucket == b), np.flatnonzero(bucket[place] == b)
                    yield _row(b, RARE_SEATS, pack(u[rows], np.searchsorted(words, place[rows]), kept[rows], w[words], had[:, words].ravel(), has[:, words].ravel()))

    joined = F.col("kind").isin(COMMON_SEATS, RARE_SEATS)
    return seats.filter(~joined).unionByName(seats.filter(joined).select("kind", "payload").mapInArrow(deal, _ROW))


def _groups(customers: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about `GROUP` customers that end where the key changes, if it does within another such range."""
    begin, ends = 0, np.cumsum(customers)
    change = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    while begin < len(customers):
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + GROUP)) + 1
        at = change[np.searchsorted(change, end)] if end < len(key) else len(key)
        end = int(at) if ends[min(at, len(key)) - 1] - (ends[begin - 1] if begin else 0) <= 2 * GROUP else end
        yield begin, min(end, len(customers))
        begin = min(end, len(customers))


def _parts(c: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values repeated for parts of at most `SHARD` customers, and the customers of each part."""
    n = -(-c // SHARD)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    whole, n = np.repeat(c, n), np.repeat(n, n)
    return np.repeat(value, -(-c // SHARD)), whole // n + (place < whole % n)


# ---- seating ----------------------------------------------------------------------------------------------------


def shards_of(c: np.ndarray, restaurant: np.ndarray) -> np.ndarray:
    """Shard of every row: restaurants (sorted) cut where their customers exceed `SHARD`."""
    at = _runs(restaurant)
    ends = np.cumsum(c)
    before = np.repeat(ends[at] - c[at], np.diff(at, append=len(c)))
    cut = (ends - c - before) // SHARD
    new = np.zeros(len(c), bool)
    new[_runs(restaurant, cut)] = True
    return np.cumsum(new) - 1


def reseat(rng: np.random.Generator, c: np.ndarray, t: np.ndarray, sizes: np.ndarray, shard: np.ndarray, opened: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """One sweep: every customer gets up, if seated, and sits down again, one after another in each shard.

    Rows are dishes with `c` customers at `t` tables; `sizes` are the tables' sizes, row by row; customers beyond
    those seated sit down for the first time, after all others of their row. `opened` is the number of tables in
    each shard's restaurant, `parent` the probability of each row's dish one level up. Returns `t` and `sizes`.
    """
    n, t = len(c), t.astype(np.int64)
    first = np.cumsum(c) - c
    begin = first[_runs(shard)] if n else first
    length = np.diff(begin, append=int(c.sum()))
    order = np.argsort(-length, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    opened = opened[order].astype(np.float64)
    steps = int(length.max(initial=0))
    live_at = len(length) - np.searchsorted(np.sort(length), np.arange(steps), "right")
    offset = np.cumsum(live_at) - live_at
    start = first - begin[shard]  # the step of a row's first customer
    small = np.int16 if c.max(initial=0) < 1 << 15 else np.int32
    # Customers lie by step, then by shard, so that those who move at one step lie side by side.
    place = np.arange(int(c.sum()), dtype=np.int32)  # of a customer in its row, then among all
    place -= np.repeat(first.astype(np.int32), c)
    spare = np.repeat((c - 1).astype(small), c)  # a stack of free tables for each row
    spare -= place.astype(small)
    place += np.repeat(start.astype(np.int32), c)
    place = offset.astype(np.int32).take(place)
    place += np.repeat(rank[shard], c)
    seated = np.bincount(np.repeat(np.arange(n), t), sizes, n).astype(np.int64)
    everyone, nobody = bool((seated == c).all()), not len(sizes)
    at_table, size = np.full(len(place), -1, small), np.zeros(len(place), small)
    if not nobody:
        number = np.arange(len(sizes)) - np.repeat(np.cumsum(t) - t, t)  # of a table in its row
        size[np.repeat(first, t) + number] = sizes
        if not everyone:
            before = np.cumsum(seated) - seated
            place = place[np.repeat(first - before, seated) + np.arange(int(seated.sum()))]
        at_table[place] = np.repeat(number.astype(small), sizes)
        del number
    del place
    # Of each shard the row whose customers are moving; only shards that come to their next row look up what is new.
    rank_of = rank[shard].astype(np.int64)
    row_of = np.argsort(start * max(1, len(order)) + rank_of)
    rank_of = rank_of[row_of]
    turns = np.searchsorted(start[row_of], np.arange(steps + 1)).tolist()
    firsts, starts, cs, ts, known_of = (x.astype(np.int32)[row_of] for x in (first, start, c, t, seated))
    parents, row_of = parent[row_of], row_of.astype(np.int32)
    del first, start, seated, shard
    now, base, since, of, tables_of, under, known = (np.zeros(len(order), x) for x in (np.int64, np.int64, np.int64, np.int64, np.float64, np.float64, np.int64))
    offsets, live_at = offset.tolist(), live_at.tolist()
    for step in range(steps):
        i, j = turns[step], turns[step + 1]
        if i < j:
            who = rank_of[i:j]
            if step:
                ts[now.take(who)] = tables_of.take(who)
            now[who] = np.arange(i, j)
            base[who], since[who], of[who], under[who], tables_of[who] = firsts[i:j], starts[i:j], cs[i:j], parents[i:j], ts[i:j]
            if not everyone:
                known[who] = known_of[i:j]
        a, live = offsets[step], live_at[step]
        here, base_, of_, tables_ = at_table[a : a + live], base[:live], of[:live], tables_of[:live]
        if not nobody:
            if everyone:
                gone = _leave(size, base_ + here)
            else:
                up = (here >= 0).nonzero()[0]
                gone = up[_leave(size, base_[up] + here[up])]
            if len(gone):
                left = tables_.take(gone)
                spare[base_.take(gone) + of_.take(gone) - left.astype(np.int64)] = here.take(gone)
                tables_[gone] = left - 1
                opened[gone] -= 1
            here.fill(-1)
        if everyone:
            reach = of_  # customers of the row that may be seated: the first so many
            others = reach - 1  # that are
        else:
            index = step - since[:live]
            reach = np.maximum(known[:live], index)
            others = reach - (index < known[:live])
        fresh = discount * opened[:live]
        fresh += strength
        fresh *= under[:live]
        weight = fresh + others
        weight -= discount * tables_
        weight *= rng.random(live)
        new = weight < fresh
        waiting, new = (~new).nonzero()[0], new.nonzero()[0]
        if len(new):
            mine = base_.take(new)
            tables = tables_.take(new) + 1
            tables_[new] = tables
            table = spare.take(mine + of_.take(new) - tables.astype(np.int64))
            here[new] = table
            size[mine + table] = 1
            opened[new] += 1
        if not len(waiting):
            continue
        # Whoever is picked sits at a large table more likely than not; one part of each goes to the discount.
        mine, reach, begun, many = base_.take(waiting), reach.take(waiting), since.take(waiting), len(waiting)
        luck = rng.random(2 * many)
        at = (luck[:many] * reach).astype(np.int64)
        at += begun
        at = offset.take(at)
        at += waiting
        table = at_table.take(at)
        chance = 1 - luck[many:]
        chance *= size.take(table + mine)  # any table's of one who stands
        good = chance > discount
        good &= table >= 0
        stands = _seat(good, table, waiting, mine, here, size)
        while len(stands):
            waiting, mine, reach, begun = waiting.take(stands), mine.take(stands), reach.take(stands), begun.take(stands)
            whom, luck = rng.random((2, len(waiting), TRIES))
            stands = _retried(whom, luck, waiting, mine, reach, begun, offset, at_table, here, size, discount)
    ts[now] = tables_of
    t[row_of] = ts
    return t, size[size > 0].astype(np.int64)


def _leave(size: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Takes one customer from each of the tables; which of these are empty then."""
    rest = size.take(tables)
    rest -= 1
    size[tables] = rest
    return (rest == 0).nonzero()[0]


def _seat(good: np.ndarray, table: np.ndarray, waiting: np.ndarray, mine: np.ndarray, here: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Seats those whose table is good; which of them stand on."""
    stays = good.nonzero()[0]
    table = table.take(stays)
    here[waiting.take(stays)] = table
    table = table + mine.take(stays)
    size[table] = size.take(table) + 1
    return (~good).nonzero()[0]


def _retried(whom: np.ndarray, luck: np.ndarray, waiting: np.ndarray, mine: np.ndarray, reach: np.ndarray, since: np.ndarray, offset: np.ndarray, at_table: np.ndarray, here: np.ndarray, size: np.ndarray, discount: float) -> np.ndarray:
    """Seats those who wait at the table of the first customer picked that takes them; which of them stand on."""
    if len(waiting) > MANY and whom.shape[1] == TRIES:  # most need no more than two tries
        few = slice(0, 2)
        left = _retried(whom[:, few], luck[:, few], waiting, mine, reach, since, offset, at_table, here, size, discount)
        rest = slice(2, None)
        return left.take(_retried(whom[left, rest], luck[left, rest], waiting.take(left), mine.take(left), reach.take(left), since.take(left), offset, at_table, here, size, discount))
    at = (whom * reach[:, None]).astype(np.int64)
    at += since[:, None]
    at = offset.take(at)
    at += waiting[:, None]
    table = at_table.take(at)
    chance = 1 - luck
    chance *= size.take(table + mine[:, None])
    good = chance > discount
    good &= table >= 0
    pick = good.argmax(1)
    pick += np.arange(0, good.size, good.shape[1])
    return _seat(good.take(pick), table.take(pick), waiting, mine, here, size)


class State(NamedTuple):
    """What a sweep needs of all others: common words' tables as contexts and probabilities under the parent, and the
    sums that give a rare word its own."""

    sweep: int
    tables: np.ndarray
    parent: np.ndarray
    customers: int  # of the parent
    opened: int  # its tables
    types: int
    tokens: int


def under_parent(customers: np.ndarray, tables: np.ndarray, of: State) -> np.ndarray:
    spare = (STRENGTHS[1] + DISCOUNTS[1] * of.opened) / (of.types + 1)
    return (customers - DISCOUNTS[1] * tables + spare) / (STRENGTHS[1] + of.customers)


def _rng(seed: int, sweep: int, *of: int) -> np.random.Generator:
    return np.random.default_rng([seed, sweep, *(x & 0xFFFFFFFF for x in of)])


def _swept_common(payload: bytes, state: State, seed: int) -> tuple[bytes, Iterator[pa.RecordBatch]]:
    code, c, whole, t, kept, sizes = unpack(payload)
    u, w = (code >> WORD_BITS) - 1, code & WORD_MASK
    shard = shards_of(c, u)
    t, sizes = reseat(_rng(seed, state.sweep, int(code[0])), c, t, sizes, shard, state.tables[u[_runs(shard)]], state.parent[w], DISCOUNTS[0], STRENGTHS[0])
    kept = kept + t * (state.sweep >= SWEEPS - KEPT)
    return pack(code, c, whole, t, kept, sizes), _of_common(u, w, t)


def _swept_context(payload: bytes, state: State, seed: int) -> tuple[bytes, Iterator[pa.RecordBatch]]:
    u, w, elsewhere, c, t, kept, sizes = unpack(payload)
    shard, at = shards_of(c, u), _runs(u)
    own = np.repeat(_total(t, at), np.diff(at, append=len(u)))
    begin = _runs(shard)
    t, sizes = reseat(_rng(seed, state.sweep, int(u[0]), int(w[0])), c, t, sizes, shard, (own + elsewhere)[begin], state.parent[w], DISCOUNTS[0], STRENGTHS[0])
    kept = kept + t * (state.sweep >= SWEEPS - KEPT)
    tables = np.bincount(w, t)
    ids = np.flatnonzero(tables)
    return pack(u, w, elsewhere, c, t, kept, sizes), _sums(OF_WORD, ids, tables[ids], np.zeros(len(ids)))


def _of_common(u: np.ndarray, w: np.ndarray, t: np.ndarray) -> Iterator[pa.RecordBatch]:
    for kind, x in ((OF_CONTEXT, u), (OF_WORD, w)):
        tables = np.bincount(x, t)
        ids = np.flatnonzero(tables)  # every row has a table
        yield from _sums(kind, ids, tables[ids], np.zeros(len(ids)))


def _swept_rare(payload: bytes, state: State, seed: int) -> tuple[bytes, Iterator[pa.RecordBatch]]:
    u, place, c, t, kept, sizes, w, tokens, fixed, pieces, tables, table_sizes, least, had, has = unpack(payload)
    rng = _rng(seed, state.sweep, int(w[0]))
    if state.sweep:
        owner = np.repeat(np.arange(len(w)), pieces)
        parent = under_parent(_by_owner(owner, _seated(tables, table_sizes), len(w)), _by_owner(owner, tables, len(w)), state)
    else:
        parent = (tokens + 1) / (state.tokens + state.types + 1)
    if len(c):
        shard = shards_of(c, u)
        opened = np.where(u < 0, least, state.tables[np.maximum(u, 0)])[_runs(shard)]
        t, sizes = reseat(rng, c, t, sizes, shard, opened, parent[place], DISCOUNTS[0], STRENGTHS[0])
    customers = fixed + np.bincount(place, t, len(w)).astype(np.int64)
    tables, table_sizes = _swept_parent(rng, customers, pieces, tables, table_sizes, state)
    opened = _by_owner(np.repeat(np.arange(len(w)), pieces), tables, len(w))
    if state.sweep >= SWEEPS - KEPT:
        kept, had, has = kept + t, np.concatenate([had, customers]), np.concatenate([has, opened])
    opened_in = np.bincount(u[u >= 0], t[u >= 0])
    ids = np.flatnonzero(opened_in)
    sums = [*_sums(OF_CONTEXT, ids, opened_in[ids], np.zeros(len(ids))), *_sums(OF_ALL, np.array([0]), customers.sum()[None], opened.sum()[None])]
    return pack(u, place, c, t, kept, sizes, w, tokens, fixed, pieces, tables, table_sizes, least, had, has), iter(sums)


def _by_owner(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, value, n).astype(np.int64)


def _seated(t: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(t)), t), sizes, len(t)).astype(np.int64)


def _swept_parent(rng: np.random.Generator, customers: np.ndarray, pieces: np.ndarray, tables: np.ndarray, sizes: np.ndarray, state: State) -> tuple[np.ndarray, np.ndarray]:
    """A sweep over dishes of the parent, whose customers have become more or fewer since the last."""
    number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    whole, n = np.repeat(customers, pieces), np.repeat(pieces, pieces)
    c = whole // n + (number < whole % n)
    # Who is too many leaves, picked at random.
    seated = _seated(tables, sizes)
    luck, crowd = rng.random(int(seated.sum())), np.where(seated > c, seated, 0)
    of_many = np.repeat(seated > c, seated)
    luck = luck[of_many]
    luck += np.repeat(np.arange(len(c)), crowd)
    table = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[of_many]
    del of_many
    order = np.argsort(luck)  # by dish, then by luck
    goes = np.arange(len(luck)) - np.repeat(np.cumsum(crowd) - crowd, crowd) >= np.repeat(c, crowd)
    sizes = sizes - np.bincount(table[order[goes]], minlength=len(sizes))
    del luck, table, order, goes
    tables = np.bincount(np.repeat(np.arange(len(c)), tables)[sizes > 0], minlength=len(c)).astype(np.int64)
    some = c > 0
    shard = shards_of(c[some], np.zeros(int(some.sum()), np.int64))
    opened = np.full(int(shard.max(initial=-1)) + 1, state.opened)
    t, sizes = reseat(rng, c[some], tables[some], sizes[sizes > 0], shard, opened, np.full(int(some.sum()), 1 / (state.types + 1)), DISCOUNTS[1], STRENGTHS[1])
    out = np.zeros(len(c), np.int64)
    out[some] = t
    return out, sizes


def _swept(seats: DataFrame, state: State, seed: int) -> DataFrame:
    """One sweep over all contexts, and over the parent's rare words."""
    shared = _sent(seats.sparkSession, state)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _received(shared)
        for batch in batches:
            for bucket, kind, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(5), strict=True):
                done, sums = {COMMON_SEATS: _swept_common, RARE_SEATS: _swept_rare, CONTEXT_SEATS: _swept_context}[kind](payload.as_py(), now, seed)
                yield _row(bucket, kind, done)
                yield from sums

    return seats.mapInArrow(sweep, _ROW)


_PARENT = "first long, last long, pieces binary, tables binary, tables_of binary"


def _parent_rows(spark, customers: np.ndarray) -> DataFrame:
    """The parent's common words, cut into rows of about `GROUP` customers; parts of a word are in one row each."""
    limit = max(SHARD, -(-int(customers.sum()) // 1_000_000))
    pieces = np.maximum(1, -(-customers // limit))
    rows = [(a, b, pack(pieces[a:b]), pack(np.zeros(int(pieces[a:b].sum()), np.int64), np.zeros(0, np.int64)), pack(np.zeros(b - a, np.int64))) for a, b in _groups(3 * customers // 2 + 1, np.arange(len(customers)))]
    values = zip(*rows, strict=True) if rows else [[]] * 5
    return spark.createDataFrame(pa.table([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["first", "last", "pieces", "tables", "tables_of"]))


def _swept_parents(rows: DataFrame, customers: np.ndarray, state: State, seed: int) -> DataFrame:
    shared = _sent(rows.sparkSession, (customers, state))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of = _received(shared)
        for batch in batches:
            for r in batch.to_pylist():
                (pieces,), (tables, sizes) = unpack(r["pieces"]), unpack(r["tables"])
                rng = _rng(seed, of.sweep, -1, r["first"])
                tables, sizes = _swept_parent(rng, now[r["first"] : r["last"]], pieces, tables, sizes, of)
                whole = _by_owner(np.repeat(np.arange(len(pieces)), pieces), tables, len(pieces))
                values = [r["first"]], [r["last"]], [r["pieces"]], [pack(tables, sizes)], [pack(whole)]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["first", "last", "pieces", "tables", "tables_of"])

    tasks = min(2000, max(1, -(-3 * int(customers.sum()) // (2 * GROUP))))
    return rows.repartitionByRange(tasks, "first").mapInArrow(sweep, _PARENT)  # a row a task, as nearly as may be


def _collected(rows: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The sums for the driver: two numbers for each common word, and a few for all."""
    out = {k: (np.zeros(n, np.int64), np.zeros(n, np.int64)) for k in (OF_CONTEXT, OF_WORD)} | {OF_ALL: (np.zeros(2, np.int64), np.zeros(2, np.int64))}
    found = rows.filter(F.col("kind").isin(OF_CONTEXT, OF_WORD, OF_ALL)).groupBy("kind", "id").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
    kinds, ids, a, b = (found.column(c).to_numpy() for c in ("kind", "id", "a", "b"))
    for kind, (x, y) in out.items():
        at = kinds == kind
        x[ids[at]], y[ids[at]] = a[at], b[at]
    return out


class Model(NamedTuple):
    """What all tasks know when they score: common words, and for each kept sweep a row of each table."""

    common: list[bytes]
    buckets: Buckets
    in_context: np.ndarray  # customers of each context
    counts: np.ndarray  # of common words
    tables: np.ndarray  # kept sweep x context
    parent: np.ndarray  # kept sweep x common word
    states: list[State]
    hot: np.ndarray  # pairs scored where the text is read, sorted
    hot_scores: np.ndarray

    def back_off(self, u: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The part of the probability that comes from the parent; `parent` is kept sweep x token."""
        room = STRENGTHS[0] + DISCOUNTS[0] * self.tables[:, u]
        return (room * parent).mean(0) / (STRENGTHS[0] + self.in_context[u])

    def of_pair(self, u: np.ndarray, c: np.ndarray, kept: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """log10 probability of words that follow u, seen c times there, at `kept` tables in all kept sweeps."""
        own = (c - DISCOUNTS[0] * kept / KEPT) / (STRENGTHS[0] + self.in_context[u])
        return np.log10(own + self.back_off(u, parent))


def train(texts: DataFrame, one_in: int = ONE_IN, pair_in: int = PAIR_IN, seed: int = 11) -> tuple[Model, DataFrame, DataFrame]:
    """The model from texts (one column): what is broadcast, the pairs, and the seating after the last sweep."""
    spark = texts.sparkSession
    common, share, n_words = _common(texts, one_in)
    n, n_buckets = len(common) + 1, max(1, -(-n_words // BUCKET_TOKENS))
    buckets = Buckets(n_buckets, np.maximum(1, np.ceil(4 * n_buckets * share)).astype(np.int64))
    pairs = _counted(texts, common, buckets)
    sums = _collected(pairs, n)
    in_context, single = sums[OF_CONTEXT]
    fixed, counts = sums[OF_WORD]
    (rare_tokens, once), (rare_types, _) = sums[OF_ALL]
    total, types = int(counts.sum() + rare_tokens), int((counts > 0).sum() + rare_types)

    state = State(0, single, (counts + 1) / (total + types + 1), 0, 0, types, total)
    seats, kept_states = stored(_side_by_side(pairs.filter(F.col("kind").isin(*SEATS)), int(rare_tokens - once)), "side-by-side"), []
    before, parents = seats, None
    for sweep in range(SWEEPS):
        done = stored(_swept(seats, state._replace(sweep=sweep), seed), "seats")
        sums = _collected(done, n)
        customers = fixed + sums[OF_WORD][0]
        were, parents = parents, stored(_swept_parents(_parent_rows(spark, customers) if parents is None else parents, customers, state._replace(sweep=sweep), seed), "parents")
        opened = np.zeros(n, np.int64)
        for r in parents.select("first", "last", "tables_of").collect():  # a number for each common word
            opened[r.first : r.last] = unpack(bytes(r.tables_of))[0]
        rare_customers, rare_opened = int(sums[OF_ALL][0][0]) + int(once), int(sums[OF_ALL][1][0]) + int(once)
        state = state._replace(tables=single + sums[OF_CONTEXT][0], customers=int(customers.sum()) + rare_customers, opened=int(opened.sum()) + rare_opened)
        state = state._replace(parent=under_parent(customers, opened, state))
        for old in (before, were):  # each sweep needs only the one before
            if old is not None:
                drop(old)
        before, seats = done, done.filter(F.col("kind").isin(*SEATS))
        if sweep >= SWEEPS - KEPT:
            kept_states.append(state)
    model = Model(common, buckets, in_context, counts, np.stack([s.tables for s in kept_states]), np.stack([s.parent for s in kept_states]), [s._replace(tables=None, parent=None) for s in kept_states], np.zeros(0, np.int64), np.zeros(0))
    return _with_hot_pairs(model, seats, math.ceil(total / pair_in)), pairs.filter(F.col("kind").isin(COMMON, RARE, CONTEXT, CONTEXT_STATS)), stored(_in_buckets(seats, buckets), "in-buckets")


def _with_hot_pairs(model: Model, seats: DataFrame, least: int) -> Model:
    """The model with the scores of pairs seen at least `least` times: no more than there are tokens for."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                code, _, whole, _, kept, _ = unpack(payload.as_py())
                some = whole >= max(2, least)
                code, whole, kept = code[some], whole[some], kept[some]
                at = _runs(code)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (code[at], whole[at], _total(kept, at))], names=["code", "c", "kept"])

    rows = seats.filter(F.col("kind") == COMMON_SEATS).select("payload").mapInArrow(find, "code long, c long, kept long")
    found = rows.groupBy("code").agg(F.first("c").alias("c"), F.sum("kept").alias("kept")).toArrow()  # parts may lie in several rows
    code, c, kept = (found.column(x).to_numpy() for x in ("code", "c", "kept"))
    order = np.argsort(code)
    code, c, kept = code[order], c[order], kept[order]
    return model._replace(hot=code, hot_scores=model.of_pair((code >> WORD_BITS) - 1, c, kept, model.parent[:, code & WORD_MASK]))


# ---- scoring ----------------------------------------------------------------------------------------------------


def _asked(rows: DataFrame, model) -> DataFrame:
    """For some slices of texts at a time: what can be told on the spot, and the pairs that the buckets are asked for."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        m = _received(model)
        numbers = Numbers(m.common)
        log_c = np.log10(m.counts + 1.0)
        held, told_of, many = Held(), [], 0

        def done() -> Iterator[pa.RecordBatch]:
            texts = [np.concatenate(x) for x in zip(*told_of, strict=True)]
            slice_id = xxhash.xxh64_intdigest(texts[0].tobytes()) - (1 << 63)
            yield _row(int(slice_id % m.buckets.n), TEXTS, pack(*texts), slice_id)
            yield from held.dealt(slice_id)

        for batch in batches:
            for a, b in ranges(batch.column(1)):
                if held.n > TOGETHER or many + b - a > 1 << TEXT_BITS:
                    yield from done()
                    told_of, many = [], 0
                u, w, d = numbers.flat(batch.column(1).slice(a, b - a))
                keys, n = batch.column(0).slice(a, b - a).to_numpy(), b - a
                wc, dc = w[w >= 0], d[w >= 0]
                known, log_base = np.bincount(dc, m.counts[wc] > 0, n).astype(np.int64), np.bincount(dc, log_c[wc], n)
                tokens = np.bincount(d, minlength=n)
                under = u < 0
                common = ~under & (w >= 0)
                both = np.sort((u[common] + 1 << WORD_BITS | w[common]) << TEXT_BITS | d[common])
                at = _runs(both)
                both, times = both[at], np.diff(at, append=len(both)).astype(np.int32)
                code, dc = both >> TEXT_BITS, (both & ((1 << TEXT_BITS) - 1)).astype(np.int32)
                at, told = _find(m.hot, code)
                score = m.hot_scores[at[told]] * times[told] if len(m.hot) else np.zeros(0)
                answered = np.bincount(dc[told], times[told], n).astype(np.int64)
                told_of.append((keys, tokens, answered, known, log_base, np.bincount(dc[told], score, n).astype(np.float64)))
                code, dc, times = code[~told], dc[~told], times[~told]
                held.add(ASKED, m.buckets.of((code >> WORD_BITS) - 1, code & WORD_MASK), code, dc + np.int32(many), times)
                x, y, dc, times = _once(u[under], w[under], d[under])
                held.add(ASKED_CONTEXT, m.buckets.of_rare(x), x, y, dc + np.int32(many), times)
                rare = ~under & (w < 0)
                x, y, dc, times = _once(w[rare], u[rare], d[rare])
                none = np.zeros(len(x), np.int32)
                held.add(ASKED_RARE, m.buckets.of_rare(x), x, y, dc + np.int32(many), times, none, none)
                many += n
        if told_of:
            yield from done()

    return rows.select("key", "text").mapInArrow(ask, _ROW)


def _once(x: np.ndarray, y: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is asked of rare x, sorted by it, and how often; most of what a text has several times is asked once."""
    order = np.argsort(x)
    x, y, d = x[order], y[order], d[order].astype(np.int32)
    at = _runs(x, y, d)
    return x[at], y[at], d[at], np.diff(at, append=len(x)).astype(np.int32)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys among sorted ones, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Bucket:
    """The pairs of a bucket with their tables; answers what is asked."""

    def __init__(self, model: Model, held: dict[int, list[bytes]]) -> None:
        self.model = model
        self.code, self.c = _in_order(held[COMMON], 2)
        self.kept = np.where(self.c == 1, KEPT, 0)
        for payload in held[COMMON_SEATS]:
            code, kept = unpack(payload)
            np.add.at(self.kept, np.searchsorted(self.code, code), kept)
        w, u, c = _in_order(held[RARE], 3)
        at = _runs(w)
        self.word, self.tokens = w[at], _total(c, at)
        self.tokens_of = np.append(self.tokens, 0)  # a new word has none
        dish = np.repeat(np.arange(len(at)), np.diff(at, append=len(w)))
        self.contexts = np.unique(u)
        self.pair, self.pair_c = dish * len(self.contexts) + np.searchsorted(self.contexts, u), c
        self.pair_kept = np.where(c == 1, KEPT, 0)
        # Of the parent, for each kept sweep: a word seen once has one customer at one table, a new word none.
        had, has = (np.ones((KEPT, len(self.word) + 1), np.int64) for _ in range(2))
        had[:, -1] = has[:, -1] = 0
        for payload in held[RARE_SEATS]:
            u, place, kept, w, x, y = unpack(payload)
            mine = np.searchsorted(self.word, w)
            had[:, mine], has[:, mine] = x.reshape(KEPT, -1), y.reshape(KEPT, -1)
            np.add.at(self.pair_kept, np.searchsorted(self.pair, mine[place] * len(self.contexts) + np.searchsorted(self.contexts, u)), kept)
        self.parent = np.stack([under_parent(had[s], has[s], model.states[s]) for s in range(KEPT)])

    def common(self, code: np.ndarray) -> np.ndarray:
        at, there = _find(self.code, code)
        u, w = (code >> WORD_BITS) - 1, code & WORD_MASK
        c, kept = (np.where(there, x[at], 0) if len(x) else np.zeros(len(code)) for x in (self.c, self.kept))
        return self.model.of_pair(u, c, kept, self.model.parent[:, w])

    def rare(self, w: np.ndarray, u: np.ndarray, customers: np.ndarray | int = 0, tables: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and how often each word occurs in training; `customers` and `tables` are those of rare contexts."""
        dish, known = _find(self.word, w)
        dish = np.where(known, dish, len(self.word))
        tokens = self.tokens_of[dish]
        context, there = _find(self.contexts, u)
        known &= there
        at, there = _find(self.pair, dish * len(self.contexts) + context)
        there &= known
        c, kept = (np.where(there, x[at], 0) if len(x) else np.zeros(len(w)) for x in (self.pair_c, self.pair_kept))
        parent = self.parent[:, dish]
        score = _of_rare_context(c, kept, customers, tables, parent.mean(0))
        inside = u >= 0
        score[inside] = self.model.of_pair(u[inside], c[inside], kept[inside], parent[:, inside])
        return score, tokens


def _of_rare_context(c: np.ndarray, kept: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """log10 probability of words seen c times in a rare context; `kept` and `tables` are those of all kept sweeps, `parent`
    the mean of these."""
    own = c - DISCOUNTS[0] * kept / KEPT + (STRENGTHS[0] + DISCOUNTS[0] * tables / KEPT) * parent
    return np.log10(own / (STRENGTHS[0] + customers))


class Contexts:
    """The rare contexts of a bucket: customers and tables of each, and its pairs with common words."""

    def __init__(self, model: Model, held: dict[int, list[bytes]]) -> None:
        self.parent = model.parent.mean(0)
        u, customers, tables = _joined(held[CONTEXT_STATS], 3)
        order = np.argsort(u)
        self.context, self.customers, self.tables = u[order], customers[order], tables[order]
        self.many = len(model.counts)
        u, w, c = _joined(held[CONTEXT], 3)
        key = np.searchsorted(self.context, u) * self.many + w
        order = np.argsort(key)
        self.pair, self.c = key[order], c[order]
        self.kept = np.where(self.c == 1, KEPT, 0)
        for payload in held[CONTEXT_SEATS]:
            u, w, _, _, _, kept, _ = unpack(payload)
            place = np.searchsorted(self.context, u)
            np.add.at(self.kept, np.searchsorted(self.pair, place * self.many + w), kept)
            np.add.at(self.tables, place, kept)
        for payload in held[CONTEXT_TABLES]:
            u, kept = unpack(payload)
            np.add.at(self.tables, np.searchsorted(self.context, u), kept)

    def of(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers, and tables of all kept sweeps; none where training never saw the context."""
        at, there = _find(self.context, u)
        return tuple(np.where(there, x[at], 0) if len(x) else np.zeros(len(u), np.int64) for x in (self.customers, self.tables))

    def common(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        place, known = _find(self.context, u)
        at, there = _find(self.pair, place * self.many + w)
        there &= known
        c, kept = (np.where(there, x[at], 0) if len(x) else np.zeros(len(w)) for x in (self.c, self.kept))
        return _of_rare_context(c, kept, *self.of(u), self.parent[w])


def _tables_under_rare(seats: DataFrame, model) -> DataFrame:
    """Tables of rare contexts with rare words, on the way to the buckets of the contexts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = _received(model).buckets
        for batch in batches:
            for payload in batch.column(0):
                u, _, kept, *_ = unpack(payload.as_py())
                u, kept = u[u < 0], kept[u < 0]
                yield from _dealt(deal.of_rare(u), CONTEXT_TABLES, [u, kept])

    return seats.filter(F.col("kind") == RARE_SEATS).select("payload").mapInArrow(find, _ROW)


def _by_text(d: np.ndarray, times: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> bytes:
    texts = np.flatnonzero(np.bincount(d))
    sums = [np.bincount(d, x)[texts] for x in (times, known, base, times * score)]
    return pack(texts, *(x.astype(np.int64) for x in sums[:2]), *sums[2:])


def _answered(asked: DataFrame, held: DataFrame, model, n_buckets: int) -> DataFrame:
    """Answers of the buckets: a slice's texts as they are, sums for its texts, and what is asked of rare words that follow
    rare contexts, which goes on to their own buckets. Rows come by kind, so those of rare contexts are the last. What has
    gone on is answered at once for all slices: a row for each slice, context's and word's bucket would be too many."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _received(model)
        waiting: dict[int, list[bytes]] = {k: [] for k in (COMMON, RARE, COMMON_SEATS, RARE_SEATS, CONTEXT, CONTEXT_STATS, CONTEXT_SEATS, CONTEXT_TABLES)}
        bucket = contexts = None
        going, come = Held(), []
        for batch in batches:
            for kind, slice_id, payload in zip(*(batch.column(i).to_pylist() for i in (1, 2)), batch.column(5), strict=True):
                payload = payload.as_py()
                if kind in waiting:
                    waiting[kind].append(payload)
                elif kind == TEXTS:
                    yield _row(0, TEXTS, payload, slice_id)
                elif kind == ASKED_CONTEXT:
                    if contexts is None:
                        bucket, contexts = None, Contexts(m, waiting)
                        waiting = dict.fromkeys(waiting, [])
                    u, w, d, times = unpack(payload)
                    common = w >= 0
                    if common.any():
                        known = base = np.zeros(int(common.sum()))
                        yield _row(0, ANSWER, _by_text(d[common], times[common], known, base, contexts.common(u[common], w[common])), slice_id)
                    u, w, d, times = (x[~common] for x in (u, w, d, times))
                    going.add(ONWARD, m.buckets.of_rare(w), w, u, d, times, *contexts.of(u), np.full(len(w), slice_id))
                    if going.n > TOGETHER:
                        yield from going.dealt()
                elif kind == ONWARD:
                    come.append(unpack(payload))
                else:
                    if bucket is None:
                        bucket = Bucket(m, waiting)
                        waiting |= {k: [] for k in (COMMON, RARE, COMMON_SEATS, RARE_SEATS)}
                    if kind == ASKED:
                        code, d, times = unpack(payload)
                        known = base = np.zeros(len(d))
                        score = bucket.common(code)
                    else:
                        w, u, d, times, customers, tables = unpack(payload)
                        score, tokens = bucket.rare(w, u, customers, tables)
                        known, base = times * (tokens > 0), times * np.log10(tokens + 1.0)
                    yield _row(0, ANSWER, _by_text(d, times, known, base, score), slice_id)
        yield from going.dealt()
        if come:
            w, u, d, times, customers, tables, of = (np.concatenate(x) for x in zip(*come, strict=True))
            score, tokens = (bucket or Bucket(m, waiting)).rare(w, u, customers, tables)
            order = np.argsort(of, kind="stable")
            d, times, score, tokens, of = d[order], times[order], score[order], tokens[order], of[order]
            at = _runs(of)
            for a, b in zip(at.tolist(), np.append(at[1:], len(of)).tolist(), strict=True):
                known, base = times[a:b] * (tokens[a:b] > 0), times[a:b] * np.log10(tokens[a:b] + 1.0)
                yield _row(0, ANSWER, _by_text(d[a:b], times[a:b], known, base, score[a:b]), int(of[a]))

    rows = held.unionByName(asked).repartitionById(n_buckets, F.col("bucket")).sortWithinPartitions("kind")
    return rows.mapInArrow(answer, _ROW)


_PER_TEXT = "key long, m long, n long, n_known long, log_c double, score double"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by slice, its texts first: sums for each text."""
    texts, now, many = None, None, 0

    def done() -> Iterator[pa.RecordBatch]:
        keys, n, answered, known, base, score = texts
        if not np.array_equal(n, answered):
            raise RuntimeError("the texts came in another order when a task ran again; store them first")
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, np.full(len(keys), many), n, known, base, score)], names=["key", "m", "n", "n_known", "log_c", "score"])

    for batch in batches:
        for slice_id, first, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), strict=True):
            values = unpack(payload.as_py())
            if slice_id != now:
                if texts is not None:
                    yield from done()
                now, texts, many = slice_id, [x.copy() for x in values], 1
                if not first:
                    raise RuntimeError("a slice without its texts")
            elif first:  # the same texts in the same order once more
                many += 1
                for x, y in zip(texts[1:], values[1:], strict=True):
                    x += y
            else:
                at, times, known, base, score = values
                for x, y in zip(texts[2:], (times, known, base, score), strict=True):
                    x[at] += y
    if texts is not None:
        yield from done()


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN, pair_in: int = PAIR_IN, seed: int = 11) -> DataFrame:
    """Per row of `docs`: doc_id, trained (took part in training), n_tokens, n_known, train_tokens, base_score (add
    one, log10) and score (the model's log10 probability of the text).

    A null text is empty: its only token is the end. `learn` that is null counts as false. Without training rows all
    counts are 0 and both scores are those of the uniform base. Repeated rows and equal texts are scored alike, each
    row once; a null id is kept. Texts of any length count whole. An empty table gives no rows. Other columns are not
    read. Rare words, and texts, are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.coalesce(learn, F.lit(False)).alias("trained"), text.alias("text"))
    model, pairs, seats = train(rows.filter("trained").select("text"), one_in, pair_in, seed)
    tokens, types = model.states[0].tokens, model.states[0].types
    shared = _sent(spark, model)
    held = pairs.unionByName(seats.filter(F.col("kind").isin(COMMON_SEATS, RARE_SEATS, CONTEXT_SEATS)))
    first = stored(_answered(_asked(rows, shared), held.unionByName(_tables_under_rare(seats, shared)), shared, model.buckets.n), "answers")
    second = _answered(first.filter(F.col("kind") == ONWARD), held.filter(F.col("kind").isin(RARE, RARE_SEATS)), shared, model.buckets.n)
    answered = first.filter(F.col("kind").isin(TEXTS, ANSWER)).unionByName(second).select(F.col("id").alias("slice"), (F.col("kind") == TEXTS).alias("texts"), "payload")
    by_slice = answered.repartition("slice").sortWithinPartitions("slice", F.desc("texts"))
    # Equal texts add up, and each takes its part.
    per_text = by_slice.mapInArrow(_summed, _PER_TEXT).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("m", "n", "n_known", "log_c", "score")])
    both = rows.select("doc_id", "key", "trained").join(per_text, "key")
    whole = lambda c: F.expr(f"{c} div m").alias(c)
    return both.select(
        "doc_id", "trained", F.expr("n div m").alias("n_tokens"), whole("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_c") / F.col("m") - F.expr("n div m") * float(np.log10(tokens + types + 1))).alias("base_score"), (F.col("score") / F.col("m")).alias("score"),
    )
