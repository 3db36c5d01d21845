"""Benchmark decontamination as a prefix-filtered set join.

A window is `size` consecutive words of a benchmark item (all its words, if it has fewer). A window's tokens are its
3-word shingles; a document can contain the window only if it has all of them. Tokens are ordered by rarity over all
documents; for exact containment one token, the rarest, is a sufficient prefix. Occurrences of prefixes in documents are
joined with the prefixes of windows; the token's offset places the window, bounds on position and length drop what
would reach over the text's begin or end, and the words that remain are compared one by one.

Benchmark and documents meet in joins only, neither goes through the driver. What a task needs to tell tokens of the
benchmark from others is a bitmap of fixed size: a false hit in it costs a row that finds no partner, nothing else.
Occurrences in equal texts count once. Prefixes that are one in `HOT_IN` of all occurrences, so at most as many, are
spread over `SALTS` keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored
from .textmap import map_texts, slices

FILTER_BITS = 25  # of a position in the bitmap of tokens, so 4 MB
HOT_IN, SALTS = 1000, 32
HELD = 300_000  # words whose hashes a task keeps
CHARS = 1_000_000  # of text whose words a task has in hand; these take some twenty times as much
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII; A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


class Hashes(dict):
    """Hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= HELD:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def flat(self, texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words of all texts in a row, their hashes, and the edges between the texts."""
        found = [words(t) for t in texts]
        row = list(chain.from_iterable(found))
        edges = np.cumsum([0, *map(len, found)])
        return row, np.fromiter(map(self.__getitem__, row), np.uint64, len(row)), edges


def tokens(hashes: np.ndarray, k: int) -> np.ndarray:
    """The token of `k` words at every position that has as many after it."""
    value = np.full(max(0, len(hashes) - k + 1), k, np.uint64)
    for j in range(k if len(value) else 0):
        value = (value ^ hashes[j : j + len(value)]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def _places(hashes: np.ndarray, edges: np.ndarray, k: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of tokens that the bitmap has and that lie in one text, the tokens, and the texts' places."""
    found = tokens(hashes, k)
    slot = found & (8 * len(bits) - 1)
    at = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
    text = np.searchsorted(edges, at, "right") - 1
    inside = at + k <= edges[text + 1]
    return at[inside], found[at[inside]], text[inside]


# ---- the benchmark ----------------------------------------------------------------------------------------------


def _windows(benchmark: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """A row for each window of each item: item, window (its words, parted by spaces), n, tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            items = batch.column(0).to_pylist()
            for a, b, texts in slices(batch.column(1)):
                for item, text in zip(items[a:b], texts, strict=True):
                    row, h, _ = hashes.flat([text])
                    n = min(size, len(row))
                    k = min(3, n)
                    of = tokens(h, k)
                    for i in range(0, len(row) - n + 1 if n else 0, 10_000):
                        at = range(i, min(i + 10_000, len(row) - n + 1))
                        names = [pa.array([item] * len(at), pa.string()), pa.array([b" ".join(row[j : j + n]).decode() for j in at], pa.string())]
                        yield pa.RecordBatch.from_arrays([*names, pa.array([n] * len(at), pa.int32()), pa.array([of[j : j + n - k + 1] for j in at], pa.list_(pa.int64()))], names=["item", "window", "n", "tokens"])

    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"), F.col(f"`{text_col}`").alias("text"))
    return stored(items.mapInArrow(cut, "item string, window string, n int, tokens array<long>"), "windows")


def _bitmap(found: DataFrame, token: Column, bits: int) -> bytes:
    """A bitmap of tokens: 2 ** bits bits, whatever their number."""
    slot = token.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    parts = found.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767).cast("long"))).alias("bits"))
    whole = bytearray(1 << bits - 3)
    for part in parts.collect():  # at most 2 ** (bits - 15) rows of 4 KB
        whole[part["part"] * 4096 : (part["part"] + 1) * 4096] = part["bits"]
    return bytes(whole)


# ---- the documents ----------------------------------------------------------------------------------------------


def _counts(texts: DataFrame, bitmap: bytes, lengths: list[int]) -> DataFrame:
    """How often each token occurs in all documents, for those in the bitmap; summed within tasks before the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hashes = np.frombuffer(shared.value, np.uint8), Hashes()
        for batch in batches:
            for _, _, part in slices(batch.column(0), CHARS):
                _, h, edges = hashes.flat(part)
                for k in lengths:
                    found, n = np.unique(_places(h, edges, k, bits)[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["token", "n"])

    return texts.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _occurrences(texts: DataFrame, bitmap: bytes, lengths: list[int], size: int, hot: list[int], salts: int) -> DataFrame:
    """Occurrences of prefixes: text key, position, token, salt, the words around it, and how many are before it."""
    shared = texts.sparkSession.sparkContext.broadcast((bitmap, np.array(sorted(hot), np.int64)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bitmap, spread), hashes = shared.value, Hashes()
        bits = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy() for i in (1, 2))
            for a, _, part in slices(batch.column(0), CHARS):
                row, h, edges = hashes.flat(part)
                for k in lengths:
                    at, found, text = _places(h, edges, k, bits)
                    begin = np.maximum(edges[text], at - (size - k))
                    end = np.minimum(edges[text + 1], at + size)
                    key, other = h1[a + text], h2[a + text]
                    salt = np.where(np.isin(found, spread), key % salts, 0)
                    for i in range(0, len(at), 10_000):
                        cut = slice(i, i + 10_000)
                        around = [b" ".join(row[x:y]).decode() for x, y in zip(begin[cut].tolist(), end[cut].tolist(), strict=True)]
                        numbers = (key, other, at - edges[text], found, salt, at - begin)
                        yield pa.RecordBatch.from_arrays([*(pa.array(x[cut].astype(np.int64)) for x in numbers), pa.array(around, pa.string())], names=names)

    names = ["h1", "h2", "at", "token", "salt", "before", "around"]
    found = texts.select("text", "h1", "h2").mapInArrow(probe, "h1 long, h2 long, at long, token long, salt long, before long, around string")
    return found.groupBy(*names).agg(F.lit(1).alias("one")).drop("one")  # equal texts have equal occurrences


def _prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window's rarest token, the first of equally rare ones; none where some token is in no document."""
    each = windows.select("window", "n", F.posexplode("tokens").alias("offset", "token")).join(counts.withColumnRenamed("n", "often"), "token", "left")
    rarest = F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "offset", "token"))
    return each.groupBy("window", "n").agg(rarest.alias("x")).select("window", "n", "x.*").filter("often > 0")


def _hits(texts: DataFrame, benchmark: DataFrame, size: int, item_col: str, text_col: str, salts: int, filter_bits: int) -> DataFrame:
    """Of every different text with a window: key (h1, h2), hit_spans, hit_items."""
    windows = _windows(benchmark, size, item_col, text_col)
    lengths = sorted(r.k for r in windows.select(F.least("n", F.lit(3)).alias("k")).distinct().collect())  # of 1, 2 and 3
    counts = stored(_counts(texts, _bitmap(windows.select(F.explode("tokens").alias("token")), F.col("token"), filter_bits), lengths), "token-counts")
    prefixes = stored(_prefixes(windows, counts), "prefixes")
    used = prefixes.groupBy("token").agg(F.max("often").alias("often"))
    total = used.agg(F.coalesce(F.sum("often"), F.lit(0)).alias("n")).first().n
    is_hot = F.col("often") * HOT_IN >= F.lit(total)
    hot = [r.token for r in used.filter(is_hot).select("token").collect()]  # at most HOT_IN, as their shares add up to one
    found = _occurrences(texts, _bitmap(prefixes, F.col("token"), filter_bits), lengths, size, hot, salts)
    salted = prefixes.select("window", "n", "offset", "token", F.explode(F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0)).cast("array<long>")).alias("salt"))
    begin = F.col("before") - F.col("offset")
    around = F.split("around", " ")
    pairs = found.join(salted, ["token", "salt"]).filter((begin >= 0) & (begin + F.col("n") <= F.size(around)))
    exact = pairs.filter(F.slice(around, (begin + 1).cast("int"), F.col("n")) == F.split("window", " "))
    hits = stored(exact.select("h1", "h2", (F.col("at") - F.col("offset")).cast("int").alias("a"), "n", "window"), "hits")

    # A window's place in a text decides its words, so the windows found are spans; those that touch become one.
    spans = hits.select("h1", "h2", "a", (F.col("a") + F.col("n")).alias("b")).distinct()
    order = Window.partitionBy("h1", "h2").orderBy("a", "b")
    spans = spans.withColumn("new", F.coalesce(F.col("a") > F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("h1", "h2", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    spans = spans.groupBy("h1", "h2").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("a", "b"))), lambda s: F.array(s.a, s.b))).alias("hit_spans"))
    items = hits.select("h1", "h2", "window").distinct().join(windows.select("window", "item").distinct(), "window")
    items = items.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("item")).alias("hit_items"))
    return stored(spans.join(items, ["h1", "h2"]), "hits-by-text")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    salts: int = SALTS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """`keep` columns (default all) with n_words, hit_spans (disjoint word ranges, flat) and hit_items (sorted texts).

    Null texts and texts without words have none and are clean; an item without words has no window; a null item id
    counts as the text 'null', so as one item with an item of that name. Repeated rows and items are each judged
    alike, and of several items with equal windows all are named. Texts of any length count whole; texts are told
    apart by 128 bits of hashes. An empty benchmark leaves every document clean, an empty table gives no rows. Columns
    named like a result are replaced, others kept. `salts` and `filter_bits` (15 at least) change the work only.
    """
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("n_words", "hit_spans", "hit_items")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]
    found = _hits(docs.select(text.alias("text"), *key), benchmark, size, item_col, item_text_col, salts, filter_bits)
    names = [f"__{i}" for i in range(len(keep))]  # plain names, as a column of the input may be called anything
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], *key, text.alias("text"))
    rows = map_texts(rows, lambda: lambda texts: {"n_words": [len(words(t)) for t in texts]}, "n_words long", keep=[*names, "h1", "h2"])
    spans, items = (F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("hit_spans", "array<int>"), ("hit_items", "array<string>")))
    return rows.join(found, ["h1", "h2"], "left").select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_words", spans, items)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, x: x.cast("long") - total)
    return found.select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
    )
