"""SimHash near-duplicates through one hierarchical index in Gray order.

All distinct fingerprints are sorted by Gray rank, so that those next to each other share many bits. Runs of `LEAF`
sorted values are leaves, `FAN` neighbours form the node above, and so on up to the blocks (one a partition) and over
these to the root: one tree over all fingerprints. A node keeps the bits that everything below it shares, without
those its parent has already: the common pattern is factored out upwards. A group of queries, itself a leaf or a
chunk with its shared bits, walks down from the root and adds up the differences that are already certain; as soon as
they exceed the limit the whole subtree is left out. Only the values of leaves that remain are compared.

The tree over the blocks has at most `MAX_BLOCKS` leaves and is broadcast; a chunk of queries is sent to those blocks
alone that the tree leaves for it, and walks on inside them. Each pair of chunks meets once. What a block finds leaves
it as trees over linked groups, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import stored
from .textmap import map_texts

BITS = 3
LEAF, FAN, CHUNK = 32, 8, 1024
BLOCK, MAX_BLOCKS = 1 << 15, 1024  # values a block, as long as there are no more blocks than that
HELD_LINKS = 1 << 20  # links that a task holds before it reduces them to trees


# ---- fingerprints -----------------------------------------------------------------------------------------------


def fingerprint(text: str | None, size: int = 3) -> int:
    """Majority bits of the shingles' XXH64 values; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < size:
        hashes = [h(b" ".join(words), 42)]
    else:
        hashes = [h(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(size)), strict=False)]
    values, ones = np.array(hashes, np.uint64), np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 14):
        part = values[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns with `fp`, the fingerprint as a signed long; a column named fp is replaced."""

    def start():
        return lambda texts: {"fp": np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)}

    return map_texts(docs, start, "fp long", text_col, keep)


# ---- the index --------------------------------------------------------------------------------------------------


def _gray_rank(word: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        word = word.bitwiseXOR(F.shiftrightunsigned(word, shift))
    return word


def _shared(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of `size` values the bits that all have, and those that any has."""
    at = np.arange(0, len(values), size)
    return np.bitwise_and.reduceat(values, at), np.bitwise_or.reduceat(values, at)


class Tree:
    """A tree over groups in Gray order, given by the bits that all (`low`) and any (`high`) of their values have."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        levels = [(low, high)]
        while len(low) > FAN:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            levels.append((low, high))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        above = None
        for low, high in reversed(levels):
            mask = ~(low ^ high)
            own = mask if above is None else mask & ~above[np.arange(len(low)) // FAN]
            self.levels.append((low, own))
            above = mask
        self.visited = self.skipped = 0  # nodes looked at, and nodes below which nothing was looked at

    def search(self, pattern: np.ndarray, mask: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
        """Places of query groups and of tree groups whose certain differences are at most `bits`."""
        n = len(self.levels[0][0])
        query, node = np.repeat(np.arange(len(pattern)), n), np.tile(np.arange(n), len(pattern))
        sure = np.zeros(len(query), np.uint8)
        for k, (low, own) in enumerate(self.levels):
            if k:
                query, sure = np.repeat(query, FAN), np.repeat(sure, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                real = node < len(low)
                query, node, sure = query[real], node[real], sure[real]
            sure = sure + np.bitwise_count((pattern[query] ^ low[node]) & own[node] & mask[query])
            near = sure <= bits
            self.visited += len(near)
            self.skipped += len(near) - int(near.sum())
            query, node, sure = query[near], node[near], sure[near]
        return query, node


def _padded(values: np.ndarray) -> np.ndarray:
    """Leaves as rows; the last one is filled up with its last value."""
    return np.pad(values, (0, -len(values) % LEAF), mode="edge").reshape(-1, LEAF)


def _groups(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place linked to each of n places."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same values as the links a-b do: each group as a tree of four children a node."""
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = _groups(len(values), place[: len(a)], place[len(a) :])
    order = np.argsort(label, kind="stable")
    values, label = values[order], label[order]
    first = np.concatenate([[True], label[1:] != label[:-1]]) if len(label) else np.zeros(0, bool)
    begin = np.flatnonzero(first)[np.cumsum(first) - 1] if len(label) else np.zeros(0, int)
    at = np.arange(len(values)) - begin
    child = at > 0
    return values[child], values[begin[child] + (at[child] - 1) // 4]


class Block:
    """The values of a block under their tree, and the links found so far."""

    def __init__(self, values: np.ndarray) -> None:
        self.leaves = _padded(values)
        self.tree = Tree(*_shared(values, LEAF))
        self.a, self.b, self.held, self.reduced = [], [], 0, 0

    def link(self, queries: np.ndarray, first: int = -1) -> None:
        """Links of a chunk of queries with this block's values. Queries that are the block's own values from place
        `first` on are compared with themselves and what comes after them."""
        leaves, (low, high) = _padded(queries), _shared(queries, LEAF)
        query, node = self.tree.search(low, ~(low ^ high))
        if first >= 0:
            later = node >= query + first // LEAF
            query, node = query[later], node[later]
        for i in range(0, len(query), 256):
            x, y = leaves[query[i : i + 256]], self.leaves[node[i : i + 256]]
            which, p, q = np.nonzero(np.bitwise_count(x[:, :, None] ^ y[:, None, :]) <= BITS)
            a, b = x[which, p], y[which, q]
            other = a != b
            self.a.append(a[other])
            self.b.append(b[other])
            self.held += int(other.sum())
            if self.held > self.reduced + HELD_LINKS:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        a, b = _forest(np.concatenate([*self.a, np.zeros(0, np.uint64)]), np.concatenate([*self.b, np.zeros(0, np.uint64)]))
        self.a, self.b, self.held, self.reduced = [a], [b], len(a), len(a)
        return a, b


_CHUNKS = "block int, chunk int, low long, high long, words binary"
_SENT = "block int, role int, source int, chunk int, words binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted values of a partition, a block, in chunks."""
    block, held, made = TaskContext.get().partitionId(), np.zeros(0, np.uint64), 0

    def row(words: np.ndarray) -> pa.RecordBatch:
        low, high = (np.array([f.reduce(words)], np.uint64).view(np.int64) for f in (np.bitwise_and, np.bitwise_or))
        columns = [pa.array([block], pa.int32()), pa.array([made], pa.int32()), pa.array(low), pa.array(high), pa.array([words.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "chunk", "low", "high", "words"])

    for batch in batches:
        held = np.concatenate([held, batch.column(0).to_numpy().view(np.uint64)])
        while len(held) >= CHUNK:
            yield row(held[:CHUNK])
            held, made = held[CHUNK:], made + 1
    if len(held):
        yield row(held)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block, the block's own values (role 0) before the queries (role 1): its links."""
    now, parts, block = None, [], None

    def links() -> Iterator[pa.RecordBatch]:
        if block is not None:
            a, b = block.reduce()
            for i in range(0, len(a), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000].view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        for at, role, source, chunk, words in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
            if at != now:
                yield from links()
                now, parts, block = at, [], None
            values = np.frombuffer(words.as_buffer(), np.uint64)
            if role == 0:
                parts.append(values)
                continue
            if block is None:
                block, parts = Block(np.concatenate(parts)), []
            block.link(values, chunk * CHUNK if source == at else -1)
    yield from links()


def link_edges(values: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints in column fp exactly as links of at most BITS bits do."""
    spark = values.sparkSession
    blocks = min(MAX_BLOCKS, max(1, -(-values.count() // BLOCK)))
    # Gray ranks are unsigned; the flipped sign bit makes Spark's signed order theirs.
    rank = _gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63)))
    ordered = values.select("fp", rank.alias("rank")).repartitionByRange(blocks, "rank").sortWithinPartitions("rank").select("fp")
    index = stored(ordered.mapInArrow(_chunks, _CHUNKS), "gray-index")
    tops = index.groupBy("block").agg(F.bit_and("low").alias("low"), F.bit_or("high").alias("high")).orderBy("block").limit(MAX_BLOCKS).collect()
    upper = spark.sparkContext.broadcast(([r.block for r in tops], [r.low for r in tops], [r.high for r in tops]))  # at most MAX_BLOCKS nodes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high = (np.array(x, np.int64) for x in upper.value)
        tree = Tree(low.view(np.uint64), high.view(np.uint64))
        for batch in batches:
            low, high = (batch.column(i).to_numpy().view(np.uint64) for i in (2, 3))
            query, node = tree.search(low, ~(low ^ high))
            own = batch.column(0).to_numpy()
            later = names[node] >= own[query]
            query, node = query[later], node[later]
            for role, rows, to in ((0, np.arange(len(own)), own), (1, query, names[node])):
                for i in range(0, len(rows), 1000):
                    part = pa.array(rows[i : i + 1000])
                    columns = [pa.array(to[i : i + 1000], pa.int32()), pa.array(np.full(len(part), role), pa.int32()), batch.column(0).take(part), batch.column(1).take(part), batch.column(4).take(part)]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "role", "source", "chunk", "words"])

    sent = index.mapInArrow(send, _SENT).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "role", "source", "chunk")
    return sent.mapInArrow(_search, "a long, b long")


# ---- operators --------------------------------------------------------------------------------------------------


def _roots(values: DataFrame) -> DataFrame:
    """(fp, root): for each distinct fingerprint one that all linked to it have in common."""
    roots = components(link_edges(values.select("fp")))
    return stored(values.select("fp").join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "members")


def near_duplicates(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, fp (signed long), component_id, the smallest doc_id linked to it over any path.

    Rows without words (null and empty texts) have fingerprint 0 and are linked with each other. Rows with equal
    fingerprints, so repeated rows and ties, count once in the index and share a component. Ids must be whole numbers
    or text that shows one, else the cast is an error. A null id takes no part in the minimum and still gets the
    component of its text; a component of null ids alone has none. Texts of any length count whole. An empty table
    gives no rows. Other columns are not read.
    """
    fps = stored(fingerprints(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), size, keep=["doc_id"]), "fingerprints")
    values = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = _roots(values)
    smallest = roots.join(values, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    by_value = stored(roots.join(smallest, "root").select("fp", "component_id"), "members")
    return fps.join(by_value, "fp").select("doc_id", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked texts, with all columns: the first.

    First is the row with the smallest id; null ids come after all others, and rows of one id in the order of a hash
    of the whole row. Rows are told apart by themselves, not by their id: two texts of one id that are not linked
    both stay, as do texts whose id is null, and of rows that are equal in all columns one stays. Texts without words
    are one group. Columns of map type have no hash and take no part in telling rows apart. An empty table gives
    no rows.
    """
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    flags = [F.col(f"`{c}`").isNull() for c in plain]
    cells = [F.col(f"`{c}`") for c in plain]
    names = [f"__{i}" for i in range(len(docs.columns))]  # plain names, as a column of the input may be called anything
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], F.xxhash64(*flags, *cells).alias("h1"), F.xxhash64(F.lit(1), *cells, *flags).alias("h2"))
    id_name, text_name = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    fps = stored(fingerprints(rows.select(id_name.alias("id"), "h1", "h2", text_name.alias("text")), size, keep=["id", "h1", "h2"]), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "h1", "h2")
    first = stored(fps.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    winners = _roots(first).join(first, "fp").groupBy("root").agg(F.min("first").alias("w")).select("w.h1", "w.h2")
    repeats = fps.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
    winners = stored(winners.join(repeats, ["h1", "h2"]), "winners")
    kept = rows.join(winners, ["h1", "h2"])
    kept = kept.filter("copies = 1").unionByName(kept.filter("copies > 1").dropDuplicates(["h1", "h2"]))
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
