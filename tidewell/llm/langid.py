"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the 2-, 3- and 4-byte grams of the lower-cased text, with everything in ASCII that is no letter read as
a word border. A text is the average of its subwords' embeddings. Embeddings and softmax are trained together by
mini-batch stochastic gradient descent: first on a bounded sample, then in `PASSES` passes over all training texts. In
a pass the texts are dealt into shards by their hash, each shard is learned from in the order of its hashes, starting
with the present model, and the shards' models are averaged; so the result doesn't hang on how rows are stored. Every text
is then scored on the executors. Because the model is linear in the embeddings, the broadcast table holds embedding times softmax: a few numbers a
bucket, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textmap import map_texts

BUCKETS = 1 << 13
DIM = 16
BATCH = 32
PASSES = 2  # over all training texts, after the sample
SHARD_DOCS, SHARDS = 4096, 256  # texts in a shard of a pass, as long as there are no more shards than that
PARTS = 16  # of the parameters when shards are averaged
_BORDERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def letters(text: str) -> np.ndarray:
    """The bytes of the whole text that count, with single borders."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_BORDERS) + b" ", np.uint8)
    space = raw == 32
    return raw[~(space & np.concatenate([[False], space[:-1]]))]


def subwords(text: str) -> np.ndarray:
    """Bucket of every subword of the whole text."""
    return _buckets(letters(text))


def _buckets(raw: np.ndarray) -> np.ndarray:
    codes = raw.astype(np.uint32)
    found, h = [], codes
    for n in (2, 3, 4):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint32(16777619) ^ codes[n - 1 :]
        mixed = (h + np.uint32(n)) * np.uint32(2654435761)
        found.append(mixed >> np.uint32(32 - 13))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def has_letter(text: str) -> bool:
    """Whether any character is a letter (Unicode categories L*); digits, fractions and numerals are none."""
    return any(map(str.isalpha, text))


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # bucket × label: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float  # calibrated scores below it are rejected

    def logits(self, text: str) -> np.ndarray:
        buckets = subwords(text)
        if len(buckets) > 2 * BUCKETS:
            total = np.bincount(buckets, minlength=BUCKETS) @ self.table
        else:
            total = self.table[buckets].sum(0)
        return total / max(1, len(buckets)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Label, calibrated probability, rejected."""
        if not text or not has_letter(text) or not self.labels:
            return "und", 0.0, True
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best]), bool(p[best] < self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _sample(docs: DataFrame, train: Column, max_docs: int, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """At most `max_docs` rows, in equal parts by label as far as there are rows, picked by the hash of their id; all
    training rows with a place among them; and how many each label has."""
    label, text = F.col(f"`{label_col}`").cast("string"), F.col(f"`{text_col}`")
    known = docs.filter(train & label.isNotNull() & text.isNotNull())
    counts = {r.label: r["count"] for r in known.groupBy(label.alias("label")).count().limit(max_docs + 1).collect()}
    if len(counts) > max_docs:
        raise ValueError(f"more than {max_docs} labels")
    shares, room = [], 0.9 * max_docs
    for k, name in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        part = min(counts[name], room / (len(counts) - k))
        room -= part
        shares += [F.lit(name), F.lit(int(part / counts[name] * (1 << 30)))]
    at = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(1 << 30))
    picked = known.filter(at < F.element_at(F.create_map(*shares), label)) if shares else known
    chosen = picked.orderBy(at, F.xxhash64(text)).limit(max_docs).select(label.alias("label"), text.alias("text"), F.xxhash64(text).alias("key"))
    place = F.xxhash64(F.col(f"`{id_col}`").cast("string"), label, text)
    return chosen, known.select(label.alias("label"), text.alias("text"), F.xxhash64(text).alias("key"), place.alias("place")), counts


def _count_subwords():
    def step(texts):
        sums = [np.unique(subwords(t or ""), return_counts=True) for t in texts]
        return {"buckets": [s[0].astype(np.int32) for s in sums], "counts": [s[1].astype(np.int32) for s in sums]}

    return step


def _packed():
    import zstandard

    pack = zstandard.ZstdCompressor(3).compress
    return lambda texts: {"packed": [pack(letters(t).tobytes()) for t in texts]}


def _learn(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None, emb: np.ndarray, out: np.ndarray, bias: np.ndarray, rate: float) -> None:
    """A step of gradient descent on a batch, in place."""
    hidden = x @ emb
    grad = softmax(hidden @ out + bias)
    grad[np.arange(len(y)), y] -= 1
    if weight is not None:
        grad *= weight[y, None]
    back = grad @ out.T
    out -= rate * hidden.T @ grad
    bias -= rate * grad.mean(0) * 0.1
    # An average over thousands of subwords leaves each a thin slice of the gradient; the rate makes up for it.
    emb -= rate * 60 * x.T @ back / len(y) * BATCH / max(1, len(y))


def _passed(rows: DataFrame, counts: dict[str, int], held: list[int], emb: np.ndarray, out: np.ndarray, bias: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The model after all `rows` (label, text, key, place) but those whose key is held out: each shard learns for
    itself, and the mean of the shards, weighted by their texts, is formed part by part. Labels weigh alike, up to a
    factor of 10."""
    spark = rows.sparkSession
    names, n = sorted(counts), sum(counts.values())
    shards = min(SHARDS, -(-n // SHARD_DOCS))
    weight = np.array([min(10.0, n / (len(names) * counts[v])) for v in names], np.float32)
    shared = spark.sparkContext.broadcast((names, weight, emb, out, bias))  # bounded: BUCKETS x DIM and labels

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names, weight, *start = shared.value
        emb, out, bias = (v.copy() for v in start)
        number = {v: i for i, v in enumerate(names)}
        x, y, filled, seen, shard = np.zeros((BATCH, BUCKETS), np.float32), np.zeros(BATCH, np.int64), 0, 0, None
        for batch in batches:
            for label, packed, shard in zip(*(batch.column(i) for i in range(3)), strict=True):  # noqa: B007
                found = _buckets(np.frombuffer(unpack(packed.as_py()), np.uint8))
                x[filled] = np.bincount(found, minlength=BUCKETS) / max(1, len(found))
                y[filled] = number[label.as_py()]
                filled += 1
                if filled == BATCH:
                    _learn(x, y, weight, emb, out, bias, rate)
                    seen, filled = seen + filled, 0
        if filled:
            _learn(x[:filled], y[:filled], weight, emb, out, bias, rate * filled / BATCH)
            seen += filled
        if seen:
            parts = np.array_split(np.concatenate([emb.ravel(), out.ravel(), bias.ravel()]).astype(np.float32), PARTS)
            columns = [range(PARTS), [shard.as_py()] * PARTS, [seen] * PARTS, [v.tobytes() for v in parts]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["part", "shard", "n", "payload"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, part = 0.0, 0, None
        for batch in batches:
            for part, many, payload in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):  # noqa: B007
                total, n = total + many * np.frombuffer(payload, np.float32).astype(np.float64), n + many
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], names=["part", "payload"])

    mine = rows.filter(~F.col("key").isin(held)) if held else rows
    packed = map_texts(mine.select("label", "text", F.pmod("place", F.lit(shards)).cast("int").alias("shard"), "place"), _packed, "packed binary", keep=["label", "shard", "place"])
    dealt = packed.select("label", "packed", "shard", "place").repartitionById(shards, F.col("shard")).sortWithinPartitions("place", "packed", "label")
    learned = dealt.mapInArrow(learn, "part int, shard int, n long, payload binary")
    means = learned.repartitionById(PARTS, F.col("part")).sortWithinPartitions("shard").mapInArrow(mean, "part int, payload binary")
    found = {r.part: np.frombuffer(bytes(r.payload), np.float32) for r in means.collect()}  # the parameters once
    if not found:
        return emb, out, bias
    whole = np.concatenate([found[i] for i in range(PARTS)])
    a, b = emb.size, emb.size + out.size
    return whole[:a].reshape(emb.shape).copy(), whole[a:b].reshape(out.shape).copy(), whole[b:].copy()


def train(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    max_docs: int = 2400,
    epochs: int = 14,
    reject_rate: float = 0.0005,
    seed: int = 7,
) -> Model:
    """Fit on all rows that satisfy `train` and have a label and a text.

    The driver begins with at most `max_docs` of them, in equal parts by label and picked by the hash of their id. If
    there are more rows, all are then learned from in `PASSES` passes on the executors. Whole texts are counted into at
    most `BUCKETS` numbers on the executors, so the driver holds at most `max_docs * BUCKETS` counts. A fifth of the
    sample, and what has the same text, is kept from learning; it sets the temperature and the rejection threshold: the
    score below which `reject_rate` of well-labelled texts fall, and never more than 1.1 / labels, as a score near
    1 / labels says nothing. Without labelled rows the model knows no label and rejects everything.
    """
    chosen, known, counts = _sample(docs, train, max_docs, id_col, text_col, label_col)
    data = map_texts(chosen, _count_subwords, "buckets array<int>, counts array<int>", keep=["label", "key"]).toArrow()
    labels = sorted(counts)
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    y = np.array([labels.index(v) for v in data.column("label").to_pylist()])
    sparse = []
    for b, c in zip(data.column("buckets"), data.column("counts"), strict=True):
        c = c.values.to_numpy().astype(np.float32)
        sparse.append((b.values.to_numpy(), c / max(1.0, c.sum())))
    # Collected rows come in any order; the result must not depend on it.
    order = sorted(range(len(y)), key=lambda i: (y[i], len(sparse[i][0]), sparse[i][1].tobytes(), sparse[i][0].tobytes()))
    rng = np.random.default_rng(seed)
    order = np.array(order)[rng.permutation(len(order))]
    held = order[: len(order) // 5] if len(order) >= 50 else order
    fit = order[len(order) // 5 :] if len(order) >= 50 else order

    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32)

    def dense(part: np.ndarray) -> np.ndarray:
        x = np.zeros((len(part), BUCKETS), np.float32)
        for k, i in enumerate(part):
            x[k, sparse[i][0]] = sparse[i][1]
        return x

    steps = total = max(1, epochs * -(-len(fit) // BATCH))
    for _ in range(epochs):
        fit = fit[rng.permutation(len(fit))]
        for a in range(0, len(fit), BATCH):
            rate = 0.5 * steps / total
            steps -= 1
            part = fit[a : a + BATCH]
            _learn(dense(part), y[part], None, emb, out, bias, rate)
    if sum(counts.values()) > len(y):
        keys = data.column("key").to_pylist()
        for nth in range(PASSES):
            emb, out, bias = _passed(known, counts, sorted({keys[i] for i in held}), emb, out, bias, 0.2 / 2**nth)
    table = emb @ out
    scores = np.concatenate([dense(held[a : a + 64]) @ table + bias for a in range(0, len(held), 64)])
    truth = y[held]

    def loss(temperature: float) -> float:
        return -np.log(softmax(scores / temperature)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.2, 5, 41), key=loss)
    p = softmax(scores / temperature)
    good = p.max(1)[p.argmax(1) == truth]
    limit = float(np.quantile(good, reject_rate)) if len(good) else 1.0
    return Model(labels, table.astype(np.float32), bias, float(temperature), min(limit, 1.1 / len(labels)))


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default all) with lang_pred, score and rejected; columns of those names are replaced.

    Null and empty texts and texts without a letter are `und` with score 0 and rejected. Texts of any length count
    whole; repeated rows are each judged alike; of labels with equal scores the first by name wins. An empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))  # bounded: BUCKETS x labels

    def start():
        local = Model(*shared.value)

        def step(texts):
            found = [local.predict(t) for t in texts]
            return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "rejected": [f[2] for f in found]}

        return step

    return map_texts(docs, start, "lang_pred string, score double, rejected boolean", text_col, keep)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
