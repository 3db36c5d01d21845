"""Quality classification by nearest-neighbour voting in a latent-semantic space.

A document is a bag of hashed words and word shapes (`Reaux###` is `Aa#`) with a few measures of repetition; the
bags of a bounded sample of labelled documents are reduced by truncated singular value decomposition. The sample's
unit vectors are broadcast; every document is compared with all of them by exact, blocked cosine products, and the
nearest ones vote with their labels, weighted by similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textmap import map_texts

WORDS, SHAPES = 4096, 1024
MEASURES = ("repeated", "distinct", "lines", "upper", "symbols", "length")
LENGTHS = 10
SIZE = WORDS + SHAPES + 2 * len(MEASURES) + LENGTHS
WEIGHTS = (0.35, 1.0, 0.7)  # of words, shapes and measures
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 25, 12
_RUN = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Letters by case, digits as 0, everything else as it is; runs as one."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUN.sub(r"\1", out)


class Bags:
    """Sparse term vectors of texts."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def _terms(self, word: str) -> tuple[int, int]:
        if len(self.known) > 200_000:
            self.known.clear()
        terms = zlib.crc32(word.lower().encode()) % WORDS, WORDS + zlib.crc32(shape(word).encode()) % SHAPES
        self.known[word] = terms
        return terms

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values; an empty text has only its length and measures."""
        text = text or ""
        words = text.split()
        counts, n, get = Counter(words), max(1, len(words)), self.known.get
        pairs = [get(w) or self._terms(w) for w in counts]
        size = np.fromiter(counts.values(), np.float64, len(counts))
        places = np.array(pairs, np.int64).reshape(-1, 2)
        bag = np.sqrt((np.bincount(places[:, 0], size, SIZE) + np.bincount(places[:, 1], size, SIZE)) / n) if pairs else np.zeros(SIZE)
        bag[:WORDS] *= WEIGHTS[0]
        bag[WORDS : WORDS + SHAPES] *= WEIGHTS[1]
        lines = [x for x in text.split("\n") if x]
        chars = max(1, len(text))
        measures = (
            sum(map(str.__eq__, words, words[1:])) / n,
            len(counts) / n,
            1 - len(set(lines)) / max(1, len(lines)),
            sum(len(x) for x in re.findall(r"[A-Z]+", text)) / chars,
            sum(len(x) for x in re.findall(r"[#*$%&|<>]+", text)) / chars,
            min(1.0, (chars / n) / 20),
        )
        at = WORDS + SHAPES
        bag[at : at + 2 * len(MEASURES)] = WEIGHTS[2] * np.array([v for m in measures for v in (m, 1 - m)])
        bag[SIZE - LENGTHS + min(LENGTHS - 1, int(np.log2(len(words) + 1) / 1.5))] = WEIGHTS[2] * 0.5
        places = np.flatnonzero(bag)
        return places.astype(np.int32), bag[places]


def _bags() -> Callable:
    bags = Bags()

    def step(texts: list[str | None]) -> dict:
        found = [bags(t) for t in texts]
        return {"places": [p for p, _ in found], "values": [v for _, v in found]}

    return step


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), SIZE), np.float32)
    for i, (p, v) in enumerate(rows):
        x[i, p] = v
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_labelled: int = 3000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Term weights times the decomposition's basis, the labelled vectors, their labels, and the mean label.

    At most `max_labelled` labelled rows that satisfy `learn` (on the labels' doc_id) are used, picked by the hash of
    their id; several labels of one id count as their mean. Their bags, of at most SIZE numbers each, are made on
    the executors. Without labelled rows the vectors are empty.
    """
    known = labels.filter(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("y"))
    share = min(1.0, 0.9 * max_labelled / max(1, known.count()))
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    picked = known.filter(at < int(share * (1 << 30))).orderBy(at, "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most max_labelled rows of two numbers
    rows = rows.orderBy("doc_id", F.xxhash64("text")).limit(max_labelled)  # an id may repeat among the documents
    data = map_texts(rows.select("doc_id", "y", "text"), _bags, "places array<int>, values array<double>", keep=["doc_id", "y"]).toArrow()
    order = np.argsort(data.column("doc_id").to_numpy(), kind="stable")
    y = data.column("y").to_numpy()[order]
    if not len(y):
        return np.zeros((SIZE, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5
    places, values = data.column("places").combine_chunks(), data.column("values").combine_chunks()
    x = _dense([(places[i].values.to_numpy(), values[i].values.to_numpy()) for i in order.tolist()])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.2
    idf[WORDS:] = 1.0
    x *= idf
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(SIZE, min(DIMENSIONS + 8, len(x)))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ v.T)[:, :DIMENSIONS]
    return (idf[:, None] * basis).astype(np.float32), _unit(x @ basis).astype(np.float32), y, float(y.mean())


def vote(vectors: np.ndarray, labelled: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Similarity-weighted mean label of the nearest labelled vectors; half a neighbour's weight goes to the prior."""
    if not len(y):
        return np.full(len(vectors), prior)
    near = vectors @ labelled.T
    k = min(NEIGHBOURS, len(y))
    at = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(y) else np.tile(np.arange(k), (len(near), 1))
    last = np.take_along_axis(near, at, 1).min(1, keepdims=True)
    weight = np.maximum(np.take_along_axis(near, at, 1), 0) ** SHARPNESS
    score = ((weight * y[at]).sum(1) + 0.5 * prior) / (weight.sum(1) + 0.5)
    # Those equally near at the edge share the votes that are left, whatever their ids.
    for i in np.flatnonzero((near >= last).sum(1) > k):
        share, edge = (near[i] > last[i]).astype(np.float64), near[i] == last[i]
        share[edge] = (k - share.sum()) / edge.sum()
        weight = share * np.maximum(near[i], 0) ** SHARPNESS
        score[i] = ((weight * y).sum() + 0.5 * prior) / (weight.sum() + 0.5)
    return np.clip(score, 0, 1)


def classify(docs: DataFrame, model: tuple, block: int = 256, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default all) with score, 0 to 1. Null texts count as empty; texts of any length count whole;
    repeated rows are each scored alike, and equally near neighbours at the edge share what votes are left. An empty
    table gives no rows; a column named score is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's size

    def start():
        basis, labelled, y, prior = shared.value
        bags = Bags()

        def step(texts):
            out = []
            for a in range(0, len(texts), block):
                found = [bags(t) for t in texts[a : a + block]]
                vectors = np.stack([v.astype(np.float32) @ basis[p] for p, v in found])
                out.append(vote(_unit(vectors), labelled, y, prior))
            return {"score": np.concatenate(out)}

        return step

    return map_texts(docs, start, "score double", text_col, keep)
