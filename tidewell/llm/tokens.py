"""Token-ID output in directly addressable codes.

Ids are split into chunks of 8 bits. Level 0 holds the lowest chunk of every id; level k+1 holds the next chunk of
the ids that need one. A continuation bitmap for each level says which ids go on, and a rank directory (set bits
before every 512th bit) turns a position at one level into its position at the next, so any single token is read
with one directory entry and at most 64 bitmap bytes per level.

A file is a row of segments. A segment holds whole documents in order: header, document ids, document lengths, then
the levels. All numbers are little-endian. Files are written by Spark's own file writer (atomic task commit, any
file system), one record per segment with a closing newline byte.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import scratch
from .textmap import slices

MAGIC = b"TDAC"
HEADER = "<4sIQQI"  # magic, documents, tokens, bytes of the whole segment, levels
BLOCK_BITS = 512
SEGMENTS_A_FILE = 2048  # so a file of average segments holds some hundred megabytes
CACHE_WORDS = 200_000  # words in each of the two generations whose ids a worker remembers


# ---- directly addressable codes ---------------------------------------------------------------------------------


def encode_levels(ids: np.ndarray) -> bytes:
    """Chunk levels with continuation bitmaps and rank directories."""
    parts = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK_BITS)) if len(more) else np.zeros(0)
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u8") if len(more) else np.zeros(0, "<u8")
        parts.append(struct.pack("<Q", len(rest)) + rest.astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            return struct.pack("<I", len(parts)) + b"".join(parts)
        rest = rest[more] >> 8


class Levels:
    """Views of encoded levels; nothing is decoded before it is asked for."""

    def __init__(self, data: memoryview) -> None:
        (n_levels,) = struct.unpack_from("<I", data)
        self.levels, at = [], 4
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            bits = np.frombuffer(data, np.uint8, (n + 7) // 8, at)
            at += len(bits)
            ranks = np.frombuffer(data, "<u8", -(-n // BLOCK_BITS), at)
            at += 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """Token i, by one rank query per level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // BLOCK_BITS
            first = block * BLOCK_BITS // 8
            before = np.unpackbits(bits[first : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK_BITS]
            i, shift = int(ranks[block]) + int(before.sum()), shift + 8
        return value

    def all(self) -> np.ndarray:
        """All tokens as unsigned 32-bit integers."""
        ids = np.zeros(len(self), "<u4")
        at = None
        for k, (chunks, bits, _) in enumerate(self.levels):
            if at is None:
                ids |= chunks
                at = np.arange(len(ids))
            else:
                ids[at] |= chunks.astype(np.uint32) << (8 * k)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return ids


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    body = known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u8").tobytes()
    body += encode_levels(ids)
    levels = struct.unpack_from("<I", body, 17 * len(doc_ids))[0]
    return struct.pack(HEADER, MAGIC, len(doc_ids), len(ids), struct.calcsize(HEADER) + len(body), levels) + body


class Segment:
    def __init__(self, data: memoryview) -> None:
        magic, n, self.n_tokens, self.size, _ = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = struct.calcsize(HEADER)
        known = np.frombuffer(data, np.uint8, n, at)
        numbers = np.frombuffer(data, "<i8", n, at + n)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known, strict=True)]
        self.lengths = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
        self.tokens = Levels(data[at + 17 * n : self.size])


def segments(data: bytes) -> Iterator[Segment]:
    view = memoryview(data)
    while len(view):
        segment = Segment(view)
        yield segment
        view = view[segment.size + 1 :]


# ---- tokenizing -------------------------------------------------------------------------------------------------


def _is_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class WordEncoder:
    """Ids of whole texts, encoded word by word: the tokenizer drops white space and never joins across it.

    Texts are cut at spaces, line feeds, tabs and carriage returns only; other white space stays inside a piece and
    is left to the tokenizer. Latin texts are lower-cased first, as the tokenizer does, and closing punctuation, a
    token boundary for the tokenizer, is encoded apart, so that fewer different words remain. New Latin words are
    encoded many at a time and told apart by the ids that end a word. Other pieces are encoded one by one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, pieces: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False):
            yield np.array(e.ids, "<u4").tobytes()

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Words of Latin letters only, each one token group."""
        for i in range(0, len(words), 2000):
            part = words[i : i + 2000]
            data = next(self._encode([" ".join(part)]))
            cuts = 4 * (np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 1)
            if len(cuts) != len(part):
                yield from self._encode(part)
                continue
            a = 0
            for b in cuts.tolist():
                yield data[a:b]
                a = b

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text the ids as little-endian unsigned 32-bit integers."""
        lowered = [t.lower() if _is_latin(t) else t for t in texts]
        pieces = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in lowered]
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        split, words, others = [], set(), set()
        new = set().union(*pieces).difference(known)
        if older:
            back = {p: older[p] for p in new if p in older}
            known.update(back)
            new.difference_update(back)
        for piece in new:
            stem = piece.rstrip(string.punctuation)
            if stem.isalpha() and _is_latin(stem) and stem.islower():
                words.add(stem)
                if len(stem) < len(piece):
                    split.append((piece, stem))
                    others.add(piece[len(stem) :])
            else:
                others.add(piece)
        words, others = list(words.difference(known)), list(others.difference(known))
        known.update(zip(words, self._encode_words(words), strict=True))
        known.update(zip(others, self._encode(others), strict=True))
        for piece, stem in split:
            known[piece] = known[stem] + known[piece[len(stem) :]]
        get = known.__getitem__
        return [b"".join(map(get, ps)) for ps in pieces]


def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker process. It is kept in a module of its own name, made on the spot, as functions that
    travel by value leave nothing behind when a task ends."""
    import sys
    import types

    kept = vars(sys.modules.setdefault("tidewell_word_encoders", types.ModuleType("tidewell_word_encoders")))
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


# ---- operators --------------------------------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    order_by: list[str] | None = None,
    segment_tokens: int = 1 << 16,
) -> None:
    """Write the ids of every whole text, each followed by `end_id`, ordered by `order_by` (default the id).

    Rows are range-partitioned on the order with the text's hash as tie-breaker, so rows of one id can spread over
    several tasks; each task cuts its documents into segments of about `segment_tokens` ids (a longer document is a
    segment of its own). A null text is empty and gives the end id alone; a null id is kept and sorts first; repeated
    rows are all written. Other columns are not read. An empty table gives files without segments.
    """
    keys = order_by or [id_col]
    picked = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keys)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*picked, F.xxhash64(text).alias("__tie"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    order = [*(f"__k{i}" for i in range(len(keys))), "__tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer), struct.pack("<I", end_id)
        doc_ids, lengths, parts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            return pa.RecordBatch.from_arrays([pa.array([pack_segment(doc_ids, lengths, ids)], pa.binary())], names=["payload"])

        for batch in batches:
            for a, b, texts in slices(batch.column(1)):
                for doc_id, data in zip(batch.column(0).slice(a, b - a).to_pylist(), encode(texts), strict=True):
                    n = len(data) // 4 + 1
                    if parts and held + n > segment_tokens:
                        yield flush()
                        doc_ids, lengths, parts, held = [], [], [], 0
                    doc_ids.append(doc_id)
                    lengths.append(n)
                    parts += [data, end]
                    held += n
        if parts:
            yield flush()

    # The text sink writes the bytes of a string as they are; the cast relabels the binary payload.
    rows.mapInArrow(pack, "payload binary").select(F.col("payload").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", SEGMENTS_A_FILE).text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: file, place, doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it, over files in name order. Files are read whole, one at a
    time in a task; the per-file totals are one row a file.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                base = place = 0
                for segment in segments(content.as_buffer()):
                    ids, ends = segment.tokens.all(), np.cumsum(segment.lengths)
                    begins = ends - segment.lengths
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                    n = len(sums)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n, pa.string()), pa.array(range(place, place + n), pa.int64()), pa.array(segment.doc_ids, pa.int64()), pa.array(begins + base), pa.array(segment.lengths), pa.array(sums, pa.int64())],
                        names=["file", "place", "doc_id", "at", "n_tokens", "ids_crc32"],
                    )
                    base, place = base + int(segment.n_tokens), place + n

    rows = scratch.stored(files.mapInArrow(unpack, "file string, place long, doc_id long, at long, n_tokens long, ids_crc32 long"), "token-index")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return rows.join(before, "file").select("file", "place", "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_digest(docs: DataFrame, tokenizer: str, order_by: list[str] | None = None, end_id: int = 1) -> DataFrame:
    """Write the files in the shared folder, read them back, and describe each document's place and ids."""
    spark = docs.sparkSession
    path = scratch.new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id, order_by=order_by)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
