"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and returns a DataFrame that
is written as Parquet and read again as the next one's docs. All but the last return the columns of their input.

In every stage texts of any length count whole, further columns are kept under their names whatever these are, and an
empty table gives no rows. A row is a document: rows that share an id, or have none, are each judged by themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, langid, mixing, scratch, simhash, tokens
from tidewell.llm.queries import MIX_BLOCK, MIX_OTHER, MIX_WEIGHTS, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Rows that go to a Python worker at once. Spark's 10,000 whole texts lie several times over in each executor: in buffers on
# their way to the worker and back, and as lists of words.
ROWS_AT_ONCE = 1000


def _small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))


def _set_aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on `docs`, whose extra columns bear plain names meanwhile, so that none clashes with a result's."""
    _small_batches(docs.sparkSession)
    names = {c if c in COLUMNS else f"extra_{i}": c for i, c in enumerate(docs.columns)}
    done = work(docs.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()]))
    return done.select(*[F.col(n).alias(c) for n, c in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (so null and empty texts), and those whose calibrated score for every language is too
    low, go. Equal texts share their fate. Documents none of which has a lang are an error, as nothing can be learned."""
    _small_batches(spark)
    model = langid.train(docs, F.lit(True))
    if not model.labels and not docs.isEmpty():
        raise ValueError("no document has a language to learn from")
    return _set_aside(docs, lambda d: langid.identify(d, model).filter("not rejected"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints of at most 3 different bits the first stays: the smallest
    doc_id, null ids last, rows of one id by a hash of the row. Of equal rows one stays. Texts without words are one group."""
    return _set_aside(docs, simhash.deduplicate)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go. Null and empty texts have no words and stay; equal texts
    share their fate; without benchmark all stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _set_aside(docs, lambda d: decontaminate.decontaminate(d, benchmark).filter(F.size("hit_spans") == 0))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: by file name and row, which the next stage follows. Null sources are
    in the stream of all sources without a weight; rows of one id are ordered by a hash of the row."""
    return _set_aside(docs, lambda d: mixing.in_order(mixing.mix(d, MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK), d.columns))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture, read back: doc_id, start, n_tokens, ids_crc32. A null or empty text is
    the end token alone; repeated rows and null ids have a row each."""
    _small_batches(spark)
    placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))
    return tokens.token_digest(placed, tokenizer_path(), order_by=["file_name", "row_index"])


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("token_output", token_output),
]

# Trained models, tokenizers and linked groups are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
