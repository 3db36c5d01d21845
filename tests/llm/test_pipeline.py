from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import langid, scratch


@pytest.fixture(scope="module")
def folder(spark, docs, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    text = " ".join(rows[7][1].split()[:15])
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, rows):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = scratch.stored(stage(spark, docs, folder), name)
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "token_output":
            assert docs.columns == columns
    letters = [r[0] for r in rows if langid.has_letter(r[1] or "")]
    assert set(kept["language"]) <= set(letters) and len(kept["language"]) >= len(letters) - 1
    assert {65, 66}.isdisjoint(kept["near_dedup"]) and kept["near_dedup"].count(5) == 1 and None not in kept["near_dedup"]
    assert set(kept["near_dedup"]) - set(kept["decontaminated"]) == {7}
    assert sorted(kept["mixed"], key=str) == sorted(kept["decontaminated"], key=str) == sorted(kept["token_output"], key=str)


def test_tokens_follow_the_mixture(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60").dropDuplicates(["doc_id"])
    mixed = scratch.stored(corpus_pipeline.mixed(spark, docs, folder), "mixed")
    placed = mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").toPandas().sort_values(["file_name", "row_index"])
    found = corpus_pipeline.token_output(spark, mixed, folder).toPandas().sort_values("start")
    assert found.doc_id.tolist() == placed.doc_id.tolist()
    from tidewell.llm import mixing
    from tidewell.llm.queries import MIX_BLOCK, MIX_OTHER, MIX_WEIGHTS

    order = mixing.mix(docs.select("doc_id", "source"), MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK).toPandas().sort_values(["slot", "place"])
    assert placed.doc_id.tolist() == order.doc_id.tolist()
    assert isinstance(found, pd.DataFrame)


def test_no_language_to_learn_is_an_error(spark, docs):
    with pytest.raises(ValueError, match="language"):
        corpus_pipeline.language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")


def test_rows_of_one_id_are_documents_of_their_own(spark, docs, rows, folder):
    """Two texts of one id, and texts without id, pass every stage that keeps documents."""
    texts = [rows[i][1] for i in (9, 11, 13, 15)]
    odd = spark.createDataFrame([(7000, texts[0], "en", "src0", 1), (7000, texts[1], "en", "src0", 1), (None, texts[2], "en", "src1", 1), (None, texts[3], "en", None, 1)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name in ("near_dedup", "decontaminated", "mixed"):
        odd = scratch.stored(dict(corpus_pipeline.STAGES)[name](spark, odd, folder), name)
        assert sorted(r.text for r in odd.collect()) == sorted(texts)
    assert corpus_pipeline.token_output(spark, odd, folder).count() == 4


def test_pipeline_on_nothing(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["mixed", "token_output"])
def test_few_texts_are_in_a_worker_at_once(spark, docs, folder, name):
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "10000")
        dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        sizes = spark.range(5000, numPartitions=1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in bs), "id long")
        assert {r.id for r in sizes.collect()} == {corpus_pipeline.ROWS_AT_ONCE}
        spark.conf.set(conf, "10")
        dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert spark.conf.get(conf) == "10"  # a smaller choice stays
    finally:
        spark.conf.set(conf, before)
