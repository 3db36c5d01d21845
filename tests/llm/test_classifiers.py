from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import langid, quality_knn, queries


def test_languages_are_told_apart(spark, docs, rows):
    held = langid.fold("doc_id", 5) == 0
    model = langid.train(docs, ~held)
    assert model.labels == ["de", "en"]
    found = langid.identify(docs, model, keep=["doc_id", "lang", "text"]).collect()
    assert len(found) == len(rows)
    for r in found:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in model.labels and 0 <= r.score <= 1
    judged = [r for r in found if r.doc_id is not None and r.doc_id < 60]
    assert sum(r.lang_pred == r.lang for r in judged) >= 0.95 * len(judged)


def test_training_does_not_depend_on_row_order(spark, docs):
    a = langid.train(docs, F.lit(True))
    b = langid.train(docs.repartition(7, "text"), F.lit(True))
    assert (a.table == b.table).all() and a.threshold == b.threshold


def test_numerals_are_no_letters():
    assert [langid.has_letter(t) for t in ("\u00bd 12", "\u00b2", "\u2167", "_ 7", "", "\u65e5", "7 \u00e9")] == [False] * 5 + [True] * 2


def test_a_rare_language_is_learned(spark, docs):
    rare = spark.createDataFrame([(5000 + i, "kwa zimu ntu bwe " * 20, "zz", "s") for i in range(3)], "doc_id long, text string, lang string, source string")
    both = docs.select("doc_id", "text", "lang", "source").union(rare)
    assert langid.train(both, F.lit(True), max_docs=30).labels == ["de", "en", "zz"]


@pytest.fixture(scope="module")
def small_tables(spark, docs, rows, tmp_path_factory):
    """A folder as the registered queries read it, and one with everything changed that no prediction may use."""
    folders = []
    for changed in (False, True):
        path = str(tmp_path_factory.mktemp("tables"))
        some = docs.filter("doc_id < 60").select("doc_id", "text", "lang", "source", "n_chars").dropDuplicates(["doc_id"])
        labels = spark.createDataFrame([(r[0], int(r[0] % 2), 0) for r in rows[:60]], "doc_id long, quality int, toxic int")
        if changed:
            some = some.withColumns({"source": F.lit("x"), "lang": F.when(langid.fold("doc_id", 5) == 0, F.lit("??")).otherwise(F.col("lang"))})
            labels = labels.withColumn("quality", F.when(langid.fold("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
        some.write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        folders.append(path)
    return folders


@pytest.mark.parametrize("name", ["op3_quality_votes", "op7_language_id"])
def test_held_out_labels_and_sources_are_not_used(spark, small_tables, name):
    a, b = (sorted(map(tuple, queries.QUERIES[name](spark, f).collect())) for f in small_tables)
    assert a == b and len({r[1] for r in a}) == 2


def test_votes_are_those_of_plain_loops():
    rng = np.random.default_rng(2)
    labelled = quality_knn._unit(rng.normal(size=(80, 5)))
    labelled[40:50] = labelled[:10]  # ties
    y, vectors = rng.integers(0, 2, 80).astype(float), quality_knn._unit(rng.normal(size=(30, 5)))
    vectors[:10] = labelled[:10]
    found = quality_knn.vote(vectors, labelled, y, 0.4)
    near = vectors @ labelled.T
    for i in range(30):
        edge = sorted(near[i])[-quality_knn.NEIGHBOURS]
        inside, level = [j for j in range(80) if near[i, j] > edge], [j for j in range(80) if near[i, j] == edge]
        votes = dict.fromkeys(inside, 1.0) | dict.fromkeys(level, (quality_knn.NEIGHBOURS - len(inside)) / len(level))
        weight = {j: v * max(near[i, j], 0) ** quality_knn.SHARPNESS for j, v in votes.items()}
        assert abs(found[i] - (sum(w * y[j] for j, w in weight.items()) + 0.2) / (sum(weight.values()) + 0.5)) < 1e-9


def test_no_labelled_rows_and_no_rows(spark, docs, no_docs):
    model = langid.train(docs, F.lit(False))
    assert {r.lang_pred for r in langid.identify(docs, model, keep=["doc_id"]).collect()} == {"und"}
    assert langid.identify(no_docs, langid.train(no_docs, F.lit(True))).count() == 0


def test_neighbours_vote(spark, docs, rows):
    junk = [(1000 + i, " ".join(w.upper() + "###" for w in (r[1] or "").split()), None, None, 0, *["x"] * 2, 1, *["x"] * 3) for i, r in enumerate(rows[:40])]
    both = docs.union(spark.createDataFrame(junk, docs.schema))
    labels = spark.createDataFrame([(r[0], 1) for r in rows[:60]] + [(j[0], 0) for j in junk] + [(0, 1), (1, None), (None, 1)], "doc_id long, quality int")
    model = quality_knn.fit(both, labels, langid.fold("doc_id", 4) != 2)
    found = quality_knn.classify(both, model, keep=["doc_id"]).collect()
    assert len(found) == both.count() and all(0 <= r.score <= 1 for r in found)
    score = {r.doc_id: r.score for r in found}
    right = [(score[r[0]] >= 0.7) for r in rows[:60] if len((r[1] or "").split()) > 10] + [score[j[0]] < 0.7 for j in junk if len(j[1].split()) > 10]
    assert sum(right) >= 0.95 * len(right)


def test_blocked_votes_equal_all_at_once(spark, docs, rows):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows[:60])], "doc_id long, quality int")
    model = quality_knn.fit(docs, labels, F.lit(True))
    a = {r.doc_id: r.score for r in quality_knn.classify(docs, model, block=7, keep=["doc_id"]).collect()}
    b = {r.doc_id: r.score for r in quality_knn.classify(docs, model, block=999, keep=["doc_id"]).collect()}
    assert all(abs(a[k] - b[k]) < 1e-5 for k in a)


def test_votes_without_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_knn.classify(docs, quality_knn.fit(docs, labels, F.lit(True)), keep=["doc_id"]).collect()} == {0.5}
    assert quality_knn.classify(no_docs, quality_knn.fit(no_docs, labels, F.lit(True))).count() == 0


def test_all_training_rows_are_learned_from(spark, docs, rows):
    """A row outside the sample changes the model; how rows are stored doesn't."""
    some = docs.select("doc_id", "text", "lang").filter("doc_id < 60")
    late = spark.createDataFrame([(9000 + i, f"qx{i} vwqx zkqj " * 30, "zz") for i in range(400)], "doc_id long, text string, lang string")
    both = some.union(late).union(late.selectExpr("doc_id + 1000", "concat(text, 'jjk ')", "'yy'"))
    a, b = (langid.train(x, F.lit(True), max_docs=40) for x in (both, both.repartition(7, "text")))
    assert (a.table == b.table).all() and (a.bias == b.bias).all() and a.threshold == b.threshold
    sample = {r.key for r in langid._sample(both, F.lit(True), 40, "doc_id", "text", "lang")[0].collect()}
    outside = next(r.doc_id for r in late.select("doc_id", F.xxhash64("text").alias("key")).orderBy("doc_id").collect() if r.key not in sample)
    changed = both.withColumn("text", F.when(F.col("doc_id") == outside, F.concat("text", F.lit(" bbbb"))).otherwise(F.col("text")))
    assert (langid.train(changed, F.lit(True), max_docs=40).table != a.table).any()
    assert a.labels == ["de", "en", "yy", "zz"]
