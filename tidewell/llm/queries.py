"""The registered queries of this subpackage: name → function(spark, sf_dir) → DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, hpylm, langid, mixing, oracles, periodic, pii, quality_knn, quality_rules, secret_scan, simhash, tokens, url_tree


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digest(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = langid.fold("doc_id", 4) == 2
    scored = quality_knn.classify(docs, quality_knn.fit(docs, labels, ~held_out), keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(_table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(docs, benchmark, keep=["doc_id"]))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = langid.fold("doc_id", 5) == 0
    found = langid.identify(docs, langid.train(docs, ~held_out), keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = langid.fold("doc_id", 7) == 2
    scored = hpylm.score(_table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents"), keep=["doc_id"]))


# Target weights of the mixture; all sources not named share one stream.
MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK = {"src0": 6, "src1": 3, "src2": 3, "src3": 2, "src4": 2}, 8, 16


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK).select("doc_id", "stream", "block", "slot", "place")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.plant(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic.digest(periodic.find_runs(docs, keep=["doc_id"]))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = _table(spark, sf_dir, "conversations")
    return conversations.digest(original, conversations.repair(conversations.damage(original)))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.find(docs, pii.train(docs), keep=["doc_id"]))


QUERIES = {f.__name__: f for f in (op1_token_codes, op2_quality_rules, op3_quality_votes, op4_url_templates, op5_simhash, op6_decontaminate, op7_language_id, op8_pitman_yor, op9_secret_scan, op10_mix_sources, op11_periodic_runs, op12_repair_conversations, op13_personal_data)}

# Trained models, tokenizers, linked groups and regular expressions' spans are beyond SQL: tests hold these queries
# against brute force, round trips and held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": oracles.quality_sql(),
    "op4_url_templates": url_tree.judge_sql(),
    "op6_decontaminate": oracles.decontaminate_sql(),
    "op10_mix_sources": mixing.mix_sql(MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK),
}
