"""The corpus operators as queries over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.llm import chat, decontam, embed_dedup, langid, mixing, quality, sharding, simhash, tokens, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95 or more, and their components."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op2_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law ``rows``."""
    return sharding.interleave(table(spark, sf_dir, "documents"), shards=16)


#: The contract's added conversation: texts that look like marks.
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_fsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(added)), ordered=True)


def op4_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and components of those within 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_wu_manber_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in a ten-word window of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), size=10)
    return decontam.verdicts(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the curriculum takes of each document, and position and rank of its first copy (null if nothing)."""
    order = mixing.training_ranks(mixing.curriculum(table(spark, sf_dir, "documents")))
    first = order.filter("copy is null or copy = 0")
    return first.select("doc_id", "size", "source_size", "target", "taken", F.col("position").alias("first_position"), "training_rank")


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents, and the half that resampling keeps."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), share=0.5)


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language predictions of all documents."""
    return langid.predict_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_token_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as segment files and read back from them."""
    return tokens.token_index(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_embedding_hnsw, op2_stratified_shards, op3_chat_fsm, op4_simhash_bktree, op5_wu_manber_decontam, op6_curriculum_mix, op7_importance_resampling, op8_toxicity_cnn, op9_language_bitmask, op10_token_segments]
    return {f.__name__: f for f in found}
