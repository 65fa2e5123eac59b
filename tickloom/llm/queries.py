"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import best_positions, bm25_wand, byte_cnn, hnsw, label_shards, merkle_manifest, mixing, pii_weak, prefix_targets, simhash_vptree, substring_doubling, token_records, toxic_crf
from tickloom.llm.common import read

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token records written in the order of doc_id, as read back from their files."""
    return token_records.record_digest(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of even counts that keep equal texts together."""
    return label_shards.shard_rows(read(spark, sf_dir, "documents"))


def op3_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the tokens a conditional random field tags."""
    found = toxic_crf.held_out_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and its component of near duplicates."""
    return simhash_vptree.digest(read(spark, sf_dir, "documents"))


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a byte network that learns from three folds of four."""
    return byte_cnn.held_out_languages(read(spark, sf_dir, "documents"))


def op6_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items that documents hold, with the best passage of each."""
    return bm25_wand.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of every twentieth vector."""
    return hnsw.digest(read(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that occur elsewhere."""
    found = substring_doubling.dedup_substrings(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: strict spans, and those that labelers agree on."""
    return pii_weak.digest(read(spark, sf_dir, "documents"))


def op11_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn as an example of its own, digested by conversation."""
    return prefix_targets.format_and_digest(read(spark, sf_dir, "conversations"))


def op12_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty documents that rank highest for each test item."""
    return best_positions.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document, held against a tampered copy."""
    return merkle_manifest.tampered(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_records, op2_label_shards, op3_toxic_crf, op4_simhash_vptree, op5_byte_cnn, op6_bm25_wand,
                                    op7_hnsw, op8_mixing, op9_substring_dedup, op10_pii_weak, op11_prefix_targets, op12_best_positions,
                                    op13_merkle_manifest)
}
SQL: dict[str, str] = {"op8_mixing": mixing.MIX_SQL, "op9_substring_dedup": substring_doubling.DEDUP_SQL,
                       "op11_prefix_targets": prefix_targets.PREFIX_SQL, "op12_best_positions": best_positions.RANKED_SQL,
                       "op13_merkle_manifest": merkle_manifest.MANIFEST_SQL}
