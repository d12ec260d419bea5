"""The queries of this subpackage by key, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from merchlens.llm import chat_format, embedding_dedup, fingerprint, jaccard_join, language_id, license_scan, line_dedup, merkle, mixing, sentence_pieces, token_files, toxicity, turn_repair
from merchlens.session import scratch_path, tune

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    # Batches that Python workers take at once, by rows and by bytes.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digest(table(spark, sf_dir, "conversations"))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.coded_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_doc_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edited(table(spark, sf_dir, "documents"))


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path, summary=True)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_digest(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat_formatting, op2_sentence_pieces, op3_doc_fingerprints, op4_embedding_neardup, op5_toxicity, op6_license_scan, op7_source_mixing, op8_token_files, op9_line_dedup, op10_ngram_jaccard, op11_merkle_manifest, op12_turn_repair, op13_language_id)}
SQL: dict[str, str] = {"op1_chat_formatting": chat_format.SQL, "op4_embedding_neardup": embedding_dedup.SQL, "op9_line_dedup": line_dedup.SQL, "op10_ngram_jaccard": jaccard_join.SQL, "op11_merkle_manifest": merkle.SQL, "op12_turn_repair": turn_repair.SQL}
