"""A corpus pipeline: the stages in order, each over all that the one before it kept.

Every stage but the last returns the columns of ``documents``; ``n_chars``
follows the text where a stage changes it. The last returns the sampled piece
ids of every document left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import jaccard_join, line_dedup, mixing, queries, sentence_pieces, toxicity
from merchlens.session import stage

# The mix takes this share of the tokens that reach it, each document once at most.
MIX_SHARE = 0.9


def _beside(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns an operator needs beside the whole row, so that no column of the row can clash with one it makes."""
    return docs.select(F.struct("*").alias("whole_row"), *columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels outside the held-out fifth and drop documents that score one half or more."""
    labels = queries.table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    return toxicity.with_toxicity(_beside(docs, "text"), model).filter("score < 0.5").select("whole_row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents share, except in the last document that holds them."""
    kept = line_dedup.drop_repeated_lines(_beside(docs, "doc_id", "text"))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*[new.get(c, F.col("whole_row")[c]).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar shingle sets, keep the one with the smallest id."""
    return jaccard_join.keep_one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents so that tokens follow the weights of domains, languages and sources."""
    placed = _beside(docs, "doc_id", "text", "lang", "source", mixing.domain_of(F.col("source")).alias("domain"))
    return mixing.mix(placed, share=MIX_SHARE, max_epochs=1).select("whole_row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, and a digest of the text decoded from them."""
    return sentence_pieces.coded_documents(docs, queries.vocabulary("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("source mixing", mix_sources),
    ("SentencePiece", encode_pieces),
]

# The toxicity model and the sampled pieces cannot be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again,
    so that no later pass computes an earlier stage anew."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
