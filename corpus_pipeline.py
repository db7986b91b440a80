"""From raw documents to packed training sequences, in five stages.

Every stage is a function of (session, documents, directory of the tables). What it returns
is written as Parquet in the shared folder and read again as the documents of the next one;
all but the last return the columns of the table `documents`.

Rows are told apart by their id and text together, so repeated and NULL ids do no harm. A
NULL or empty text does not pass the quality rules. All stages take an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import crc_share, read_table, stage
from tradewind.llm.langid import identify, learn
from tradewind.llm.ngram_join import similar_documents
from tradewind.llm.packing import op2_best_fit_packing
from tradewind.llm.quality import apply_rules
from tradewind.llm.substring import repeated_passages, without_passages

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Texts whose language is this unsure are rejected; half one language and half another is 0.5.
LEAST_LANGUAGE_SCORE = 0.3


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return apply_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    model = learn(docs.where(crc_share(F.col("doc_id"), 5) != 0))
    return identify(docs, model, spans=False).where(
        (F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingle sets hold together."""
    keyed = docs.withColumn("_key", _row_key())
    similar = similar_documents(keyed.select(F.col("_key").alias("doc_id"), "text"))
    stays = similar.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    # Equal rows have equal keys, and one of them stays.
    return keyed.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that others have too; one document keeps each passage."""
    passages = repeated_passages(docs.select(_row_key().alias("doc_id"), "text"))
    return without_passages(docs, passages, _row_key()).withColumn(
        "n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return op2_best_fit_packing(docs)


STAGES = (
    ("quality_rules", quality),
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substrings),
    ("best_fit_packing", packed),
)
# Language identification, chaining and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
