"""A training-data pipeline over the operators of ``shoplens.llm``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame, which is written and read again for the next.
Columns of ``docs`` beyond those of ``documents`` pass through; an empty table
goes through empty; what a stage does with nulls, ties and repeated rows is
stated at its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import bpe, decontamination, near_dedup, pii, toxicity
from shoplens.llm.common import read_table, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It is fitted on the labelled
    rows of the table ``documents`` itself."""
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row stays, the one with the smallest doc_id (none
    comes last), whatever ids the others have.  Rows are told apart by a
    written key, so repeated rows and rows without an id link like any other;
    only rows without words link with nothing and stay."""
    keyed = stage(docs.withColumn("_llm_key", F.monotonically_increasing_id()), "keyed")
    found = near_dedup.near_duplicates(keyed.select(F.col("_llm_key").alias("doc_id"), "text"))
    ids = keyed.select("_llm_key", F.col("doc_id").alias("_llm_id"))
    first = F.struct(F.col("_llm_id").isNull(), "_llm_id", "_llm_key")
    kept = (
        found.select(F.col("doc_id").alias("_llm_key"), "component_id")
        .join(ids, "_llm_key")
        .groupBy("component_id")
        .agg(F.min_by("_llm_key", first).alias("_llm_key"))
    )
    return keyed.join(stage(kept.select("_llm_key"), "kept", keyed.count()), "_llm_key", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its personal data replaced by their kinds."""
    return pii.mask(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document."""
    return bpe.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("bpe", encode),
]

#: SQL expresses none of the trained, sketched or tokenizing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
