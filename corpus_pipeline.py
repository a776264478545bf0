"""Corpus pipeline: quality, near copies, repeated passages, mixture, packing. Part of the subpackage llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshare.llm import chaining, mixing, packing, quality, simhash
from nightshare.llm.common import saved, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; it learns from the labels of the documents it is given."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.good_label())
    rows = quality.classify(quality.with_evidence(docs, model), F.col("source"), F.col("lang"))
    return rows.where("quality_keep").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; of repeated rows of one id one stays."""
    groups = saved(simhash.near_copies(docs), "groups")
    once = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("first"))
    # Rows without an id cannot be told apart from each other and stay.
    gone = saved(once.where("doc_id <> first").select(F.col("doc_id").alias("_gone")), "gone")
    again = saved(once.where("doc_id = first and rows > 1").select(F.col("doc_id").alias("_again")), "again")
    kept = docs.join(gone, docs.doc_id == gone._gone, "left_anti")
    single = kept.join(again, kept.doc_id == again._again, "left_anti")
    return single.unionByName(kept.join(again, kept.doc_id == again._again, "left_semi").dropDuplicates(["doc_id"]))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; n_chars follows the text."""
    names = docs.columns
    texts = chaining.without_passages(docs, saved(chaining.passages(docs), "passages"))
    return texts.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix draws them."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences; the rows of the pipeline."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near copies", drop_near_copies),
    ("repeated passages", cut_passages),
    ("source mixture", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
