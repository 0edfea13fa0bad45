"""Corpus pipeline: quality rules, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on what the stage before kept; all but the last
return the columns of documents. Null ids, null texts and repeated rows are handled as the
operators define; the result of an empty table is empty.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import ngram_join, packing, quality, suffixes
from textloom.llm.common import apart, first_of, returned, small_batches, stored, words


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or whose host is rejected, go."""
    return quality.judge(docs).where("kept").select(*docs.columns)


@apart
def _one_of_each(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    # Different texts of one id are documents of their own: they get ids made of both.
    texts = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64(text)).alias("a"), F.max(F.xxhash64(text)).alias("z"))
    several = stored(texts.where("a <> z").select("doc_id", F.lit(True).alias("_several")), "several-texts")
    keyed = docs.join(several, "doc_id", "left").withColumn(
        "_key", F.when(F.col("_several"), F.xxhash64("doc_id", text)).otherwise(F.col("doc_id").cast("bigint"))).drop("_several")
    found = ngram_join.similar(keyed.select("_key", "text"), id="_key").where("_key IS NOT NULL")
    ids = keyed.where("_key IS NOT NULL").groupBy("_key").agg(F.min("doc_id").alias("_doc"), F.count(F.lit(1)).alias("_rows"))
    groups = found.select("_key", "component_id").distinct().join(ids, "_key")
    staying = groups.groupBy("component_id").agg(F.min(F.struct("_doc", "_key", "_rows")).alias("_s")).select("_s._key", "_s._rows")
    kept = keyed.join(stored(staying, "staying"), "_key", "left")
    once = kept.where("_key IS NULL OR _rows = 1")
    several_rows = first_of(kept.where("_rows > 1"), ["_key"], [F.xxhash64(*docs.columns)])
    return once.unionByName(several_rows).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity the one with the least id stays, with one row. Rows of a null
    id all stay; different texts of one id go only if they are linked with what stays."""
    return _one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a document of which nothing is left goes. Characters that a cut
    divides go too, and n_chars follows the text."""
    decode = F.pandas_udf(_decoded, "string").asNondeterministic()
    out = suffixes.dedup(docs).where("n_removed = 0 OR n_removed < n_bytes")
    out = out.withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(decode("kept")))
    return out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(
        F.length("text").cast("bigint"))).select(*docs.columns)


def _decoded(kept: pd.Series) -> pd.Series:
    out = kept.map(lambda b: None if b is None else b.decode("utf-8", "ignore"))
    returned()
    return out


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or pieces of long ones, in batches; lengths in words and one end token each."""
    return packing.pack(docs.withColumn("n_tokens", F.size(words(F.col("text"))) + 1), "n_tokens")


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages), ("length_buckets", length_buckets),
]

#: SQL cannot express the packing; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # Whole texts go to Python workers a few at a time: what a stage took there stays with the executor for the next.
        with small_batches(spark, suffixes.BATCH):
            docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
