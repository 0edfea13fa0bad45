"""Parquet in, typed parquet and JSON out, and the process-once ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.cleaning import strip


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def typed_tokens(df: DataFrame, *keep: str) -> DataFrame:
    """The token columns in their stored types, and nothing else but `keep`."""
    arrays = [F.col(c).cast("array<bigint>").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    length = [F.col("length").cast("int").alias("length")] if "length" in df.columns else []
    return df.select(*keep, *arrays, *length)


def write_tokens(df: DataFrame, path: str, *keep: str) -> None:
    typed_tokens(df, *keep).write.mode("overwrite").parquet(path)


def write_reports(reports: DataFrame, path: str) -> None:
    """One JSON object per report row."""
    reports.write.mode("overwrite").json(path)


def dataset_name(path: Column) -> Column:
    """Last part of the path without its extension; leading dots are part of the name."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(base, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def ledger_check(paths: DataFrame, path: str, ledger: DataFrame) -> DataFrame:
    """Each dataset name once, with `is_new`: whether the ledger does not list it yet."""
    names = paths.select(dataset_name(F.col(path)).alias("dataset_name")).distinct()
    listed = ledger.select(strip(F.col("dataset_name")).alias("dataset_name")).distinct().withColumn("_listed", F.lit(True))
    return names.join(listed, "dataset_name", "left").select("dataset_name", F.col("_listed").isNull().alias("is_new"))


LEDGER_SCHEMA = "dataset_name string, logged_at timestamp, claim string"


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Each listed name once: of several claims, as two writers at once leave them, the earliest counts."""
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    first = F.min(F.struct("logged_at", F.coalesce("claim", F.lit("")).alias("claim"))).alias("c")
    return rows.groupBy("dataset_name").agg(first).select("dataset_name", "c.*")


def append_ledger(paths: DataFrame, path: str, ledger_path: str) -> str:
    """Log the names that are not listed yet. Running it again adds nothing.

    The names are claimed: those that `read_ledger` gives with the returned claim are this call's, whoever else
    logged them meanwhile.
    """
    spark = paths.sparkSession
    return claim(ledger_check(paths, path, read_ledger(spark, ledger_path)).where("is_new"), ledger_path)


def claim(names: DataFrame, ledger_path: str) -> str:
    own = uuid.uuid4().hex
    names.select("dataset_name", F.current_timestamp().alias("logged_at"), F.lit(own).alias("claim")).write.mode("append").parquet(ledger_path)
    return own


def empty_ledger(spark: SparkSession, ledger_path: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(ledger_path)
