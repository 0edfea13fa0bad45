"""Inputs shared by the queries: the given tables, and logs and catalogs derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def r6(c: Column | str, name: str) -> Column:
    """Rounded for comparison; the small shift keeps exact ties from depending on summation order."""
    return (F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6) + 0.0).alias(name)


def r6_sql(x: str, name: str) -> str:
    return f"round({x} + 1e-9, 6) + 0.0::DOUBLE AS {name}"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def marked(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """The text with markup in place of common words, so that every step finds work everywhere."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def marked_sql(text: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        text = f"replace({text}, {quoted(old)}, {quoted(new)})"
    return text


# ---- event log: run = user, order = event id, loss = value -----------------------------------

# Values have two decimals; odd factors keep them off exact ties, where the last bit of a sum
# (and so the order of summation) would decide a rounded figure.
LOSS_SCALE = 1.0001371733
EPOCH_STEP = 0.00700371
TOP_RATE = 1.0037173e-4


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step for every 40 events of all users, so a run has about one entry per step; some
    steps repeat."""
    seq = F.col("event_id")
    step = F.floor(seq / 40) + 1
    loss = F.col("value") * LOSS_SCALE
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), seq.alias("seq"), "event_type", step.alias("step"), loss.alias("loss"),
        (TOP_RATE * (1 + 0.05 * (seq % 3)) / (1 + step / 40)).alias("learning_rate"),
        (loss / 10).alias("grad_norm"), (step * EPOCH_STEP).alias("epoch"))


EVENT_LOG_SQL = f"""
event_log AS (
  SELECT user_id AS run_id, event_id AS seq, event_type, event_id // 40 + 1 AS step, value * {LOSS_SCALE}::DOUBLE AS loss,
         {TOP_RATE}::DOUBLE * (1 + 0.05::DOUBLE * (event_id % 3)) / (1 + (event_id // 40 + 1) / 40::DOUBLE) AS learning_rate,
         value * {LOSS_SCALE}::DOUBLE / 10 AS grad_norm, (event_id // 40 + 1) * {EPOCH_STEP}::DOUBLE AS epoch
  FROM events)
"""
