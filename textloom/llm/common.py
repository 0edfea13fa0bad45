"""Helpers shared by the operators: words, shared folders, hash keys, connected components."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import scratch_path

#: White space that separates words: the space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text: runs of anything but `SPACE`. No text, no words."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), SPACE[1:], " " * 5), " "), "")


def byte_length(text: Column) -> Column:
    """UTF-8 bytes of a text; 0 without one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: later passes do not compute it again,
    and a lost executor loses nothing of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that name their own columns with a leading underscore: columns of the caller that are
    named so go under another name meanwhile, wherever the arguments name them too."""
    @functools.wraps(operator)
    def run(df: DataFrame, *args, **named) -> DataFrame:  # noqa: ANN002, ANN003
        away: dict[str, str] = {}
        for c in df.columns:
            if c.startswith("_"):
                k = len(away)
                while f"own{k}{c}" in df.columns or f"own{k}{c}" in away.values():
                    k += 1
                away[c] = f"own{k}{c}"
        if not away:
            return operator(df, *args, **named)
        known = lambda x: away.get(x, x) if isinstance(x, str) else x
        out = operator(df.withColumnsRenamed(away), *map(known, args), **{k: known(v) for k, v in named.items()})
        return out.withColumnsRenamed({new: old for old, new in away.items()})

    return run


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run within it hand rows to Python in batches of about so many bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def returned() -> None:
    """Memory that this process has freed goes back to the system: workers outlive their tasks, and what they keep is
    missing in the executor, in later stages too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For functions of mapInArrow with large arrays: the worker returns their memory when the task ends."""
    @functools.wraps(run)
    def returning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            returned()

    return returning


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) links as (node, component); component is the least node.

    Alternates two steps on (u, v) pairs: every node's larger neighbours, then its smaller ones,
    are hung under its least neighbour, until the pairs are stars. The number of pairs never
    grows, and each step shuffles them by key with the minimum taken in partial aggregates first.
    Null ends and self-links are ignored. Nodes without links are not returned.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, name)
    signature = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        pairs = stored(small, name)
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == signature:
            break
        signature = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def first_of(df: DataFrame, keys: list[str], order: list, keep: int = 1) -> DataFrame:
    """The first rows of each key; Spark limits a group within the map tasks before it is shuffled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= keep).drop("_nth")


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
