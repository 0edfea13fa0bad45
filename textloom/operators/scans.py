"""Ordered per-run computations without putting a whole run into one task.

A window over `partitionBy(run)` gives a run to one task, whatever its length. The helpers here
cut runs into chunks of bounded length instead: a position comes from bucket counts, a running
minimum or maximum from chunk values carried forward, and a moving window sees the rows next to
its chunk as copies (the halo). Only chunk totals, one row per some ten thousand log rows, are
ordered per run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16
_BITS = 18
#: Runs whose brackets of a median are sent to every task; those of more are joined.
BROADCAST_RUNS = 200_000


def index_rows(df: DataFrame, run: str, order: str, bits: int = _BITS, per_run: DataFrame | None = None) -> DataFrame:
    """Add `pos` (1, 2, ... within the run by `order`) and `n` (rows of the run).

    `order` is a counter: a whole number, unique within a run. Rows are numbered within buckets
    of 2^bits order values, so no task holds more than that of any run; only the bucket counts
    are ordered per run. The columns of `per_run`, one row per run, come along with the counts:
    joined to the rows by run alone, a long run would meet in one task.
    """
    rows = df.withColumn("_b", F.shiftright(F.col(order).cast("bigint"), bits))
    ahead = Window.partitionBy(run).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(run, "_b").agg(F.count(F.lit(1)).alias("_c")).select(
        run, "_b", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(run)).alias("n"))
    if per_run is not None:
        offsets = offsets.join(per_run, run)
    inside = F.row_number().over(Window.partitionBy(run, "_b").orderBy(order))
    return (
        rows.withColumn("_rn", inside)
        .join(offsets, [run, "_b"])
        .withColumn("pos", (F.col("_rn") + F.col("_off")).cast("bigint"))
        .drop("_b", "_rn", "_off")
    )


def chunk_of(length: Column | int) -> Column:
    """Number of the chunk that holds `pos`, for chunks of `length` rows."""
    return F.floor((F.col("pos") - 1) / length).cast("bigint")


def with_halo(df: DataFrame, before: Column | int, after: Column | int,
              length: Column | int = CHUNK) -> DataFrame:
    """Copy rows into neighbouring chunks: adds `_chunk` and `_home`.

    Chunk c holds its own rows (`_home`) plus `before` rows ahead of its first and `after` rows
    behind its last. Needs `pos` and `n`. With halos no longer than a chunk, a row is copied at
    most twice.
    """
    p = F.col("pos") - 1
    first = F.floor(F.greatest(p - after, F.lit(0)) / length)
    last = F.floor(F.least(p + before, F.col("n") - 1) / length)
    return df.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.col("_chunk") == chunk_of(length)
    )


def running(df: DataFrame, run: str, columns: dict[str, tuple[Column, str, bool]],
            length: Column | int = CHUNK) -> DataFrame:
    """Running minima and maxima along `pos`.

    columns: output name -> (value, "min" or "max", whether the row itself counts).
    """
    rows = df.withColumn("_k", chunk_of(length))
    for name, (value, _, _) in columns.items():
        rows = rows.withColumn(f"_v_{name}", value)
    agg = {"min": F.min, "max": F.max}
    pick = {"min": F.least, "max": F.greatest}
    ahead = Window.partitionBy(run).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(run, "_k")
        .agg(*[agg[how](f"_v_{name}").alias(f"_a_{name}") for name, (_, how, _) in columns.items()])
        .select(run, "_k", *[agg[how](f"_a_{name}").over(ahead).alias(f"_c_{name}")
                             for name, (_, how, _) in columns.items()])
    )
    inside = Window.partitionBy(run, "_k").orderBy("pos")
    for name, (_, how, own) in columns.items():
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
        rows = rows.withColumn(f"_i_{name}", agg[how](f"_v_{name}").over(frame))
    out = rows.join(carried, [run, "_k"])
    for name, (_, how, _) in columns.items():
        out = out.withColumn(name, pick[how](f"_c_{name}", f"_i_{name}"))  # both skip nulls
    return out.drop("_k", *[f"_{p}_{name}" for name in columns for p in "vci"])


def neighbours(df: DataFrame, run: str, columns: dict[str, tuple[str, int]],
               length: int = CHUNK) -> DataFrame:
    """Add values of rows `offset` places away: output -> (column, offset), negative = earlier."""
    before = max([0] + [-o for _, o in columns.values()])
    after = max([0] + [o for _, o in columns.values()])
    w = Window.partitionBy(run, "_chunk").orderBy("pos")
    out = with_halo(df, before, after, length)
    for name, (column, offset) in columns.items():
        out = out.withColumn(name, F.lag(column, -offset).over(w) if offset < 0 else F.lead(column, offset).over(w))
    return out.where("_home").drop("_chunk", "_home")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no group is cut: holds back one group at most."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        same = np.ones(table.num_rows, dtype=bool)
        for k in keys:
            same &= pc.equal(table[k], table[k][-1]).to_numpy(zero_copy_only=False).astype(bool)
        cut = 0 if same.all() else table.num_rows - int(np.argmin(same[::-1]))
        if cut == 0 and (not held or all(held[-1][k][-1] == table[k][0] for k in keys)):
            held.append(table)
            continue
        ready = [t for t in [*held, table.slice(0, cut)] if t.num_rows]
        held = [table.slice(cut)]
        yield pa.concat_tables(ready)
    if held:
        yield pa.concat_tables(held)


#: Ranks of the sketch that brackets a median, and how many of its errors the bracket is wide.
SKETCH = 2000
_SAFE = 4


def median_bracket(value: Column) -> Column:
    """An aggregate: two values between which the median lies, from a sketch that merges, and whether a value is NaN.

    The sketch's ranks are off by a share of 1 / `SKETCH` at most, which says nothing for few values: these are all between.
    """
    ranks = F.array(F.lit(0.5 - _SAFE / SKETCH), F.lit(0.5 + _SAFE / SKETCH))
    ends = F.when(F.count(value) <= SKETCH, F.array(F.min(value), F.max(value))).otherwise(F.percentile_approx(value, ranks, SKETCH))
    return F.struct(ends.alias("ends"), F.coalesce(F.max(F.isnan(value)), F.lit(False)).alias("odd"), F.count(value).alias("n"))


def exact_median(df: DataFrame, run: str, value: str, out: str = "median", brackets: DataFrame | None = None) -> DataFrame:
    """Exact median of `value` per run, without a run's values meeting in one task.

    One pass brackets the middle (`brackets`: run and `_bracket`, where it was made along with other aggregates), one
    counts what lies below the bracket and every distinct value within it. A run with a NaN has a median of NaN.
    """
    v = F.col("_v")
    rows = df.select(run, F.col(value).cast("double").alias("_v")).where(v.isNotNull())
    if brackets is None:
        brackets = rows.groupBy(run).agg(median_bracket(v).alias("_bracket"))
    few = F.broadcast(brackets) if brackets.count() <= BROADCAST_RUNS else brackets
    ends = F.col("_bracket.ends")
    low, high = ends[0], ends[1]
    place = F.when(v < low, F.lit(None)).otherwise(v)  # null: below the bracket
    counts = rows.join(few, run).where((v <= high) & ~F.col("_bracket.odd")).groupBy(run, place.alias("_x")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("_bracket.n").alias("_n"))
    after = F.sum("_c").over(Window.partitionBy(run).orderBy(F.col("_x").asc_nulls_first()))
    counts = counts.withColumn("_to", after)
    middle = lambda k: F.min(F.when(F.col("_to") >= k, F.struct("_to", "_x")))["_x"]
    found = counts.groupBy(run).agg(((middle(F.floor((F.col("_n") + 1) / 2)) + middle(F.floor(F.col("_n") / 2) + 1)) / 2).alias(out))
    return brackets.select(run, "_bracket").join(found, run, "left").select(
        run, F.when(F.col("_bracket.odd"), F.lit(float("nan"))).otherwise(F.col(out)).alias(out))
