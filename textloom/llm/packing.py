"""Length buckets of least padding, and batches of a token budget within them.

The histogram of lengths is counted over all documents; a dynamic program over it picks the
bucket lengths with the least padding. Sequences of a bucket are then numbered, by prefix sums
over small cells, and cut into batches of as many sequences as the token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import apart, stored

#: Number of buckets, longest sequence, tokens of a batch, and what bucket lengths are multiples of.
BUCKETS = 16
MAX_LENGTH = 4096
BUDGET = 65_536
ALIGN = 8
#: Sequences that one cell of the numbering holds, about, and the bits of the order that cut a cell of a bucket into runs.
CELL = 200_000
RUN_BITS = 6


def best_lengths(counts: dict[int, int], buckets: int) -> list[int]:
    """The bucket lengths, at most `buckets`, that pad the sequences least.

    `counts` has the number of sequences of each length. A bucket ends at a length that
    occurs, the last one at the longest. Cost of lengths i+1..j in one bucket:
    length j times their number, less their sum.
    """
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return []
    n = np.concatenate([[0], np.cumsum([counts[x] for x in lengths.tolist()])]).astype(np.float64)
    size = len(lengths)
    best = np.full(size + 1, np.inf)
    best[0] = 0.0
    choice = []
    for _ in range(min(buckets, size)):
        # to[j] = min over i < j of best[i] + lengths[j - 1] * (n[j] - n[i]): padded tokens; the sum of lengths is constant.
        after, came = best.copy(), np.full(size + 1, -1)
        for j in range(1, size + 1):
            cost = best[:j] + lengths[j - 1] * (n[j] - n[:j])
            i = int(np.argmin(cost))
            if cost[i] < after[j]:
                after[j], came[j] = cost[i], i
        choice.append(came)
        best = after
    found, j = [], size
    for came in reversed(choice):
        if j and came[j] >= 0:
            found.append(int(lengths[j - 1]))
            j = int(came[j])
    return sorted(found)


@apart
def pack(df: DataFrame, length: str, id: str = "doc_id", buckets: int = BUCKETS, max_length: int = MAX_LENGTH,
         budget: int = BUDGET, align: int = ALIGN, cell: int = CELL) -> DataFrame:
    """One row per sequence of at most `max_length` tokens: the columns of `df` and piece, start,
    n_tokens, bucket (its length), batch and slot.

    A longer row is cut into pieces of `max_length`, all kept. Rows of no, null or
    negative length have one piece of no tokens, in the shortest bucket. Batches are numbered from
    0 in each bucket; every batch of a bucket but the last holds `budget // bucket` sequences (at
    least one), slots counted from 0. Sequences are ordered by the hash of (id, piece), so a
    batch mixes sources; equal rows are packed each on its own. An empty table gives an empty
    result. Columns of `df` named like a result are replaced.

    Rows are sorted in runs, the ranges of their hashes within a cell: however many rows a bucket has, a task sorts
    some `cell` / 2^`RUN_BITS` of them. Lengths and ids are written first, since the histogram and the places of the
    runs need no more of a row.

    The driver holds the histogram: at most max_length / align counts, whatever the table.
    """
    n = F.greatest(F.coalesce(F.col(length).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    rounded = lambda c: (F.greatest(F.ceil(c / align), F.lit(1)) * align).cast("int")
    narrow = stored(df.select(F.col(id).alias("_id"), n.alias("_n")), "lengths")
    whole = F.floor(F.col("_n") / max_length)
    rest = F.col("_n") - whole * max_length
    last = rounded(F.lit(max_length))
    seen = narrow.select(whole.alias("whole"), rest.alias("rest"))
    counted = seen.select(F.explode(F.array(
        F.struct(last.alias("long"), F.col("whole").alias("n")),
        F.struct(rounded(F.col("rest")).alias("long"),
                 F.when((F.col("rest") > 0) | (F.col("whole") == 0), 1).otherwise(0).cast("bigint").alias("n")))).alias("c"))
    histogram = {r["long"]: r["n"] for r in
                 counted.groupBy("c.long").agg(F.sum("c.n").alias("n")).where("n > 0").collect()}
    lengths = best_lengths(histogram, buckets) or [align]

    made = {"piece", "start", "n_tokens", "bucket", "batch", "slot"}
    cells = max(1, sum(histogram.values()) // cell)

    def placed(rows: DataFrame, id: str) -> DataFrame:
        pieces = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("_n") / max_length) - 1, F.lit(0)).cast("bigint"))
        start = F.col("_piece") * max_length
        rows = rows.withColumn("_piece", F.explode(pieces)).withColumns(
            {"_start": start, "_tokens": F.least(F.col("_n") - start, F.lit(max_length))})
        bucket = F.lit(lengths[-1])
        for b in reversed(lengths[:-1]):
            bucket = F.when(F.col("_tokens") <= b, b).otherwise(bucket)
        order = F.xxhash64(F.col(id), F.col("_piece"))
        return rows.withColumns({"_bucket": bucket, "_order": order}).withColumns({
            "_cell": F.pmod(F.shiftright("_order", 20), F.lit(cells)), "_run": F.shiftright("_order", 64 - RUN_BITS)})

    rows = placed(df.withColumn("_n", n).drop(*made), id)
    before = Window.partitionBy("_bucket").orderBy("_cell", "_run").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed(narrow, "_id").groupBy("_bucket", "_cell", "_run").agg(F.count(F.lit(1)).alias("_count")).select(
        "_bucket", "_cell", "_run", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_bucket", "_cell", "_run").orderBy("_order", id, "_piece"))
    rows = rows.withColumn("_rank", inside - 1).join(bases, ["_bucket", "_cell", "_run"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("_bucket")))
    return rows.withColumns({
        "piece": F.col("_piece"), "start": F.col("_start"), "n_tokens": F.col("_tokens"), "bucket": F.col("_bucket"),
        "batch": F.floor(F.col("_rank") / fits).cast("bigint"), "slot": (F.col("_rank") % fits).cast("bigint"),
    }).drop("_n", "_piece", "_start", "_tokens", "_bucket", "_cell", "_run", "_order", "_rank", "_base")
