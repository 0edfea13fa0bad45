"""Shards of near equal bytes by histogram sort.

Documents are ordered by (hash of the text, id), so equal texts are neighbours and the order says
nothing about the content. The shard boundaries are found by counting: all tasks count the
bytes below a set of candidate keys, the totals show between which two candidates each boundary
lies, and the next candidates are put there, until every boundary is within the tolerance. Only
then do the rows move, once, each straight to the range of keys that it belongs to.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import apart, stored

#: Candidate keys per open boundary and round.
PROBES = 64
#: A boundary may be off by this share of a shard's bytes, or else lies next to a single key.
TOLERANCE = 0.001
#: Bytes of a range that one task sorts.
RANGE_BYTES = 256 << 20

_HALF = 1 << 63


def _places(h: np.ndarray, i: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """For each key the number of probes at or below it. Probes are sorted (hash, id) pairs."""
    ph = np.array([p[0] for p in probes], np.int64)
    pi = np.array([p[1] for p in probes], np.int64)
    left, right = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
    place = left.copy()
    tied = np.flatnonzero(right > left)
    for at in np.unique(left[tied]):
        rows = tied[left[tied] == at]
        place[rows] = at + np.searchsorted(pi[at:right[rows[0]]], i[rows], "right")
    return place


def _histogram(keys: DataFrame, probes: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Bytes and rows in each gap between the probes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            h, i, s = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            place = _places(h, i, probes)
            np.add.at(size, place, s)
            rows += np.bincount(place, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.record_batch([pa.array(some), pa.array(size[some]), pa.array(rows[some])], ["gap", "size", "n"])

    found = keys.mapInArrow(count, "gap bigint, size bigint, n bigint").groupBy("gap").agg(
        F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    size, rows = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for r in found:
        size[r["gap"]], rows[r["gap"]] = r["size"], r["n"]
    return size, rows


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES
              ) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """Range boundaries of a (hash, id, size) table, the first rank in each range, and the shard of each range.

    The boundaries of the shards are among those of the ranges. A range is of at most `range_bytes`, or a single key.
    The driver holds the candidate keys with their counts: `PROBES` times the shards and rounds, and some for each
    `range_bytes` of the table.
    """
    total, low_id, high_id = keys.agg(F.sum("_size"), F.min("_id"), F.max("_id")).first()
    if total is None:
        return [], [0], [0]
    span = high_id - low_id + 1

    def key(n: int) -> tuple[int, int]:
        return n // span - _HALF, n % span + low_id

    below: dict[int, tuple[int, int]] = {0: (0, 0), (1 << 64) * span: (total, 0)}
    targets = [total * k // shards for k in range(1, shards)]
    cuts: dict[int, int] = {}
    ranges = max(shards, -(-total // range_bytes))
    probes = [n * (1 << 64) // (4 * ranges) * span for n in range(1, 4 * ranges)]
    while probes:
        probes = sorted(set(probes) - set(below))
        size, rows = _histogram(keys, [key(n) for n in probes])
        run = 0
        count = 0
        for n, s, r in zip(probes, size, rows, strict=False):
            run, count = run + s, count + r
            below[n] = (run, count)
        known = sorted(below)
        sums = [below[n][0] for n in known]
        probes = []
        for t in targets:
            at = bisect.bisect_right(sums, t)
            lo, hi = known[at - 1], known[min(at, len(known) - 1)]
            near = lo if t - below[lo][0] <= below[hi][0] - t else hi
            cuts[t] = near
            if abs(below[near][0] - t) > tolerance * total / shards and hi - lo > 1:
                probes += [lo + (hi - lo) * k // (PROBES + 1) for k in range(1, PROBES + 1)]
        for lo, hi in zip(known, known[1:], strict=False):
            # Neighbours with more between them than a task should sort, as in a large group of equal texts.
            inside = below[hi][0] - below[lo][0]
            if inside > range_bytes and hi - lo > 1:
                k = min(PROBES, 2 * -(-inside // range_bytes))
                probes += [lo + (hi - lo) * j // (k + 1) for j in range(1, k + 1)]
        probes = [n for n in set(probes) if n not in below]
    chosen, last, before = [], 0, None
    edges = set(cuts.values()) - {0, (1 << 64) * span}
    for n in sorted(n for n in below if 0 < n):
        if before is not None and below[n][0] - last > range_bytes and below[before][0] > last:
            chosen.append(before)
            last = below[before][0]
        if n in edges:
            chosen.append(n)
            last, before = below[n][0], None
        else:
            before = n
    chosen = [n for n in chosen if n < (1 << 64) * span]
    cut_list = [cuts[t] for t in targets]
    starts = [0, *(below[n][1] for n in chosen)]
    return [key(n) for n in chosen], starts, [bisect.bisect_right(cut_list, n) for n in [0, *chosen]]


@apart
def shard(df: DataFrame, size: str, shards: int, id: str = "doc_id", group: str = "text",
          tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All rows of `df` with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Rows are ordered by the 64-bit hash of `group` and by `id`, a whole number; the bytes in
    `size` of the shards are equal up to `tolerance`, or up to one key where a single key weighs
    more. A group of equal texts stays together unless a boundary falls into it, and then it is
    divided by id, so no group is too large for a shard. Rows of one (group, id) are one key and
    stay in one shard. A null group is a group, a null id comes first in it, a null size counts 0.
    An empty table gives an empty result. Columns named shard or slot are replaced.
    """
    low = F.lit(-_HALF).cast("bigint")
    keyed = df.withColumns({"_hash": F.xxhash64(F.col(group)), "_id": F.coalesce(F.col(id).cast("bigint"), low),
                            "_size": F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint"))})
    keys = stored(keyed.select("_hash", "_id", "_size"), "shard-keys")
    bounds, starts, shard_of = splitters(keys, shards, tolerance, range_bytes)
    first = {}
    for s, n in zip(shard_of, starts, strict=True):
        first.setdefault(s, n)
    offsets = [n - first[s] for s, n in zip(shard_of, starts, strict=True)]

    @F.pandas_udf("int")
    def range_of(h, i):  # noqa: ANN001, ANN202
        import pandas as pd
        return pd.Series(_places(h.to_numpy(), i.to_numpy(), bounds).astype(np.int32))

    placed = keyed.drop("shard", "slot").withColumn("_range", range_of("_hash", "_id"))
    placed = placed.repartitionById(len(bounds) + 1, F.col("_range")).sortWithinPartitions("_hash", "_id")
    kept = [f for f in placed.schema.fields if f.name not in ("_hash", "_id", "_size", "_range")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for b in batches:
            if not b.num_rows:
                continue
            r = b.column(b.schema.get_field_index("_range"))[0].as_py()
            slot = np.arange(done, done + b.num_rows, dtype=np.int64) + offsets[r]
            done += b.num_rows
            columns = [b.column(b.schema.get_field_index(f.name)) for f in kept]
            shard = pa.array(np.full(b.num_rows, shard_of[r], np.int32))
            yield pa.record_batch([*columns, shard, pa.array(slot)], [*(f.name for f in kept), "shard", "slot"])

    schema = type(placed.schema)([*kept]).add("shard", "integer").add("slot", "long")
    return placed.mapInArrow(number, schema)
