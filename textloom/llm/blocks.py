"""Arrays on the move: numpy arrays dealt to partitions as binary cells, many values to a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal(part: np.ndarray, groups: list[np.ndarray], of: np.ndarray, values: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each partition number in `part`, which has one entry per value.

    `of` gives the group of each value (a document, mostly; ascending), `groups` arrays with one
    entry per group, `values` arrays with one entry per value. A row has the entries of its
    groups, the number of its values in each, and the values.
    """
    order = np.argsort(part, kind="stable")
    part, of = part[order], of[order]
    if not len(part):
        return pa.record_batch([pa.array([], pa.int32())] + [pa.array([], pa.binary())] * (len(groups) + len(values) + 1),
                               _names(len(groups), len(values)))
    run = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (of[1:] != of[:-1])]))
    counts = np.diff(np.append(run, len(part))).astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    edge = np.append(np.searchsorted(run, first), len(run))
    first = np.append(first, len(part))
    cells = [[g[of[run[a:z]]].tobytes() for a, z in zip(edge, edge[1:], strict=False)] for g in groups]
    cells.append([counts[a:z].tobytes() for a, z in zip(edge, edge[1:], strict=False)])
    for v in values:
        v = v[order]
        cells.append([v[a:z].tobytes() for a, z in zip(first, first[1:], strict=False)])
    return pa.record_batch([pa.array(part[first[:-1]].astype(np.int32))] + [pa.array(c, pa.binary()) for c in cells],
                           _names(len(groups), len(values)))


def _names(groups: int, values: int) -> list[str]:
    return ["part", *(f"g{k}" for k in range(groups)), "counts", *(f"v{k}" for k in range(values))]


def schema(groups: int, values: int) -> str:
    return ", ".join(["part int", *(f"{c} binary" for c in _names(groups, values)[1:])])


def together(df: DataFrame, parts: int) -> DataFrame:
    """Each partition number in a task of its own."""
    return df.repartitionById(parts, F.col("part"))


def gathered(batches: Iterator[pa.RecordBatch], kinds: list) -> list[np.ndarray]:
    """The arrays of all rows, joined: groups, counts (u4), values. `kinds` are their dtypes."""
    cells: list[list[np.ndarray]] = []
    for b in batches:
        for row in range(b.num_rows):
            cells.append([np.frombuffer(b.column(c)[row].as_buffer(), np.uint8) for c in range(1, b.num_columns)])
    return [np.concatenate([c[k] for c in cells]).view(kind) if cells else np.zeros(0, kind) for k, kind in enumerate(kinds)]
