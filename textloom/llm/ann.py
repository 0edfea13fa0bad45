"""Nearest neighbours by largest inner product, with a forest of random-projection trees.

Inner product becomes distance by one more component: vectors get sqrt(M^2 - |v|^2), M the
largest norm, and queries 0. Trees halve the space at the median of a projection on the line
between two random vectors. They are fitted on a bounded sample; every vector is put into a leaf
of every tree. A query keeps one priority queue for all trees, ordered by the squared distance to
the halves it has not entered, and opens leaves until they hold a given share of the rows. Tasks
own ranges of leaves: they hold their vectors, and the queries that opened a leaf there come by
and are reranked with exact products.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import first_of, stored

#: Vectors that the trees are fitted on, trees, and sample vectors in a leaf.
FIT = 8192
TREES = 8
LEAF = 32
#: A query opens leaves until they hold this share of all rows, over all trees together, and this
#: many rows for each result and tree. The share is for vectors without much structure, whose
#: neighbours lie in all directions; clustered ones need far less for the same recall.
SHARE = 1.0
LEAST = 32
#: Rows of one task, and of the largest piece of a leaf.
TASK_ROWS = 40_000
PIECE_ROWS = 20_000

_DEALT = ["task", "kind", "id", "v", "leaves"]

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def fit_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """normals, thresholds, children (node >= 0, or -1 - leaf), number of leaves. Node 0 is the root."""
    normals, thresholds, children, leaves = [], [], [], 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            w = a - b
            if not w.any():
                w = rng.normal(size=sample.shape[1])
            w /= np.linalg.norm(w)
            p = sample[rows] @ w
            t = float(np.median(p))
            left, right = rows[p <= t], rows[p > t]
            if len(left) and len(right):
                node = len(normals)
                normals.append(w)
                thresholds.append(t)
                children.append([0, 0])
                children[node] = [grow(left), grow(right)]
                return node
        leaves += 1
        return -leaves

    grow(np.arange(len(sample)))
    return (np.array(normals).reshape(-1, sample.shape[1]), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2),
            leaves)


def leaves_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    normals, thresholds, children, _ = tree
    if not len(normals):
        return np.zeros(len(vectors), np.int64)
    node = np.zeros(len(vectors), np.int64)
    while (at := np.flatnonzero(node >= 0)).size:
        n = node[at]
        side = np.einsum("ij,ij->i", vectors[at], normals[n]) > thresholds[n]
        node[at] = children[n, side.astype(np.int64)]
    return -1 - node


def search(forest: list[Tree], first: list[int], counts: list[int], query: np.ndarray, want: float) -> list[int]:
    """The leaves a query opens, through one queue for all trees."""
    margins = [t[0] @ query - t[1] for t in forest]
    queue = [(0.0, t, 0 if len(tree[0]) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    found, seen = [], 0
    while queue and seen < want:
        far, t, node = heapq.heappop(queue)
        if node < 0:
            found.append(first[t] - 1 - node)
            seen += counts[found[-1]]
            continue
        m = margins[t][node]
        left, right = forest[t][2][node]
        heapq.heappush(queue, (far + max(m, 0.0) ** 2, t, int(left)))
        heapq.heappush(queue, (far + max(-m, 0.0) ** 2, t, int(right)))
    return found


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


class _Best:
    """The best `k` candidates of each query of a block, and those that rounding could put among them."""

    def __init__(self, queries: int, rows: int, k: int) -> None:
        self.k, self.rows, self.bar = k, rows, np.full(queries, -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, queries: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        """scores: rows x queries, from a matrix product."""
        r, q = np.nonzero(scores > self.bar[queries])
        self.found.append((queries[q] * self.rows + rows[r], scores[r, q]))
        self.size += len(q)
        if self.size > 1_000_000:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all kept pairs, each once."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair, first = np.unique(np.concatenate([f[0] for f in self.found]), return_index=True)
        s = np.concatenate([f[1] for f in self.found])[first]
        q = pair // self.rows
        order = np.lexsort((-s, q))
        pair, s, q = pair[order], s[order], q[order]
        begin = np.searchsorted(q, q, "left")
        last = begin + self.k - 1
        enough = np.searchsorted(q, q, "right") > last
        bar = np.where(enough, s[np.minimum(last, len(s) - 1)], -np.inf)
        bar = np.where(enough, bar - 1e-9 * (1 + np.abs(bar)), bar)
        self.bar[q] = bar
        keep = s > bar
        self.found, self.size = [(pair[keep], s[keep])], int(keep.sum())
        return q[keep], pair[keep] % self.rows


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding",
            share: float = SHARE, trees: int = TREES, fit: int = FIT, leaf: int = LEAF,
            task_rows: int = TASK_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the `k` rows of largest inner product that the search finds.

    Both tables have `id` (a whole number) and `vector` (an array of numbers). A query is not its own
    candidate: rows with its id are left out. Equal scores are ranked by smaller id; fewer
    candidates give fewer rows. Rows with a null id, or a vector that is null, empty, zero, has
    null or non-finite components, or another length than most, take no part. Of equal vectors the
    k + 1 with the smallest ids stand for all: the others cannot be in any result. Repeated rows of
    one (id, vector) are one. Empty tables give an empty result; other columns are not read.

    The driver holds the sample, the trees and a count for each leaf and task.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    sound = (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) \
        & F.exists(v, lambda x: x != 0)

    def plain(df: DataFrame) -> DataFrame:
        # Zero has one form only, so that equal vectors are equal arrays.
        return df.select(F.col(id).cast("bigint").alias("id"), F.transform(F.col(vector), lambda x: x.cast("double") + 0.0).alias("v")
                         ).where(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False)))

    rows = plain(vectors)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["d"]
    rows = stored(first_of(rows.where(F.size("v") == dims).distinct(), ["v"], [F.col("id")], k + 1), "ann-rows")
    asked = plain(queries).where(F.size("v") == dims).distinct()

    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(fit).select("v").collect()], np.float64)

    def lifted(m: np.ndarray) -> np.ndarray:
        return np.column_stack([m, np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", m, m), 0.0))])

    rng = np.random.default_rng(7)
    forest = [fit_tree(lifted(sample), leaf, rng) for _ in range(trees)]
    first = np.concatenate([[0], np.cumsum([t[3] for t in forest])]).tolist()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = lifted(_matrix(b.column(1), dims))
            leaves = np.stack([leaves_of(t, m) + f for t, f in zip(forest, first, strict=False)], axis=1)
            offsets = pa.array(np.arange(0, leaves.size + 1, trees, dtype=np.int32))
            yield pa.record_batch([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(leaves.ravel().astype(np.int32)))],
                                  ["id", "v", "leaves"])

    located = stored(rows.mapInArrow(locate, "id bigint, v array<double>, leaves array<int>"), "ann-leaves")
    counts = [0] * first[-1]
    for r in located.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]
    # Leaves in order, a large one in several pieces, are dealt to tasks of about `task_rows` rows.
    pieces = np.maximum(1, -(-np.array(counts) // piece_rows))
    base = np.concatenate([[0], np.cumsum(pieces)])
    load = np.repeat(np.array(counts) / pieces, pieces)
    task_of = ((np.cumsum(load) - load) // task_rows).astype(np.int64)
    tasks = int(task_of[-1]) + 1

    want = max(share * total, LEAST * k * trees)

    def dealt(b: pa.RecordBatch, kind: int, row: np.ndarray, piece: np.ndarray) -> pa.RecordBatch:
        """Each row once for each task that owns one of its pieces, with these."""
        task = task_of[piece]
        order = np.lexsort((piece, row, task))
        row, piece, task = row[order], piece[order], task[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (task[1:] != task[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(fresh)
        take = pa.array(row[first])
        return pa.record_batch([
            pa.array(task[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int32)), b.column(0).take(take),
            b.column(1).take(take), pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)),
                                                             pa.array(piece.astype(np.int32)))], _DEALT)

    def send_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), trees)
            yield dealt(b, 0, row, base[own] + b.column(0).to_numpy()[row] % pieces[own])

    def send_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.column_stack([_matrix(b.column(1), dims), np.zeros(b.num_rows)])
            opened = [np.array(search(forest, first, counts, x, want), np.int64) for x in m]
            row, own = np.repeat(np.arange(len(m)), [len(o) for o in opened]), np.concatenate([*opened, np.zeros(0, np.int64)])
            every = np.arange(pieces[own].sum()) - np.repeat(np.cumsum(pieces[own]) - pieces[own], pieces[own])
            yield dealt(b, 1, np.repeat(row, pieces[own]), np.repeat(base[own], pieces[own]) + every)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        held = None

        def hold() -> tuple:
            ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            m = np.concatenate([p[1] for p in parts]) if parts else np.zeros((0, dims))
            of = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
            counts = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(ids)), counts)
            order = np.argsort(of, kind="stable")
            return ids, m, of[order], row[order]

        for whole in batches:
            kinds = whole.column(1).to_numpy()
            for kind in (0, 1):
                b = whole.filter(pa.array(kinds == kind))
                if not b.num_rows:
                    continue
                ids, m = b.column(2).to_numpy(), _matrix(b.column(3), dims)
                of, lengths = b.column(4).flatten().to_numpy().astype(np.int64), np.diff(b.column(4).offsets.to_numpy())
                if kind == 0:
                    parts.append((ids, m, of, lengths))
                    continue
                held = held or hold()
                own_ids, own, piece, row = held
                best = _Best(len(ids), len(own_ids), k)
                q_of = np.repeat(np.arange(len(ids)), lengths)
                order = np.argsort(of, kind="stable")
                of, q_of = of[order], q_of[order]
                opened, at = np.unique(of, return_index=True)
                place = {i: n for n, i in enumerate(own_ids.tolist())}
                self_row = np.array([place.get(i, -1) for i in ids.tolist()])
                for p, a, z in zip(opened, at, [*at[1:], len(of)], strict=True):
                    r = row[np.searchsorted(piece, p):np.searchsorted(piece, p, "right")]
                    for x in range(0, len(r), 2048):
                        for y in range(a, z, 2048):
                            q, rows_here = q_of[y:min(y + 2048, z)], r[x:x + 2048]
                            s = own[rows_here] @ m[q].T
                            at_row = np.searchsorted(rows_here, self_row[q]).clip(max=len(rows_here) - 1)
                            mine = np.flatnonzero(rows_here[at_row] == self_row[q])
                            s[at_row[mine], mine] = -np.inf
                            if len(place) < len(own_ids):  # several vectors of one id
                                s[own_ids[rows_here][:, None] == ids[q][None, :]] = -np.inf
                            best.add(q, rows_here, s)
                q, r = best.settle()
                s = np.concatenate([np.sum(own[r[x:x + 65536]] * m[q[x:x + 65536]], axis=1) for x in range(0, len(q), 65536)]
                                   or [np.zeros(0)])
                other = own_ids[r] != ids[q]
                yield pa.record_batch([pa.array(ids[q][other]), pa.array(own_ids[r][other]), pa.array(s[other])],
                                      ["query_id", "vec_id", "score"])

    fields = "task int, kind int, id bigint, v array<double>, leaves array<int>"
    both = located.mapInArrow(send_rows, fields).unionByName(asked.mapInArrow(send_queries, fields))
    both = both.repartitionById(tasks, F.col("task")).sortWithinPartitions("kind")
    found = both.mapInArrow(rerank, "query_id bigint, vec_id bigint, score double").distinct()
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
