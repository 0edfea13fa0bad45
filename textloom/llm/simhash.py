"""Near duplicates by SimHash: links at a small Hamming distance, found by the generalised pigeonhole principle.

A fingerprint bit is set if it is set in over half the hashes of a text's word shingles, repeats included.
Equal fingerprints become one point. The 64 bits are cut into partitions, bits that go together over all
points into the same one. If two points differ in at most `near` bits, then for any thresholds t whose t + 1 add up
to near + 1 some partition has at most t differing bits; so every point may choose its own thresholds, -1 for a
partition that it need not look at. It takes those of least estimated cost, by dynamic programming over the
partitions: probes to send, and candidates to meet. How many points lie at which distance of a value is estimated
from exact histograms of at most 8 bits each over all points. The number of partitions is the one of
least cost summed over all points.

Points are filed under the value of each partition, and probe all values within their thresholds. Every
candidate is verified; of the links met together only those are kept that span their components. A value met by
more than `BLOCK` rows is cut into blocks by point. First a block is probed by its own points only. Then,
with the components found so far, the points of the largest component of a value need not probe it: whoever is
outside does, in all blocks, and each point finds all its links by itself. Components are ranked once for all
values, so of two points never both stay away.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import components, stored
from textloom.llm.shingles import text_slices

WIDTH = 4
SEED = 42
BITS = 64
NEAR = 4
#: Rows of one value that meet in a task; more are cut into blocks.
BLOCK = 4096
#: A probe costs as much as so many candidates.
PROBE = 20
PARTITIONS = range(2, 7)
#: Values with blocks are sent to every task up to this many, else joined.
BROADCAST_VALUES = 100_000
#: Bytes of a text taken at a time, shingles counted together, candidates verified together.
PIECE = 1 << 20
COUNTED = 1 << 16
TOGETHER = 1 << 20

_SPACE = re.compile(rb"[ \x09-\x0d]")
#: The bits of a byte, highest first, as eight counters of a byte each.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _digests(text: bytes, width: int) -> Iterator[bytes]:
    """Hashes of all shingles, eight bytes each, highest first; a long text is read piece by piece."""
    from xxhash import xxh64_digest
    at, words, some = 0, [], False
    while at < len(text):
        end = at + PIECE
        found = _SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        words += text[at:end].lower().split()
        at = end
        if len(words) >= width:
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            yield b"".join([xxh64_digest(joined[a:z - 1], SEED) for a, z in zip([0, *ends], ends[width - 1:], strict=False)])
            words, some = words[len(words) - width + 1:], True
    if words and not some:
        yield xxh64_digest(b" ".join(words), SEED)


def _counts(digests: bytes, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set in the hashes of every group; groups begin at `starts`."""
    rows = _SPREAD[np.frombuffer(digests, np.uint8)].reshape(-1, 8)
    size = np.diff(np.append(starts, len(rows)))
    # Counters of a byte hold 255 hashes.
    runs = -(-size // 255)
    first = np.cumsum(runs) - runs
    cut = np.repeat(starts - first * 255, runs) + np.arange(runs.sum()) * 255
    part = np.add.reduceat(rows, cut, axis=0).view(np.uint8).reshape(-1, BITS)
    return np.add.reduceat(part, first, axis=0, dtype=np.int64)


def fingerprints(column: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of each text; 0 without words."""
    counts, total = np.zeros((len(column), BITS), np.int64), np.zeros(len(column), np.int64)
    held: list[bytes] = []
    starts: list[int] = []
    of: list[int] = []
    size = 0

    def settle() -> None:
        if held:
            np.add.at(counts, of, _counts(b"".join(held), np.array(starts)))
        for x in (held, starts, of):
            x.clear()

    for k, text in enumerate(column):
        body = text.as_buffer() if text.is_valid else None
        for found in _digests(body.to_pybytes(), width) if body is not None else ():
            held.append(found)
            starts.append(size)
            of.append(k)
            size += len(found) // 8
            total[k] += len(found) // 8
            if size >= COUNTED:
                settle()
                size = 0
    settle()
    bits = np.packbits(2 * counts > total[:, None], axis=1)
    return bits.reshape(-1).view(">u8").astype(np.uint64)


def signatures(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 1) if whole.num_rows else []:
                yield pa.record_batch([b.column(0), pa.array(fingerprints(b.column(1), width).view(np.int64))], ["doc", "fp"])

    return docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc bigint, fp bigint")


def _summed(points: DataFrame, size: int, add) -> np.ndarray:  # noqa: ANN001
    """Sums of the `size` numbers that `add(fingerprints)` gives, over all points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += add(b.column(0).to_numpy().view(np.uint64))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["at", "v"])

    out = np.zeros(size)
    for r in points.select("fp").mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


def _together(fp: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    return (bits.T @ bits).astype(np.float64).ravel()


def grouped(together: np.ndarray, total: float, parts: int) -> list[list[int]]:
    """The bits in `parts` groups of near equal size. A group begins with the bit most tied to those that are left, and
    takes the one most tied to it, again and again."""
    c = together.reshape(BITS, BITS) / max(total, 1.0)
    p = np.diag(c)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((c - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS * (k + 1) // parts - BITS * k // parts
        own: list[int] = []
        while len(own) < size:
            best = max(left, key=lambda b: (tie[b, own or left].sum(), -b))  # noqa: B023
            left.remove(best)
            own.append(best)
        out.append(own)
    return out


@dataclass
class Layout:
    """One way to cut the bits, and what the thresholds of a point cost under it."""

    parts: list[list[int]]
    near: int
    #: Of each partition its pieces of at most 8 bits, and for those the points at each distance of each value.
    pieces: list[list[list[int]]] = field(init=False)
    tables: list[list[np.ndarray]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.pieces = [[p[k:k + 8] for k in range(0, len(p), 8)] for p in self.parts]

    @property
    def size(self) -> int:
        return sum(256 for p in self.pieces for _ in p)

    @staticmethod
    def _value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
        out = np.zeros(len(fp), np.int64)
        for k, b in enumerate(bits):
            out |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
        return out

    def histogram(self, fp: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self._value(fp, bits), minlength=256) for p in self.pieces for bits in p])

    def learn(self, histogram: np.ndarray, points: float) -> None:
        at = 0
        for p in self.pieces:
            self.tables.append([])
            for bits in p:
                share = np.zeros((self.near + 1, 256))
                share[0] = histogram[at:at + 256] / points
                for k in range(len(bits)):
                    # Whoever differs in this bit too is one further away.
                    share[1:] += share[:-1, np.arange(256) ^ (1 << k)].copy()
                self.tables[-1].append(share)
                at += 256

    def costs(self, fp: np.ndarray, points: float) -> np.ndarray:
        """(partition, threshold + 1, point): probes and candidates; nothing for threshold -1."""
        out = np.zeros((len(self.parts), self.near + 2, len(fp)))
        for i, (bits, pieces, tables) in enumerate(zip(self.parts, self.pieces, self.tables, strict=True)):
            at = np.zeros((self.near + 1, len(fp)))
            at[0] = 1
            for own, share in zip(pieces, tables, strict=True):
                step = share[:, self._value(fp, own)]
                at = np.stack([sum(at[a] * step[d - a] for a in range(d + 1)) for d in range(self.near + 1)])
            probes = np.cumsum([comb(len(bits), d) for d in range(self.near + 1)])
            out[i, 1:] = PROBE * probes[:, None] + points * np.cumsum(at, axis=0)
        return out

    def thresholds(self, fp: np.ndarray, points: float) -> tuple[np.ndarray, np.ndarray]:
        """(partition, point): the thresholds of least cost, and that cost, for each point."""
        cost, goal = self.costs(fp, points), self.near + 1
        best = np.full((goal + 1, len(fp)), np.inf)
        best[0], chosen = 0, []
        for own in cost:
            options = np.stack([np.stack([best[j - u] + own[u] if u <= j else np.full(len(fp), np.inf) for u in range(goal + 1)])
                                for j in range(goal + 1)])  # (budget, threshold + 1, point)
            chosen.append(options.argmin(axis=1))
            best = options.min(axis=1)
        at, every, out = np.full(len(fp), goal), np.arange(len(fp)), np.empty((len(self.parts), len(fp)), np.int64)
        for i in range(len(self.parts) - 1, -1, -1):
            out[i] = chosen[i][at, every]
            at = at - out[i]
        return out - 1, best[goal]


def _plan(points: DataFrame, total: int, near: int) -> Layout:
    """The layout of least cost over all points."""
    together = _summed(points, BITS * BITS, _together)
    layouts = [Layout(grouped(together, total, m), near) for m in PARTITIONS if m <= near + 2]
    edges = np.cumsum([0, *(x.size for x in layouts)])
    counts = _summed(points, int(edges[-1]), lambda fp: np.concatenate([x.histogram(fp) for x in layouts]))
    for x, a, z in zip(layouts, edges, edges[1:], strict=False):
        x.learn(counts[a:z], total)

    def cost(fp: np.ndarray) -> np.ndarray:
        # Each point is filed once in each partition too.
        return np.array([x.thresholds(fp, total)[1].sum() + PROBE * len(x.parts) * len(fp) for x in layouts])

    return layouts[int(np.argmin(_summed(points, len(layouts), cost)))]


def _filed(points: DataFrame, layout: Layout, total: int) -> DataFrame:
    """(part, value, probe, fp): each point under its values, and its probes."""
    masks = [np.bitwise_or.reduce([np.uint64(1) << np.uint64(b) for b in p]) for p in layout.parts]

    def flips(bits: list[int], t: int) -> np.ndarray:
        return np.array([sum(1 << b for b in some) for d in range(t + 1) for some in combinations(bits, d)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            chosen, _ = layout.thresholds(fp, total)
            for i, mask in enumerate(masks):
                yield rows(i, fp & mask, fp, False)
                for t in np.unique(chosen[i][chosen[i] >= 0]).tolist():
                    flip = known.setdefault((i, t), flips(layout.parts[i], t))
                    own = fp[chosen[i] == t]
                    step = max(1, TOGETHER // len(flip))
                    for k in range(0, len(own), step):
                        some = own[k:k + step]
                        yield rows(i, ((some & mask)[:, None] ^ flip).ravel(), np.repeat(some, len(flip)), True)

    def rows(part: int, value: np.ndarray, fp: np.ndarray, probe: bool) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.full(len(fp), part, np.int32)), pa.array(value.view(np.int64)),
                                pa.array(np.full(len(fp), probe)), pa.array(fp.view(np.int64))], ["part", "value", "probe", "fp"])

    return points.select("fp").mapInArrow(run, "part int, value bigint, probe boolean, fp bigint")


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every point of some links with the first point of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _met(rows: DataFrame, near: int) -> DataFrame:
    """Links (a, b) among rows (part, value, block, probe, fp): every probe meets what is filed in its block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is filed comes before the probes of its block, so only that of the last block is carried on.
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        for b in batches:
            part, value, block = (np.concatenate([h, b.column(k).to_numpy().astype(np.int64)]) for k, h in enumerate(held[:3]))
            probe = np.concatenate([np.zeros(len(held[0]), bool), b.column(3).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held[3], b.column(4).to_numpy().view(np.uint64)])
            if not len(fp):
                continue
            fresh = np.ones(len(fp), bool)
            fresh[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (block[1:] != block[:-1])
            group = np.cumsum(fresh) - 1
            filed = np.flatnonzero(~probe)
            sent = np.flatnonzero(probe)
            begin = np.searchsorted(group[filed], np.arange(group[-1] + 2))
            size = np.diff(begin)[group[sent]]
            sent, size = sent[size > 0], size[size > 0]
            ends = np.cumsum(size)
            at = 0
            while at < len(sent):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, "right")))
                n = size[at:to]
                q = np.repeat(sent[at:to], n)
                d = filed[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[group[sent[at:to]]], n)]
                differing = np.bitwise_count(fp[q] ^ fp[d])
                hit = (differing <= near) & (differing > 0)
                if hit.any():
                    a, z = _spanning(fp[q[hit]], fp[d[hit]])
                    yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], ["a", "b"])
                at = to
            last = filed[group[filed] == group[-1]]
            held = [part[last], value[last], block[last], fp[last]]

    keys = ["part", "value", "block"]
    return rows.select(*keys, "probe", "fp").repartition(*keys).sortWithinPartitions(*keys, "probe").mapInArrow(run, "a bigint, b bigint")


def _links(points: DataFrame, total: int, near: int, block: int) -> DataFrame:
    """Links (a, b) between points that span the components of all pairs within `near` bits."""
    rows = stored(_filed(points, _plan(points, total, near), total), "simhash-filed")
    keys = ["part", "value"]
    hot = stored(rows.groupBy(*keys).agg(F.count_if("probe").alias("probes"), F.count_if(~F.col("probe")).alias("filed")).where(
        F.col("filed") > 0).select(*keys, F.ceil(F.greatest("probes", "filed") / block).cast("int").alias("blocks")).where("blocks > 1"), "simhash-hot")
    many = hot.count()
    if not many:
        return stored(_met(rows.withColumn("block", F.lit(0)), near), "simhash-links")
    few = F.broadcast(hot) if many <= BROADCAST_VALUES else hot
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    links = stored(_met(rows.join(few, keys, "left").withColumn("block", own), near), "simhash-links")

    # Components so far, ranked by their points; of each hot value the points of the first one stay away.
    now = components(links, "simhash-components").withColumnRenamed("node", "fp")
    large = now.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    ranked = stored(now.join(large, "component").select("fp", F.struct(F.col("n"), F.col("component")).alias("rank")), "simhash-ranked")
    alone = F.struct(F.lit(1).cast("bigint").alias("n"), F.col("fp").alias("component"))
    met = stored(rows.join(few, keys).join(ranked, "fp", "left").withColumn("rank", F.coalesce("rank", alone)), "simhash-hot-rows")
    first = met.where(~F.col("probe")).groupBy(*keys).agg(F.max("rank").alias("first"))
    first = F.broadcast(first) if many <= BROADCAST_VALUES else first
    visits = met.where("probe").join(first, keys).where("rank <> first").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    second = met.where(~F.col("probe")).withColumn("block", own).unionByName(visits.drop("first"))
    return stored(links.unionByName(_met(second, near)), "simhash-links-all")


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, near: int = NEAR, block: int = BLOCK) -> DataFrame:
    """Per row of `docs`: id, fingerprint (16 hexadecimal digits) and component_id, the least id reachable by links.

    Texts are lower-cased (A-Z), words are what stands between white space, a shingle is `width` words with a
    space between; a text of fewer words is one shingle, and one without words, or null, has the fingerprint zero,
    which is linked like any other. Fingerprints link when at most `near` bits differ (0 to 6). Rows of one id are
    one document, whatever their texts; rows of a null id link nothing and have a null component; repeated rows stay.
    An empty table gives an empty result. Other columns are not read.
    """
    found = stored(signatures(docs, id, text, width), "simhash-fingerprints")
    points = stored(found.where("doc IS NOT NULL").groupBy("fp").agg(F.min("doc").alias("least")), "simhash-points")
    total = points.count()
    # Rows of one id with several fingerprints join these.
    several = found.where("doc IS NOT NULL").groupBy("doc").agg(F.min("fp").alias("b"), F.max("fp").alias("z")).where("b < z").select("doc", "b")
    links = found.join(several, "doc").select(F.col("fp").alias("a"), "b").distinct()
    if near > 0 and total > 1:
        links = links.unionByName(_links(points, total, near, block))
    joined = components(links, "simhash-joined").withColumnRenamed("node", "fp")
    points = stored(points.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-classes")
    least = points.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = points.join(least, "component").select("fp", "component_id")
    return found.join(classes, "fp", "left").select(
        F.col("doc").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc").isNotNull(), F.col("component_id")).alias("component_id"))
