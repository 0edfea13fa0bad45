"""Similarity join on word n-grams with a prefix tree, and the components of its links.

Sets of equal hashes form classes, and one document stands for each. A document can only be
like another if 75 % of its n-grams occur elsewhere, so n-grams are counted over all documents
first (as 40 bits, dealt by their upper bits: a collision can only let a document through).
What remains is counted again, exactly, and each set is ordered by a global order, rare n-grams
first. Documents that share an n-gram of their prefixes are hung together in clusters, which
hold every possible link. Within a cluster the ordered sets lie in a prefix tree; each document
walks down it, sharing the overlap with common beginnings, and leaves a subtree as soon as what
is left of the document or below cannot reach the overlap needed.

A cluster beyond `BLOCK` n-grams is cut into blocks. Blocks are joined within first, then one
document of each component found; then only documents outside their cluster's largest component
visit the other blocks. Any link between two components has such a document at one end, so
none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks
from textloom.llm.common import components, default_parallelism, first_of, lean, stored
from textloom.llm.shingles import mixed, shingle_sets, text_slices

WIDTH = 5
#: Link when LIKE * union <= 100 * intersection.
LIKE = 75
#: N-grams of a block of one cluster.
BLOCK = 1 << 20
#: A candidate list of at most this many ids is sent to every task.
BROADCAST_IDS = 1_000_000


class Tree:
    """Prefix tree of ordered sets with unary paths joined, as arrays; items in order of their sets."""

    def __init__(self, codes: list[np.ndarray], sizes: np.ndarray) -> None:
        order = sorted(range(len(codes)), key=lambda i: codes[i].astype(">u4").tobytes())
        self.items = np.array(order)
        flat = [codes[i] for i in order]
        self.codes = np.concatenate([*flat, np.zeros(0, np.int64)])
        base = np.concatenate([[0], np.cumsum([len(c) for c in flat])])
        depth, parent, item_node, seg = [0], [-1], [], [0]
        stack = [0]
        for i, c in enumerate(flat):
            l = 0  # noqa: E741
            if i:
                prev = flat[i - 1]
                n = min(len(prev), len(c))
                differ = np.flatnonzero(prev[:n] != c[:n])
                l = int(differ[0]) if len(differ) else n  # noqa: E741
            below = -1
            while depth[stack[-1]] > l:
                below = stack.pop()
            if depth[stack[-1]] < l:
                depth.append(l)
                parent.append(stack[-1])
                seg.append(base[i - 1])
                parent[below] = len(depth) - 1
                stack.append(len(depth) - 1)
            if len(c) > l:
                depth.append(len(c))
                parent.append(stack[-1])
                seg.append(base[i])
                stack.append(len(depth) - 1)
            item_node.append(stack[-1])
        self.depth, self.parent = np.array(depth), np.array(parent)
        self.start = np.array(seg) + np.where(self.parent >= 0, self.depth[self.parent], 0)
        self.end = np.array(seg) + self.depth
        n = len(depth)
        self.sizes = sizes
        item_node = np.array(item_node, np.int64)
        least, most, deepest = np.full(n, 1 << 60), np.zeros(n, np.int64), self.depth.copy()
        np.minimum.at(least, item_node, sizes[self.items])
        np.maximum.at(most, item_node, sizes[self.items])
        for k in np.argsort(-self.depth, kind="stable")[:-1] if n > 1 else []:
            p = self.parent[k]
            least[p], most[p], deepest[p] = min(least[p], least[k]), max(most[p], most[k]), max(deepest[p], deepest[k])
        self.least, self.most, self.left = least, most, deepest - self.depth
        self.children, self.child_at = self._lists(self.parent[1:] if n > 1 else np.zeros(0, np.int64), n, 1)
        self.ends, self.end_at = self._lists(item_node, n, 0)

    @staticmethod
    def _lists(key: np.ndarray, n: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        return order + shift, np.searchsorted(key[order], np.arange(n + 1))

    @staticmethod
    def _spread(values: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The listed values of all keys, and the place in `keys` of each."""
        n = at[keys + 1] - at[keys]
        place = np.repeat(np.arange(len(keys)), n)
        return values[np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[keys], n)], place

    def like(self, codes: np.ndarray, size: int, flag: np.ndarray) -> np.ndarray:
        """The items linked with a set of `size` n-grams, of which `codes` are known here."""
        flag[codes] = True
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            ended, at = self._spread(self.ends, self.end_at, nodes)
            own = self.items[ended]
            found.append(own[(100 + LIKE) * overlap[at] >= LIKE * (size + self.sizes[own])])
            nodes, at = self._spread(self.children, self.child_at, nodes)
            if not len(nodes):
                break
            length = self.end[nodes] - self.start[nodes]
            first = np.cumsum(length) - length
            every = np.arange(first[-1] + length[-1]) + np.repeat(self.start[nodes] - first, length)
            overlap = overlap[at] + np.add.reduceat(flag[self.codes[every]].astype(np.int64), first)
            behind = len(codes) - np.searchsorted(codes, self.codes[self.end[nodes] - 1], "right")
            bound = overlap + np.minimum(behind, self.left[nodes])
            live = ((100 + LIKE) * bound >= LIKE * (size + self.least[nodes])) & (100 * self.most[nodes] >= LIKE * size)
            nodes, overlap = nodes[live], overlap[live]
        flag[codes] = False
        return np.concatenate(found) if found else np.zeros(0, np.int64)


class Home:
    """The documents of a block in a tree, past which others walk one at a time, and the components so far."""

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        tokens = np.concatenate([t for t, _ in sets])
        uses = np.concatenate([f for _, f in sets])
        self.distinct, first, inverse = np.unique(tokens, return_index=True, return_inverse=True)
        self.rank = np.empty(len(self.distinct), np.int64)
        self.rank[np.lexsort((self.distinct, uses[first]))] = np.arange(len(self.distinct))
        ends = np.cumsum([len(t) for t, _ in sets])
        self.codes = [np.sort(c) for c in np.split(self.rank[inverse], ends[:-1])]
        self.docs, self.sizes, self.labels = docs, sizes, labels
        self.tree = Tree(self.codes, sizes)
        self.flag = np.zeros(len(self.distinct), bool)
        self.up: dict[int, int] = {}
        self.open = len({self._find(x) for x in labels.tolist()})

    def _find(self, x: int) -> int:
        up = self.up
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def _link(self, doc: int, size: int, label: int, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        for j in self.tree.like(codes, size, self.flag):
            a, b = self._find(label), self._find(int(self.labels[j]))
            if a != b:
                self.up[a] = b
                yield doc, int(self.docs[j])

    def inside(self) -> Iterator[tuple[int, int]]:
        """Links (a, b) that join the components of the block. Pairs already joined are not looked for."""
        for i, codes in enumerate(self.codes):
            if self.open == 1:
                break
            for link in self._link(int(self.docs[i]), int(self.sizes[i]), int(self.labels[i]), codes):
                self.open -= 1
                yield link

    def visit(self, doc: int, size: int, label: int, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links of a document that is not in the block; n-grams that the block has not are left out."""
        if self.open == 1 and self._find(label) == self._find(int(self.labels[0])):
            return  # all of the block are joined with it already
        at = np.searchsorted(self.distinct, tokens).clip(max=len(self.distinct) - 1)
        codes = np.sort(self.rank[at[self.distinct[at] == tokens]])
        yield from self._link(doc, size, label, codes)


def _join(rows: DataFrame, parts: int) -> DataFrame:
    """Links within each (cluster, block) of rows (cluster, block, doc, n, tokens, uses, home, label).

    If all are at home, all walk down the tree; else only the others do, one after the other: a task
    holds the documents at home of one block, however many visit it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key, home, visited = None, None, False

        def build() -> Home:
            return Home(np.array([r["doc"] for r in held]), np.array([r["n"] for r in held]),
                        [(np.frombuffer(r["tokens"], np.uint64), np.frombuffer(r["uses"], np.uint32)) for r in held],
                        np.array([r["label"] for r in held]))

        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            for a in range(0, b.num_rows, 256):
                found: list[tuple[int, int]] = []
                for r in b.slice(a, 256).to_pylist():
                    if key != (r["cluster"], r["block"]):
                        if not visited and len(held) > 1:
                            found += build().inside()
                        held.clear()
                        key, home, visited = (r["cluster"], r["block"]), None, False
                    if r["home"]:
                        held.append(r)
                        continue
                    visited = True
                    if held:
                        home = build()
                        held.clear()
                    if home:
                        found += home.visit(r["doc"], r["n"], r["label"], np.frombuffer(r["tokens"], np.uint64))
                yield links(found)
        yield links([*build().inside()] if not visited and len(held) > 1 else [])

    return rows.repartition(parts, "cluster", "block").sortWithinPartitions("cluster", "block", F.desc("home"), "doc").mapInArrow(
        lean(run), "a bigint, b bigint")


def signatures(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """Per row: doc, n (distinct n-grams), and 128 bits that are equal for equal sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 1):
                tokens, n = shingle_sets(b.column(1), width)
                at = np.cumsum(n) - n
                some = n > 0
                a, z = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(tokens):
                    a[some] = np.add.reduceat(mixed(tokens), at[some])
                    z[some] = np.bitwise_xor.reduceat(mixed(tokens + np.uint64(0x51ED27)), at[some])
                yield pa.record_batch([b.column(0), pa.array(n), pa.array(a.view(np.int64)), pa.array(z.view(np.int64))],
                                      ["doc", "n", "a", "z"])

    return docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("text")).mapInArrow(
        lean(run), "doc bigint, n bigint, a bigint, z bigint")


def _part(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int32)


def _shared(texts: DataFrame, width: int, parts: int) -> DataFrame:
    """(doc, r): n-grams of each document that other documents have too, at least those."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 1):
                tokens, n = shingle_sets(b.column(1), width)
                docs, of = b.column(0).to_numpy(), np.repeat(np.arange(len(n)), n)
                short = (tokens & np.uint64((1 << 40) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                yield blocks.deal(_part(tokens, parts), [docs], of, [np.ascontiguousarray(short)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, short = blocks.gathered(batches, [np.int64, np.uint32, np.uint8])
        tokens = np.zeros((len(short) // 5, 8), np.uint8)
        tokens[:, :5] = short.reshape(-1, 5)
        tokens = tokens.reshape(-1).view(np.uint64)
        order = np.argsort(tokens, kind="stable")
        same = tokens[order][1:] == tokens[order][:-1]
        twice = np.zeros(len(tokens), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        ends = np.cumsum(counts, dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(twice)])
        r = sums[ends] - sums[ends - counts]
        some = r > 0
        docs, r = docs[some], r[some].astype(np.uint32)
        yield blocks.deal((mixed(docs.view(np.uint64)) % np.uint64(parts)).astype(np.int32), [docs], np.arange(len(docs)), [r])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, _, r = blocks.gathered(batches, [np.int64, np.uint32, np.uint32])
        each, of = np.unique(docs, return_inverse=True)
        yield pa.record_batch([pa.array(each), pa.array(np.bincount(of, r, len(each)).astype(np.int64))], ["doc", "r"])

    sent = blocks.together(texts.mapInArrow(lean(send), blocks.schema(1, 1)), parts)
    counted = blocks.together(sent.mapInArrow(lean(count), blocks.schema(1, 1)), parts)
    return counted.mapInArrow(lean(add), "doc bigint, r bigint")


def _ordered(texts: DataFrame, width: int, parts: int) -> DataFrame:
    """(doc, n, tokens, uses, prefix) of the documents that can have links: their shared n-grams in
    the global order, how many documents use each, and how many of the first form the prefix."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 1):
                tokens, n = shingle_sets(b.column(1), width)
                of = np.repeat(np.arange(len(n)), n)
                key = np.zeros(len(n), np.uint64)  # tells apart texts of one id
                key[n > 0] = np.add.reduceat(tokens, (np.cumsum(n) - n)[n > 0]) if len(tokens) else 0
                yield blocks.deal(_part(tokens, parts), [b.column(0).to_numpy(), key, n.astype(np.int64)], of, [tokens])

    kinds = [np.int64, np.uint64, np.int64, np.uint32, np.uint64]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, key, n, counts, tokens = blocks.gathered(batches, kinds)
        # A repeated row has the same n-grams here as the first of its id and set, which stands for it.
        by = np.lexsort((n, key, docs))
        again = np.zeros(len(docs), bool)
        again[by[1:]] = (docs[by[1:]] == docs[by[:-1]]) & (key[by[1:]] == key[by[:-1]]) & (n[by[1:]] == n[by[:-1]])
        if again.any():
            tokens = tokens[~np.repeat(again, counts)]
            docs, key, n, counts = docs[~again], key[~again], n[~again], counts[~again]
        _, inverse, uses = np.unique(tokens, return_inverse=True, return_counts=True)
        uses = uses[inverse]
        of = np.repeat(np.arange(len(docs)), counts)
        twice = uses > 1
        of, tokens, uses = of[twice], tokens[twice], uses[twice].astype(np.uint32)
        home = (mixed(docs.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        yield blocks.deal(home[of], [docs, key, n], of, [tokens, uses])

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, key, n, counts, tokens, uses = blocks.gathered(batches, [*kinds, np.uint32])
        of = np.repeat(np.arange(len(docs)), counts)
        by = np.lexsort((tokens, uses, key[of], docs[of]))
        of, tokens, uses = of[by], tokens[by], uses[by]
        first = np.flatnonzero(np.concatenate([[True], (docs[of[1:]] != docs[of[:-1]]) | (key[of[1:]] != key[of[:-1]])])
                               ) if len(of) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(of))[:len(first)]
        rows = []
        for a, z in zip(first, last, strict=True):
            size = int(n[of[a]])
            need = -(-LIKE * size // 100)
            if z - a >= need:
                rows.append((int(docs[of[a]]), size, tokens[a:z].tobytes(), uses[a:z].tobytes(), int(z - a - need + 1)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds_out = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds_out, strict=True)], ["doc", "n", "tokens", "uses", "prefix"])

    sent = blocks.together(texts.mapInArrow(lean(send), blocks.schema(3, 1)), parts)
    counted = blocks.together(sent.mapInArrow(lean(count), blocks.schema(3, 2)), parts)
    return counted.mapInArrow(lean(order), "doc bigint, n bigint, tokens binary, uses binary, prefix bigint")


def _prefix_edges(ordered: DataFrame, parts: int) -> DataFrame:
    """Documents that share an n-gram of their prefixes, each with the least of them."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, prefix = b.column(0).to_numpy(), b.column(2).to_numpy()
            tokens = [np.frombuffer(t, np.uint64)[:p] for t, p in zip(b.column(1).to_pylist(), prefix, strict=True)]
            tokens = np.concatenate([*tokens, np.zeros(0, np.uint64)])
            yield blocks.deal(_part(tokens, parts), [docs], np.repeat(np.arange(len(docs)), prefix), [tokens])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, tokens = blocks.gathered(batches, [np.int64, np.uint32, np.uint64])
        docs = np.repeat(docs, counts)
        by = np.lexsort((docs, tokens))
        docs, tokens = docs[by], tokens[by]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        least = np.repeat(docs[first], np.diff(np.append(first, len(docs))))
        pairs = np.unique(np.stack([docs, least])[:, docs != least], axis=1)
        yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    sent = blocks.together(ordered.select("doc", "tokens", "prefix").mapInArrow(lean(send), blocks.schema(1, 1)), parts)
    return sent.mapInArrow(lean(meet), "a bigint, b bigint")


def _links(ordered: DataFrame, clusters: DataFrame, parts: int, block: int) -> DataFrame:
    """Links that span the components of every cluster."""
    rows = ordered.join(clusters.withColumnRenamed("node", "doc"), "doc").select(
        F.col("component").alias("cluster"), "doc", "n", "tokens", "uses", "prefix")
    weight = F.octet_length("tokens") / 8
    counts = rows.groupBy("cluster").agg(F.ceil(F.sum(weight) / block).cast("int").alias("blocks"))
    rows = stored(rows.join(counts, "cluster").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")),
                  "ngram-clusters")
    base = ["cluster", "block", "doc", "n", "tokens", "uses"]
    links = stored(_join(rows.select(*base, F.lit(True).alias("home"), F.col("doc").alias("label")), parts), "ngram-links")
    large = rows.where("blocks > 1")
    if large.isEmpty():
        return links

    def labelled(found: DataFrame) -> DataFrame:
        return large.join(components(found, "ngram-components").withColumnRenamed("node", "doc"), "doc", "left").withColumn(
            "label", F.coalesce("component", "doc")).drop("component")

    # One document of each component, in as many blocks as they need.
    ones = first_of(labelled(links), ["label"], [F.col("doc")])
    need = ones.groupBy("cluster").agg(F.ceil(F.sum(weight) / block).cast("int").alias("_need"))
    ones = ones.join(need, "cluster").withColumn("block", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("_need")).cast("int"))
    links = stored(links.unionByName(_join(ones.select(*base, F.lit(True).alias("home"), "label"), parts)), "ngram-links")

    # Whoever is outside the largest component of the cluster goes to the blocks that share an n-gram of its prefix.
    now = stored(labelled(links), "ngram-labels")
    largest = first_of(now.groupBy("cluster", "label").count(), ["cluster"], [F.desc("count"), F.col("label")]).select(
        "cluster", F.col("label").alias("_largest"))
    away = now.join(largest, "cluster").where("label <> _largest")
    if away.isEmpty():
        return links
    at_home = now.join(away.select("cluster").distinct(), "cluster", "left_semi")
    away = away.drop("block").join(_visits(at_home, away), ["cluster", "doc"]).select(*base, F.lit(False).alias("home"), "label")
    at_home = at_home.select(*base, F.lit(True).alias("home"), "label")
    return stored(links.unionByName(_join(at_home.unionByName(away), parts)), "ngram-links")


def _visits(at_home: DataFrame, away: DataFrame) -> DataFrame:
    """(cluster, doc, block): the blocks in which a document at home shares an n-gram of its prefix with the visitor's."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefix = b.column(3).to_numpy()
            tokens = [np.frombuffer(t, np.int64)[:p] for t, p in zip(b.column(2).to_pylist(), prefix, strict=True)]
            of = pa.array(np.repeat(np.arange(len(prefix)), prefix))
            yield pa.record_batch([b.column(0).take(of), b.column(1).take(of), pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)]))],
                                  ["cluster", "at", "token"])

    def spelt(df: DataFrame, at: str) -> DataFrame:
        return df.select("cluster", F.col(at).cast("bigint"), "tokens", "prefix").mapInArrow(
            lean(spell), "cluster bigint, at bigint, token bigint").distinct()

    held = spelt(at_home, "block").withColumnRenamed("at", "block")
    return spelt(away, "doc").withColumnRenamed("at", "doc").join(held, ["cluster", "token"]).select(
        "cluster", "doc", F.col("block").cast("int").alias("block")).distinct()


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Per row of `docs`: id, n_shingles and component_id, the least id reachable by links.

    A set is the distinct n-grams of a whole text, words in lower case (A-Z only); a text of fewer
    words is one n-gram, and a null or empty text has none and no links. Two documents link when
    100 * intersection >= 75 * union. N-grams are told apart by 64-bit hashes. Rows of one id
    are one document, whatever their texts; rows of a null id have a null component; repeated rows
    stay. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = default_parallelism(spark)
    found = stored(signatures(docs, id, text, width), "ngram-signatures")
    known = found.where("doc IS NOT NULL AND n > 0")
    classes = known.groupBy("n", "a", "z").agg(F.min("doc").alias("rep"))
    classes = stored(classes, "ngram-classes")
    texts = docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    shared = stored(_shared(texts, width, parts).join(classes.groupBy("rep").agg(F.min("n").alias("n")), F.col("doc") == F.col("rep"))
                    .where(100 * F.col("r") >= LIKE * F.col("n")).select("doc"), "ngram-candidates")
    few = F.broadcast(shared) if shared.count() <= BROADCAST_IDS else shared
    ordered = stored(_ordered(texts.join(few, "doc", "left_semi"), width, parts), "ngram-ordered")
    clusters = components(_prefix_edges(ordered, parts), "ngram-cluster-edges")
    links = _links(ordered, stored(clusters, "ngram-clusters-found"), parts, block)
    # Rows of one id that are in several classes join these.
    split = known.join(classes, ["n", "a", "z"]).groupBy("doc").agg(F.min("rep").alias("least"), F.collect_set("rep").alias("reps")
                                                                   ).where(F.size("reps") > 1)
    links = links.unionByName(split.select(F.explode("reps").alias("a"), F.col("least").alias("b")))
    joined = components(links, "ngram-links-joined")
    classes = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        "n", "a", "z", F.coalesce("component", "rep").alias("component_id"))
    return found.join(classes, ["n", "a", "z"], "left").select(
        F.col("doc").alias(id), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id"))
