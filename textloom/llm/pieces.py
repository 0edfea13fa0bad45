"""SentencePiece encoding and decoding, with giant documents encoded by a parallel scan.

A sequence of pieces is the byte-pair encoding of a text exactly if each piece is its own encoding
and each two neighbours are the encoding of their joined text: no merge can cross a boundary
in the whole that could not cross it there. So encoding is a path through states (end of the last
piece, last piece), with weight 0 where two pieces go together and minus infinity elsewhere, and
chunks of a text can be worked on without knowing what comes before. For each chunk a max-plus matrix says
from which states at its beginning which states at its end are reached; matrices are combined from
both ends, which leaves one state at each boundary, and every chunk then traces its own path back.
Documents of ordinary length are encoded whole by the library.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import apart, byte_length, default_parallelism, stored
from textloom.llm.shingles import text_slices

#: A document of more bytes than this is giant, and is cut into chunks of this many characters.
GIANT = 64 << 10
CHUNK = 16 << 10
#: Bytes of text that the library encodes together, and entries of a worker's caches.
SLICE = 1 << 20
CACHE = 100_000
SPACE = "▁"


class Pieces:
    """The pieces of a byte-pair model file with byte fallback, identity normalisation and a space put first."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        self.library = p = SentencePieceProcessor(model_file=path)
        self.scores, self.ids, self.surface = {}, {}, []
        self.bytes = [0] * 256
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif p.is_control(i) or p.is_unknown(i):
                self.surface.append(b"")
            else:
                self.scores[piece], self.ids[piece] = p.get_score(i), i
                self.surface.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids))
        self.fits = lru_cache(maxsize=CACHE)(self._fits)
        self.own = lru_cache(maxsize=CACHE)(lambda piece: self.merged(piece) == (piece,))

    def merged(self, text: str) -> tuple[str, ...]:
        """The byte-pair encoding of a short string: the best-scored pair is merged first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return tuple(parts)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: str, right: str) -> bool:
        return self.merged(left + right) == (left, right)

    def at(self, text: str, start: int) -> list[str]:
        """The pieces that begin at a character: known ones that are their own encoding, else the character."""
        found = [t for n in range(1, min(self.longest, len(text) - start) + 1)
                 if (t := text[start:start + n]) in self.scores and self.own(t)]
        if not found or len(found[0]) > 1:
            found.append(text[start])
        return found

    def ids_of(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for t in parts:
            i = self.ids.get(t)
            out.extend([i] if i is not None else [self.bytes[x] for x in t.encode()])
        return out

    def states(self, text: str, at: int) -> list[tuple[int, str]]:
        """All (end, piece) with a piece that begins before `at` and ends there or behind: the states at a boundary."""
        if at == 0:
            return [(0, "")]
        return sorted((s + len(t), t) for s in range(max(0, at - self.longest), at) for t in self.at(text, s) if s + len(t) >= at)

    def walk(self, text: str, begin: list[tuple[int, str]], to: int) -> dict[int, dict[str, tuple[int, list]]]:
        """From states at the beginning to where pieces reach `to`: by end and piece, the set of beginnings
        (as bits) from which it is reached, and the pieces before it with theirs."""
        nodes: dict[int, dict[str, tuple[int, list]]] = {}
        for k, (end, piece) in enumerate(begin):
            nodes.setdefault(end, {})[piece] = (1 << k, [])
        for pos in range(min(nodes), to):
            here = nodes.get(pos)
            if not here:
                continue
            for t in self.at(text, pos):
                bits, before = 0, []
                for prev, (own, _) in here.items():
                    if own and (not prev or self.fits(prev, t)):
                        bits |= own
                        before.append((prev, own))
                if bits:
                    there = nodes.setdefault(pos + len(t), {})
                    old = there.get(t, (0, []))
                    there[t] = (old[0] | bits, old[1] + before)
        return nodes

    def matrix(self, text: str, at: int, to: int) -> np.ndarray:
        """The chunk's max-plus matrix: 0 where a state at `to` is reached from one at `at`, else minus infinity."""
        begin, end = self.states(text, at), self.states(text, to)
        nodes = self.walk(text, begin, to)
        out = np.full((len(begin), len(end)), -np.inf, np.float32)
        for column, (pos, piece) in enumerate(end):
            bits = nodes.get(pos, {}).get(piece, (0, []))[0]
            for row in range(len(begin)):
                if bits >> row & 1:
                    out[row, column] = 0.0
        return out

    def trace(self, text: str, at: int, to: int, entry: int, leave: int) -> list[str]:
        """The pieces of the chunk's path from one state at `at` to one at `to`."""
        first = self.states(text, at)[entry]
        pos, piece = self.states(text, to)[leave]
        nodes, out = self.walk(text, [first], to), []
        while (pos, piece) != first:
            out.append(piece)
            before = nodes[pos][piece][1]
            pos, piece = pos - len(piece), before[0][0]
        return out[::-1]


def times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1) if left.size and right.size else np.full(
        (left.shape[0], right.shape[1]), -np.inf, np.float32)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each boundary that lies on the path through all chunks."""
    ahead = [np.zeros((1, 1), np.float32)]
    for m in matrices:
        ahead.append(times(ahead[-1], m))
    behind = [np.zeros((matrices[-1].shape[1], 1), np.float32)]
    for m in reversed(matrices):
        behind.append(times(m, behind[-1]))
    return [int(np.argmax(a[0] + b[:, 0])) for a, b in zip(ahead, reversed(behind), strict=True)]


_models: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    """The worker's model of this file."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _giants(texts: DataFrame, path: str, chunk: int, parts: int) -> DataFrame:
    """(a, z, ids) of distinct giant texts (a, z, text)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin = model(path).longest
        for b in batches:
            for r in range(b.num_rows):
                text = SPACE + b.column(2)[r].as_py().replace(" ", SPACE)
                for n, at in enumerate(range(0, len(text), chunk)):
                    low, to = max(0, at - margin), min(at + chunk, len(text))
                    yield pa.record_batch([b.column(0).slice(r, 1), b.column(1).slice(r, 1), pa.array([n]), pa.array([at - low]),
                                           pa.array([to - low]), pa.array([text[low:to + margin]])], _CHUNK)

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model(path)
        for b in batches:
            found = [p.matrix(t, at, to) for at, to, t in zip(*(b.column(c).to_pylist() for c in (3, 4, 5)),
                                                                                   strict=True)]
            yield pa.record_batch([*(b.column(c) for c in (0, 1, 2)), pa.array([len(m) for m in found]),
                                   pa.array([(m == 0).astype(np.uint8).tobytes() for m in found], pa.binary())],
                                  ["a", "z", "chunk", "rows", "matrix"])

    def scan(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        matrices = [np.where(np.frombuffer(m, np.uint8).reshape(n, -1) > 0, np.float32(0), np.float32(-np.inf))
                    for m, n in zip(group["matrix"], group["rows"], strict=True)]
        states = boundary_states(matrices)
        return pd.DataFrame({"a": key[0], "z": key[1], "chunk": group["chunk"], "entry": states[:-1], "leave": states[1:]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model(path)
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in (3, 4, 5, 6, 7)), strict=True)
            ids = [p.ids_of(p.trace(t, at, to, entry, leave)) for at, to, t, entry, leave in rows]
            yield pa.record_batch([*(b.column(c) for c in (0, 1, 2)), pa.array(ids, pa.list_(pa.int32()))], ["a", "z", "chunk", "ids"])

    chunks = texts.mapInArrow(cut, "a bigint, z bigint, chunk bigint, at bigint, to bigint, body string")
    chunks = stored(chunks.repartition(parts, "a", "z", "chunk"), "pieces-chunks")
    matrices = chunks.mapInArrow(transfer, "a bigint, z bigint, chunk bigint, rows bigint, matrix binary")
    states = matrices.groupBy("a", "z").applyInPandas(scan, "a bigint, z bigint, chunk bigint, entry bigint, leave bigint")
    # The chunks are small in bytes and long to trace: they stay spread.
    placed = chunks.join(states, ["a", "z", "chunk"]).select(*_CHUNK, "entry", "leave").repartition(parts, "a", "z", "chunk")
    traced = placed.mapInArrow(
        trace, "a bigint, z bigint, chunk bigint, ids array<int>")
    return traced.groupBy("a", "z").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))


_CHUNK = ["a", "z", "chunk", "at", "to", "body"]


@apart
def encode(docs: DataFrame, path: str, text: str = "text", giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """All rows of `docs` with `ids` (array<int>), the encoding of `text` by the model file at `path`.

    Null and empty texts have no ids. Texts of more than `giant` bytes go through the parallel scan, each
    distinct one once; the result does not depend on `giant` or `chunk`. Rows are neither lost nor added; an empty
    table gives an empty result. A column `ids` is replaced.
    """
    parts = default_parallelism(docs.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model(path).library
        for big in batches:
            for b in text_slices(big, position, SLICE) if big.num_rows else []:
                ids = p.encode([t or "" for t in b.column(position).to_pylist()], num_threads=1)
                yield pa.record_batch([*b.columns, pa.array(ids, pa.list_(pa.int32()))], [*b.schema.names, "ids"])

    docs = docs.drop("ids")
    position = docs.columns.index(text)
    large = byte_length(F.col(text)) > giant
    schema = type(docs.schema)([*docs.schema.fields]).add("ids", T.ArrayType(T.IntegerType()))
    small = docs.where(~large).mapInArrow(whole, schema)
    keyed = docs.where(large).withColumns({"_a": F.xxhash64(text), "_z": F.xxhash64(text, F.lit(1))})
    distinct = keyed.select(F.col("_a").alias("a"), F.col("_z").alias("z"), F.col(text).alias("text")).dropDuplicates(["a", "z"])
    coded = stored(_giants(distinct, path, chunk, parts), "pieces-giants")
    coded = coded.select(F.col("a").alias("_a"), F.col("z").alias("_z"), F.col("ids").alias("ids"))
    return small.unionByName(keyed.join(coded, ["_a", "_z"], "left").drop("_a", "_z"))


@apart
def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows of `docs` with the text of their ids: pieces joined, bytes put together, the first space
    taken off. Null ids give null, no ids an empty text; bytes that are not UTF-8 become U+FFFD. Encoding and
    decoding give a text back, but for U+2581, which becomes a space."""
    def join(column: pd.Series) -> pd.Series:
        surface = model(path).surface
        return column.map(lambda x: None if x is None else b"".join([surface[i] for i in x]).removeprefix(b" ").decode("utf-8", "replace"))

    return docs.withColumn(text, F.pandas_udf(join, "string")(F.col(ids)))
