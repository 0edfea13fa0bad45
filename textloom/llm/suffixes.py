"""Removal of repeated passages by a sorted order of sampled suffixes.

A byte goes if some string of `length` bytes that covers it also starts earlier in the corpus.
Whole copies are settled first, by a 128-bit hash. Then strings that occur once are put aside:
every string of `length` bytes contains the least hash of its K-byte substrings, its anchor, and a string can
only repeat if that substring does. What remains, segments of texts, is sorted.

The sample is the anchors of the segments. The least substring depends on nothing but the string, so two equal strings
reach a sample position after the same number of steps, as they do on a difference cover, which needs more positions
for it. Neighbouring strings share an anchor, so one record stands for them all: the bytes from the anchor on, the bytes before
it from right to left, and which steps lead to it. Records go to tasks by ranges of their suffixes, so the tasks
follow one another in suffix order, and suffixes that begin with the same anchor are in one task.

The remaining strings follow from the sample. Neighbours in the order are compared, which tells at once how far any two
suffixes agree; neighbours in the order of the bytes before them likewise. A string `s` bytes before its anchor is in the class of the
suffixes that agree in `length` - s bytes and in that of the records that agree in s bytes before; all but the earliest
in both classes are marked. Bytes decide throughout: hashes choose positions, they do not stand for strings.

A part of the segments sends each distinct record once, with its earliest position, so a passage
that is everywhere costs, but for its ends, no more than one row of each part in the task that sorts it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks
from textloom.llm.common import apart, default_parallelism, lean, returned, small_batches, stored
from textloom.llm.shingles import _BASE, _powers, mixed, text_slices, utf8

LENGTH = 100
#: Bytes of segments in one part, and of the longest piece of a segment.
PART_BYTES = 2 << 20
PIECE = 1 << 19
#: Bytes that a Python worker is handed at once.
BATCH = 4 << 20
#: Bytes of a part, and anchors of all parts, from which the ranges of the suffixes are taken; records compared at once.
SAMPLE_BYTES = 1 << 16
SAMPLE = 200_000
CHUNK = 1 << 17
#: Copied texts are listed in every task up to this many; beyond it they are joined by hash.
BROADCAST_COPIES = 1_000_000

_TABLE = np.random.default_rng(31).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPAN = 1 << 18
_POWERS, _INVERSE = _powers(_BASE, _SPAN), _powers(pow(_BASE, -1, 1 << 64), _SPAN)


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or largest of every `width` neighbours."""
    pick = np.minimum if least else np.maximum
    pad = np.full(-len(x) % width, (1 << 64) - 1 if least else 0, np.uint64)
    y = np.concatenate([x, pad]).reshape(-1, width)
    before = pick.accumulate(y, axis=1).ravel()
    after = pick.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(after[:len(x) - width + 1], before[width - 1:len(x)])


def _grams(a: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all K-byte substrings of a span."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[a] * _POWERS[:len(a)], dtype=np.uint64)])
    return mixed((sums[k:] - sums[:-k]) * _INVERSE[:len(a) - k + 1])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the K-byte substrings that are the least of some string of `length` bytes."""
    k = _anchor_bytes(length)
    width, at, found = length - k + 1, 0, []
    while len(data) - at >= length:
        # Spans overlap so that all strings lie in one of them with the strings next to them.
        a = data[at:at + _SPAN]
        h = _grams(a, k)
        low = _slide(h, width, True)
        edge = np.zeros(width - 1, np.uint64)
        best = _slide(np.concatenate([edge, low, edge]), width, False)
        here = np.flatnonzero(h == best)
        found.append((here + at, h[here]))
        if at + len(a) == len(data):
            break
        at += len(a) - length + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pos, h = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    pos, first = np.unique(pos, return_index=True)
    return pos, h[first]


def _anchor_bytes(length: int) -> int:
    return max(1, length * 2 // 5)


def _candidates(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """(a, z, starts, ends): the stretches of each text that may hold repeated strings."""
    k = _anchor_bytes(length)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 2):
                data, offsets = utf8(b.column(2))
                found = [anchors(data[x:y], length) for x, y in zip(offsets, offsets[1:], strict=False)]
                of = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
                pos = np.concatenate([p for p, _ in found]).astype(np.uint32)
                h = np.concatenate([x for _, x in found])
                groups = [b.column(c).to_numpy().astype(np.int64) for c in (0, 1)] + [np.diff(offsets)]
                short = np.ascontiguousarray((h & np.uint64((1 << 40) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
                yield blocks.deal(((h >> np.uint64(40)) % np.uint64(parts)).astype(np.int32), groups, of, [short, pos])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, z, size, counts, short, pos = blocks.gathered(batches, [np.int64, np.int64, np.int64, np.uint32, np.uint8, np.uint32])
        tokens = np.zeros((len(short) // 5, 8), np.uint8)
        tokens[:, :5] = short.reshape(-1, 5)
        tokens = tokens.reshape(-1).view(np.uint64)
        order = np.argsort(tokens, kind="stable")
        same = tokens[order][1:] == tokens[order][:-1]
        twice = np.zeros(len(tokens), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        of = np.repeat(np.arange(len(a)), counts)[twice]
        home = (mixed(a.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        yield blocks.deal(home[of], [a, z, size], of, [pos[twice]])

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, z, size, counts, pos = blocks.gathered(batches, [np.int64, np.int64, np.int64, np.uint32, np.uint32])
        of = np.repeat(np.arange(len(a)), counts)
        by = np.lexsort((pos, z[of], a[of]))
        of, pos = of[by], pos[by].astype(np.int64)
        a, z = a[of], z[of]
        start, end = np.maximum(pos - (length - k), 0), np.minimum(pos + length, size[of])
        fresh = np.ones(len(pos), bool)
        # A stretch goes on while the next string still overlaps it by all but its last byte.
        fresh[1:] = (a[1:] != a[:-1]) | (z[1:] != z[:-1]) | (start[1:] > end[:-1] - length + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(pos)) - 1 if len(first) else first
        keep = end[last] - start[first] >= length
        yield pa.record_batch([pa.array(x) for x in (a[first][keep], z[first][keep], start[first][keep], end[last][keep])],
                              ["a", "z", "start", "end"])

    sent = blocks.together(texts.select("a", "z", "text").mapInArrow(lean(send), blocks.schema(3, 2)), parts)
    counted = blocks.together(sent.mapInArrow(lean(count), blocks.schema(3, 1)), parts)
    found = counted.mapInArrow(lean(stretch), "a bigint, z bigint, start bigint, end bigint").distinct()
    return found.groupBy("a", "z").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("stretches"))


def _parts(texts: DataFrame, stretches: DataFrame, length: int, part_bytes: int) -> tuple[DataFrame, int]:
    """The segments in parts, (part, heads, body), and their number. heads has (a, z, start, size) of each segment, body their bytes.
    Parts and the segments in them follow the order (id, text, start) over the whole corpus."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                key, body = [b.column(c)[r].as_py() for c in range(3)], b.column(3)[r].as_buffer()
                rows = []
                for s in b.column(4)[r].as_py():
                    for start in range(s["start"], s["end"] - length + 1, PIECE):
                        end = min(start + PIECE + length - 1, s["end"])
                        rows.append((*key, start, body.slice(start, end - start).to_pybytes()))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CUT, strict=True)], _CUT_NAMES)

    joined = texts.join(stretches, ["a", "z"]).select("doc", "a", "z", F.col("text").cast("binary"), "stretches")
    rows = joined.mapInArrow(lean(cut), "doc bigint, a bigint, z bigint, start bigint, body binary")
    rows = rows.dropDuplicates(["a", "z", "start"]).repartitionByRange("doc", "a", "z", "start").sortWithinPartitions("doc", "a", "z", "start")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            heads = np.array([h for h, _ in held], np.int64)
            body = b"".join(x for _, x in held)
            return pa.record_batch([pa.array([task], pa.int32()), pa.array([n]), pa.array([heads.tobytes()]), pa.array([body])],
                                   ["task", "n", "heads", "body"])

        for b in batches:
            for r in range(b.num_rows):
                body = b.column(4)[r].as_py()
                held.append(((b.column(1)[r].as_py(), b.column(2)[r].as_py(), b.column(3)[r].as_py(), len(body)), body))
                size += len(body)
                if size >= part_bytes:
                    yield row()
                    n, held, size = n + 1, [], 0
        if held:
            yield row()

    packed = stored(rows.mapInArrow(lean(pack), "task int, n bigint, heads binary, body binary"), "suffix-segments")
    first, before = [], 0
    for r in packed.groupBy("task").agg(F.max("n").alias("last")).orderBy("task").collect():  # one row per task
        first.append((r["task"], before))
        before += r["last"] + 1
    places = packed.sparkSession.createDataFrame(first, "task int, first bigint")
    return packed.join(F.broadcast(places), "task").select((F.col("first") + F.col("n")).cast("int").alias("part"), "heads", "body"), before


_CUT = [pa.int64()] * 4 + [pa.binary()]
_CUT_NAMES = ["doc", "a", "z", "start", "body"]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts rows of bytes (a multiple of 8 to a row): their order, and whether a new key begins at each place in it."""
    order = np.lexsort(keys.view(">u8").T[::-1]) if keys.shape[1] else np.arange(len(keys))
    fresh = np.ones(len(keys), bool)
    s = keys[order].view(np.uint64)
    fresh[1:] = (s[1:] != s[:-1]).any(axis=1)
    return order, fresh


def _agreeing(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and in how many first bytes each agrees with the one before it in the order."""
    order = np.lexsort(keys.view(">u8").T[::-1]) if keys.shape[1] else np.arange(len(keys))
    s = keys[order]
    differ = np.ones((len(s), keys.shape[1] + 1), bool)  # the last column ends rows that agree in all
    differ[1:, :-1] = s[1:] != s[:-1]
    out = differ.argmax(axis=1)
    out[:1] = -1
    return order, out


def _up(n: int) -> int:
    return -(-n // 8) * 8


def samples(body: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, low, high): the anchors of the strings of segments that lie one after the other, and the least and the most
    steps that lead to each. Every string that lies in one segment has one anchor, the first of its least K-byte substrings."""
    k, found, begin = _anchor_bytes(length), [], 0
    width, edge = length - k + 1, np.zeros(length - k, np.uint64)
    whole = np.ones(len(body), bool)
    ends = np.cumsum(sizes)
    whole[(ends[:, None] - np.arange(1, length)).ravel()] = False
    while len(body) - begin >= length:
        a = body[begin:begin + _SPAN]
        h = _grams(a, k)
        least = _slide(h, width, True)
        candidates = np.flatnonzero(h == _slide(np.concatenate([edge, least, edge]), width, False))
        start = np.flatnonzero(whole[begin:begin + len(least)])
        least, at = least[start], start.copy()
        # The first candidate of a string that has its least hash.
        place, open_ = np.searchsorted(candidates, start), np.arange(len(start))
        while len(open_):
            at[open_] = candidates[place[open_]]
            open_ = open_[h[at[open_]] != least[open_]]
            place[open_] += 1
        fresh = np.ones(len(start), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(start)) - 1 if len(first) else first
        found.append((at[first] + begin, at[first] - start[last], at[first] - start[first]))
        if begin + len(a) == len(body):
            break
        begin += len(a) - length + 1
    none = np.zeros(0, np.int64)
    at, low, high = (np.concatenate([none, *x]) for x in (zip(*found, strict=True) if found else [[]] * 3))
    return at, low, high


def _records(body: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """The bytes behind each anchor and those before it, from right to left, as far as its strings go; zeros fill up."""
    ahead, back = _up(length), _up(length - _anchor_bytes(length))
    padded = np.concatenate([np.zeros(back, np.uint8), body, np.zeros(ahead, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, back + ahead)[at]
    out = np.concatenate([rows[:, back:], rows[:, :back][:, ::-1]], axis=1)
    out[:, :ahead][np.arange(ahead) >= (length - low)[:, None]] = 0
    out[:, ahead:][np.arange(back) >= high[:, None]] = 0
    return out


def _later(keys: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, least step, most steps): the strings that an earlier record has too. Records come in the order of their places."""
    ahead, k = _up(length), _anchor_bytes(length)
    order, agree = _agreeing(keys[:, :ahead])
    back, agree_back = _agreeing(keys[:, ahead:])
    marked = np.zeros((len(keys), length - k + 2), bool)
    right, left = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    for step in range(length - k + 1):
        here = np.flatnonzero((low <= step) & (step <= high))
        right[order] = np.cumsum(agree < length - step)
        left[back] = np.cumsum(agree_back < step)
        both = right[here] * (len(keys) + 1) + left[here]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        marked[here[by[1:][same]], step] = True
    edge = np.diff(marked.astype(np.int8), axis=1, prepend=0)
    record, begin = np.nonzero(edge == 1)
    return record, begin, np.nonzero(edge == -1)[1] - 1


_PLACE = np.dtype([("at", "<u4"), ("low", "<u4"), ("high", "<u4"), ("fresh", "u1")])


def _marks(table: DataFrame, length: int, parts: int) -> DataFrame:
    """(part, g0, counts, v0, v1): runs of bytes, in places of the body of each part, that strings marked as repeated cover."""
    k, width = _anchor_bytes(length), _up(length) + _up(length - _anchor_bytes(length))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cell in b.column(0):
                body = np.frombuffer(cell.as_buffer(), np.uint8)[:max(SAMPLE_BYTES, length)]
                at = samples(body, np.array([len(body)]), length)[0]
                at = at[::max(1, len(at) * parts // SAMPLE)]
                yield pa.record_batch([pa.array([body[x:x + k].tobytes() for x in at.tolist()], pa.binary())], ["gram"])

    grams = np.sort(np.array(table.select("body").mapInArrow(lean(sample), "gram binary").toArrow().column(0).to_pylist(), f"S{k}"))
    edges = grams[np.arange(1, parts) * len(grams) // parts] if len(grams) else grams

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                sizes = np.frombuffer(b.column(1)[r].as_buffer(), np.int64).reshape(-1, 4)[:, 3]
                body = np.frombuffer(b.column(2)[r].as_buffer(), np.uint8)
                at, low, high = samples(body, sizes, length)
                keys = _records(body, at, low, high, length)
                order, fresh = _distinct(np.concatenate([keys, np.stack([low, high], axis=1).astype(">u4").view(np.uint8)], axis=1))
                place = np.empty(len(at), _PLACE)
                for c, x in zip(_PLACE.names, (at[order], low[order], high[order], fresh), strict=True):
                    place[c] = x
                keys = keys[order]
                to = np.searchsorted(edges, np.ascontiguousarray(keys[:, :k]).view(f"S{k}").ravel(), "right")
                run = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
                rows = [(to[a], b.column(0)[r].as_py(), place[a:z].tobytes(), pa.compress(keys[a:z][fresh[a:z]].tobytes(), "zstd", asbytes=True))
                        for a, z in zip(run, run[1:], strict=False)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SENT, strict=True)], _SENT_NAMES)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes, places, keys = [], [], []
        for b in batches:
            for r in range(b.num_rows):
                place = np.frombuffer(b.column(2)[r].as_buffer(), _PLACE)
                n = int(place["fresh"].sum())
                homes.append(np.full(len(place), b.column(1)[r].as_py()))
                places.append(place)
                keys.append(np.frombuffer(pa.decompress(b.column(3)[r].as_buffer(), n * width, "zstd"), np.uint8).reshape(n, width))
        if not homes:
            return
        home, place, keys = np.concatenate(homes), np.concatenate(places), np.concatenate(keys)
        low, high, fresh = place["low"].astype(np.int64), place["high"].astype(np.int64), place["fresh"] > 0
        again = np.flatnonzero(~fresh)  # of equal records of a part the first, which is the earliest, came with its bytes
        found = [(again, low[again], high[again])]
        of = np.flatnonzero(fresh)
        order, begins = _distinct(np.concatenate([keys[:, :k], np.zeros((len(keys), _up(k) - k), np.uint8)], axis=1))
        groups = np.append(np.flatnonzero(begins), len(order))
        a = 0
        while a < len(order):
            # Whole groups of one anchor, about `CHUNK` records at once; those that are alone are in no other record.
            z = groups[min(len(groups) - 1, np.searchsorted(groups, a + CHUNK))]
            size = np.diff(groups[np.searchsorted(groups, a):np.searchsorted(groups, z) + 1])
            chosen = order[a:z][np.repeat(size > 1, size)]
            chosen = chosen[np.lexsort((place["at"][of[chosen]], home[of[chosen]]))]
            record, least, most = _later(keys[chosen], low[of[chosen]], high[of[chosen]], length)
            found.append((of[chosen[record]], least, most))
            a = z
        of, least, most = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(home[of], kind="stable")
        of, least, most = of[by], least[by], most[by]
        at = place["at"][of].astype(np.int64)
        each, number = np.unique(home[of], return_inverse=True)
        yield blocks.deal(home[of].astype(np.int32), [each], number, [(at - most).astype(np.uint32), (at - least + length).astype(np.uint32)])

    sent = blocks.together(table.select("part", "heads", "body").mapInArrow(lean(send), "part int, home bigint, places binary, keys binary"), parts)
    return blocks.together(sent.mapInArrow(lean(mark), blocks.schema(1, 2)), parts)


_SENT = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
_SENT_NAMES = ["part", "home", "places", "keys"]


def _removed(table: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, z, start, end): the runs of bytes to remove, merged within a segment."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, _, start, end = blocks.gathered(batches, [np.int64, np.uint32, np.uint32, np.uint32])
        if len(home):
            yield pa.record_batch([pa.array(home[:1].astype(np.int32)), pa.array([start.tobytes()]), pa.array([end.tobytes()])],
                                  ["part", "starts", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                heads = np.frombuffer(b.column(0)[r].as_buffer(), np.int64).reshape(-1, 4)
                start, end = (np.frombuffer(b.column(c)[r].as_buffer(), np.uint32).astype(np.int64) for c in (1, 2))
                order = np.argsort(start, kind="stable")
                start, end = start[order], end[order]
                first = np.cumsum(heads[:, 3]) - heads[:, 3]
                segment = np.searchsorted(first, start, "right") - 1
                # No run goes on behind its segment, so what was reached before is within it or ends before it.
                reach = np.maximum.accumulate(end)
                fresh = np.ones(len(start), bool)
                fresh[1:] = (segment[1:] != segment[:-1]) | (start[1:] > reach[:-1])
                begin = np.flatnonzero(fresh)
                last = np.append(begin[1:], len(start)) - 1
                own, shift = heads[segment[begin]], first[segment[begin]]
                yield pa.record_batch([pa.array(x) for x in (own[:, 0], own[:, 1], own[:, 2] + start[begin] - shift,
                                                             own[:, 2] + reach[last] - shift)], ["a", "z", "start", "end"])

    gathered = marks.mapInArrow(lean(gather), "part int, starts binary, ends binary")
    return table.select("part", "heads").join(gathered, "part").select("heads", "starts", "ends").mapInArrow(
        lean(run), "a bigint, z bigint, start bigint, end bigint")


def repeated(texts: DataFrame, length: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """Runs of repeated bytes of distinct texts (doc, a, z, text), as (a, z, runs)."""
    parts = default_parallelism(texts.sparkSession)
    stretches = stored(_candidates(texts, length, parts), "suffix-stretches")
    table, n = _parts(texts, stretches, length, part_bytes)
    # About as many records are sorted in a task as a part sends.
    found = _removed(table, _marks(table, length, max(parts, n)))
    return found.groupBy("a", "z").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _hashes(text: Column) -> dict[str, Column]:
    return {"a": F.xxhash64(text), "z": F.xxhash64(text, F.lit(1))}


@apart
def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """All rows of `docs` with kept (binary), n_bytes, n_removed and n_spans.

    Texts are UTF-8 bytes, null as none. Removed is every byte covered by a string of `length` bytes
    that also starts earlier: in a row of smaller id, or earlier in the same text. Strings are
    judged on the input and do not cross texts. Equal texts of one id are one text; of different texts
    of one id the one with the smaller hash comes first; null ids come before all others. Rows are neither lost
    nor added, and an empty table gives an empty result. Columns named like a result are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({"_doc": F.coalesce(F.col(id).cast("bigint"), F.lit(-(1 << 63)).cast("bigint")), "_body": body,
                             **{f"_{c}": h for c, h in _hashes(body).items()}})
    copied = stored(rows.where(F.octet_length("_body") >= length).groupBy("_a", "_z").agg(
        F.min("_doc").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "suffix-copies")
    few = F.broadcast(copied) if copied.count() <= BROADCAST_COPIES else copied
    rows = rows.join(few, ["_a", "_z"], "left").withColumn("_copy", F.coalesce(F.col("_doc") > F.col("_first"), F.lit(False)))
    texts = rows.where(~F.col("_copy") & (F.octet_length("_body") >= length)).select(
        F.col("_doc").alias("doc"), F.col("_a").alias("a"), F.col("_z").alias("z"), F.col("_body").alias("text"))
    with small_batches(docs.sparkSession, BATCH):
        found = stored(repeated(texts, length, part_bytes), "suffix-runs")
    runs = found.select(
        F.col("a").alias("_a"), F.col("z").alias("_z"), F.col("runs").alias("_runs"))
    size = F.octet_length("_body").cast("bigint")
    rows = rows.join(runs, ["_a", "_z"], "left").withColumn("_runs", F.when(F.col("_copy"), F.array(F.struct(
        F.lit(0).cast("bigint").alias("start"), size.alias("end")))).otherwise(F.col("_runs")))
    # Not deterministic, so that a filter on the result stays behind it and no text is cut, nor a worker held, twice.
    rows = rows.withColumn("_cut", F.pandas_udf(_cut, "kept binary, n_spans bigint").asNondeterministic()(F.col("_body").cast("binary"), F.col("_runs.start"), F.col("_runs.end")))
    return rows.withColumns({
        "kept": F.col("_cut.kept"), "n_bytes": size, "n_removed": size - F.octet_length("_cut.kept"), "n_spans": F.col("_cut.n_spans"),
    }).drop("_a", "_z", "_doc", "_body", "_first", "_copy", "_runs", "_cut")


def _cut(body: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """The bytes outside the runs, and the number of runs. Those of neighbouring segments may touch or overlap."""
    out = []
    for b, s, e in zip(body, starts, ends, strict=True):
        if s is None:
            out.append((b, 0))
            continue
        s, reach = np.asarray(s), np.maximum.accumulate(np.asarray(e))
        first = np.flatnonzero(np.append(True, s[1:] > reach[:-1]))
        begin, end = [*s[first].tolist(), len(b)], [0, *reach[np.append(first[1:], len(s)) - 1].tolist()]
        out.append((b"".join(b[x:y] for x, y in zip(end, begin, strict=True)), len(first)))
    returned()
    return pd.DataFrame(out, columns=["kept", "n_spans"])
