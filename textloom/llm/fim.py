"""Fill-in-middle transformation: cuts found with a wavelet matrix over character classes.

A text is a row of units: runs of the letters A-Z and a-z, and single other characters. Every byte
of its UTF-8 form has one of eight classes, which tell whether a unit begins there and whether a
character does. A wavelet matrix over the classes answers how often a class occurs before a place,
so three rank queries give the units before it (all bytes but letters within a run and inner bytes of
a character), and one the characters. Units before a place never fall along the text, so bisection
on these ranks finds the place where any given number of units ends; all cuts of a slice of texts
are looked for at once. Long texts are indexed in segments, whose ranks begin at the totals before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.llm.shingles import text_slices, utf8

SENTINELS = ("<P>", "<S>", "<M>")
#: Shares of a hundred: texts left plain, and cut ones with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of one wavelet matrix, and of the texts handled together.
SEGMENT = 1 << 21
SLICE = 2 << 20

# Classes. In the first two no unit begins; in the second no character does.
WITHIN, INNER, UPPER, LOWER, DIGIT, BLANK, SIGN, BEYOND = range(8)
_LEVELS = 3
_CLASS = np.full(256, SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = BLANK
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = DIGIT, UPPER, LOWER
_CLASS[128:192], _CLASS[192:] = INNER, BEYOND


def classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The class of each byte; `begins` are the places at which texts begin."""
    found = _CLASS[data]
    letter = (found == UPPER) | (found == LOWER)
    goes_on = letter.copy()
    goes_on[1:] &= letter[:-1]
    goes_on[:1] = False
    goes_on[begins[begins < len(data)]] = False
    found[goes_on] = WITHIN
    return found


class WaveletMatrix:
    """Rank over a row of small numbers: one bit vector for each bit, zeros of a level before its ones in the next."""

    def __init__(self, values: np.ndarray, levels: int = _LEVELS) -> None:
        self.size, self.levels, self.bits, self.before, self.zeros = len(values), levels, [], [], []
        for level in range(levels):
            bit = (values >> (levels - 1 - level)) & 1
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - self.before[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.bits[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(below)

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How often `value` occurs before each place."""
        start, end = np.zeros_like(at), at
        for level in range(self.levels):
            a, z = self._ones(level, start), self._ones(level, end)
            start, end = (self.zeros[level] + a, self.zeros[level] + z) if value >> (self.levels - 1 - level) & 1 else (start - a, end - z)
        return end - start


class Units:
    """Units and characters before any place of some bytes, from the ranks of their segments."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, segment: int = SEGMENT) -> None:
        self.segment, self.parts = segment, []
        self.units_before, self.chars_before = [0], [0]
        for at in range(0, max(len(data), 1), segment):
            # One byte more in front shows whether a letter goes on.
            lead = min(at, 1)
            own = data[at - lead:at + segment]
            inside = begins[(begins >= at - lead) & (begins < at + segment)] - (at - lead)
            part = WaveletMatrix(classes(own, inside)[lead:])
            self.parts.append(part)
            end = np.array([part.size])
            self.units_before.append(self.units_before[-1] + int(self._local(part, end)[0]))
            self.chars_before.append(self.chars_before[-1] + int(part.size - part.rank(INNER, end)[0]))

    @staticmethod
    def _local(part: WaveletMatrix, at: np.ndarray) -> np.ndarray:
        return at - part.rank(WITHIN, at) - part.rank(INNER, at)

    def _each(self, at: np.ndarray, count, before: list[int]) -> np.ndarray:  # noqa: ANN001
        out, which = np.empty(len(at), np.int64), np.minimum(at // self.segment, len(self.parts) - 1)
        for k in np.unique(which):
            own = which == k
            out[own] = before[k] + count(self.parts[k], at[own] - k * self.segment)
        return out

    def units(self, at: np.ndarray) -> np.ndarray:
        return self._each(at, self._local, self.units_before)

    def chars(self, at: np.ndarray) -> np.ndarray:
        return self._each(at, lambda part, x: x - part.rank(INNER, x), self.chars_before)

    def ends(self, low: np.ndarray, high: np.ndarray, units: np.ndarray) -> np.ndarray:
        """For each text [low, high) the place where its first `units` units end: the last one before
        which no more units begin. Bisection on ranks."""
        goal = self.units(low) + units
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            fits = self.units(middle) <= goal[open_]
            low[open_[fits]], high[open_[~fits]] = middle[fits], middle[~fits] - 1
        return low


def _cut(b: pa.RecordBatch, plain: int, suffix_first: int, sentinels: tuple[str, ...]) -> list[pa.Array]:
    """n_units, form, prefix_chars, middle_chars and output of a batch (h1, h2, h3, h4, text)."""
    data, offsets = utf8(b.column(4))
    h1, h2, h3, h4 = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
    begin, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    index = Units(data, begin)
    n = index.units(end) - index.units(begin)
    one, two = h1 % (n + 1), h2 % (n + 1)
    text = b.column(4).cast(pa.large_string()).fill_null("")
    left = (end == begin) | (h3 % 100 >= 100 - plain)
    for mark in sentinels:
        left |= pa.compute.match_substring(text, mark).to_numpy(zero_copy_only=False)
    spm = h4 % 100 < suffix_first
    first = index.ends(begin, end, np.minimum(one, two))
    second = index.ends(begin, end, np.maximum(one, two))
    prefix, middle = index.chars(first) - index.chars(begin), index.chars(second) - index.chars(first)
    p, s, m = (x.encode() for x in sentinels)
    whole, out = data.tobytes(), []
    for k in range(len(begin)):
        a, x, y, z = begin[k], first[k], second[k], end[k]
        if left[k]:
            out.append(whole[a:z])
        elif spm[k]:
            out.append(b"".join([s, whole[y:z], p, whole[a:x], m, whole[x:y]]))
        else:
            out.append(b"".join([p, whole[a:x], s, whole[y:z], m, whole[x:y]]))
    return [pa.array(n), pa.array(np.where(left, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
            pa.array(prefix, mask=left), pa.array(middle, mask=left), pa.array(out, pa.binary()).cast(pa.string())]


RESULT = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
          StructField("middle_chars", LongType()), StructField("output", StringType())]


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1, plain: int = PLAIN,
              suffix_first: int = SUFFIX_FIRST, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All rows of `docs` with n (units), form, prefix_chars, middle_chars and output.

    Both cuts are drawn from the sha256 of `seed`, a colon and the id, so they do not depend on order,
    partitions or repeated runs; equal rows get equal cuts. A text without characters, or one that holds
    a sentinel, stays plain, and so do `plain` of a hundred; of the others `suffix_first` of a hundred have
    the suffix first (spm), the rest the prefix (psm). Null texts count as empty, their output is an empty
    text; a null id draws as an empty one. Rows are neither lost nor added, an empty table gives an empty
    result, and columns named like a result are replaced.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    kept = [f for f in docs.schema.fields if f.name not in {r.name for r in RESULT}]
    # In a struct of its own, the caller's columns meet no name of these.
    rows = docs.select(*[F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)],
                       F.col(text).cast("string").alias("body"), F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, 4, SLICE) if whole.num_rows else []:
                yield pa.record_batch([*b.column(5).flatten(), *_cut(b, plain, suffix_first, sentinels)],
                                      [*(f.name for f in kept), *(f.name for f in RESULT)])

    return rows.mapInArrow(run, StructType([*kept, *RESULT]))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that `output` was made of. A cut text holds no sentinel, so each stands in it once."""
    p, s, m = (F.lit(x) for x in sentinels)
    part = lambda x, mark, k: F.split_part(x, mark, F.lit(k))
    head, middle = part(output, m, 1), part(output, m, 2)
    psm = F.concat(part(part(head, p, 2), s, 1), middle, part(head, s, 2))
    spm = F.concat(part(head, p, 2), middle, part(part(head, p, 1), s, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
