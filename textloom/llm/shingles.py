"""64-bit hashes of the words and word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from textloom.llm.common import SPACE

SEGMENT = 1 << 17
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_POWERS, _INVERSE = _powers(_BASE, SEGMENT), _powers(pow(_BASE, -1, 1 << 64), SEGMENT)
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z counts as a-z
_IN_WORD = np.ones(256, bool)
_IN_WORD[[ord(c) for c in SPACE]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one text after the other, and where each begins and the last ends."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text. Words do not cross texts."""
    hashes, starts, _ = word_spans(data, offsets)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and length of every word.

    A word's hash is a polynomial in its bytes, taken from running sums over segments; a word that
    goes on behind a segment is put together from its parts.
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    found, starts, lengths = [], [], []
    open_hash, open_length, open_start = 0, 0, 0
    for at in range(0, len(data), SEGMENT):
        b = data[at:at + SEGMENT]
        inside, fresh = _IN_WORD[b], begins[at:at + len(b) + 1]
        before = np.concatenate([[at > 0 and bool(_IN_WORD[data[at - 1]])], inside[:-1]])
        first = np.flatnonzero(inside & (~before | fresh[:-1]))
        last = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | fresh[1:])) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[b] * _POWERS[:len(b)], dtype=np.uint64)])
        carried = len(last) and (not len(first) or first[0] >= last[0])
        if carried:  # the segment begins within a word
            part = (int(sums[last[0]]) * pow(_BASE, open_length, 1 << 64)) & _MASK
            open_hash, open_length = (open_hash + part) & _MASK, open_length + int(last[0])
            last = last[1:]
        goes_on = inside[-1] and at + len(b) < len(data) and not fresh[-1] and _IN_WORD[data[at + len(b)]]
        if carried and not (goes_on and not len(first)):
            found.append(np.array([open_hash], np.uint64) + np.uint64(open_length))
            starts.append(np.array([open_start]))
            lengths.append(np.array([open_length]))
        hashes = (sums[last] - sums[first]) * _INVERSE[first]
        if goes_on and len(first):
            open_hash, open_length, open_start = int(hashes[-1]), int(last[-1] - first[-1]), at + int(first[-1])
            hashes, first, last = hashes[:-1], first[:-1], last[:-1]
        found.append(hashes + (last - first).astype(np.uint64))
        starts.append(first + at)
        lengths.append(last - first)
    none = np.zeros(0, np.int64)
    return (mixed(np.concatenate([none.astype(np.uint64), *found])), np.concatenate([none, *starts]),
            np.concatenate([none, *lengths]))


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's shingles, one text after the other, and their numbers.

    A text of fewer words than `width` has one shingle, all its words; without words it has none.
    """
    words, counts = word_hashes(*utf8(column))
    ends = np.cumsum(counts)
    folded = np.zeros(len(words), np.uint64)
    for k in range(min(width, len(words))):
        folded[:len(words) - k] = mixed(folded[:len(words) - k] * np.uint64(3) + words[k:])
    inside = np.arange(len(words)) + width <= np.repeat(ends, counts)
    found, sizes = [], np.zeros(len(counts), np.int64)
    for t, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
        if n >= width:
            own = np.sort(folded[end - n:end][inside[end - n:end]])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            h = np.full(1, n, np.uint64)
            for w in words[end - n:end]:
                h = mixed(h * np.uint64(3) + w)
            own = h
        else:
            continue
        found.append(own)
        sizes[t] = len(own)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), sizes


def text_slices(batch: pa.RecordBatch, text: int, most: int = 8 << 20) -> list[pa.RecordBatch]:
    """The batch in slices of about `most` bytes of text, so that what is computed for one stays small."""
    lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    cuts = [0]
    while cuts[-1] < batch.num_rows:
        base = total[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(total, base + most, "right"))))
    return [batch.slice(a, z - a) for a, z in zip(cuts, cuts[1:], strict=False)]
