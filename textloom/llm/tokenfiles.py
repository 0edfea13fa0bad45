"""Token ids in flat binary files.

A folder holds, for each part k, `k.ids` (unsigned 16- or 32-bit little-endian integers, all
documents one after the other), `k.ends` (unsigned 64-bit: ids before the end of each document,
within the part) and `k.docs` (signed 64-bit document ids). Parts are in ascending order of the
document ids, so a prefix sum over the parts' totals gives where each part begins in the whole.
Files are written under another name and renamed, so a repeated task leaves one whole file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import small_batches
from textloom.llm.shingles import text_slices

#: Bytes of pieces in a worker's cache of encoded pieces, some 100 for the entry of each included. Once half of it is
#: new, the other half goes, except for what was met again.
CACHE = 48 << 20
_ENTRY = 100
#: New pieces that go to the tokenizer together, and bytes of text that are cut together.
TOGETHER = 10_000
SLICE = 2 << 20
#: Ids of one row on reading; a longer document is read in several rows.
READ_IDS = 1 << 20


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _write(filesystem: pafs.FileSystem, path: str, chunks: Iterator[bytes]) -> None:
    trial = f"{path}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(trial) as out:
        for chunk in chunks:
            out.write(chunk)
    filesystem.move(trial, path)


_MARK = "\x01"
_LINE_END = 198
_SIGNS = ".,;:!?"
#: White space in a row, or other than the space and the line end, and the mark itself.
_WHOLE = ("[ \n][ \n]|[\\x{01}\\t\\r\\x{0b}\\x{0c}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
          "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
#: A sign before a space that does not stand behind a letter or digit, and so may belong to a longer piece.
_SIGN_APART = f"(^|[^\\pL\\pN])[{_SIGNS}] "


class Encoder:
    """Encodes texts with a tokenizer file of byte-level BPE, piece by piece through a cache.

    The pattern of these tokenizers takes a single space as the beginning of the next word, a
    single line end as a piece of its own, and a sign behind a letter or digit apart from both
    that and the space behind it. So a text may be cut there, and each distinct piece is
    encoded once: Arrow cuts a column and finds its distinct pieces, and new ones go to the
    tokenizer together, a line each. Texts with other white space, white space in a row, or an
    added token of the tokenizer are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # Texts that hold an added token, like one for the end of a text, are encoded whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._empty()
        self._renew()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.bytes, self.filled = 0, 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def _renew(self) -> None:
        """What is cached becomes the old half."""
        self.old = self.place, self.ids, self.ends
        self._empty()

    def _spans(self, place: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin, and how many they are."""
        start = np.where(place > 0, ends[place - 1], 0)
        return start, ends[place] - start

    def _plain(self, text: str) -> np.ndarray:
        # The call that gives ids without the places of tokens in the text.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _put(self, pieces: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n, base = len(self.place), self.filled
        self.place.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.bytes += sum(map(len, pieces)) + _ENTRY * len(pieces)
        self.filled += len(flat)
        while self.filled > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        while n + len(pieces) > len(self.ends):
            self.ends = np.append(self.ends, np.zeros_like(self.ends))
        self.ids[base:self.filled] = flat
        self.ends[n:n + len(pieces)] = base + np.cumsum(lengths)

    def _learn(self, pieces: list[str]) -> None:
        known, ids, ends = self.old
        again = [p for p in pieces if p in known]
        start, length = self._spans(np.array([known[p] for p in again], np.int64), ends)
        self._put(again, _ranges(ids, start, length), length)
        texts = {p: p[1:] if p[:1] == _MARK else " " + p for p in pieces if p not in known}
        for piece in [p for p, t in texts.items() if t in ("", " ", "\n")]:
            ids = self._plain(texts.pop(piece))
            self._put([piece], ids, np.array([len(ids)]))
        keys = list(texts)
        for own in (keys[k:k + TOGETHER] for k in range(0, len(keys), TOGETHER)):
            # The line ends between the pieces are tokens of their own.
            ids = np.append(self._plain("\n".join([texts[p] for p in own])), np.uint32(_LINE_END))
            breaks = np.flatnonzero(ids == _LINE_END)
            self._put(own, np.delete(ids, breaks), np.diff(breaks, prepend=-1) - 1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column without nulls, one after the other, and their number in each text."""
        texts = texts.cast(pa.string())
        whole = pc.match_substring_regex(texts, _WHOLE)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        cut = pc.binary_join_element_wise(pa.scalar(_MARK), pc.if_else(whole, "", texts), "")
        cut = pc.replace_substring(cut, "\n", f" {_MARK}\n {_MARK}")
        apart, signed = pc.match_substring_regex(pc.utf8_slice_codeunits(cut, 1), _SIGN_APART), cut
        for sign in _SIGNS:
            signed = pc.replace_substring(signed, f"{sign} ", f" {_MARK}{sign} ")
        pieces = pc.split_pattern(pc.if_else(apart, cut, signed), " ")
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.bytes > CACHE // 2:
            self._renew()
        get = self.place.get
        place = np.array([get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            self._learn([words[k] for k in new])
            place[new] = [get(words[k]) for k in new]
        start, length = self._spans(place, self.ends)
        at = coded.indices.to_numpy()
        start, length = start[at], length[at]
        ends = np.cumsum(length)
        flat = _ranges(self.ids, start, length)
        counts = np.diff(np.append(0, ends)[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()])
        for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            own = self._plain(texts[int(k)].as_py())
            flat = np.insert(flat, counts[:k].sum(), own)
            counts[k] += len(own)
        return flat, counts


def _ranges(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The values of all ranges, one after the other."""
    ends = np.cumsum(length)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file; its cache serves all tasks of the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop the worker's encoders and their caches."""
    _encoders.clear()


def write_tokens(docs: DataFrame, folder: str, encode: Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]], end_id: int,
                 vocabulary: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents, in ascending order of id, and return the list of parts:
    part, n_docs, n_ids, first_doc, first_id, folder, width (bytes of an id).

    `encode` gives, in a worker, the function from texts to ids and counts; `end_id` closes each
    document. Null and empty texts have only the end id. Null ids come first and are written as
    the least 64-bit number; rows of one id are ordered by the hash of their text. An empty
    table gives an empty list. Other columns are not read.
    """
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")
    low = F.lit(-(1 << 63)).cast("bigint")
    rows = docs.select(F.coalesce(F.col(id).cast("bigint"), low).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, total = TaskContext.get().partitionId(), None, 0
        ends, ids = [], []

        def chunks() -> Iterator[bytes]:
            nonlocal run, total
            for b in (part for whole in batches if whole.num_rows for part in text_slices(whole, 1, SLICE)):
                run = run or encode()
                flat, counts = run(b.column(1))
                ids.append(b.column(0).to_numpy())
                ends.append(total + np.cumsum(counts + 1))
                total = int(ends[-1][-1])
                yield np.insert(flat, np.cumsum(counts), end_id).astype(kind).tobytes()

        filesystem, root = open_folder(folder)
        base = f"{root}/{part:06d}"
        _write(filesystem, f"{base}.ids", chunks())
        if ids:
            _write(filesystem, f"{base}.ends", (x.astype("<u8").tobytes() for x in ends))
            _write(filesystem, f"{base}.docs", (x.astype("<i8").tobytes() for x in ids))
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([sum(map(len, ids))]), pa.array([total])],
                                  ["part", "n_docs", "n_ids"])

    filesystem, root = open_folder(folder)
    filesystem.create_dir(root, recursive=True)
    # One row per part: its totals. The prefix sums need no more than these.
    with small_batches(docs.sparkSession, 2 * SLICE):
        parts = sorted(rows.mapInArrow(write, "part int, n_docs bigint, n_ids bigint").collect())
    listed, doc, first = [], 0, 0
    for p in parts:
        listed.append((p["part"], p["n_docs"], p["n_ids"], doc, first, folder, width))
        doc, first = doc + p["n_docs"], first + p["n_ids"]
    return docs.sparkSession.createDataFrame(
        listed, "part int, n_docs bigint, n_ids bigint, first_doc bigint, first_id bigint, folder string, width int")


def _loaded(filesystem: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(filesystem, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    return np.frombuffer(filesystem.open_input_file(path).read(), kind)


READ = "doc_id bigint, position bigint, start bigint, offset bigint, ids array<int>"


def read_tokens(parts: DataFrame, read_ids: int = READ_IDS, use: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
                schema: str = READ) -> DataFrame:
    """The documents of the files: doc_id, position (rank among all documents), start (ids of all
    documents before it), offset (ids of the document before this row) and ids.

    Files in a local or mounted folder are memory-mapped. A document of more than `read_ids` ids
    comes in several rows. One task reads one part. `use` makes other rows, of `schema`, of these in the same process.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in (r for b in batches for r in b.to_pylist()):
            filesystem, root = open_folder(part["folder"])
            base = f"{root}/{part['part']:06d}"
            ids = _loaded(filesystem, f"{base}.ids", f"<u{part['width']}")
            ends = _loaded(filesystem, f"{base}.ends", "<u8").astype(np.int64)
            docs = np.asarray(_loaded(filesystem, f"{base}.docs", "<i8"))
            begins = np.append(0, ends[:-1])
            rows = -(-(ends - begins) // read_ids)  # of each document
            of = np.repeat(np.arange(len(docs)), rows)
            offset = (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)) * read_ids
            cuts = np.append(begins[of] + offset, len(ids))
            at = 0
            while at < len(of):
                to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + read_ids, "right")) - 1)
                own = cuts[at:to + 1]
                yield pa.record_batch([
                    pa.array(docs[of[at:to]]), pa.array(of[at:to] + part["first_doc"]),
                    pa.array(begins[of[at:to]] + part["first_id"]), pa.array(offset[at:to]),
                    pa.ListArray.from_arrays(pa.array((own - own[0]).astype(np.int32)),
                                             pa.array(ids[own[0]:own[-1]].astype(np.int32))),
                ], ["doc_id", "position", "start", "offset", "ids"])
                at = to

    return parts.repartition(max(1, parts.count()), "part").mapInArrow((lambda batches: use(read(batches))) if use else read, schema)
