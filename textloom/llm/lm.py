"""A gated recurrent language model over words, trained and applied in blocks of documents.

Documents are coded once: blocks hold each text as numbers into the block's list of distinct words.
Word counts of the training documents are summed over all blocks, so every word of every block
knows its count in the corpus. All words that occur at least twice in the training documents are inputs
and outputs of the model, whatever their number; words seen once or never stand in a class by their
form (length, last character, other than ASCII) and share it by their counts, with one part for words
not seen.

The output is factored: a softmax over classes (of words of like frequency; a form; the end), one over the groups
of the class, and one over the words of the group, each of about the third root of the vocabulary. Words share vectors
by class, by group and by place, on the way in and out; the `FREQUENT` words have inputs and outputs of their own, and every
group and word begins at its count within its class and group. Every task trains on its blocks by back-propagation through windows of
`WINDOW` words, with the state carried into the next window; the weights of a round are averaged,
by words seen, and go into the next. Scoring walks through whole documents, window by window, with
the state carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks
from textloom.llm.common import default_parallelism, stored
from textloom.llm.shingles import mixed, text_slices, utf8, word_spans

#: Words with an input of their own, uses from which a word is in the vocabulary.
FREQUENT = 512
LEAST = 2
#: Units of the state, lanes of a training step, words of a window, rounds.
UNITS = 16
LANES = 256
WINDOW = 16
ROUNDS = 3
RATE = 0.02
#: Rows of a softmax at once.
LOT = 2048
#: Bytes of text in a block.
BLOCK = 4 << 20
FORMS = 32
#: The end's number where the vocabulary has `FREQUENT` words.
END_INPUT = FREQUENT + FORMS


def _forms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The form of each word: length in four steps, last byte in four kinds, bytes beyond ASCII or none."""
    if not len(starts):
        return np.zeros(0, np.uint8)
    last = data[starts + lengths - 1]
    letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
    kind = np.where(letter, 0, np.where(np.isin(last, list(b".!?")), 1, np.where((last >= 48) & (last <= 57), 2, 3)))
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    beyond = high[starts + lengths] > high[starts]
    return (np.digitize(lengths, [4, 7, 11]) * 8 + kind * 2 + beyond).astype(np.uint8)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in order, where each occurs, and the number of every word among them."""
    order = np.argsort(hashes)
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    codes = np.empty(len(hashes), np.int64)
    codes[order] = np.cumsum(new) - 1
    first = order[new]
    return hashes[first], first, codes


def coded(docs: DataFrame, id: str, text: str, fold: int, folds: int) -> DataFrame:
    """Blocks of documents: block, docs, null (1 for a null id), held, counts (words of each), words (hashes
    of the distinct ones), forms, trained (times in training documents), codes (each word's place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        n = TaskContext.get().partitionId() << 32
        for whole in batches:
            for b in text_slices(whole, 1, BLOCK) if whole.num_rows else []:
                data, offsets = utf8(b.column(1))
                hashes, starts, lengths = word_spans(data, offsets)
                counts = np.diff(np.searchsorted(starts, offsets))
                words, first, codes = _distinct(hashes)
                ids = b.column(0).to_pylist()
                held = np.array([i is not None and zlib.crc32(str(i).encode()) % folds == fold for i in ids])
                trained = np.bincount(codes[~np.repeat(held, counts)], minlength=len(words))
                cells = [np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), held.astype(np.uint8),
                         counts.astype(np.uint32), words, _forms(data, starts[first], lengths[first]), trained.astype(np.uint32),
                         _packed(codes)]
                yield pa.record_batch([pa.array([n])] + [pa.array([c.tobytes()], pa.binary()) for c in cells], _CODED)
                n += 1

    return docs.select(F.col(id).cast("bigint"), F.col(text)).mapInArrow(
        run, ", ".join(["block bigint", *(f"{c} binary" for c in _CODED[1:])]))


_CODED = ["block", "docs", "null", "held", "counts", "words", "forms", "trained", "codes"]
_KINDS = {"docs": np.int64, "null": np.uint8, "held": np.uint8, "counts": np.uint32, "words": np.uint64, "forms": np.uint8,
          "trained": np.uint32, "codes": np.uint8, "rare": np.uint64, "uses": np.uint64}


def _packed(codes: np.ndarray) -> np.ndarray:
    """Codes as compressed bytes, all lowest bytes first: most words of a block have few bits."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return np.frombuffer(pa.compress(planes, "zstd", asbytes=True), np.uint8)


def _cells(b: pa.RecordBatch, row: int) -> dict[str, np.ndarray]:
    x = {c: np.frombuffer(b.column(b.schema.get_field_index(c))[row].as_buffer() or b"", k)
         for c, k in _KINDS.items() if c in b.schema.names}
    if "codes" in x:
        n = int(x["counts"].sum())
        planes = np.frombuffer(pa.decompress(x["codes"], 4 * n, "zstd", asbytes=True), np.uint8) if n else x["codes"][:0]
        x["codes"] = planes.reshape(4, n).T.copy().view("<u4").ravel()
    return x


def counted(table: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """(block, rare, uses): words of a block that its own texts and the vocabulary do not tell, as `_places` reads
    them, and their corpus counts; and per task, as cells, its words with at least `LEAST` uses, their counts and forms, and the tokens and
    distinct words of each form."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                x = _cells(b, r)
                yield blocks.deal((x["words"] % np.uint64(parts)).astype(np.int32), [np.array([b.column(0)[r].as_py()], np.int64)],
                                  np.zeros(len(x["words"]), np.int64), [x["words"], x["trained"], x["forms"]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, words, trained, forms = blocks.gathered(batches, [np.int64, np.uint32, np.uint64, np.uint32, np.uint8])
        part = (words[:1] % np.uint64(parts)).astype(np.int64)
        # A block's words of a part come in their order, so where one stands among them need not be sent along.
        place = (np.arange(len(words)) - np.repeat(np.cumsum(counts, dtype=np.int64) - counts, counts)).astype(np.uint32)
        each, first, number = np.unique(words, return_index=True, return_inverse=True)
        uses = np.bincount(number, trained, len(each)).astype(np.uint64)
        # A word that is not in the vocabulary, and used elsewhere too, or only elsewhere.
        untold = np.flatnonzero((uses[number] < LEAST) & (uses[number] != trained))
        of = np.repeat(np.arange(len(block)), counts)[untold]
        home = (mixed(block.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        if len(of):
            back = blocks.deal(home[of], [block, np.repeat(part, len(block))], of, [place[untold], uses[number[untold]]])
            nothing = pa.nulls(back.num_rows)
            yield pa.record_batch([*back.columns, *[nothing.cast(pa.binary())] * 5], _BACK)
        known = uses > 0
        each, uses, form = each[known], uses[known].astype(np.int64), forms[first][known]
        cells = [uses >= LEAST, np.bincount(form, uses, FORMS).astype(np.int64), np.bincount(form, minlength=FORMS).astype(np.int64)]
        cells = [each[cells[0]], uses[cells[0]], form[cells[0]], *cells[1:]]
        blank = [pa.nulls(1, t) for t in (pa.int32(), *[pa.binary()] * 5)]
        yield pa.record_batch([*blank, *(pa.array([c.tobytes()], pa.binary()) for c in cells)], _BACK)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            for r in range(b.num_rows):
                own = np.frombuffer(b.column(1)[r].as_py(), np.int64)
                source, size = np.frombuffer(b.column(2)[r].as_py(), np.uint64), np.frombuffer(b.column(3)[r].as_py(), np.uint32)
                place, uses = np.frombuffer(b.column(4)[r].as_py(), np.uint32), np.frombuffer(b.column(5)[r].as_py(), np.uint64)
                place = (np.repeat(source, size) << np.uint64(32)) + place
                size = np.cumsum(size)[:-1]
                for o, p, u in zip(own.tolist(), np.split(place, size), np.split(uses, size), strict=True):
                    found.setdefault(o, []).append((p, u))
        for block, cells in found.items():
            place, uses = (np.concatenate(c) for c in zip(*cells, strict=True))
            yield pa.record_batch([pa.array([block]), pa.array([place.tobytes()], pa.binary()), pa.array([uses.tobytes()], pa.binary())],
                                  ["block", "rare", "uses"])

    schema = blocks.schema(2, 2) + "".join(f", {c} binary" for c in _SUMS)
    sent = blocks.together(table.select("block", "words", "trained", "forms").mapInArrow(send, blocks.schema(1, 3)), parts)
    sums = stored(sent.mapInArrow(add, schema), "lm-counts")
    uses = blocks.together(sums.where("part IS NOT NULL").select("part", "g0", "g1", "counts", "v0", "v1"), parts)
    return uses.mapInArrow(gather, "block bigint, rare binary, uses binary"), sums.where("part IS NULL").select(*_SUMS)


_SUMS = ["words", "n", "forms", "form_n", "form_d"]
_BACK = ["part", "g0", "g1", "counts", "v0", "v1", *_SUMS]


def _places(words: np.ndarray, rare: np.ndarray, parts: int) -> np.ndarray:
    """Where words of a block stand that are told by part (upper half) and place among its words of that part."""
    part = words % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return order[np.searchsorted(part[order], rare >> np.uint64(32)) + (rare & np.uint64((1 << 32) - 1)).astype(np.int64)]


class Vocabulary:
    """The words with at least `LEAST` uses by rank, and what the forms hold besides them."""

    def __init__(self, sums: DataFrame, train_docs: int) -> None:
        rows = sums.toArrow()
        words, n, forms, form_n, form_d = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), k)
            for c, k in zip(_SUMS, [np.uint64, np.int64, np.uint8, np.int64, np.int64], strict=True))
        by = np.lexsort((words.view(np.int64), -n))
        hashes, self.top_n = words[by], n[by]
        self.form_n, self.form_d = form_n.reshape(-1, FORMS).sum(axis=0), form_d.reshape(-1, FORMS).sum(axis=0)
        self.tokens = int(self.form_n.sum()) + train_docs
        self.distinct = int(self.form_d.sum()) + (train_docs > 0)
        self.form_n -= np.bincount(forms, n, FORMS).astype(np.int64)
        self.form_d -= np.bincount(forms, minlength=FORMS)
        self.train_docs = train_docs
        order = np.argsort(hashes)
        self.sorted, self.rank = hashes[order], order.astype(np.uint32)

    def inputs(self, words: np.ndarray, forms: np.ndarray) -> np.ndarray:
        """The input of each word: its rank, or its form."""
        out = len(self.top_n) + forms.astype(np.int64)
        if len(self.sorted):
            at = np.searchsorted(self.sorted, words).clip(max=len(self.sorted) - 1)
            hit = self.sorted[at] == words
            out[hit] = self.rank[at[hit]]
        return out

    def shares(self, inputs: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's share of its form; 0 for words of the vocabulary."""
        rare = inputs >= len(self.top_n)
        form = np.where(rare, inputs - len(self.top_n), 0)
        share = (uses + 1.0) / (self.form_n[form] + self.form_d[form] + 1.0)
        return np.where(rare, np.log(share), 0.0)


def _choose(x: np.ndarray, w: np.ndarray, bias: np.ndarray | None, target: np.ndarray, scale: float | None = None
            ) -> tuple[np.ndarray, tuple | None]:
    """Log of the softmax of x w + bias at each row's target; with `scale`, the gradients by w and x of the
    negative sum of these times `scale`.

    Exponentials are taken as they are; only where a sum is out of reach of the type is the largest value taken off first.
    `LOT` rows are taken at a time, so that they stay in the cache."""
    if len(target) > LOT:
        cuts = [slice(a, a + LOT) for a in range(0, len(target), LOT)]
        done = [_choose(x[c], w, bias if bias is None else bias[c], target[c], scale) for c in cuts]
        out = np.concatenate([p for p, _ in done])
        return out, None if scale is None else (sum(g[0] for _, g in done), np.concatenate([g[1] for _, g in done]))
    rows = np.arange(len(target))
    y = x @ w
    if bias is not None:
        y += bias
    out = y[rows, target].astype(np.float64)
    with np.errstate(over="ignore"):
        np.exp(y, out=y)
        total = y @ np.ones(y.shape[1], y.dtype)
    if not (total.min() > 1e-30 and total.max() < 1e30):
        y = x @ w
        if bias is not None:
            y += bias
        y -= y.max(axis=1, keepdims=True)
        out = y[rows, target].astype(np.float64)
        np.exp(y, out=y)
        total = y.sum(axis=1)
    out -= np.log(total)
    if scale is None:
        return out, None
    y *= (scale / total)[:, None]
    y[rows, target] -= scale
    return out, ((y.T @ x).T, y @ w.T)


def _summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place once, and the sum of its rows; places ascend."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(rows, first, axis=0)


def _gathered(shape: tuple[int, int], at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A table with the sums of the rows that go to each place."""
    out = np.zeros(shape, np.float32)
    if len(at):
        order = np.argsort(at)
        place, sums = _summed(at[order], rows[order])
        out[place] = sums
    return out


class Model:
    """Weights: own (words, classes, forms and the end x 3 units) and placed (places of both levels, and none, x 3
    units) tables of the inputs, hidden (units x 3 units), outputs over classes; over the groups of the first class, of the
    others, and a factor of each unit by class; over the words of each of the first groups, of the others, and a factor of
    each unit by group."""

    def __init__(self, v: Vocabulary, weights: list[np.ndarray] | None = None) -> None:
        self.n = n = len(v.top_n)
        self.side = side = next(k for k in range(max(1, int(n ** (1 / 3)) - 1), n + 2) if k ** 3 >= n)
        self.groups = groups = max(1, -(-n // side))
        self.classes = classes = max(1, -(-groups // side))
        self.own = own = min(groups, -(-FREQUENT // side))
        self.end = n + FORMS
        u = UNITS
        self.shapes = [(FREQUENT + classes + FORMS + 1, 3 * u), (u, 3 * u), (u, classes + FORMS + 1),
                       (1, classes + FORMS + 1), (2 * side + 1, 3 * u), (u, side), (u, side), (classes, u),
                       (u, own * side), (u, side), (groups, u)]
        # Where each group of a class and each word of a group begins: its count. Places that none has are out of reach.
        uses = np.zeros(classes * side * side)
        uses[:n] = np.asarray(v.top_n)
        counted = uses.reshape(-1, side)
        self.words = np.where(np.arange(counted.size).reshape(counted.shape) < n, np.log(counted + 1), -1e4).astype(np.float32)
        per_group = counted.sum(axis=1).reshape(classes, side)
        self.grouped = np.where(np.arange(per_group.size).reshape(per_group.shape) < groups, np.log(per_group + 1), -1e4).astype(np.float32)
        self.w = weights or []

    @classmethod
    def fresh(cls, v: Vocabulary) -> Model:
        """Small random weights; the outputs begin at the words' frequencies."""
        rng, m = np.random.default_rng(11), cls(v)
        m.w = [rng.normal(0, 0.1, s).astype(np.float32) for s in m.shapes]
        n = np.zeros(m.classes * m.side * m.side)
        n[:m.n] = v.top_n
        per_class = np.concatenate([n.reshape(m.classes, -1).sum(axis=1), v.form_n, [v.train_docs]]) + 1
        m.w[3][0] = np.log(per_class / per_class.sum())
        m.w[7] += 1
        m.w[10] += 1
        return m

    @classmethod
    def load(cls, cell: bytes, v: Vocabulary) -> Model:
        flat, m, at = np.frombuffer(cell, np.float64), cls(v), 0
        for s in m.shapes:
            m.w.append(flat[at:at + s[0] * s[1]].reshape(s).astype(np.float32))
            at += s[0] * s[1]
        return m

    def class_of(self, inputs: np.ndarray) -> np.ndarray:
        return np.where(inputs < self.n, inputs // self.side ** 2, inputs - self.n + self.classes)

    def read(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The row of the own table and the two of the placed one that an input reads; the last place is for those
        with a row of their own."""
        common = (inputs >= FREQUENT) & (inputs < self.n)
        own = np.where(inputs < min(FREQUENT, self.n), inputs, FREQUENT + self.class_of(inputs))
        none = 2 * self.side
        return own, np.where(common, inputs // self.side % self.side, none), np.where(common, self.side + inputs % self.side, none)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.w]).astype(np.float64)

    def steps(self, inputs: np.ndarray, h: np.ndarray, active: list[int] | None = None, keep: bool = False,
              fresh: np.ndarray | None = None) -> tuple[np.ndarray, list]:
        """States before each step's word is read: (time, lanes, units), and what the way back needs. `h` is carried on in place.

        `active`: lanes, from the first, that still go on; `fresh`: where a text begins, with an empty state.
        """
        u, width = UNITS, inputs.shape[1]
        own, group, place = self.read(inputs)
        x = self.w[0].take(own, axis=0)
        x += self.w[4].take(group, axis=0)
        x += self.w[4].take(place, axis=0)
        # A gate is 0.5 + 0.5 tanh(half of its sum).
        x[:, :, :2 * u] *= 0.5
        hidden = self.w[1].copy()
        hidden[:, :2 * u] *= 0.5
        states, saved = np.empty((*inputs.shape, u), np.float32), []
        gates, news, turned = (np.empty((*inputs.shape, k), x.dtype) for k in ((2 * u, u, u) if keep else (0, 0, 0)))
        for t in range(len(inputs)):
            a = active[t] if active else width
            if fresh is not None:
                h[fresh[t]] = 0
            states[t] = h
            prev = h[:a]
            y = prev @ hidden
            zr = y[:, :2 * u] + x[t, :a, :2 * u]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            n = zr[:, u:] * y[:, 2 * u:]
            n += x[t, :a, 2 * u:]
            np.tanh(n, out=n)
            if keep:
                gates[t], news[t], turned[t] = zr, n, y[:, 2 * u:]
            prev -= n
            prev *= zr[:, :u]
            prev += n
        if keep:
            saved = [states, gates[:, :, :u], gates[:, :, u:], news, turned]
        return states, saved

    def log_p(self, states: np.ndarray, targets: np.ndarray, back: bool = False, order: np.ndarray | None = None
              ) -> tuple[np.ndarray, list | None]:
        """Natural logarithm of each target's probability given the state before it (for rare words, of the
        form), and the gradients of the mean loss by the weights from the third on and by the states, if asked.
        `order` puts the targets in order, if that is known."""
        w, side, u, scale = self.w, self.side, UNITS, 1 / len(targets) if back else None
        # In order of the targets, those of a class, a group and a word are neighbours; forms and ends come last.
        order = np.argsort(targets) if order is None else order
        target = targets[order]
        s = np.ones((len(target), u + 1), np.result_type(states, w[2]))
        s[:, :u] = states[order]
        out, g = _choose(s, np.concatenate([w[2], w[3]]), None, self.class_of(target), scale)
        grads, d_s = [], None
        if back:
            grads = [g[0][:u], g[0][u:], None, *(np.zeros_like(x) for x in w[5:])]
            d_s = g[1][:, :u]
        words = int(np.searchsorted(target, self.n))
        target = target[:words]
        group = target // side
        kind = group // side
        first, own = int(np.searchsorted(kind, 1)), int(np.searchsorted(group, self.own))
        edges = np.searchsorted(group[:own], np.arange(self.own + 1))
        # (rows, weights, their columns, rows of the biases, targets, and the factors with their rows, if any)
        steps = [(slice(0, first), 5, slice(0, side), self.grouped[:1], group[:first] % side, None, None),
                 (slice(first, words), 6, slice(0, side), None, group[first:] % side, 7, kind[first:])]
        steps += [(slice(a, z), 8, slice(k * side, (k + 1) * side), self.words[k:k + 1], target[a:z] % side, None, None)
                  for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False))]
        steps.append((slice(own, words), 9, slice(0, side), None, target[own:] % side, 10, group[own:]))
        for rows, at, columns, bias, to, factors, by in steps:
            if not len(to):
                continue
            if factors is None:
                # The first class and the first groups have one row of biases, which goes with the weights.
                p, g = _choose(s[rows], np.concatenate([w[at][:, columns], bias]), None, to, scale)
            else:
                factor, x = w[factors].take(by, axis=0), s[rows, :u]
                p, g = _choose(x * factor, w[at], (self.grouped if at == 6 else self.words).take(by, axis=0), to, scale)
            out[rows] += p
            if not back:
                continue
            if factors is None:
                grads[at - 2][:, columns] += g[0][:u]
                d_s[rows] += g[1][:, :u]
            else:
                grads[at - 2] += g[0]
                place, rest = _summed(by, x * g[1])
                grads[factors - 2][place] = rest
                d_s[rows] += g[1] * factor
        back_to = np.empty_like(out)
        back_to[order] = out
        if not back:
            return back_to, None
        d_states = np.empty_like(d_s)
        d_states[order] = d_s
        return back_to, [*grads, d_states]

    def gradients(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        """Of one window (time, lanes): the state before a word predicts it, then reads it."""
        states, (prev, z, r, n, turned) = self.steps(inputs, h, keep=True, fresh=fresh)
        flat, u = inputs.ravel(), UNITS
        order = np.argsort(flat)
        _, g = self.log_p(states.reshape(-1, u), flat, back=True, order=order)
        d_states = g[-1].reshape(states.shape)
        by_n, by_z, by_r = (1 - z) * (1 - n * n), (prev - n) * z * (1 - z), turned * r * (1 - r)
        d_x, d_y = np.empty((*inputs.shape, 3 * u), np.float32), np.empty((*inputs.shape, 3 * u), np.float32)
        d_h, back = np.zeros_like(h), np.ascontiguousarray(self.w[1].T)
        for t in range(len(inputs) - 1, -1, -1):
            x, y = d_x[t], d_y[t]
            np.multiply(d_h, by_z[t], out=x[:, :u], casting="same_kind")
            np.multiply(d_h, by_n[t], out=x[:, 2 * u:], casting="same_kind")
            np.multiply(x[:, 2 * u:], by_r[t], out=x[:, u:2 * u], casting="same_kind")
            y[:, :2 * u] = x[:, :2 * u]
            np.multiply(x[:, 2 * u:], r[t], out=y[:, 2 * u:], casting="same_kind")
            d_h = d_h * z[t]
            d_h += y @ back
            d_h += d_states[t]
            d_h[fresh[t]] = 0
        d_hidden = prev.reshape(-1, u).T @ d_y.reshape(-1, 3 * u)
        # Rows of the own table are in the order of the words.
        flat, rows = flat[order], d_x.reshape(-1, 3 * u)[order]
        own, group, place = self.read(flat)
        tables = np.zeros(self.shapes[0], np.float32)
        at, sums = _summed(own, rows)
        tables[at] = sums
        common = np.flatnonzero(group < 2 * self.side)
        both = rows[common]
        placed = _gathered(self.shapes[4], np.concatenate([group[common], place[common]]), np.concatenate([both, both]))
        placed[2 * self.side] = 2 * (np.ones(len(rows), np.float32) @ rows - np.ones(len(both), np.float32) @ both)
        return [tables, d_hidden, g[0], g[1], placed, *g[3:-1]]


class Adam:
    """Steps on all weights at once, which the model then has in one array."""

    def __init__(self, model: Model) -> None:
        self.w = np.concatenate([x.ravel() for x in model.w])
        self.m, self.v, self.rest = (np.zeros_like(self.w) for _ in range(3))
        edges = np.cumsum([0, *(x.size for x in model.w)])
        model.w = [self.w[a:z].reshape(x.shape) for a, z, x in zip(edges, edges[1:], model.w, strict=False)]
        self.t = 0

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        self.t += 1
        g, m, v, rest = np.concatenate([x.ravel() for x in grads]), self.m, self.v, self.rest
        g *= np.float32(min(1.0, 1.0 / (np.sqrt(float(g @ g)) + 1e-12)))
        rate = rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        m *= np.float32(0.9)
        m += np.multiply(g, np.float32(0.1), out=rest)
        v *= np.float32(0.999)
        g *= g
        g *= np.float32(0.001)
        v += g
        np.sqrt(v, out=rest)
        rest += np.float32(1e-8)
        np.divide(m, rest, out=rest)
        rest *= np.float32(rate)
        self.w -= rest


def _stream(x: dict, v: Vocabulary, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of the chosen documents one after the other, each with its end, and where documents begin."""
    inputs = v.inputs(x["words"], x["forms"])[x["codes"]]
    counts = x["counts"].astype(np.int64)
    pick = np.repeat(chosen, counts)
    ends = np.cumsum(counts[chosen])
    flat = np.insert(inputs[pick], ends, len(v.top_n) + FORMS)
    starts = np.zeros(len(flat), bool)
    starts[np.append(0, (ends + np.arange(1, len(ends) + 1))[:-1])[:len(ends)]] = True
    return flat, starts


def train(table: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The model after `rounds` rounds; each block is used in one of them, and every training document once."""
    model = Model.fresh(v)

    def round_of(k: int, weights: bytes) -> Model | None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model.load(weights, v)
            adam, seen = Adam(own), 0
            for b in batches:
                for r in range(b.num_rows):
                    x = _cells(b, r)
                    flat, starts = _stream(x, v, x["held"] == 0)
                    lanes = min(LANES, max(1, len(flat) // WINDOW))
                    steps = -(-len(flat) // lanes)
                    pad = lanes * steps - len(flat)
                    flat, starts = np.append(flat, np.full(pad, own.end)), np.append(starts, np.ones(pad, bool))
                    flat, starts = flat.reshape(lanes, steps).T, starts.reshape(lanes, steps).T
                    h = np.zeros((lanes, UNITS), np.float32)
                    for t in range(0, steps, WINDOW):
                        adam.step(own.gradients(flat[t:t + WINDOW], starts[t:t + WINDOW], h), RATE / (1 + k))
                    seen += lanes * steps
            if seen:
                yield pa.record_batch([pa.array([(own.flat() * seen).tobytes()], pa.binary()), pa.array([float(seen)])], ["w", "seen"])

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, seen = None, 0.0
            for b in batches:
                for r in range(b.num_rows):
                    one = np.frombuffer(b.column(0)[r].as_py(), np.float64)
                    w, seen = one if w is None else w + one, seen + b.column(1)[r].as_py()
            if w is not None:
                yield pa.record_batch([pa.array([w.tobytes()], pa.binary()), pa.array([seen])], ["w", "seen"])

        schema = "w binary, seen double"
        mine = table.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == k).select("counts", "held", "words", "forms", "codes")
        done = mine.mapInArrow(run, schema)
        # Sums of sums: no task adds more than a few dozen tables of weights.
        for n in (256, 16, 1):
            done = done.repartition(n).mapInArrow(total, schema) if n < 256 or default_parallelism(table.sparkSession) > 1024 else done
        last = done.collect()
        return Model.load((np.frombuffer(last[0]["w"], np.float64) / last[0]["seen"]).tobytes(), v) if last else None

    for k in range(rounds):
        model = round_of(k, model.flat().tobytes()) or model
    return model


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", fold: int = 2, folds: int = 7, rounds: int = ROUNDS) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    The model learns from the documents whose crc32(id as text) modulo `folds` is not `fold`, all of them,
    and scores all. Words are lower-cased (A-Z), and an end counts as one more token. Null and empty texts
    have the end only; a null id counts as one to learn from and stays null; repeated rows count each;
    other columns are not read; an empty table gives an empty result. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    parts = default_parallelism(spark)
    table = stored(coded(docs, id, text, fold, folds), "lm-blocks")
    uses, sums = counted(table, parts)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(int((np.frombuffer(h, np.uint8) == 0).sum()) for b in batches for h in b.column(0).to_pylist())
        yield pa.record_batch([pa.array([n])], ["n"])

    train_docs = table.select("held").mapInArrow(trained, "n bigint").agg(F.sum("n")).first()[0] or 0
    v = Vocabulary(sums, train_docs)
    weights = train(table, v, rounds).flat().tobytes() if train_docs else Model.fresh(v).flat().tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.load(weights, v)
        for b in batches:
            for r in range(b.num_rows):
                x = _cells(b, r)
                counts = x["counts"].astype(np.int64)
                of = np.repeat(np.arange(len(counts)), counts)
                inputs = v.inputs(x["words"], x["forms"])
                used = x["trained"].astype(np.float64)
                used[inputs < len(v.top_n)] = v.top_n[inputs[inputs < len(v.top_n)]]
                used[_places(x["words"], x["rare"], parts)] = x["uses"]
                share = np.bincount(of, v.shares(inputs, used)[x["codes"]], len(counts))
                known = np.bincount(of, (used > 0)[x["codes"]], len(counts)).astype(np.int64)
                norm = np.log10(v.tokens + 1.0 * (v.distinct + 1))
                base = np.bincount(of, (np.log10(used + 1) - norm)[x["codes"]], len(counts)) + np.log10(v.train_docs + 1.0) - norm
                total = share + _walk(model, inputs[x["codes"]], counts)
                ids = pa.array(x["docs"], mask=x["null"].astype(bool))
                yield pa.record_batch([
                    ids, pa.array(x["held"].astype(bool)), pa.array(counts + 1), pa.array(known + (v.train_docs > 0)),
                    pa.array(np.full(len(counts), v.tokens)), pa.array(base), pa.array(total / np.log(10))], _SCORED)

    # Few words are told about, so this side is small, and Spark sends it to the blocks where it is small enough.
    uses = stored(uses, "lm-rare")
    joined = table.select("block", "docs", "null", "held", "counts", "words", "forms", "trained", "codes").join(uses, "block", "left").drop("block")
    return joined.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                  "base_score double, score double").withColumnRenamed("doc_id", id)


_SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _walk(model: Model, inputs: np.ndarray, counts: np.ndarray, lanes: int = 512) -> np.ndarray:
    """Natural log-likelihood of each whole document under the model (rare words by form). Documents of
    like length walk side by side; the state goes along from window to window."""
    total = np.zeros(len(counts))
    begins, by_length = np.cumsum(counts) - counts, np.argsort(-counts, kind="stable")
    for g in range(0, len(counts), lanes):
        own = by_length[g:g + lanes]
        size = counts[own] + 1  # with the end
        h = np.zeros((len(own), UNITS), np.float32)
        for t in range(0, int(size[0]), WINDOW):
            steps = min(WINDOW, int(size[0]) - t)
            active = [int(np.searchsorted(-size, -(t + s), "left")) for s in range(steps)]
            width = active[0]
            at = begins[own[:width], None] + np.arange(t, t + steps)
            end = np.arange(t, t + steps) >= size[:width, None] - 1
            tokens = np.where(end, model.end, inputs[np.where(end, 0, at)] if len(inputs) else model.end).T
            h = h[:width]
            states, _ = model.steps(tokens, h, active)
            live = np.arange(width) < np.array(active)[:, None]
            p, _ = model.log_p(states[live], tokens[live])
            total[own[:width]] += np.bincount(np.nonzero(live)[1], p, width)
    return total
