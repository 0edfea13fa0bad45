import math
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import words

from textloom.llm import lm


def check(rows, docs):
    held = [zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for d, _ in docs]
    texts = [[*words(x), None] for _, x in docs]
    c = Counter(w for t, h in zip(texts, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((d, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6))
                  for (d, _), h, t in zip(docs, held, texts, strict=True))
    got = sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_held_out(llm, documents):
    """On documents it has not seen the model beats the word counts."""
    rows = lm.score(documents).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in documents.collect()])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(odd, odd_rows):
    check(lm.score(odd).collect(), odd_rows)


def test_null_and_repeated_ids(llm):
    rows = lm.score(llm.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string")).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 3, 3, 3] and sum(r["doc_id"] is None for r in rows) == 1
    assert all(r["train_tokens"] == sum(x["n_tokens"] for x in rows if not x["held_out"]) for r in rows)


def test_empty(none):
    assert lm.score(none).collect() == []


def test_vocabulary_holds_every_repeated_word(llm):
    """Beyond the frequent words too: only words seen once or never stand for their form, and all probabilities sum to one."""
    docs = [(d, " ".join(f"w{i}" for i in range(2000)) + f" once{d}") for d in (1, 2, 3)]
    c = Counter(w for d, x in docs if zlib.crc32(str(d).encode()) % 7 != 2 for w in words(x))
    table = lm.stored(lm.coded(llm.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", 2, 7), "lm-test")
    _, sums = lm.counted(table, 4)
    v = lm.Vocabulary(sums, 3)
    assert len(v.top_n) == sum(n > 1 for n in c.values()) == 2000
    ranks = set()
    for b in table.toArrow().to_batches():
        for r in range(b.num_rows):
            x = lm._cells(b, r)
            got = v.inputs(x["words"], x["forms"])
            assert (got < 2000).sum() >= 2000
            ranks |= set(got[got < 2000].tolist())
    assert ranks == set(range(2000))
    m = lm.Model.fresh(v)
    assert (m.side, m.groups, m.classes) == (13, 154, 12)
    state = np.random.default_rng(3).normal(size=(1, lm.UNITS)).astype(np.float32)
    every = np.arange(m.end + 1)
    p, _ = m.log_p(np.repeat(state, len(every), axis=0), every)
    assert np.exp(p).sum() == pytest.approx(1, abs=1e-3)


def test_blocks_are_small(llm, monkeypatch):
    """A word in a block takes some two bytes, its place with the word's counts none; both come back as they were."""
    rng = np.random.default_rng(8)
    words_of = [" ".join(f"w{i}" for i in np.minimum(rng.zipf(1.3, 40_000), 30_000)) for _ in range(3)]
    table = lm.coded(llm.createDataFrame(list(enumerate(words_of)), "doc_id bigint, text string"), "doc_id", "text", 2, 7)
    for b in table.toArrow().to_batches():
        for r in range(b.num_rows):
            x = lm._cells(b, r)
            hashes = np.concatenate([lm.word_spans(*lm.utf8(lm.pa.array([words_of[d]])))[0] for d in x["docs"]])
            assert np.array_equal(x["words"][x["codes"]], hashes)
            assert len(b.column("codes")[r].as_py()) < 2.5 * len(hashes)
            for parts in (1, 5, 48):
                part = (x["words"] % np.uint64(parts)).astype(np.int64)
                rare = [(np.flatnonzero(part == p), p) for p in range(parts)]
                told = np.concatenate([(np.uint64(p) << np.uint64(32)) + np.arange(len(at), dtype=np.uint64) for at, p in rare])
                assert np.array_equal(lm._places(x["words"], told, parts), np.concatenate([at for at, _ in rare]))


class _Counts:
    def __init__(self):
        self.top_n, self.form_n, self.train_docs = np.arange(lm.FREQUENT, 0, -1), np.arange(lm.FORMS), 5


def test_gradients():
    rng = np.random.default_rng(1)
    m = lm.Model.fresh(_Counts())
    m.w = [w.astype(np.float64) for w in m.w]
    inputs = rng.integers(0, lm.END_INPUT + 1, (5, 4))
    fresh = rng.random((5, 4)) < 0.2

    def loss():
        states, _ = m.steps(inputs, np.full((4, lm.UNITS), 0.1), fresh=fresh)
        return -m.log_p(states.reshape(-1, lm.UNITS).astype(np.float64), inputs.ravel())[0].mean()

    grads = m.gradients(inputs, fresh, np.full((4, lm.UNITS), 0.1))
    for w, g in zip(m.w, grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = w[at], 1e-2
        w[at] = old + e
        high = loss()
        w[at] = old - e
        low = loss()
        w[at] = old
        assert g[at] == pytest.approx((high - low) / (2 * e), rel=0.03, abs=1e-5)


def test_state_is_carried(monkeypatch):
    """Windows and lanes do not change a document's likelihood, and probabilities sum to one."""
    rng = np.random.default_rng(2)
    m = lm.Model.fresh(_Counts())
    counts = np.array([70, 0, 3, 33])
    inputs = rng.integers(0, lm.END_INPUT, counts.sum())
    whole = lm._walk(m, inputs, counts)
    monkeypatch.setattr(lm, "WINDOW", 1000)
    assert np.allclose(whole, lm._walk(m, inputs, counts, lanes=1), atol=1e-3)
    state = rng.normal(size=(1, lm.UNITS)).astype(np.float32)
    every = np.arange(lm.END_INPUT + 1)
    p, _ = m.log_p(np.repeat(state, len(every), axis=0), every)
    assert np.exp(p).sum() == pytest.approx(1, abs=1e-4)


def test_words_told_by_other_blocks(llm, documents):
    """Counts of words that a block cannot know itself reach their places in it."""
    rows = lm.score(documents.select("doc_id", "text").repartition(5), rounds=0).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_softmax_out_of_reach():
    """Without the largest value taken off: the same, also in lots, and where exponentials would overflow or vanish."""
    rng = np.random.default_rng(5)
    for size in (1, 30, 300):
        x, w = rng.normal(size=(2 * lm.LOT + 7, 4)).astype(np.float32) * size, rng.normal(size=(4, 9)).astype(np.float32)
        bias, target = rng.normal(size=(len(x), 9)).astype(np.float32), rng.integers(0, 9, len(x))
        y = x.astype(np.float64) @ w + bias
        y -= y.max(axis=1, keepdims=True)
        p = np.exp(y) / np.exp(y).sum(axis=1, keepdims=True)
        want = y[np.arange(len(x)), target] - np.log(np.exp(y).sum(axis=1))
        out, (by_w, by_x) = lm._choose(x, w, bias, target, 0.5)
        d = p - np.eye(9)[target]
        assert np.allclose(out, want, rtol=1e-4, atol=1e-3)
        assert np.allclose(by_x, 0.5 * d @ w.T, atol=2e-3) and np.allclose(by_w, 0.5 * x.T @ d, rtol=1e-3, atol=0.02 * size)
        assert np.array_equal(lm._choose(x, w, bias, target)[0], out)


def test_words_and_steps_in_one_array():
    """Distinct words of a block as numpy has them, and Adam on all weights at once, which stay those of the model."""
    x = np.random.default_rng(6).integers(0, 50, 1000).astype(np.uint64)
    words, first, codes = lm._distinct(x)
    assert np.array_equal(words, np.unique(x)) and np.array_equal(words[codes], x) and np.array_equal(x[first], words)
    assert all(len(a) == 0 for a in lm._distinct(x[:0]))
    m = lm.Model.fresh(_Counts())
    before = [w.copy() for w in m.w]
    adam = lm.Adam(m)
    adam.step([np.ones_like(w) for w in m.w], 0.01)
    assert all(np.allclose(b - w, 0.01, rtol=1e-2) and np.shares_memory(w, adam.w) for b, w in zip(before, m.w, strict=True))
