import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import brute
from textloom.llm import queries, simhash
from textloom.llm.common import components

SF = "/root/testdata/sf0.001"


def fingerprint(text, width=4):
    w = brute.words(text)
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(nodes, near):
    """{id: least id reachable}; nodes is a list of (id, fingerprint)."""
    known = [(d, f) for d, f in nodes if d is not None]
    up = {d: d for d, _ in known}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, f) in enumerate(known):
        for e, g in known[:i]:
            if (f ^ g).bit_count() <= near:
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in known}


@pytest.mark.parametrize("piece,counted", [(1, 1), (30, 7), (1 << 20, 1 << 16)])
def test_fingerprints(odd_rows, monkeypatch, piece, counted):
    """Whatever the pieces that texts are read in, and with more hashes than one byte counts."""
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash, "COUNTED", counted)
    texts = [x for _, x in odd_rows if piece > 1 or len(x or "") < 5000] + ["A b\tC\nd  e", " lead", "É é É é É", "one\x0btwo\x0cthree\rfour"]
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == [fingerprint(t) for t in texts]


def some_points(seed, size):
    """Fingerprints in groups that hang together by chains, some tight, with bits that always go together."""
    rng = random.Random(seed)
    out = set()
    for _ in range(size // 20):
        f = rng.getrandbits(64)
        if rng.random() < 0.5:
            f = f & ~0xFFFF | (0xFFFF if rng.random() < 0.5 else 0)
        for _ in range(20):
            out.add(f)
            for _ in range(rng.choice([1, 2, 3, 4, 5, 6])):
                f ^= 1 << rng.randrange(64)
    tight = rng.getrandbits(64)
    out |= {tight ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    return sorted(out)


@pytest.mark.parametrize("near,block,partitions", [(4, 4096, range(2, 7)), (4, 8, range(5, 6)), (4, 20, range(3, 4)), (4, 50, range(2, 3)),
                                                   (1, 4096, range(2, 4)), (6, 16, range(6, 7)), (3, 5, range(4, 5))])
def test_links(llm, monkeypatch, near, block, partitions):
    monkeypatch.setattr(simhash, "PARTITIONS", partitions)
    fp = some_points(near + block, 600)
    signed = np.array(fp, np.uint64).view(np.int64).tolist()
    points = llm.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp bigint, least bigint").repartition(5)
    found = components(simhash._links(points, len(fp), near, block))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = linked(list(zip(signed, fp)), near)
    assert {f: got.get(f, f) for f in signed} == want
    assert len(set(want.values())) > 5


def test_thresholds():
    """The thresholds of every point leave no pair out, and the estimate is right where the pieces are independent."""
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000, dtype=np.uint64)
    for parts in simhash.PARTITIONS:
        layout = simhash.Layout(simhash.grouped(simhash._together(fp), len(fp), parts), simhash.NEAR)
        assert sorted(b for p in layout.parts for b in p) == list(range(64))
        layout.learn(layout.histogram(fp), len(fp))
        chosen, cost = layout.thresholds(fp, len(fp))
        assert ((chosen + 1).sum(axis=0) == simhash.NEAR + 1).all() and np.isfinite(cost).all()
    one = simhash.Layout([list(range(0, 8)), list(range(8, 64))], 4)
    one.learn(one.histogram(fp), len(fp))
    cost = one.costs(fp[:5], len(fp))
    for k in range(5):
        distance = np.bitwise_count((fp ^ fp[k]) & np.uint64(255))
        for t in range(5):
            assert cost[0, t + 1, k] == pytest.approx(simhash.PROBE * sum(simhash.comb(8, d) for d in range(t + 1)) + (distance <= t).sum())


def test_correlated_bits_together():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    twins = [(3, 40), (17, 61), (22, 5)]
    for a, b in twins:
        fp = fp & ~(np.uint64(1) << np.uint64(b)) | ((fp >> np.uint64(a)) & np.uint64(1)) << np.uint64(b)
    groups = simhash.grouped(simhash._together(fp), len(fp), 4)
    assert all(any({a, b} <= set(g) for g in groups) for a, b in twins)


@pytest.mark.parametrize("block", [3, 4096])
def test_odd_rows(llm, odd, odd_rows, block):
    got = simhash.similar(odd, block=block).collect()
    want = linked([(d, fingerprint(x)) for d, x in odd_rows], 4)
    assert sorted(map(tuple, got)) == [(d, f"{fingerprint(x):016x}", want[d]) for d, x in odd_rows]


def test_ids(llm, none):
    rows = [(5, "one two three four five"), (None, "one two three four five"), (5, "six seven eight nine"), (3, "six seven eight nine"),
            (5, "six seven eight nine"), (9, ""), (8, None), (7, "one two three four five")]
    got = simhash.similar(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r[0], r[2]) for r in got), key=repr) == sorted([(5, 3), (None, None), (5, 3), (3, 3), (5, 3), (9, 8), (8, 8), (7, 3)], key=repr)
    assert simhash.similar(none).collect() == []


def test_query(llm, documents):
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in documents.collect()]
    want = linked(rows, 4)
    assert sorted(map(tuple, queries.op11_simhash(llm, SF).collect())) == sorted((d, f"{f:016x}", want[d]) for d, f in rows)
