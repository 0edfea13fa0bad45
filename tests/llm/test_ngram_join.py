import numpy as np
import pytest
from brute import joined, shingles

from textloom.llm import ngram_join, queries
from textloom.llm.common import components


def pairs(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_documents(llm, documents, block):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = joined(docs)
    got = pairs(ngram_join.similar(documents, block=block).collect())
    assert got == {d: (len(shingles(x)), found[d]) for d, x in docs}


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_near_copies_across_blocks(llm, block):
    """A chain of near copies, and strangers that share most of it: whoever is linked is found in any blocks."""
    import random
    rng, docs = random.Random(3), []
    base = [f"w{i}" for i in range(80)]
    for d in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 9])):
            w[rng.randrange(80)] = f"new{rng.randrange(10**6)}"
        docs.append((d * 3 % 61, " ".join(w)))
    got = pairs(ngram_join.similar(llm.createDataFrame(docs, "doc_id bigint, text string"), block=block).collect())
    found = joined(docs)
    assert got == {d: (len(shingles(x)), found[d]) for d, x in docs}


def test_visitors_go_where_they_share_a_prefix(llm, monkeypatch):
    """Sets of one cluster that are hardly alike: results are whole, and nobody visits a block without a shared prefix n-gram."""
    docs = []
    for d in range(24):  # rings of sets that overlap their neighbours by two thirds
        docs.append((d, " ".join(f"w{(d * 10 + i) % 240}" for i in range(34))))
    docs += [(100 + d, x.replace("w5 ", "new5 ")) for d, x in docs[:3]]
    sent, join = [], ngram_join._join
    monkeypatch.setattr(ngram_join, "_join", lambda rows, parts: (sent.append(rows), join(rows, parts))[1])
    got = pairs(ngram_join.similar(llm.createDataFrame(docs, "doc_id bigint, text string"), block=60).collect())
    found = joined(docs)
    assert got == {d: (len(shingles(x)), found[d]) for d, x in docs}
    rows = sent[-1].select("cluster", "block", "doc", "home").collect()
    home, away = [r for r in rows if r["home"]], [r for r in rows if not r["home"]]
    blocks = len({(r["cluster"], r["block"]) for r in home})
    assert away and len(away) < len({r["doc"] for r in away}) * blocks / 2


def test_a_task_holds_only_its_block():
    """Visitors are linked one at a time, with n-grams that the block has not left out."""
    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 1, 100)]
    home = ngram_join.Home(np.array([1, 2, 3]), np.full(3, 20), [(t, np.full(20, 2, np.uint32)) for t in sets], np.array([1, 1, 3]))
    assert list(home.visit(7, 20, 7, np.arange(500, 520, dtype=np.uint64))) == []
    assert [a for a, _ in home.visit(8, 20, 8, np.append(np.arange(19), 900).astype(np.uint64))] == [8]
    assert list(home.visit(9, 20, 3, np.arange(100, 120, dtype=np.uint64))) == []


def test_odd_rows(llm, odd, odd_rows):
    found = joined(odd_rows)
    assert pairs(ngram_join.similar(odd).collect()) == {d: (len(shingles(x)), found[d]) for d, x in odd_rows}


def test_repeated_and_null_ids(llm):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, "q r"), (3, "a b c d e f"), (4, "Q  R")]
    got = ngram_join.similar(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got if r["doc_id"]) == [
        (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1), (3, 2, 1), (4, 1, 1)]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]


def test_repeated_rows_and_a_neighbour_below_the_threshold(llm):
    """Repeated rows of one id count once: sets of Jaccard 0.5 to 0.74 stay apart, closer ones are linked."""
    base = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(base))] * 2
    for d, cut in ((2, 87), (3, 80), (4, 99), (5, 92)):
        rows.append((d, " ".join([*base[:cut], *(f"own{d}x{i}" for i in range(104 - cut))])))
    rows += [(6, rows[-1][1] + " more")] * 3
    found = joined(rows)
    assert found[1] == found[4] and found[2] != 1 and found[3] != 1
    got = ngram_join.similar(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(
        (d, len(shingles(x)), found[d]) for d, x in rows)


def test_empty(none):
    assert ngram_join.similar(none).collect() == []


def test_components(llm):
    edges = [(5, 6), (6, 7), (7, 1), (10, 11), (12, 11), (12, 12), (None, 3), *[(100 + i, 101 + i) for i in range(40)]]
    got = {r["node"]: r["component"] for r in components(llm.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {5: 1, 6: 1, 7: 1, 1: 1, 10: 10, 11: 10, 12: 10, **{100 + i: 100 for i in range(41)}}


def test_query(llm):
    assert queries.op1_ngram_join(llm, "/root/testdata/sf0.001").count() == 200
