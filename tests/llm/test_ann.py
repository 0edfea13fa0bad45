import numpy as np
import pytest

from textloom.llm import ann, queries

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def exact(rows, asked, k):
    out = {}
    for q, v in asked:
        found = sorted((-float(np.sum(np.array(v) * np.array(x))), i) for i, x in rows if i != q)[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def test_recall(llm):
    df = llm.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in df.collect()]
    want = exact(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    hits, by = 0, {}
    for r in queries.op3_neighbours(llm, "/root/testdata/sf0.01").collect():
        by.setdefault(r["query_id"], []).append(r)
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits += len({i for i, _ in want[q]} & {r["vec_id"] for r in found})
    assert set(by) == set(want) and hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("share,least", [(0.6, 0.9)])
def test_clusters(llm, share, least, monkeypatch):
    """Without opening everything, in several tasks and pieces."""
    monkeypatch.setattr(ann, "LEAST", 1)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    v = (centres[rng.integers(0, 30, 3000)] + 0.2 * rng.normal(size=(3000, 16))).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id % 100 = 0"), 10, share=share, fit=1000, task_rows=2000, piece_rows=20).collect()
    want = exact(rows, [rows[i] for i in range(0, 3000, 100)], 10)
    hits = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 300 and hits >= least * 300


def test_odd_rows(llm):
    one = [1.0, 0.0, 2.0]
    rows = [(i, one, "x") for i in range(40)] + [(100, None, "x"), (101, [], "x"), (102, [0.0, 0.0, -0.0], "x"),
            (103, [1.0, None, 2.0], "x"), (104, [float("nan"), 1.0, 1.0], "x"), (105, [float("inf"), 1.0, 1.0], "x"), (106, [1.0], "x"),
            (None, one, "x"), (0, one, "x"), (7, [-1.0, 0.0, 5.0], "x")]
    df = llm.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.nearest(df, df.where("vec_id in (0, 30, 100, 102, 106) OR vec_id IS NULL"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(7, 9.0), (1, 5.0), (2, 5.0), (3, 5.0), (4, 5.0)], 30: [(7, 9.0), (0, 5.0), (1, 5.0), (2, 5.0), (3, 5.0)]}


def test_few_and_none(llm):
    df = llm.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "x")], SCHEMA)
    assert [(r["query_id"], r["vec_id"]) for r in ann.nearest(df, df.where("vec_id = 1"), 5).collect()] == [(1, 2)]
    assert ann.nearest(df.limit(0), df, 5).collect() == [] and ann.nearest(df, df.limit(0), 5).collect() == []
