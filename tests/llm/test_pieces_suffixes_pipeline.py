import random

import numpy as np
import public_tokenizers
import pytest
from brute import joined, measures, without_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import packing, pieces, quality, queries, sharding, suffixes, urls

MODEL = public_tokenizers.path(queries.PIECE_BPE)


def test_scan():
    """Chunks of any length give the library's encoding."""
    p, rng = pieces.model(MODEL), random.Random(4)
    parts = ["a", "b", "e", "in", "th", "the", " ", "  ", "\n", "é", "你", "😀", "tion", "ing", ".", "1", "23", "▁", "\x00", "er", "<s>", "<0x41>"]
    for _ in range(300):
        text, chunk = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))), rng.choice([1, 3, 7, 20, 1000])
        if text:
            whole = pieces.SPACE + text.replace(" ", pieces.SPACE)
            cuts = [*range(0, len(whole), chunk), len(whole)]
            spans = list(zip(cuts, cuts[1:], strict=False))
            states = pieces.boundary_states([p.matrix(whole, a, z) for a, z in spans])
            found = [t for (a, z), i, o in zip(spans, states[:-1], states[1:], strict=True) for t in p.trace(whole, a, z, i, o)]
            assert p.ids_of(found) == p.library.encode(text), (text, chunk)


def test_max_plus():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random((4, 4)) < 0.5, 0, -np.inf).astype(np.float32) for _ in range(3))
    assert np.array_equal(pieces.times(pieces.times(a, b), c), pieces.times(a, pieces.times(b, c)))


def test_encode_and_decode(odd, odd_rows):
    library = pieces.model(MODEL).library
    got = pieces.decode(pieces.encode(odd, MODEL, giant=1000, chunk=700), MODEL)
    assert got.columns == ["doc_id", "text", "source", "shard", "kept", "ids", "decoded"]
    rows = {r["doc_id"]: (r["ids"], r["decoded"]) for r in got.collect()}
    assert rows == {d: (library.encode(x or ""), x or "") for d, x in odd_rows}


def test_pieces_of_nothing(none):
    assert pieces.decode(pieces.encode(none, MODEL), MODEL).collect() == []


def test_pieces_query(llm, documents):
    rows = queries.op4_pieces(llm, "/root/testdata/sf0.001").collect()
    assert len(rows) == documents.count() and all(r["same_text"] for r in rows)


def cut(df, **options):
    return sorted((r["doc_id"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffixes.dedup(df, **options).collect())


@pytest.mark.parametrize("part_bytes", [3000, 2 << 20])
def test_repeats(llm, part_bytes, monkeypatch):
    """Passages in other places, shifted by any number of bytes, self-overlapping, over the edges of parts and pieces."""
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (99, 100, 101, 150, 700, 2500)]
    docs = []
    for d in range(40):
        docs.append((d, noise(rng.randrange(120)) + rng.choice(shared) + noise(rng.randrange(50)) + rng.choice(shared)[rng.randrange(60):]))
    docs += [(40, "ab" * 400), (41, "x" + "ab" * 90), (42, docs[3][1]), (43, None), (44, "short"), (-5, docs[5][1][:300])]
    df = llm.createDataFrame(docs, "doc_id bigint, text string")
    assert cut(df, part_bytes=part_bytes) == without_repeats(docs)


def test_repeats_in_documents(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert cut(documents) == without_repeats(docs)


def test_repeats_odd_rows(llm, odd, odd_rows, none):
    assert cut(odd) == without_repeats(odd_rows)
    assert suffixes.dedup(none).collect() == []
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(100))
    rows = [(1, text), (1, text), (None, text), (None, None)]
    got = cut_null(llm.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == [(None, 0), (None, 0), (1, len(text)), (1, len(text))]


@pytest.mark.parametrize("length", [20, 64, 131])
def test_repeats_of_other_lengths(llm, length):
    """Strings of any length, also short ones, and bytes of zero."""
    rng = random.Random(length)
    shared = ["".join(rng.choice("ab\x00é") for _ in range(n)) for n in (length - 1, length, 3 * length)]
    docs = [(d, "".join(rng.choice([*shared, "x" * rng.randrange(200), str(d) * 9]) for _ in range(6))) for d in range(30)]
    df = llm.createDataFrame(docs, "doc_id bigint, text string")
    assert cut(df, length=length, part_bytes=2000) == without_repeats(docs, length)


def test_sampled_suffixes():
    """Every string has one record, by the first of its least substrings, and records are few."""
    rng = np.random.default_rng(5)
    body = rng.integers(97, 123, 600_000).astype(np.uint8)
    body[5000:6000], body[300_000:301_000] = 97, body[1000:2000]
    sizes = np.array([100, 400, 4500, 1000, 294_000, 300_000])
    at, low, high = suffixes.samples(body, sizes, 100)
    starts = np.concatenate([np.arange(p - h, p - x + 1) for p, x, h in zip(at.tolist(), low.tolist(), high.tolist(), strict=True)])
    ends = np.cumsum(sizes)
    assert np.array_equal(np.sort(starts), np.concatenate([np.arange(e - n, e - 99) for e, n in zip(ends, sizes, strict=True)]))
    assert len(at) < 0.045 * len(body) + 1000
    # The copy has the anchors of its original, inside.
    inner = lambda a: set((at[(at >= a + 60) & (at < a + 940)] - a).tolist())
    assert inner(1000) == inner(300_000) and inner(1000)


def cut_null(df):
    rows = [(r["doc_id"], r["n_removed"]) for r in suffixes.dedup(df).collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[1]))


def test_texts_of_one_id(llm):
    """Unrelated texts under one id all stay; equal and similar ones do not."""
    words_of = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, words_of(1)), (1, words_of(2)), (1, words_of(2)), (2, words_of(2)), (3, words_of(3)), (4, words_of(1) + " more"), (5, None), (5, "")]
    df = llm.createDataFrame([(d, x, 0) for d, x in rows], "doc_id bigint, text string, _key int")
    got = corpus_pipeline.near_duplicates(llm, df, "")
    assert got.columns == ["doc_id", "text", "_key"]
    assert sorted((r[0], (r[1] or "")[:3]) for r in got.collect()) == [(1, "w1x"), (1, "w2x"), (3, "w3x"), (5, "")]


def test_columns_named_like_internal_ones(llm):
    """Columns of the caller come back whatever their names, as themselves."""
    text = " ".join(f"w{i}" for i in range(80))
    names = ["_a", "_z", "_doc", "_body", "_w", "_h", "_n", "_id", "_hash", "_size", "_rows", "_range", "_order", "own0_a"]
    df = llm.createDataFrame([(1, text, "s", "http://a.b/c", *range(len(names))), (2, text, "s", "http://a.b/d", *range(len(names)))],
                             "doc_id bigint, text string, source string, url string, " + ", ".join(f"{n} int" for n in names))
    df = df.withColumn("_len", F.lit(5))
    ways = [suffixes.dedup(df), quality.judge(df), urls.judge(df, df.limit(1)), packing.pack(df, "_len"),
            sharding.shard(df, "_len", 2), pieces.encode(df, public_tokenizers.path(queries.PIECE_BPE))]
    for out in ways:
        assert set(df.columns) <= set(out.columns)
        assert [tuple(r[n] for n in names) for r in out.collect()] == [tuple(range(len(names)))] * 2


def test_texts_are_cut_once(llm, capsys):
    """The third stage holds one Python worker for cutting and one for decoding in a task, not one more for its filter."""
    df = llm.createDataFrame([(1, "x" * 300, 300)], "doc_id bigint, text string, n_chars bigint")
    out = corpus_pipeline.repeated_passages(llm, df, "")
    out.explain()
    shown = capsys.readouterr().out
    assert shown.count("ArrowEvalPython") == 2
    assert out.collect()[0]["n_chars"] == 1


def test_pipeline(llm, documents):
    """All stages against their plain versions."""
    docs = {r["doc_id"]: r for r in documents.collect()}
    kept = {}
    for d, r in docs.items():
        n, _, _, _, repeated = measures(r["text"])
        if n >= 50 and 100 * repeated <= 50 * n:
            kept[d] = r["text"]
    groups = joined(list(kept.items()))
    kept = {d: x for d, x in kept.items() if groups[d] == d}
    want = {}
    for d, b, gone, _ in without_repeats(list(kept.items())):
        if not gone or b:
            want[d] = b.decode("utf-8", "ignore")
    got = corpus_pipeline.run(llm, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    for r in got:
        assert r["n_chars"] == (docs[r["doc_id"]]["n_chars"] if r["text"] == docs[r["doc_id"]]["text"] else len(r["text"]))
    lengths = {d: len(x.split()) + 1 for d, x in want.items()}
    found = {}
    for r in got:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["n_tokens"]
    assert found == {d: n for d, n in lengths.items()}


def test_stages_on_odd_rows(llm, odd, none):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = odd.selectExpr("doc_id", "text", "kept AS lang", "source", "cast(length(text) AS bigint) AS n_chars")
    rows = rows.union(rows).union(rows.limit(2).selectExpr("null", "text", "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        last = name == corpus_pipeline.STAGES[-1][0]
        got = stage(llm, rows, "")
        assert got.columns[:5] == names and (last or got.columns == names)
        got.collect()
        assert stage(llm, rows.limit(0), "").collect() == []
    stayed = corpus_pipeline.near_duplicates(llm, rows, "").collect()
    ids = [r["doc_id"] for r in stayed if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and sum(r["doc_id"] is None for r in stayed) == 2
