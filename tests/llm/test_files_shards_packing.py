import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import common, packing, queries, sharding, tokenfiles
from textloom.session import scratch_path

BYTE_BPE = public_tokenizers.path(queries.BYTE_BPE)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE_BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder(library, monkeypatch):
    """Cutting a text at spaces, line ends and signs changes nothing, whatever stands there, and in a small cache."""
    parts = ["a", "B", "hello", "it's", "don't", " ", "  ", "\n", "\n\n", ".", ",", "!", "..", "'", "é", "ß", "1", "23", "_", "-", "(",
             "\t", "\xa0", "̈", "你好", "<|endoftext|>", " the", "\r\n", "²", "…", "\x01", "​", "٣", "\x1c", "\x85"]
    rng = random.Random(2)
    encoder = tokenfiles.Encoder(BYTE_BPE)
    for cache in (30_000, 10**8):
        monkeypatch.setattr(tokenfiles, "CACHE", cache)
        for _ in range(6):
            texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(500)]
            flat, counts = encoder.encode(pa.array(texts))
            assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [library(t) for t in texts]


def test_added_token(library):
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b c", "plain words."]
    flat, counts = tokenfiles.Encoder(BYTE_BPE).encode(pa.array(texts))
    assert flat[:counts[0]].tolist() == [31373, 220, 50256, 995]
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [library(t) for t in texts]


def read_back(df, spark, read_ids=tokenfiles.READ_IDS):
    parts = tokenfiles.write_tokens(df, scratch_path(spark, "tokens"), lambda: tokenfiles.encoder(BYTE_BPE).encode, 2, 50_257)
    found = defaultdict(list)
    for r in tokenfiles.read_tokens(parts, read_ids).collect():
        found[r["position"]].append((r["offset"], r["doc_id"], r["start"], r["ids"]))
    out = []
    for position, rows in sorted(found.items()):
        rows.sort()
        assert position == len(out) and [r[0] for r in rows] == list(np.cumsum([0, *(len(r[3]) for r in rows)])[:-1])
        out.append((rows[0][1], rows[0][2], [i for r in rows for i in r[3]]))
    return out


@pytest.mark.parametrize("read_ids", [50, 1 << 20])
def test_files(llm, odd, odd_rows, library, read_ids):
    want, start = [], 0
    for d, x in odd_rows:
        ids = [*library(x), 2]
        want.append((d, start, ids))
        start += len(ids)
    assert read_back(odd, llm, read_ids) == want


def test_files_ties_nulls_none(llm, none):
    rows = llm.createDataFrame([(5, "b"), (None, "n"), (5, "b"), (-3, None)], "doc_id bigint, text string")
    assert [(d, len(i)) for d, _, i in read_back(rows, llm)] == [(-(1 << 63), 2), (-3, 1), (5, 2), (5, 2)]
    assert read_back(none, llm) == []


def test_file_query(llm, documents, library):
    want, start = [], 0
    for r in documents.orderBy("doc_id").collect():
        ids = [*library(r["text"]), 2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op5_token_files(llm, SF).collect())) == want


def shards_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return by


def test_shards(llm, documents):
    rows = queries.op7_shards(llm, SF).collect()
    by = shards_of(rows)
    assert set(by) <= set(range(24)) and sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in documents.collect())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(24)]
    # A boundary is off by half the row that it falls on at most, or by the tolerance.
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows) + 2 * 0.001 * sum(sizes) / 24


@pytest.mark.parametrize("ids", [range(0, 6000), [i * i for i in range(6000)]])
def test_ranges_within_a_hot_group(llm, ids):
    """Equal texts are divided into ranges like any others."""
    rows = [(d, 7 if k % 10 < 6 else k * 10**15, 100) for k, d in enumerate(ids)]
    keys = llm.createDataFrame([(h, d, s) for d, h, s in rows], "_hash bigint, _id bigint, _size bigint")
    bounds, starts, shard_of = sharding.splitters(keys, 3, range_bytes=20_000)
    sizes = np.diff([*starts, len(rows)])
    assert len(bounds) + 1 == len(starts) == len(shard_of) and sizes.sum() == len(rows)
    assert sizes.max() <= 200 and len(sizes) < 3 * len(rows) / 200


@pytest.mark.parametrize("range_bytes", [40_000, 1 << 26])
def test_near_equal_bytes_with_a_hot_group(llm, range_bytes):
    """A third of the rows have one text; shards differ by a row's size at most."""
    rng = random.Random(1)
    rows = [(i, "same" if i % 3 == 0 else f"t{rng.random()}", rng.randrange(50, 150)) for i in range(20_000)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, size int")
    by = shards_of(sharding.shard(df, "size", 7, range_bytes=range_bytes).collect())
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    assert len(by) == 7 and max(sizes) - min(sizes) <= 2 * (150 + 0.001 * sum(sizes) / 7)
    inside = [sum(r["text"] == "same" for r in by[s]) for s in sorted(by)]
    assert sum(n not in (0, len(by[s])) for s, n in enumerate(inside)) <= 2  # the group is one run of the order


def test_shard_odd_rows(llm, none):
    rows = [(1, "a", None, "x"), (1, "a", 5, "x"), (None, None, 3, "x"), (2, "a", 9, "y")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, size int, slot string")
    got = sharding.shard(df, "size", 3).collect()
    shards_of(got)
    assert sorted((r["doc_id"] or 0, r["size"] or 0) for r in got) == [(0, 3), (1, 0), (1, 5), (2, 9)]
    assert sharding.shard(none.withColumnRenamed("shard", "size"), "size", 3).collect() == []


def cost(counts, lengths):
    return sum(n * (min(x for x in lengths if x >= k) - k) for k, n in counts.items())


def test_best_lengths():
    from itertools import combinations
    rng = random.Random(4)
    for _ in range(60):
        counts = {rng.randrange(1, 30) * 8: rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))}
        for k in (1, 2, 3):
            every = [cost(counts, c) for c in combinations(counts, min(k, len(counts))) if max(counts) in c]
            found = packing.best_lengths(counts, k)
            assert len(found) <= k and cost(counts, found) == min(every)
    assert packing.best_lengths({}, 3) == []


@pytest.mark.parametrize("cell", [50, 200_000])
def test_packing(llm, documents, cell):
    df = documents.selectExpr("doc_id", "n_chars AS length")
    rows = packing.pack(df, "length", max_length=1024, budget=8192, cell=cell).collect()
    by, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["bucket"]].append(r)
        pieces[r["doc_id"]].append((r["start"], r["n_tokens"]))
        assert 0 <= r["n_tokens"] <= r["bucket"] <= 1024 and r["start"] == 1024 * r["piece"]
    for r in df.collect():
        got = sorted(pieces[r["doc_id"]])
        assert sum(n for _, n in got) == r["length"] and all(n == 1024 for _, n in got[:-1])
    for bucket, own in by.items():
        fits = max(1, 8192 // bucket)
        assert sorted((r["batch"], r["slot"]) for r in own) == [(i // fits, i % fits) for i in range(len(own))]
    counts = defaultdict(int)
    for r in rows:
        counts[max(8, -(-r["n_tokens"] // 8) * 8)] += 1
    assert sorted(by) == packing.best_lengths(counts, packing.BUCKETS)


def test_packing_odd_rows(llm, none):
    rows = [(1, None, "x"), (1, None, "x"), (2, 0, "x"), (3, -4, "x"), (None, 20, "x"), (4, 9000, "x")]
    got = packing.pack(llm.createDataFrame(rows, "doc_id bigint, n_tokens int, batch string"), "n_tokens").collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["n_tokens"]) for r in got) == [
        (0, 0, 20), (1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 4096), (4, 1, 4096), (4, 2, 808)]
    assert packing.pack(none, "shard").collect() == []


def test_a_bucket_is_sorted_in_many_tasks(llm):
    """Rows of one length, and so of one bucket, are numbered by their hashes without being in one task."""
    df = llm.range(4000).selectExpr("id AS doc_id", "cast(7 AS int) AS length")
    adaptive = "spark.sql.adaptive.enabled"
    before = llm.conf.get(adaptive)
    llm.conf.set(adaptive, "false")
    try:
        rows = packing.pack(df, "length", budget=80).withColumn("task", F.spark_partition_id()).withColumn(
            "order", F.xxhash64("doc_id", F.lit(0).cast("bigint"))).collect()
    finally:
        llm.conf.set(adaptive, before)
    assert max(Counter(r["task"] for r in rows).values()) < len(rows) / 2
    assert [(r["batch"], r["slot"]) for r in sorted(rows, key=lambda r: r["order"])] == [(i // 10, i % 10) for i in range(4000)]


def test_workers_return_memory(monkeypatch):
    """When the task ends, also if it is not read to its end, and not before."""
    calls = []
    monkeypatch.setattr(common, "returned", lambda: calls.append(1))
    run = common.lean(lambda batches: (2 * b for b in batches))
    got = run(iter([1, 2]))
    assert next(got) == 2 and not calls
    assert list(got) == [4] and calls == [1]
    got = run(iter([1, 2]))
    next(got)
    got.close()
    assert calls == [1, 1]
    monkeypatch.undo()
    common.returned()
