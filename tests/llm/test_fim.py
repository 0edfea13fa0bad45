import hashlib
import random
import re

import numpy as np
import pytest

from textloom.llm import fim, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_version(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, z = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:z], units[z:]))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return len(units), form, len(p), len(m), out


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_rank(size):
    values = np.random.default_rng(size).integers(0, 8, size).astype(np.uint8)
    matrix, at = fim.WaveletMatrix(values), np.arange(size + 1)
    for v in range(8):
        assert matrix.rank(v, at).tolist() == np.concatenate([[0], np.cumsum(values == v)]).tolist()


@pytest.mark.parametrize("segment", [1, 2, 7, 64, 10_000])
def test_ends(segment):
    """Every cut of every text, whatever the segments."""
    rng = random.Random(segment)
    texts = ["".join(rng.choice(["a", "B", "zz", " ", "é", "你", "1", "\n", "<", "😀"]) for _ in range(rng.randrange(40))) for _ in range(30)]
    raw = [t.encode() for t in texts]
    begin = np.cumsum([0, *map(len, raw)])
    index = fim.Units(np.frombuffer(b"".join(raw), np.uint8), begin[:-1], segment)
    for k, t in enumerate(texts):
        units = UNIT.findall(t)
        n = np.arange(len(units) + 1)
        low, high = np.full(len(n), begin[k]), np.full(len(n), begin[k + 1])
        want = begin[k] + np.cumsum([0, *(len(u.encode()) for u in units)])
        ends = index.ends(low, high, n)
        assert ends.tolist() == want.tolist()
        assert (index.chars(ends) - index.chars(low)).tolist() == np.cumsum([0, *map(len, units)]).tolist()


def test_transform(llm, odd, odd_rows):
    rows = [*odd_rows, (100, "has <S> inside"), (101, "<P"), (102, "ends with <"), (103, ">"), (None, "no id"), (7, "again"), (7, "again")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").withColumns({"form": F.lit(3), "h1": F.lit("x"), "body": F.lit(1), "row": F.lit(2)})
    got = fim.transform(df)
    assert got.columns == ["doc_id", "text", "h1", "body", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = got.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((d, x, *plain_version(d, x), x or "") for d, x in rows), key=repr)
    assert sorted(((r[0], r[1], *r[5:]) for r in found), key=repr) == want
    assert {r["form"] for r in found} == {"plain", "psm", "spm"} and {(r["h1"], r["body"], r["row"]) for r in found} == {("x", 1, 2)}


def test_none(llm, none):
    assert fim.transform(none).collect() == []


def test_all_forms(llm):
    rows = [(i, f"text number {i} with é and <x>") for i in range(500)]
    got = fim.transform(llm.createDataFrame(rows, "doc_id bigint, text string"), plain=50, suffix_first=100)
    found = got.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r["back"] == r["text"] for r in found) and {r["form"] for r in found} == {"plain", "spm"}


def test_query(llm, documents):
    want = []
    for r in documents.collect():
        n, form, p, m, out = plain_version(r["doc_id"], r["text"])
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((r["doc_id"], n, form, p, m, sha(out), sha(r["text"] or "")))
    assert sorted(map(tuple, queries.op12_fill_in_middle(llm, SF).collect()), key=repr) == sorted(want, key=repr)
