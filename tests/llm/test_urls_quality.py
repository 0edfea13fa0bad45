import pytest
from brute import measures

from textloom.llm import quality, urls


def test_rules(llm):
    rows = ["http://A.Example.ORG/es/x", "http://example.org/en/12", "http://xexample.org/es/", "http://org/", "http://a.org", "http://a.com/fr/1?x",
            "HTTP://b.com/de/#x", "http://com/de/", "ftp://x.net/y", "no scheme", "", None, "http://a.com?u=://b.org/", "://c.org/z", "http:///p"]
    df = llm.createDataFrame([(i, u, "own") for i, u in enumerate(rows)], "page_id int, url string, host string")
    got = {r["page_id"]: r for r in urls.judge(df, df.limit(0)).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(rows))] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("xexample.org", "/es/", "org/", "allow"), ("org", "/", "org/", "allow"), ("a.org", "", None, "allow"),
        ("a.com", "/fr/1", "com/fr/", "allow"), ("b.com", "/de/", "com/de/", "block"), ("com", "/de/", "com/de/", "block"),
        ("x.net", "/y", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.com", "", None, "allow"), ("c.org", "/z", "org/", "allow"), ("", "/p", None, "allow")]


@pytest.mark.parametrize("blocks", [1, 1 << 17])
def test_list(llm, monkeypatch, blocks):
    """The exact join removes what a full filter lets through, and the filter loses nothing."""
    monkeypatch.setattr(urls, "MAX_BLOCKS", blocks)
    pages = llm.range(4000).selectExpr("id AS page_id", "concat('http://www.h', id % 50, '.net/p', id, '.html#f') AS url")
    listed = llm.range(0, 8000, 4).selectExpr("concat('https://m.h', id % 50, '.net/p', id, '/?q=1') AS url")
    got = urls.judge(pages, listed).collect()
    assert len(got) == 4000 and all(r["listed"] == (r["page_id"] % 4 == 0) == (r["verdict"] == "block") for r in got)


def test_list_odd_rows(llm, none):
    pages = llm.createDataFrame([(1, None, 1), (1, None, 1), (2, "http://a.net/x", 1), (2, "http://a.net/x", 1)], "page_id int, url string, listed int")
    listed = llm.createDataFrame([(None,), ("bad",), ("http://a.net/x",), ("http://a.net/x",)], "url string")
    assert sorted((r["page_id"], r["listed"]) for r in urls.judge(pages, listed).collect()) == [(1, False)] * 2 + [(2, True)] * 2
    assert urls.judge(none, none, "text", "text").collect() == []


def test_measures(odd, odd_rows, documents):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in quality.measured(odd).collect()} == {d: measures(x) for d, x in odd_rows}
    for r in quality.measured(documents).collect():
        assert tuple(r[c] for c in names) == measures(r["text"])


def test_hosts(llm):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "few words", "bad") for i in range(40)] + [(200, good, "bad"), (300, "x", "new")]
    rows += [(400 + i, good if i else "x", f"h{j}") for j in range(5) for i in range(10)] + [(900, good, None), (901, None, None)]
    got = {(r["doc_id"], r["source"]): r for r in quality.judge(llm.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert len(got) == len(rows)
    assert got[(0, "good")]["kept"] and not got[(200, "bad")]["kept"] and not got[(200, "bad")]["base_failed"]
    assert got[(200, "bad")]["host_rate"] > 0.9 and 0.3 < got[(300, "new")]["host_rate"] < 1  # one failure does not make a rate of one
    assert got[(401, "h0")]["kept"] and not got[(400, "h0")]["kept"]
    assert got[(901, None)]["host_rate"] == got[(900, None)]["host_rate"] > 0


def test_odd_rows(odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count() and all(r["kept"] is False for r in rows if r["text"] is None)
    assert quality.judge(none).collect() == []
    assert quality.judge(odd.union(odd)).count() == 2 * odd.count()
