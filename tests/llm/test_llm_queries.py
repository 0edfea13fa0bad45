"""The registered queries: names, columns, and SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as driver
from textloom.llm import queries

SF = "/root/testdata/sf0.001"
FIRST = {
    "op1_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op2_lm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op4_pieces": ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "same_text"],
    "op5_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op7_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op8_packing": ["doc_id", "length", "piece", "start", "n_tokens", "bucket", "batch", "slot"],
    "op9_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_simhash": ["doc_id", "fingerprint", "component_id"],
    "op12_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op10_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


def test_registered():
    assert set(queries.QUERIES) == set(FIRST) and set(FIRST) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](llm, SF)
    assert df.columns[:len(FIRST[name])] == FIRST[name]
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    order = sorted(names)
    assert order == sorted(df.columns)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[names.index(c)] for c in order) for r in cur.fetchall()), key=repr)
