"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import ann, fim, lm, ngram_join, packing, pieces, quality, sharding, simhash, suffixes, tokenfiles, urls, whitening
from textloom.llm.common import byte_length, words
from textloom.session import scratch_path

#: The public tokenizers that the queries use, and the id that closes a document.
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE_SIZE = 50_257
END_ID = 2
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids, and of the text that decoding them gives."""
    path = tokenizer_path(PIECE_BPE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.pandas_udf(lambda ids: ids.map(lambda x: zlib.crc32(x.astype("<u4").tobytes())), "bigint")
    coded = pieces.encode(docs, path).withColumn("ids_crc32", crc("ids"))
    return pieces.decode(coded, path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids_crc32", F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(BYTE_BPE)
    parts = tokenfiles.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                                    lambda: tokenfiles.encoder(path).encode, END_ID, BYTE_BPE_SIZE)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # a long document comes in several rows, one behind the other
        for b in batches:
            ids, ends = b.column(4).flatten().to_numpy().astype("<u4"), b.column(4).offsets.to_numpy()
            ends = ends - ends[0]
            done = []
            for k, (doc, start, offset) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(),
                                                         b.column(3).to_pylist(), strict=True)):
                if not offset:
                    done += [last] if last else []
                    last = [doc, start, 0, 0]
                last[2] += int(ends[k + 1] - ends[k])
                last[3] = zlib.crc32(ids[ends[k]:ends[k + 1]].tobytes(), last[3])
            yield rows(done)
        yield rows([last] if last else [])

    def rows(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokenfiles.read_tokens(parts, use=digest, schema="doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block list: addresses that came through a feed, so that their other forms are met too."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, pages.where(F.col("url").contains("utm_source=feed"))).select(
        "page_id", "host", "path", "rule", "verdict", "canonical", "listed")


OP6_SQL = """
WITH parts AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') > 0 AS ok,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, url, ok,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), named AS (
  SELECT *, CASE WHEN ok THEN regexp_replace(host, '^(www|m)[.]', '')
              || regexp_replace(regexp_replace(path, '[.]html$', ''), '/+$', '') END AS canonical FROM split
), listed AS (
  SELECT DISTINCT canonical FROM named WHERE canonical IS NOT NULL AND contains(url, 'utm_source=feed')
), ruled AS (
  SELECT n.*, l.canonical IS NOT NULL AS listed,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named n LEFT JOIN listed l USING (canonical)
)
SELECT page_id, host, path, rule, canonical, listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (byte_length(F.col("text")) + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("group"))
    return sharding.shard(docs, "size", SHARDS, group="group").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths in words, and one end token each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.size(words(F.col("text"))) + 1).alias("length"))
    return packing.pack(docs, "length")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"))


OP9_SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), numbered AS (SELECT row_number() OVER () AS k, * FROM base),
tri AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM numbered)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, t) AS c FROM tri) WHERE c > 1
), covered AS (
  SELECT k, count(DISTINCT i + d)::BIGINT AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY k
), measured AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (k)
), tested AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars
           OR 100 * n_dup_lines > 30 * n_lines AS failed FROM measured
), hosts AS (
  SELECT source, count(*) AS n, sum(failed::INT) AS f FROM tested GROUP BY source
), prior AS (
  SELECT avg(f / n) AS m, var_samp(f / n) AS v, avg(n) AS size FROM hosts
), weights AS (
  SELECT m, CASE WHEN v > 0 AND m > 0 AND m < 1 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE size END AS s FROM prior
), rates AS (
  SELECT source, (f + m * s) / (n + s) AS r FROM hosts, weights
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r <= 0.5 AS kept, round(r, 6) AS host_rate
FROM tested JOIN rates ON tested.source IS NOT DISTINCT FROM rates.source
"""

def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.similar(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), numbers AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM drawn
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:z], '') AS middle, array_to_string(units[z + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return white.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("at")].alias("explained"),
        "identity_error")


QUERIES = {
    "op11_simhash": op11_simhash,
    "op13_whitening": op13_whitening,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op1_ngram_join": op1_ngram_join,
    "op2_lm_scores": op2_lm_scores,
    "op3_neighbours": op3_neighbours,
    "op4_pieces": op4_pieces, "op5_token_files": op5_token_files, "op6_url_filter": op6_url_filter, "op7_shards": op7_shards,
    "op8_packing": op8_packing, "op9_quality": op9_quality,
}
ORACLES = {"op6_url_filter": OP6_SQL, "op9_quality": OP9_SQL, "op12_fill_in_middle": OP12_SQL}
