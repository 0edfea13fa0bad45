"""Vocabulary, lengths, tokenising, masks, batches and perplexity."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import tokens as t
from workload.common import documents, quoted, r6, r6_sql, table

QUERIES, ORACLES = {}, {}
SIZE = 500
_TOKEN = r"\p{L}+|\p{N}+|[^\s\x0b\x1c-\x1f\x{85}\p{Z}\p{L}\p{N}]"
_SPLIT = f"regexp_extract_all(text, {quoted(_TOKEN)})"


_docs = documents


VOCAB_SQL = f"""
vocab AS (
  SELECT * FROM (VALUES (0, '<|pad|>', NULL, 'pad'), (1, '<|startoftext|>', NULL, 'bos'),
                        (2, '<|endoftext|>', NULL, 'eos'), (3, '<|unk|>', NULL, 'unk')) s(id, token, uses, role)
  UNION ALL
  SELECT 3 + row_number() OVER (ORDER BY uses DESC, token) AS id, token, uses, NULL FROM (
    SELECT token, count(*) AS uses FROM (SELECT unnest({_SPLIT}) AS token FROM documents)
    GROUP BY 1 ORDER BY uses DESC, token LIMIT {SIZE}))
"""
QUERIES["vocab"] = lambda spark, sf: t.vocabulary(_docs(spark, sf), "text", SIZE)
ORACLES["vocab"] = f"WITH {VOCAB_SQL} SELECT * FROM vocab"

def special_ids(spark, sf):
    """Ids of a vocabulary without a pad token, and the tokens of each language that its id for unknown ones stands for."""
    docs = _docs(spark, sf)
    vocab = t.vocabulary(docs, "text", SIZE, t.SPECIALS[2:])
    ids = t.special_ids(vocab).first()
    unknown = F.size(F.filter("input_ids", lambda x: x == ids["unk_id"]))
    found = t.tokenize(docs.select("lang", "text"), "text", vocab, 1 << 30, bos=False).groupBy("lang").agg(F.sum(unknown).alias("unknown"))
    return found.select("lang", "unknown", *[F.lit(ids[c]).cast("bigint").alias(c) for c in ("pad_id", "bos_id", "eos_id", "unk_id")])


QUERIES["special_ids"] = special_ids
ORACLES["special_ids"] = f"""WITH {VOCAB_SQL}
SELECT lang, sum((id IS NULL)::INT)::BIGINT AS unknown, 0::BIGINT AS pad_id, NULL::BIGINT AS bos_id, 0::BIGINT AS eos_id, 1::BIGINT AS unk_id
FROM (SELECT lang, unnest({_SPLIT}) AS token FROM documents) LEFT JOIN vocab USING (token) GROUP BY 1"""

QUERIES["token_length"] = lambda spark, sf: _docs(spark, sf).select("doc_id", t.token_length(F.col("text")).alias("length"))
ORACLES["token_length"] = f"SELECT doc_id, 1 + len({_SPLIT}) AS length FROM documents"


def length_profile(spark, sf):
    docs = _docs(spark, sf).select("lang", t.token_length(F.col("text")).alias("length"))
    return t.length_profile(docs, "length").select(F.lit("all").alias("lang"), "*").unionByName(
        t.length_profile(docs, "length", "lang"))


QUERIES["length_profile"] = length_profile
ORACLES["length_profile"] = f"""
WITH l AS (SELECT lang, 1 + len({_SPLIT}) AS length FROM documents),
p AS (SELECT coalesce(lang, 'all') AS lang, count(*) AS rows, quantile_cont(length, [0.5, 0.95, 0.99]) AS q
      FROM l GROUP BY GROUPING SETS ((), (lang)))
SELECT lang, rows, floor(q[1])::INT AS p50, floor(q[2])::INT AS p95, floor(q[3])::INT AS p99,
       greatest(128, least(1024, floor(q[2])::INT)) AS max_length FROM p"""


def tokenize(spark, sf):
    docs = _docs(spark, sf)
    limit = t.length_profile(docs.select(t.token_length(F.col("text")).alias("length")), "length").select("max_length").scalar()
    vocab = t.vocabulary(docs, "text", SIZE)
    return t.tokenize(docs.select("doc_id", "text"), "text", vocab, limit).select(
        "doc_id", "length", "input_ids", "attention_mask", "labels")


TOKENIZED_SQL = f"""
{VOCAB_SQL},
lim AS (SELECT greatest(128, least(1024, floor(quantile_cont(1 + len({_SPLIT}), 0.95))::INT)) AS max_length FROM documents),
toks AS (SELECT doc_id, {_SPLIT} AS ts FROM documents),
flat AS (SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM toks),
ids AS (SELECT doc_id, pos, coalesce(id, 3) AS id FROM flat LEFT JOIN vocab USING (token)),
listed AS (SELECT doc_id, list(id ORDER BY pos) AS l FROM ids GROUP BY 1),
tokenized AS (
  SELECT doc_id, len(ts) + 1 AS length, list_slice(list_prepend(1, coalesce(l, [])), 1, max_length) AS input_ids
  FROM toks LEFT JOIN listed USING (doc_id), lim)
"""


def _flat(df, *keys):
    """Arrays as text: the same in both engines' results."""
    arrays = [c for c, d in df.dtypes if d.startswith("array")]
    return df.select(*keys, *[F.col(c) for c in df.columns if c not in arrays and c not in keys],
                     *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in arrays])


QUERIES["tokenize"] = lambda spark, sf: _flat(tokenize(spark, sf), "doc_id")
ORACLES["tokenize"] = f"""WITH {TOKENIZED_SQL}
SELECT doc_id, length, array_to_string(input_ids, ',') AS input_ids,
       array_to_string([1 for x in input_ids], ',') AS attention_mask, array_to_string(input_ids, ',') AS labels FROM tokenized"""


# ---- label mask and batches: token codes are cheap stand-ins for ids, one per turn ----------------
def _turn_tokens(spark, sf):
    """Turns as id arrays: the code of the first character of each token; 7 marks the assistant."""
    ids = F.transform(t.split_tokens(F.col("text")), lambda x: F.ascii(x).cast("bigint"))
    tag = F.when(F.col("role") == "assistant", F.array(F.lit(7).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", F.concat(ids, tag, F.slice(ids, 1, 5)).alias("input_ids"))


_TURN_SQL = f"""
turn_tokens AS (
  SELECT conv_id, turn, role, list_concat(ids, CASE WHEN role = 'assistant' THEN [7] ELSE [] END, ids[1:5]) AS input_ids
  FROM (SELECT conv_id, turn, role, [unicode(x)::BIGINT for x in {_SPLIT}] AS ids FROM conversations))
"""
QUERIES["assistant_mask"] = lambda spark, sf: _flat(_turn_tokens(spark, sf).select(
    "conv_id", "turn", t.assistant_labels(F.col("input_ids"), 7).alias("labels")), "conv_id", "turn")
ORACLES["assistant_mask"] = f"""WITH {_TURN_SQL},
b AS (SELECT conv_id, turn, input_ids, list_position(list_reverse(input_ids), 7) AS back FROM turn_tokens)
SELECT conv_id, turn, array_to_string(CASE WHEN coalesce(back, 0) = 0 THEN input_ids
  ELSE list_concat([-100 for x in input_ids[1:len(input_ids) - back + 1]], input_ids[len(input_ids) - back + 2:]) END, ',') AS labels FROM b"""


def _batched(spark, sf):
    return _turn_tokens(spark, sf).select(
        F.floor((F.col("conv_id") * 64 + F.col("turn")) / 100).alias("batch_id"), "conv_id", "turn", "input_ids",
        F.transform("input_ids", lambda _: F.lit(1).cast("bigint")).alias("attention_mask"))


QUERIES["pad_batch"] = lambda spark, sf: _flat(t.pad_batches(_batched(spark, sf), ["batch_id"], 0), "batch_id", "conv_id", "turn")
ORACLES["pad_batch"] = f"""WITH {_TURN_SQL},
b AS (SELECT (conv_id * 64 + turn) // 100 AS batch_id, *, len(input_ids) AS n FROM turn_tokens),
w AS (SELECT *, CAST(ceil(max(n) OVER (PARTITION BY batch_id) / 8.0) * 8 AS INT) AS pad_len FROM b)
SELECT batch_id, conv_id, turn, pad_len,
  array_to_string(list_concat(input_ids, [0 for x in range(pad_len - n)]), ',') AS input_ids,
  array_to_string(list_concat([1 for x in range(n)], [0 for x in range(pad_len - n)]), ',') AS attention_mask,
  array_to_string(list_concat(input_ids, [-100 for x in range(pad_len - n)]), ',') AS labels FROM w"""

QUERIES["pad_batch_labels"] = lambda spark, sf: _flat(t.pad_batches(
    _batched(spark, sf).withColumn("labels", t.assistant_labels(F.col("input_ids"), 7)), ["batch_id"], 0, keep_labels=True
).select("conv_id", "turn", "pad_len", "labels"), "conv_id", "turn")
ORACLES["pad_batch_labels"] = f"""WITH {_TURN_SQL},
b AS (SELECT (conv_id * 64 + turn) // 100 AS batch_id, *, len(input_ids) AS n, list_position(list_reverse(input_ids), 7) AS back FROM turn_tokens),
w AS (SELECT *, CAST(ceil(max(n) OVER (PARTITION BY batch_id) / 8.0) * 8 AS INT) AS pad_len FROM b)
SELECT conv_id, turn, pad_len, array_to_string(list_concat(CASE WHEN coalesce(back, 0) = 0 THEN input_ids
  ELSE list_concat([-100 for x in range(n - back + 1)], input_ids[n - back + 2:]) END, [-100 for x in range(pad_len - n)]), ',') AS labels FROM w"""


def _length_batches(spark, sf):
    docs = _docs(spark, sf).select("doc_id", t.token_length(F.col("text")).alias("length"))
    return t.length_batches(docs, "doc_id", "length", 16, 4711, rows_per_shard=300)


_BATCHES_SQL = f"""
l AS (SELECT doc_id, 1 + len({_SPLIT}) AS length FROM documents),
s AS (SELECT *, ('0x' || left(md5(doc_id || ':4711'), 8))::BIGINT % (SELECT greatest(1, ceil(count(*) / 300.0))::BIGINT FROM documents) AS shard FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY length, doc_id) - 1 AS p FROM s),
batches AS (SELECT doc_id, length, shard, p // 16 AS batch, p % 16 AS place FROM r)
"""
QUERIES["length_batches"] = lambda spark, sf: _length_batches(spark, sf)
ORACLES["length_batches"] = f"WITH {_BATCHES_SQL} SELECT * FROM batches"
QUERIES["padding_waste"] = lambda spark, sf: t.padding_waste(_length_batches(spark, sf), "length", ["shard", "batch"]).withColumn("waste", F.round(F.col("waste") + 1e-9, 6))
ORACLES["padding_waste"] = f"""WITH {_BATCHES_SQL},
w AS (SELECT shard, batch, count(*) AS rows, CAST(ceil(max(length) / 8.0) * 8 AS BIGINT) AS pad_len, sum(length) AS used FROM batches GROUP BY 1, 2)
SELECT shard, batch, rows, pad_len, {r6_sql('(1 - used::DOUBLE / (rows * pad_len))', 'waste')} FROM w"""


def _logits(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 50).alias("seq"), (F.col("vec_id") % 50).alias("pos"), F.col("embedding").alias("logits"),
        F.when(F.col("vec_id") % 7 == 0, t.IGNORE).otherwise(F.col("label")).alias("label"))


QUERIES["perplexity"] = lambda spark, sf: t.cross_entropy(_logits(spark, sf), "seq").select(
    "seq", "positions", r6("eval_loss", "eval_loss"), r6("perplexity", "perplexity"))
ORACLES["perplexity"] = f"""
WITH r AS (SELECT vec_id // 50 AS seq, [x::DOUBLE for x in embedding] AS z,
                  lead(CASE WHEN vec_id % 7 = 0 THEN -100 ELSE label END) OVER (PARTITION BY vec_id // 50 ORDER BY vec_id) AS target FROM embeddings),
n AS (SELECT seq, ln(list_sum([exp(x) for x in z])) - z[target + 1] AS nll FROM r WHERE target <> -100)
SELECT seq, count(*) AS positions, {r6_sql('avg(nll)', 'eval_loss')}, {r6_sql('exp(avg(nll))', 'perplexity')} FROM n GROUP BY 1"""
