"""Detection, mapping, text synthesis, filters, order and the whole preparation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from textloom.functions.cleaning import clean_text
from textloom.operators import prepare as p
from textloom.operators import profiles, roles
from workload.cleaning import clean_sql, _strip
from workload.common import TABLES, documents, marked, marked_sql, quoted, table

QUERIES, ORACLES = {}, {}

# ---- catalogs: three columns per table, names picked by the events -----------------------------
NAMES = ["Response", "id", "TEXT", "Prompt", "prompt", "Image", "label", "messages", "meta", "Question",
         "question", "summary", "photo", "caption", "url", "Output", "instruction", "text", "score",
         "expected_answer", "document", "split", "img", "Answer", "answers", "context"]


def catalog(spark, sf):
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", r"\d+", 0).cast("bigint")
    return e.select(
        F.floor(F.col("event_id") / 3).alias("table_name"),
        (F.col("event_id") % 3).cast("int").alias("position"),
        F.element_at(F.array(*[F.lit(n) for n in NAMES]), ((k + F.col("user_id")) % len(NAMES) + 1).cast("int")).alias("column_name"))


_ALIASES = ", ".join(f"('{m}', '{r}', {i}, '{a}')" for m in roles.ALIASES for r in roles.ALIASES[m]
                     for i, a in enumerate(roles.ALIASES[m][r]))
CATALOG_SQL = f"""
catalog AS (
  SELECT event_id // 3 AS table_name, event_id % 3 AS position,
         ([{', '.join(map(quoted, NAMES))}])[(regexp_extract(props, '\\d+')::BIGINT + user_id) % {len(NAMES)} + 1] AS column_name
  FROM events),
aliases(mode, role, rank, alias) AS (VALUES {_ALIASES}),
found AS (
  SELECT table_name, mode, role, column_name,
         row_number() OVER (PARTITION BY table_name, mode, role ORDER BY rank, position DESC) AS rn
  FROM catalog JOIN aliases ON lower(column_name) = alias),
best AS (SELECT table_name, mode, role, column_name FROM found WHERE rn = 1),
modes AS (
  SELECT table_name,
    CASE WHEN count(*) FILTER (mode = 'multimodal' AND role IN ('image', 'chosen')) = 2 THEN 'multimodal'
         WHEN count(*) FILTER (mode = 'sft' AND role = 'chosen') = 1 THEN 'sft'
         WHEN count(*) FILTER (mode = 'causal' AND role = 'chosen') = 1 THEN 'causal' END AS mode
  FROM best GROUP BY 1),
detected AS (
  SELECT table_name, mode FROM (SELECT DISTINCT table_name FROM catalog) LEFT JOIN modes USING (table_name)),
mapped AS (
  SELECT d.table_name, d.mode,
         max(column_name) FILTER (role = 'image') AS image, max(column_name) FILTER (role = 'question') AS question,
         max(column_name) FILTER (role = 'chosen') AS chosen, CAST(NULL AS VARCHAR) AS rejected
  FROM detected d LEFT JOIN best b ON b.table_name = d.table_name AND b.mode = d.mode GROUP BY ALL)
"""

QUERIES["detect_mode"] = lambda spark, sf: roles.detect_mode(catalog(spark, sf))
ORACLES["detect_mode"] = f"WITH {CATALOG_SQL} SELECT * FROM detected"
QUERIES["map_roles"] = lambda spark, sf: roles.map_roles(catalog(spark, sf))
ORACLES["map_roles"] = f"WITH {CATALOG_SQL} SELECT * FROM mapped"
QUERIES["resolve_role"] = lambda spark, sf: roles.resolve_role(catalog(spark, sf), "question", "multimodal")
ORACLES["resolve_role"] = f"""WITH {CATALOG_SQL}
SELECT t.table_name, column_name FROM (SELECT DISTINCT table_name FROM catalog) t
LEFT JOIN (SELECT * FROM best WHERE mode = 'multimodal' AND role = 'question') b USING (table_name)"""
QUERIES["role_summary"] = lambda spark, sf: roles.role_summary(roles.map_roles(catalog(spark, sf)))
ORACLES["role_summary"] = f"""WITH {CATALOG_SQL}
SELECT table_name, rank, role, column_name FROM (
  SELECT table_name, 0 AS rank, 'image' AS role, image AS column_name FROM mapped
  UNION ALL SELECT table_name, 1, 'question', question FROM mapped
  UNION ALL SELECT table_name, 2, 'chosen', chosen FROM mapped
  UNION ALL SELECT table_name, 3, 'rejected', rejected FROM mapped) WHERE column_name IS NOT NULL"""


def schema_preflight(spark, sf):
    def one(name):
        df = table(spark, sf, name)
        try:
            mode = roles.check_schema(spark, f"{sf}/{name}.parquet")
        except ValueError:
            mode = None
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(mode).cast("string").alias("mode"), "rows")

    return reduce(lambda a, b: a.unionByName(b), [one(t) for t in TABLES])


QUERIES["schema_preflight"] = schema_preflight
ORACLES["schema_preflight"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {repr('causal') if t in ('documents', 'benchmark', 'conversations') else 'CAST(NULL AS VARCHAR)'} AS mode, count(*) AS rows FROM {t}"
    for t in TABLES)

MODELS = ["phi-2", "Phi-3-Vision-128k", "Phi-3-mini", "llama", "my-phi-2-phi-3", "phi3", "PHI-3"]


def profile_lookup(spark, sf):
    name = F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("doc_id") % len(MODELS) + 1).cast("int"))
    models = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("/phi-2/"), "source", F.lit("/"), name, F.lit("-"), "lang").alias("model"))
    return profiles.profile_lookup(models, "model").select(
        "doc_id", "model", "profile", "grad_accum", "learning_rate", "vision",
        F.array_join("lora_targets", ",").alias("targets"), F.array_join("modules_to_save", ",").alias("saved"))


QUERIES["profile_lookup"] = profile_lookup
ORACLES["profile_lookup"] = f"""
WITH models AS (
  SELECT doc_id, '/phi-2/' || source || '/' || ([{', '.join(map(quoted, MODELS))}])[doc_id % {len(MODELS)} + 1] || '-' || lang AS model FROM documents),
rules(priority, profile, grad_accum, learning_rate, vision, saved) AS (VALUES
  (0, 'phi-2', 16, 2e-5::DOUBLE, false, NULL), (1, 'phi-3-vision', 8, 1e-5::DOUBLE, true, 'lm_head'), (2, 'phi-3', 8, 1e-5::DOUBLE, false, 'lm_head'),
  (3, 'default', 8, 2e-5::DOUBLE, false, 'lm_head')),
hits AS (
  SELECT doc_id, model, min(priority) AS priority FROM models JOIN rules
    ON profile = 'default' OR contains(lower(regexp_extract(model, '[^/]*$')), profile) GROUP BY 1, 2)
SELECT doc_id, model, profile, grad_accum, learning_rate, vision, 'q_proj,k_proj,v_proj,o_proj' AS targets, saved
FROM hits JOIN rules USING (priority)"""

# ---- text synthesis --------------------------------------------------------------------------
TURN_MARKS = [(" the ", " <i>the</i> "), (" la ", r" \le la "), (" die ", " persistent ")]


def _turns(spark, sf):
    return table(spark, sf, "conversations").withColumn("text", marked(F.col("text"), TURN_MARKS))


def sft_text(spark, sf):
    pairs = p.conversation_pairs(_turns(spark, sf))
    text = p.sft_text(F.col("question"), F.col("response"))
    return p.evaluated_once(pairs, text, "text", "conv_id", "turn")


def _turn_sql(mode="math"):
    return clean_sql(marked_sql("text", TURN_MARKS), mode, "conv_id, turn, role", "conversations", "t")


QUERIES["sft_text"] = sft_text
ORACLES["sft_text"] = f"""
WITH turns AS ({_turn_sql()}),
q AS (SELECT conv_id, turn, t, lead(role) OVER w AS next_role, lead(t) OVER w AS next_t, role
      FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, CASE WHEN next_role = 'assistant' THEN t || chr(10) || chr(10) || next_t ELSE t END AS text
FROM q WHERE role = 'user'"""

QUERIES["causal_text"] = lambda spark, sf: p.prepared(
    documents(spark, sf), p.causal_text(F.col("text")), "doc_id")
ORACLES["causal_text"] = f"SELECT * FROM ({clean_sql('text', 'math', 'doc_id', 'documents')}) WHERE text <> ''"

QUERIES["chat_text"] = lambda spark, sf: p.chat_threads(_turns(spark, sf), "general")
ORACLES["chat_text"] = f"""
WITH turns AS ({_turn_sql('general')})
SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY turn) AS text FROM turns GROUP BY ALL"""


def message_arrays(spark, sf):
    """Conversations as arrays of messages, prepared in both modes."""
    arrays = _turns(spark, sf).groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
        lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages"))
    return p.prepare(arrays, "conv_id", "general").withColumn("mode", F.lit("sft")).unionByName(
        p.prepare(arrays, "conv_id", "general", "chat").withColumn("mode", F.lit("chat")))


QUERIES["message_arrays"] = message_arrays
ORACLES["message_arrays"] = f"""
WITH turns AS ({_turn_sql('general')}),
texts AS (SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY turn) AS text FROM turns GROUP BY 1)
SELECT conv_id, text, mode FROM texts, (VALUES ('sft'), ('chat')) m(mode) WHERE {_strip('text')} <> ''"""


def _with_images(spark, sf):
    """Every page as an image row: caption from its address, payload from its source."""
    html = F.col("html").cast("binary")
    heads = ["89504E470D0A1A0A", "FFD8FF", "474946383961", "00", "52494646"]
    head = F.element_at(F.array(*[F.lit(h) for h in heads]), (F.col("page_id") % 5 + 1).cast("int"))
    payload = F.when(F.col("page_id") % 7 > 0, F.unhex(F.concat(head, F.hex(html))))
    blank = F.when(F.col("page_id") % 3 == 0, " \t ").when(F.col("page_id") % 3 == 1, F.col("url"))
    return table(spark, sf, "pages").select("page_id", "url", blank.alias("question"),
                                            F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise("").alias("caption"),
                                            payload.alias("photo"))


def multimodal_text(spark, sf):
    rows = p.multimodal_rows(_with_images(spark, sf), "question", "caption", "photo")
    return rows.select(p.image_prompt(F.col("text")).alias("prompt"), F.md5("image").alias("image_md5"))


_PAGES = """SELECT page_id, CASE page_id % 3 WHEN 1 THEN url END AS question,
  CASE WHEN page_id % 2 = 0 THEN html END AS caption,
  CASE WHEN page_id % 7 > 0 THEN unhex(([ '89504E470D0A1A0A', 'FFD8FF', '474946383961', '00', '52494646' ])[page_id % 5 + 1] || hex(encode(html))) END AS photo
  FROM pages"""
QUERIES["multimodal_text"] = multimodal_text
ORACLES["multimodal_text"] = f"""
WITH p AS ({_PAGES}),
q AS ({clean_sql('question', 'math', 'page_id', '(SELECT * FROM p WHERE question IS NOT NULL)', 't')}),
c AS ({clean_sql('caption', 'math', 'page_id', '(SELECT * FROM p WHERE caption IS NOT NULL)', 't')}),
j AS (SELECT photo, concat_ws(chr(10) || chr(10), q.t, c.t) AS text
      FROM p LEFT JOIN q USING (page_id) LEFT JOIN c USING (page_id))
SELECT '<|user|>' || chr(10) || '<|image_1|>' || chr(10) || text || '<|end|>' || chr(10) || '<|assistant|>' AS prompt,
       md5(photo) AS image_md5 FROM j WHERE {_strip('text')} <> ''"""

QUERIES["image_filter"] = lambda spark, sf: p.image_drop_counts(
    _with_images(spark, sf).withColumn("host", F.split("url", "/")[2]), "photo", "host")
ORACLES["image_filter"] = """
SELECT split_part(url, '/', 3) AS host, count(*) AS rows,
       count(*) FILTER (page_id % 7 > 0 AND page_id % 5 <> 3) AS kept,
       count(*) FILTER (page_id % 7 = 0 OR page_id % 5 = 3) AS dropped
FROM pages GROUP BY 1"""



def image_kinds(spark, sf):
    """The image rows once as (bytes, path) structs and once as paths, unreadable ones dropped."""
    rows = _with_images(spark, sf)
    path = F.concat("url", F.element_at(F.array(F.lit(".png"), F.lit(".JPG"), F.lit(".txt")), (F.col("page_id") % 3 + 1).cast("int")))
    rows = rows.select("page_id", F.struct(F.col("photo").alias("bytes"), path.alias("path")).alias("boxed"), path.alias("path"))
    return p.drop_unreadable(rows, "boxed").select("page_id", F.lit("struct").alias("kind")).unionByName(
        p.drop_unreadable(rows, "path").select("page_id", F.lit("path").alias("kind")))


QUERIES["image_kinds"] = image_kinds
ORACLES["image_kinds"] = f"""
WITH p AS ({_PAGES.replace("SELECT page_id,", "SELECT page_id, url || (['.png', '.JPG', '.txt'])[page_id % 3 + 1] AS path,", 1)}),
h AS (SELECT page_id, regexp_matches(path, '[.](png|jpe?g|gif|bmp|webp|tiff?)$', 'i') AS named, hex(photo) AS x FROM p)
SELECT page_id, 'struct' AS kind FROM h WHERE CASE WHEN x IS NULL THEN named
  ELSE regexp_matches(x, '^(89504E470D0A1A0A|FFD8FF|474946383761|474946383961|424D|52494646|49492A00|4D4D002A)') END
UNION ALL SELECT page_id, 'path' FROM h WHERE named"""

# ---- filters, metrics, order ------------------------------------------------------------------
LAST = [(" the ", " persistent "), ("é", "é ")]  # makes many English texts unusable
_DOCS = documents

QUERIES["drop_blank"] = lambda spark, sf: p.prepared(
    _DOCS(spark, sf), clean_text(marked(F.col("text"), LAST), "code"), "doc_id").select("doc_id", F.length("text").alias("chars"))
ORACLES["drop_blank"] = f"SELECT doc_id, length(text) AS chars FROM ({clean_sql(marked_sql('text', LAST), 'code', 'doc_id', 'documents')}) WHERE text <> ''"
QUERIES["retention_by_source"] = lambda spark, sf: p.retention(
    _DOCS(spark, sf), clean_text(marked(F.col("text"), LAST), "latex"), "source")
ORACLES["retention_by_source"] = f"""SELECT source, count(*) AS rows, count(*) FILTER (text <> '') AS retained
FROM ({clean_sql(marked_sql('text', LAST), 'latex', 'source', 'documents')}) GROUP BY 1"""
QUERIES["prune_columns"] = lambda spark, sf: p.drop_blank(table(spark, sf, "documents"), "text")
ORACLES["prune_columns"] = f"SELECT text FROM documents WHERE {_strip('text')} <> ''"


def preview(spark, sf):
    pairs = p.conversation_pairs(table(spark, sf, "conversations"))
    return p.preview(pairs.orderBy("conv_id", "turn"), "question", "response")


QUERIES["preview"] = preview
ORACLES["preview"] = f"""
WITH turns AS ({clean_sql('text', 'math', 'conv_id, turn, role', 'conversations', 't')}),
q AS (SELECT * FROM turns WHERE role = 'user' ORDER BY conv_id, turn LIMIT 1),
j AS (SELECT q.t AS question, coalesce(a.t, '') AS answer FROM q LEFT JOIN turns a
      ON a.role = 'assistant' AND a.conv_id = q.conv_id AND a.turn = q.turn + 1)
SELECT CASE WHEN length(question) > 120 THEN left(question, 120) || '…' ELSE question END AS question,
       CASE WHEN length(answer) > 120 THEN left(answer, 120) || '…' ELSE answer END AS answer FROM j"""


def seeded_shuffle(spark, sf):
    out = p.seeded_shuffle(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 4711)
    return out.select("doc_id", "lang", p.shuffle_key(F.col("doc_id"), 4711).alias("shuffle_key"))


QUERIES["seeded_shuffle"] = seeded_shuffle
ORACLES["seeded_shuffle"] = "SELECT doc_id, lang, md5(doc_id || ':4711') AS shuffle_key FROM documents ORDER BY shuffle_key"
QUERIES["prepare"] = lambda spark, sf: p.prepare(_DOCS(spark, sf), "doc_id", keep=("lang",), seed=4711)
ORACLES["prepare"] = f"SELECT doc_id, lang, text FROM ({clean_sql('text', 'math', 'doc_id, lang', 'documents')}) WHERE text <> ''"
QUERIES["prepare_by_lang"] = lambda spark, sf: p.prepare(_DOCS(spark, sf), "doc_id", keep=("lang",)).groupBy("lang").agg(
    F.count(F.lit(1)).alias("retained"), F.sum(F.length("text")).alias("chars"))
ORACLES["prepare_by_lang"] = f"SELECT lang, count(*) AS retained, sum(length(text)) AS chars FROM ({ORACLES['prepare']}) GROUP BY 1"
