"""Token operators: vocabulary, tokenising, lengths, label masks, batches, perplexity.

The splitter is a regular expression (letters, digits, single symbols) and ids come from a
vocabulary table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from textloom.session import staged

TOKEN = r"\p{L}+|\p{N}+|[^\s\x1c-\x1f\x85\p{Z}\p{L}\p{N}]"
# fixed values
IGNORE = -100
SPECIALS = [("pad", "<|pad|>"), ("bos", "<|startoftext|>"), ("eos", "<|endoftext|>"), ("unk", "<|unk|>")]
MIN_LENGTH, MAX_LENGTH = 128, 1024
#: A vocabulary of at most this many rows travels with the lookup; a larger one is joined.
LOOKUP_ROWS = 1 << 18


def split_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), 0)


def token_length(text: Column, specials: int = 1) -> Column:
    """Tokens of the whole text plus the special tokens put around it."""
    return (F.regexp_count(text, F.lit(TOKEN)) + specials).cast("int")


def vocabulary(df: DataFrame, text: str, size: int = 32768,
               specials: list[tuple[str, str]] = SPECIALS) -> DataFrame:
    """The `size` most frequent tokens with ids behind the special tokens.

    id, token, uses, role. Counting aggregates before the shuffle. What is kept is known from the histogram of
    uses; ranks come from ranges in their order, and the numbers of rows before each.
    """
    names = [token for _, token in specials]
    counts = df.select(F.explode(split_tokens(F.col(text))).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("uses")).where(~F.col("token").isin(names))
    counts = staged(counts, "token-counts")
    # The fewest uses of a token that is kept, from how many tokens have so many uses.
    more = Window.orderBy(F.desc("uses"))
    steps = counts.groupBy("uses").agg(F.count(F.lit(1)).alias("n")).withColumn("above", F.sum("n").over(more) - F.col("n"))
    least = steps.where(F.col("above") < size).agg(F.min("uses")).first()[0] or 0
    order = [F.desc("uses"), F.asc("token")]
    top = counts.where(F.col("uses") >= least).repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.record_batch([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(range(n, n + b.num_rows), pa.int64())],
                                  ["token", "uses", "part", "n"])
            n += b.num_rows

    top = staged(top.select("token", "uses").mapInArrow(number, "token string, uses bigint, part int, n bigint"), "token-ranks")
    # One row per task: where its ranks begin.
    before = top.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    ranked = top.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("n")).where(F.col("rank") < size).select(
        (F.col("rank") + len(specials)).alias("id"), "token", "uses", F.lit(None).cast("string").alias("role"))
    fixed = df.sparkSession.createDataFrame(
        [(i, token, None, role) for i, (role, token) in enumerate(specials)],
        "id bigint, token string, uses bigint, role string")
    return fixed.unionByName(ranked)


def special_ids(vocab: DataFrame) -> DataFrame:
    """One row with the special ids; pad falls back to eos, then to unk."""
    pick = lambda role: F.max(F.when(F.col("role") == role, F.col("id")))
    return vocab.agg(F.coalesce(pick("pad"), pick("eos"), pick("unk")).alias("pad_id"),
                     pick("bos").alias("bos_id"), pick("eos").alias("eos_id"), pick("unk").alias("unk_id"))


def length_profile(df: DataFrame, length: str, *by: str) -> DataFrame:
    """p50, p95 and p99 (interpolated, cut to whole numbers) and the max_length chosen from p95.

    Works on the histogram of lengths, which is bounded by the longest text, not by the rows.
    Raises on an empty table.
    """
    # no filter on the length: Catalyst would push it down and measure every text once more
    hist = df.groupBy(*by, length).agg(F.count(F.lit(1)).alias("_c"))
    measured = F.sum(F.when(F.col(length).isNotNull(), F.col("_c")))
    p = F.percentile(F.col(length), F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.col("_c"))
    out = hist.groupBy(*by).agg(F.coalesce(measured, F.lit(0)).alias("rows"), p.alias("_p"))
    checked = F.when(F.col("rows") == 0, F.raise_error(F.lit("no rows to measure lengths from"))).otherwise(F.col("_p"))
    out = out.withColumn("_p", checked)
    cut = [F.col("_p")[i].cast("int").alias(n) for i, n in enumerate(("p50", "p95", "p99"))]
    return out.select(*by, "rows", *cut).withColumn(
        "max_length", F.greatest(F.lit(MIN_LENGTH), F.least(F.lit(MAX_LENGTH), "p95")))


def id_lookup(vocab: DataFrame):
    """Column function: array of tokens -> array of ids.

    For a vocabulary of checked size (see `tokenize`): it travels with the function. One hash
    lookup over the flattened tokens of a batch; rows stay where they are, nothing shuffles.
    """
    table = vocab.select("id", "token", "role").toArrow()
    tokens, ids = table["token"].combine_chunks(), table["id"].combine_chunks()
    unknown = pc.filter(ids, pc.equal(table["role"].combine_chunks(), "unk"))
    unk = unknown[0].as_py() if len(unknown) else None

    @F.arrow_udf("array<bigint>")
    def lookup(batch: pa.Array) -> pa.Array:
        flat = batch.flatten().cast(tokens.type)
        found = ids.take(pc.index_in(flat, value_set=tokens))
        found = found if unk is None else pc.fill_null(found, unk)
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, found)

    return lookup


def joined_ids(df: DataFrame, tokens: str, vocab: DataFrame, name: str) -> DataFrame:
    """As `id_lookup`, by a join, for a vocabulary of any size: adds the array `name` of ids.

    Rows are written in numbered groups of some thousand, so that nothing depends on how the input is computed
    again. Of a group each distinct token is asked for once, and the answers meet the group by its number.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        n = TaskContext.get().partitionId() << 32
        for b in batches:
            yield b.append_column("_group", pa.array([n] * b.num_rows, pa.int64()))
            n += 1

    schema = StructType([*df.schema.fields, StructField("_group", LongType())])
    rows = staged(df.mapInArrow(number, schema), "token-groups")
    unknown = vocab.where("role = 'unk'").agg(F.max("id")).first()[0]
    asked = rows.select(F.col("_group").alias("_of"), F.explode(tokens).alias("token")).distinct()
    found = asked.join(vocab.select("id", "token"), "token").select("_of", "token", "id")

    def answer(own: pa.Table, table: pa.Table) -> pa.Table:
        column = own[tokens].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        known = table["token"].combine_chunks()
        known = known.cast(column.type.value_type)
        ids = table["id"].combine_chunks().take(pc.index_in(column.flatten(), value_set=known))
        ids = ids if unknown is None else pc.fill_null(ids, unknown)
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        return own.drop_columns(["_group"]).append_column(name, pa.ListArray.from_arrays(offsets, ids))

    return rows.groupBy("_group").cogroup(found.groupBy("_of")).applyInArrow(
        answer, StructType([*df.schema.fields, StructField(name, ArrayType(LongType()))]))


def tokenize(df: DataFrame, text: str, vocab: DataFrame, max_length: int | Column,
             bos: bool = True) -> DataFrame:
    """Add input_ids (cut to max_length), attention_mask, labels and the uncut length."""
    start = F.array(F.lit(dict(SPECIALS)["bos"])) if bos else F.array().cast("array<string>")
    limit = F.lit(max_length) if isinstance(max_length, int) else max_length
    # a generator, so that the split is not repeated for each of the columns made from it
    out = df.select("*", F.explode(F.array(F.concat(start, split_tokens(F.col(text))))).alias("_tokens"))
    out = out.select(*df.columns, F.size("_tokens").alias("length"), F.slice("_tokens", F.lit(1), limit).alias("_tokens"))
    if vocab.count() <= LOOKUP_ROWS:
        out = out.withColumn("input_ids", id_lookup(vocab)("_tokens")).drop("_tokens")
    else:
        out = joined_ids(out, "_tokens", vocab, "input_ids").drop("_tokens")
    return (out.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1).cast("bigint")))
            .withColumn("labels", F.col("input_ids")))


def assistant_labels(ids: Column, assistant_id: Column | int) -> Column:
    """Ids behind the last assistant tag, -100 up to it; all ids if the tag does not occur."""
    tag = F.lit(assistant_id).cast("bigint") if isinstance(assistant_id, int) else assistant_id
    back = F.array_position(F.reverse(ids), tag)  # 0 if absent
    boundary = F.size(ids) - back + 1
    return F.transform(ids, lambda x, i: F.when((back == 0) | (i >= boundary), x).otherwise(F.lit(IGNORE).cast("bigint")))


def pad_batches(df: DataFrame, batch: list[str], pad_id: int | Column, multiple: int = 8,
                keep_labels: bool = False) -> DataFrame:
    """Pad the rows of each batch to its longest, rounded up to `multiple`.

    Labels are the ids under the mask, or the given labels padded (`keep_labels`).
    """
    pad = F.lit(pad_id).cast("bigint") if isinstance(pad_id, int) else pad_id
    ignore = F.lit(IGNORE).cast("bigint")
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(*batch))
    rows = df.withColumn("pad_len", (F.ceil(longest / multiple) * multiple).cast("int"))
    fill = lambda c, v: F.concat(F.col(c), F.array_repeat(v, F.col("pad_len") - F.size(c)))
    if keep_labels:
        rows = rows.withColumn("labels", fill("labels", ignore))
    rows = (rows.withColumn("input_ids", fill("input_ids", pad))
            .withColumn("attention_mask", fill("attention_mask", F.lit(0).cast("bigint"))))
    if keep_labels:
        return rows
    return rows.withColumn("labels", F.zip_with("input_ids", "attention_mask",
                                                lambda x, m: F.when(m == 1, x).otherwise(ignore)))


def length_batches(df: DataFrame, key: str, length: str, batch_size: int, seed: int,
                   rows_per_shard: int = 100_000) -> DataFrame:
    """Group rows of similar length: adds shard, batch and place.

    Rows are spread over as many random shards as the table needs, so the sort inside a shard
    stays small and batches of neighbouring lengths are still found in every shard.
    """
    # count() runs on the key alone; the number of shards grows with the table
    shards = df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_shard)).cast("bigint").alias("k")).scalar()
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10)
    rows = df.withColumn("shard", F.pmod(bits.cast("bigint"), shards))
    place = F.row_number().over(Window.partitionBy("shard").orderBy(length, key)) - 1
    return rows.withColumn("_p", place).withColumn("batch", F.floor(F.col("_p") / batch_size)).withColumn(
        "place", (F.col("_p") % batch_size).cast("int")).drop("_p")


def padding_waste(batches: DataFrame, length: str, batch: list[str], multiple: int = 8) -> DataFrame:
    """Per batch: rows, padded width and share of padding."""
    width = (F.ceil(F.max(length) / multiple) * multiple).cast("bigint")
    return batches.groupBy(*batch).agg(F.count(F.lit(1)).alias("rows"), width.alias("pad_len"),
                                       (1 - F.sum(length) / (F.count(F.lit(1)) * width)).alias("waste"))


def cross_entropy(logits: DataFrame, *by: str) -> DataFrame:
    """Mean next-position cross-entropy and perplexity of (seq, pos, logits, label) rows.

    Position p predicts the label of p + 1. A join on (seq, pos) finds it, so a sequence of any
    length stays spread over tasks.
    """
    target = logits.select("seq", (F.col("pos") - 1).alias("pos"), F.col("label").alias("_target"))
    rows = logits.drop("label").join(target, ["seq", "pos"]).where(F.col("_target") != IGNORE)
    top = F.array_max("_z")
    lse = F.col("_top") + F.ln(F.aggregate("_z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top"))))
    rows = rows.withColumn("_z", F.col("logits").cast("array<double>")).withColumn("_top", top)
    nll = lse - F.element_at("_z", (F.col("_target") + 1).cast("int"))
    return rows.withColumn("_nll", nll).groupBy(*by).agg(
        F.avg("_nll").alias("eval_loss"), F.count(F.lit(1)).alias("positions")
    ).withColumn("perplexity", F.exp("eval_loss"))
