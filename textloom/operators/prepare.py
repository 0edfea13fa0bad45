"""From a raw table to one `text` column: synthesis, blank rows, retention, order, preview."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.cleaning import clean_text, strip
from textloom.operators.roles import table_roles
from textloom.session import staged

#: Bytes of a range of a shuffled table, and of one that is not worth a core.
RANGE_BYTES, SMALL_BYTES = 128 << 20, 1 << 20
JOINT = "\n\n"
IMAGE_PROMPT = ("<|user|>\n<|image_1|>\n", "<|end|>\n<|assistant|>")  # fixed values
# First bytes of the image formats that are accepted: PNG, JPEG, GIF, BMP, WEBP (RIFF), TIFF.
IMAGE_SIGNATURES = ["89504E470D0A1A0A", "FFD8FF", "474946383761", "474946383961", "424D",
                    "52494646", "49492A00", "4D4D002A"]
IMAGE_NAMES = r"\.(png|jpe?g|gif|bmp|webp|tiff?)$"


def _joined(parts: list[Column]) -> Column:
    return F.concat_ws(JOINT, *parts)  # skips nulls, keeps empty texts


def _is_messages(df: DataFrame, name: str | None) -> bool:
    kind = None if name is None else df.schema[name].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "content" in kind.elementType.names


def sft_text(question: Column | None, chosen: Column | None, mode: str = "math") -> Column:
    """Cleaned question and answer. A part is left out if null, not if cleaned to nothing."""
    parts = [F.when(c.isNotNull(), clean_text(c, mode)) for c in (question, chosen) if c is not None]
    return _joined(parts)


def causal_text(text: Column, mode: str = "math") -> Column:
    return clean_text(text, mode)


def chat_text(messages: Column, mode: str = "math") -> Column:
    """The question column alone. An array of messages gives one cleaned part per message."""
    return F.array_join(F.transform(messages, lambda m: clean_text(m["content"], mode)), JOINT)


def multimodal_text(question: Column | None, chosen: Column | None, mode: str = "math") -> Column:
    """As sft_text, but a blank part is left out."""
    parts = [F.when(strip(c.cast("string")) != "", clean_text(c, mode))
             for c in (question, chosen) if c is not None]
    return _joined(parts)


def counting(df: DataFrame, name: str | None) -> Column | None:
    """A column for `multimodal_text`: numbers that are zero and false count as no answer."""
    if name is None:
        return None
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.BooleanType):
        return F.when(c, c.cast("string"))
    return F.when(c != 0, c.cast("string")) if isinstance(kind, T.NumericType) else c


def multimodal_rows(df: DataFrame, question: str | None, chosen: str | None, image: str,
                    mode: str = "math") -> DataFrame:
    """text and image only, blank texts dropped."""
    text = multimodal_text(counting(df, question), counting(df, chosen), mode)
    rows = df.select(text.alias("text"), F.col(image).alias("image"))
    return drop_blank(rows, "text", "image")


def image_prompt(text: Column) -> Column:
    return F.concat(F.lit(IMAGE_PROMPT[0]), text, F.lit(IMAGE_PROMPT[1]))


def readable_image(image: Column) -> Column:
    """Whether a binary starts like an image file; no bytes are decoded."""
    head = F.hex(F.substring(image, 1, 8))
    out = F.lit(False)
    for signature in IMAGE_SIGNATURES:
        out = out | head.startswith(signature)
    return F.coalesce(out, F.lit(False))


def _image_path(path: Column) -> Column:
    return F.coalesce(F.rlike(F.lower(path), F.lit(IMAGE_NAMES)), F.lit(False))


def image_ok(df: DataFrame, image: str) -> Column:
    """Whether an image column can be read: binary payloads and the bytes of (bytes, path) structs by their
    first bytes; paths, alone or in a struct without bytes, by their ending. Files are not opened."""
    kind, c = df.schema[image].dataType, F.col(image)
    if isinstance(kind, T.StructType):
        payload = c["bytes"] if "bytes" in kind.names else F.lit(None).cast("binary")
        path = c["path"] if "path" in kind.names else F.lit(None).cast("string")
        return F.when(F.coalesce(F.octet_length(payload), F.lit(0)) > 0, readable_image(payload)).otherwise(_image_path(path))
    return _image_path(c) if isinstance(kind, T.StringType) else readable_image(c)


def drop_unreadable(df: DataFrame, image: str = "image") -> DataFrame:
    """Rows whose image can be read."""
    return df.where(image_ok(df, image))


def image_drop_counts(df: DataFrame, image: str, *by: str) -> DataFrame:
    ok = image_ok(df, image)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("kept"),
                               F.count_if(~ok).alias("dropped"))


def evaluated_once(df: DataFrame, text: Column, name: str, *keep: str) -> DataFrame:
    """Compute an expensive column behind a generator.

    Catalyst pushes a filter on a computed column below the projection and so computes it twice.
    It does not push through the output of a generator.
    """
    return df.select(*keep, F.explode(F.array(text)).alias(name))


def drop_blank(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return evaluated_once(df, F.col(text), text, *keep).where(strip(F.col(text)) != "")


def prepared(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """`keep` columns and the computed text, blank texts dropped; the text is computed once."""
    return evaluated_once(df, text, "text", *keep).where(strip(F.col("text")) != "")


def retention(df: DataFrame, text: Column, *by: str) -> DataFrame:
    """Rows, and rows whose text is not blank, per group."""
    kept = strip(F.col("_t")) != ""
    return evaluated_once(df, text, "_t", *by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("retained"))


def shuffle_key(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def table_bytes(df: DataFrame) -> int:
    """About the bytes of a table's rows: texts and binaries as they are, numbers as eight, the rest as JSON."""
    def size(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(c)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(c)))
        return F.lit(8)

    each = [F.coalesce(size(f), F.lit(0)).cast("bigint") for f in df.schema.fields]
    return df.select(functools.reduce(Column.__add__, each).alias("b")).agg(F.sum("b")).first()[0] or 0


def seeded_shuffle(df: DataFrame, key: str, seed: int, partitions: int | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A random order that depends on the key and the seed only, not on the partitioning.

    The sort keys are uniform, so the ranges of the partitions are known beforehand: the table is moved once,
    and not computed a second time to sample the ranges as a global sort would. Unless their number is given, the rows
    are written first and their bytes counted, so that ranges are of about `range_bytes` whatever the table.
    """
    n = partitions
    if n is None:
        df = staged(df, "shuffle-rows")
        total = table_bytes(df)
        # A small table still uses the cores there are.
        n = max(1, -(-total // range_bytes), min(df.sparkSession.sparkContext.defaultParallelism, -(-total // SMALL_BYTES)))
    rank = shuffle_key(F.col(key), seed)
    slot = F.conv(F.substring(rank, 1, 8), 16, 10).cast("bigint")
    return df.repartitionById(n, F.shiftright(slot * n, 32).cast("int")).sortWithinPartitions(rank, key)


def preview(df: DataFrame, question: str | None, chosen: str | None, mode: str = "math",
            width: int = 120) -> DataFrame:
    """The first row's cleaned question and answer, cut to `width` characters."""
    first = df.limit(1)
    text = lambda name: F.lit("") if name is None else clean_text(F.col(name), mode)
    out = evaluated_once(first, text(question), "_q", *([chosen] if chosen else []))
    out = evaluated_once(out, text(chosen), "_a", "_q")
    cut = lambda c: F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("…"))).otherwise(F.col(c))
    return out.select(cut("_q").alias("question"), cut("_a").alias("answer"))


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Question and answer rows: each user turn with the assistant turn right behind it.

    A join on (conversation, turn) rather than a window, so that a conversation of any length
    stays spread over tasks.
    """
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question")).join(
        answers, ["conv_id", "turn"], "left")


def chat_threads(turns: DataFrame, mode: str = "math") -> DataFrame:
    """Cleaned turns of each conversation in order, as one text."""
    rows = evaluated_once(turns, clean_text(F.col("text"), mode), "_t", "conv_id", "turn")
    return rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "_t"))).alias("_ts")
    ).select("conv_id", F.array_join(F.col("_ts._t"), JOINT).alias("text"))


def prepare(df: DataFrame, key: str, clean_mode: str = "math", forced_mode: str | None = None,
            seed: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The whole preparation of one table: detect, map, build the text, drop blanks and rows with
    unreadable images, shuffle.

    A question or answer column of message arrays gives one part per message. Shuffles last when
    a seed is given: rows are dropped before they are moved.
    """
    roles = table_roles(df.columns, forced_mode)
    col = lambda role: None if roles[role] is None else F.col(roles[role])
    mode = roles["mode"]
    kept = [key, *keep]

    def part(role: str) -> Column | None:
        if roles[role] is None:
            return None
        if _is_messages(df, roles[role]):
            return chat_text(col(role), clean_mode)
        return F.when(col(role).isNotNull(), clean_text(col(role), clean_mode))

    if mode == "causal":
        text = causal_text(col("chosen"), clean_mode)
    elif mode == "chat":
        text = _joined([part("question")])
    elif mode == "multimodal":
        text = multimodal_text(counting(df, roles["question"]), counting(df, roles["chosen"]), clean_mode)
        df = drop_unreadable(df.withColumnRenamed(roles["image"], "image"))
        kept.append("image")
    else:
        text = _joined([p for p in (part("question"), part("chosen")) if p is not None])
    out = prepared(df, text, *kept)
    return out if seed is None else seeded_shuffle(out, key, seed)
