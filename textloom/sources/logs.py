"""Training logs as tables: printed lines, whole files, and trainer state files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.cleaning import bound, strip
from textloom.functions.numbers import round_exact
from textloom.sources.logfiles import SPLIT_BYTES, local, read_units

# fixed values
OBJECT = r"\{[^{}]+\}"
NOISE = [
    "FutureWarning: `tokenizer` is deprecated",
    "UserWarning: The PEFT config's `base_model_name_or_path` was renamed",
    "Use `processing_class` instead.",
]
FIELDS = {"loss": "double", "learning_rate": "double", "grad_norm": "double", "epoch": "double",
          "step": "bigint", "eval_loss": "double", "eval_runtime": "double",
          "eval_samples_per_second": "double", "eval_steps_per_second": "double", "eval_perplexity": "double",
          "train_runtime": "double", "train_samples_per_second": "double", "train_steps_per_second": "double"}
_STRICT = {"allowSingleQuotes": "false"}


def read_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Log lines with their file and `seq`, their order in the file."""
    return read_units(spark, path, "line", split_bytes)


def read_entries(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Loss entries of log files with file and `seq`: line by line, or, in files of which no line holds an entry, from
    objects that may span lines, up to the first that is not JSON.

    Files are read in ranges; only the names of files, and the place of their first broken object, are moved.
    """
    by_line = parse_lines(read_lines(spark, path, split_bytes)).select("file", "seq", "entry")
    turned = F.replace(F.col("value"), F.lit("'"), F.lit('"'))
    spanning = read_units(spark, path, "object", split_bytes).join(by_line.select("file").distinct(), "file", "left_anti")
    # the generator keeps the filters from repeating the parsing (see prepare.evaluated_once)
    spanning = spanning.select("file", "seq", F.explode(F.array(_object(turned))).alias("entry"))
    broken = spanning.where("entry IS NULL").groupBy("file").agg(F.min("seq").alias("_broken"))
    spanning = spanning.join(broken, "file", "left").where(F.col("_broken").isNull() | (F.col("seq") < F.col("_broken")))
    return by_line.unionByName(spanning.where(F.map_contains_key("entry", F.lit("loss"))).drop("_broken"))


def _object(text: Column) -> Column:
    """A JSON object as a map of texts; null if the text is not one."""
    return F.from_json(text, "map<string,string>", _STRICT)


def line_entry(line: Column, field: str = "loss") -> Column:
    """The entry printed in a line, as a map of its fields as text; null if there is none.

    Tried in turn: the whole line as JSON, the line with single quotes turned, and the first object
    without inner braces anywhere in the line. An entry must have the field.
    """
    def parsed(x: Column) -> Column:
        turned = F.regexp_replace(x, r"(?<!\\)'", '"')
        inner = F.replace(F.regexp_extract(x, OBJECT, 0), F.lit("'"), F.lit('"'))
        with_field = lambda e: F.when(F.map_contains_key(e, F.lit(field)), e)
        # the parser reads one object and ignores what follows, so the line must end with it
        alone = lambda t: F.when(x.startswith("{") & x.endswith("}"), t)
        return F.coalesce(*[bound(_object(t), with_field) for t in (alone(x), alone(turned), inner)])

    return bound(strip(line), lambda x: F.when(_may_hold(x, field), parsed(x)))


def _may_hold(line: Column, field: str) -> Column:
    return line.contains("{") & (line.contains(f"'{field}'") | line.contains(f'"{field}"'))


def parse_lines(lines: DataFrame, value: str = "value", field: str = "loss") -> DataFrame:
    """Lines that hold an entry with a field, with `entry` (see `line_entry`)."""
    # the generator keeps the filter from repeating the parsing (see prepare.evaluated_once)
    return (lines.where(_may_hold(F.col(value), field))
            .select("*", F.explode(F.array(line_entry(F.col(value), field))).alias("entry"))
            .where("entry IS NOT NULL"))


def _spanning_entries(text: Column) -> Column:
    """Objects of a text in order, which may span lines, up to the first that is not JSON."""
    objects = F.regexp_extract_all(F.replace(text, F.lit("'"), F.lit('"')), F.lit(OBJECT), 0)

    def valid(parsed: Column) -> Column:
        broken = F.array_position(F.transform(parsed, lambda e: e.isNull()), True)
        return F.when(broken > 0, F.slice(parsed, F.lit(1), (broken - 1).cast("int"))).otherwise(parsed)

    found = bound(F.transform(objects, _object), valid)
    return F.filter(found, lambda e: F.map_contains_key(e, F.lit("loss")))


def parse_files(files: DataFrame, value: str = "value") -> DataFrame:
    """Loss entries of whole files, with `seq`: line by line, or, where no line holds an entry,
    as objects that may span lines. A file is one row, so nothing is joined or moved."""
    lines = F.split(F.col(value), r"\r\n|\n|\r")
    by_line = F.filter(F.transform(lines, lambda x: line_entry(x)), lambda e: e.isNotNull())
    entries = bound(by_line, lambda e: F.when(F.size(e) > 0, e).otherwise(_spanning_entries(F.col(value))))
    keep = [c for c in files.columns if c != value]
    return files.select(*keep, F.posexplode(entries).alias("seq", "entry")).withColumn("seq", (F.col("seq") + 1).cast("bigint"))


def parse_trainer_states(states: DataFrame, value: str = "value") -> DataFrame:
    """Loss entries of trainer state files (one JSON object each), with `seq`.

    A file that cannot be read as JSON gives no rows.
    """
    history = F.from_json(value, "log_history array<map<string,string>>")["log_history"]
    keep = [c for c in states.columns if c != value]
    return (states.select(*keep, F.posexplode(history).alias("seq", "entry"))
            .where(F.map_contains_key("entry", F.lit("loss")))
            .withColumn("seq", (F.col("seq") + 1).cast("bigint")))


def read_trainer_states(spark: SparkSession, path: str) -> DataFrame:
    """As `parse_trainer_states`, with the file. Local and mounted folders are read as logs are, some thousand files to a
    task, of which Spark's reader takes 32; it reads what only it opens, and patterns."""
    if local(path):
        files = read_units(spark, path, "file").select("value", "file")
    else:
        files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_trainer_states(files)


def entry_fields(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """Typed columns of the known fields instead of the map."""
    rest = [c for c in entries.columns if c != entry and c not in FIELDS]
    # numbers that are not finite come out of the parser with quotes
    value = lambda k: F.regexp_replace(F.col(entry)[k], '^"(NaN|-?Infinity)"$', "$1")
    return entries.select(*rest, *[value(k).try_cast(t).alias(k) for k, t in FIELDS.items()])


def without_noise(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that hold none of the known warnings."""
    for text in NOISE:
        lines = lines.where(~F.col(value).contains(text))
    return lines


def display_row(step: Column, loss: Column, lr: Column, grad_norm: Column, epoch: Column) -> Column:
    """The line shown for a log entry."""
    rate = F.when(lr > 0, F.format_string("%.2e", lr)).otherwise("0")
    return F.format_string("  step %-6d  loss %-8.4f  lr %-10s  gnorm %-8.3f  ep %.2f",
                           step, round_exact(loss, 4), rate, round_exact(grad_norm, 3), round_exact(epoch, 2))


def display_rows(entries: DataFrame) -> DataFrame:
    """run_id, pos and the shown line of indexed entries; missing values are 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return entries.select("run_id", "pos", display_row(
        F.coalesce("step", "pos"), F.col("loss"), zero("learning_rate"), zero("grad_norm"), zero("epoch")).alias("line"))
