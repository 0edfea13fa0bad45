"""Run report from the training log: loss summary, trend, throughput, evaluation entries.

Log columns: run_id, seq, step, loss, eval_loss, epoch, train_runtime,
train_samples_per_second, train_steps_per_second; all but the first two may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.numbers import round_exact
from textloom.operators.scans import index_rows

SPARK_BLOCKS = "▁▂▃▄▅▆▇█"  # fixed value
SPARK_WIDTH = 48
TREND_MARGIN = 0.02


def train_entries(log: DataFrame) -> DataFrame:
    """Entries with a loss and no evaluation loss, numbered; a missing step is the position."""
    rows = index_rows(log.where("loss IS NOT NULL AND eval_loss IS NULL"), "run_id", "seq")
    return rows.withColumn("step", F.coalesce("step", "pos"))


def _summary() -> list[Column]:
    first, last = F.min_by("loss", "pos"), F.max_by("loss", "pos")
    return [
        F.count(F.lit(1)).alias("entries"),
        first.alias("first"),
        last.alias("final"),
        F.min("loss").alias("best"),
        F.min(F.struct("loss", "pos", "step"))["step"].alias("best_step"),
        F.max("loss").alias("worst"),
        (last - first).alias("delta_first_to_final"),
    ]


def _head_tail() -> list[Column]:
    head = F.col("pos") <= F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    tail = F.col("pos") > F.col("n") - F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    return [F.avg(F.when(head, F.col("loss"))).alias("avg_first_20pct"),
            F.avg(F.when(tail, F.col("loss"))).alias("avg_last_10pct")]


def loss_summary(entries: DataFrame) -> DataFrame:
    return entries.groupBy("run_id").agg(*_summary())


def _with_trend(means: DataFrame) -> DataFrame:
    delta = F.col("avg_last_10pct") - F.col("avg_first_20pct")
    return means.withColumn("trend_delta", delta).withColumn("trend", trend_text(F.col("trend_delta")))


def head_tail(entries: DataFrame) -> DataFrame:
    """Mean loss of the first fifth and the last tenth, and what their difference says."""
    return _with_trend(entries.groupBy("run_id").agg(*_head_tail()))


def trend_class(delta: Column) -> Column:
    return (F.when(delta < -TREND_MARGIN, "improving").when(delta > TREND_MARGIN, "worsening")
            .otherwise("plateau"))


def trend_text(delta: Column) -> Column:
    word = F.rpad(trend_class(delta), 11, " ")
    text = F.concat(word, F.format_string("(%+.4f vs first 20%%)", round_exact(delta, 4)))
    return F.when(delta.isNull(), "n/a").otherwise(text)


def _latest(name: str) -> Column:
    c = F.col(name)
    return F.coalesce(F.max_by(c, F.when(c.isNotNull(), F.col("seq"))), F.lit(0.0))


def _throughput() -> list[Column]:
    return [_latest("train_runtime").alias("train_runtime"),
            _latest("train_samples_per_second").alias("samples_per_sec"),
            _latest("train_steps_per_second").alias("steps_per_sec")]


def _exposure(batch: int, grad_accum: int) -> list[Column]:
    steps = F.coalesce(F.max("step"), F.lit(0))
    return [steps.cast("bigint").alias("total_steps"),
            F.lit(batch * grad_accum).cast("bigint").alias("effective_batch"),
            (steps * batch * grad_accum).cast("bigint").alias("samples_seen"),
            _latest("epoch").alias("epochs_completed")]


def throughput(log: DataFrame) -> DataFrame:
    """The last reported runtime and rates of each run; 0 where never reported."""
    return log.groupBy("run_id").agg(*_throughput())


def exposure_totals(log: DataFrame, batch: int, grad_accum: int) -> DataFrame:
    """Steps, rows seen and epochs completed of each run."""
    return log.groupBy("run_id").agg(*_exposure(batch, grad_accum))


def eval_entries(log: DataFrame) -> DataFrame:
    """Evaluation entries: step and the eval_* columns only."""
    names = [c for c in log.columns if c.startswith("eval_")]
    return log.where("eval_loss IS NOT NULL").select("run_id", "seq", "step", *names)


def sparkline(entries: DataFrame) -> DataFrame:
    """The curve of each run in 48 characters or fewer."""
    at = F.col("pos") - 1
    # Sample i is the entry at int(i * n / 48): entry p is sampled if such an i exists.
    width = F.col("n") / SPARK_WIDTH
    i = F.floor(at / width)
    picked = F.array(*[F.when((i + d < SPARK_WIDTH) & (F.floor((i + d) * width) == at), i + d) for d in (0, 1)])
    samples = (
        entries.withColumn("_i", F.when(F.col("n") <= SPARK_WIDTH, at)
                           .otherwise(F.array_max(picked)))
        .where("_i IS NOT NULL")
        .groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.struct("_i", "loss"))).alias("_s"),
             F.min("loss").alias("_lo"), F.max("loss").alias("_hi"), F.max("n").alias("entries"))
    )
    span = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))
    levels = F.transform("_s", lambda s: F.substring(
        F.lit(SPARK_BLOCKS), F.floor((s["loss"] - F.col("_lo")) / span * (len(SPARK_BLOCKS) - 1)).cast("int") + 1, F.lit(1)))
    return samples.select("run_id", "entries", F.array_join(levels, "").alias("sparkline"))


def duration_text(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), seconds.cast("bigint"))
    minutes, hours = F.floor(s / 60), F.floor(s / 3600)
    return (
        F.when(s < 60, F.format_string("%ds", s))
        .when(s < 3600, F.format_string("%dm %02ds", minutes, s % 60))
        .otherwise(F.format_string("%dh %02dm %02ds", hours, minutes % 60, s % 60))
    )


def run_report(log: DataFrame, epochs_planned: int, dataset_size: int, batch: int, grad_accum: int) -> DataFrame:
    """One row per run with a `report` struct, ready for JSON.

    The evaluation entries of a run, with all their eval_* fields, are one array of its report.
    """
    entries = train_entries(log)
    fields = [c for c in log.columns if c.startswith("eval_")]
    evals = eval_entries(log).groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "step", *fields))).alias("_e"))
    losses = _with_trend(entries.groupBy("run_id").agg(*_summary(), *_head_tail()))
    runs = (
        log.groupBy("run_id").agg(*_exposure(batch, grad_accum), *_throughput())
        .join(losses, "run_id", "left")
        .join(evals, "run_id", "left")
    )
    loss = F.struct(
        round_exact(F.col("first"), 6).alias("first"), round_exact(F.col("final"), 6).alias("final"),
        round_exact(F.col("best"), 6).alias("best"), "best_step", round_exact(F.col("worst"), 6).alias("worst"),
        round_exact(F.col("avg_last_10pct"), 6).alias("avg_last_10pct"),
        round_exact(F.col("delta_first_to_final"), 6).alias("delta_first_to_final"),
        F.coalesce("trend", F.lit("n/a")).alias("trend"),
    )
    none = F.array().cast(f"array<struct<step:bigint,{','.join(f'{c}:double' for c in fields)}>>")
    evaluation = F.transform("_e", lambda e: F.struct(
        e["step"].cast("bigint").alias("step"), *[e[c].cast("double").alias(c) for c in fields]))
    return runs.select("run_id", F.struct(
        "total_steps", F.lit(epochs_planned).alias("epochs_planned"),
        round_exact(F.col("epochs_completed"), 4).alias("epochs_completed"),
        F.lit(dataset_size).alias("dataset_size"), F.lit(batch).alias("batch_size"),
        F.lit(grad_accum).alias("grad_accum"), "effective_batch", "samples_seen",
        round_exact(F.col("train_runtime"), 2).alias("training_time_sec"),
        round_exact(F.col("samples_per_sec"), 4).alias("samples_per_sec"),
        round_exact(F.col("steps_per_sec"), 4).alias("steps_per_sec"),
        loss.alias("loss"), F.coalesce(evaluation, none).alias("eval"),
    ).alias("report"))
