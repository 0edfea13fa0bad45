"""Run plans from row counts: steps, minimum steps, cap, scheduler, warm-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.numbers import round_exact


def step_estimate(rows: Column, batch: Column | int, grad_accum: Column | int) -> Column:
    return F.floor(rows / (batch * grad_accum)).cast("bigint")


def total_steps(estimate: Column, epochs: Column, fixed_steps: Column) -> Column:
    return F.coalesce(fixed_steps.cast("bigint"), estimate * epochs)


def planned_epochs(estimate: Column, epochs: Column, fixed_steps: Column) -> Column:
    by_steps = F.greatest(F.lit(1), F.floor(fixed_steps / F.greatest(estimate, F.lit(1))))
    return F.when(fixed_steps.isNotNull(), by_steps).otherwise(epochs).cast("bigint")


def exposure_floor(steps: Column) -> Column:
    return F.when(steps < 4000, 0.22).otherwise(0.18)


def min_steps(rows: Column, batch: Column | int, grad_accum: Column | int) -> Column:
    per_epoch = F.greatest(F.lit(1), step_estimate(rows, batch, grad_accum))
    return F.greatest((per_epoch * exposure_floor(per_epoch)).cast("bigint"), F.lit(50))


def hard_cap_fraction(total: Column) -> Column:
    scale = (F.log10(F.greatest(total, F.lit(10))) - 1) / 4
    return round_exact(0.95 - (0.95 - 0.65) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), scale)), 4)


def hard_cap_steps(total: Column) -> Column:
    return (total * hard_cap_fraction(total)).cast("bigint")


def scheduler(rows: Column, epochs: Column, min_stop: Column) -> Column:
    total = F.greatest(F.lit(1), rows) * F.greatest(F.lit(1), epochs)
    pressure = min_stop / total
    restarts = total.between(1500, 40000) & (epochs >= 2) & (pressure <= 0.18) & (total / 3 < min_stop)
    return (
        F.when((total < 1500) | (epochs <= 1), "linear")
        .when(pressure >= 2 * 0.18, "linear")
        .when(restarts, "cosine_with_restarts")
        .otherwise("cosine")
    )


def warmup_steps(total: Column) -> Column:
    one_percent = F.greatest(F.lit(75), (0.01 * total).cast("bigint"))
    return F.least(one_percent, F.greatest(F.lit(1), F.floor(total / 10)))


def plan_runs(datasets: DataFrame, batch: int = 1, force: bool = False, strict: bool = False) -> DataFrame:
    """One plan per dataset row.

    Needs rows, epochs, fixed_steps (null = by epochs), grad_accum and learning_rate (from the
    model profile). A plan of less than one step is not valid; `strict` raises on it.
    """
    rows, grad = F.col("rows"), F.col("grad_accum")
    out = datasets.withColumn("estimated_steps", step_estimate(rows, batch, grad))
    out = out.withColumn("total_steps", total_steps(F.col("estimated_steps"), F.col("epochs"), F.col("fixed_steps")))
    out = out.withColumn("epochs", planned_epochs(F.col("estimated_steps"), F.col("epochs"), F.col("fixed_steps")))
    out = out.withColumn("early_stop", F.lit(not force) & F.col("fixed_steps").isNull())
    out = out.withColumn("min_stop_steps", min_steps(rows, batch, grad))
    total = F.col("total_steps")
    out = (
        out.withColumn("hard_cap_steps", F.when(F.col("early_stop"), hard_cap_steps(total)))
        .withColumn("scheduler", scheduler(rows, F.col("epochs"), F.col("min_stop_steps")))
        .withColumn("warmup_steps", warmup_steps(total))
        .withColumn("effective_batch", batch * grad)
        .withColumn("valid", total >= 1)
    )
    if strict:
        fail = F.raise_error(F.lit("not enough data to train"))
        out = out.withColumn("valid", F.when(F.col("valid"), F.col("valid")).otherwise(fail.cast("boolean")))
    return out
