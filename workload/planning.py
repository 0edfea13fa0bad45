"""Run plans for the documents of each source, over a grid of settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators.profiles import profile_key, profile_table
from textloom.plans import runplan as r
from workload.common import table

QUERIES, ORACLES = {}, {}
# Rows per source stand for far larger datasets: a grid of multiples reaches every branch.
FACTORS = [1, 7, 40, 300, 900, 2500, 20000, 130000]


def _sources(spark, sf):
    rows = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    grid = rows.withColumn("factor", F.explode(F.array(*[F.lit(f).cast("bigint") for f in FACTORS])))
    return grid.select("source", "factor", (F.col("_n") * F.col("factor")).alias("rows"),
                       (1 + F.col("factor") % 3).cast("int").alias("epochs"),
                       F.when(F.col("factor") == 300, F.col("_n") * 40).alias("fixed_steps"))


_GRID = f"""
grid AS (
  SELECT source, factor, n * factor AS rows, (1 + factor % 3)::INT AS epochs, CASE WHEN factor = 300 THEN n * 40 END AS fixed_steps
  FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1), (SELECT unnest({FACTORS})::BIGINT AS factor)),
est AS (SELECT *, rows // 16 AS estimate, greatest(1, rows // 16) AS per_epoch FROM grid),
tot AS (SELECT *, coalesce(fixed_steps, estimate * epochs)::BIGINT AS total_steps,
        CASE WHEN fixed_steps IS NOT NULL THEN greatest(1, fixed_steps // greatest(estimate, 1)) ELSE epochs END AS planned_epochs,
        greatest(floor(per_epoch * CASE WHEN per_epoch < 4000 THEN 0.22::DOUBLE ELSE 0.18::DOUBLE END)::BIGINT, 50) AS min_stop_steps FROM est),
cap AS (SELECT *, round(0.95::DOUBLE - (0.95::DOUBLE - 0.65::DOUBLE) * least(1, greatest(0, (log10(greatest(total_steps, 10)) - 1) / 4)), 4) AS cap FROM tot)
"""
_KEYS = ["source", "factor"]

QUERIES["step_estimate"] = lambda spark, sf: _sources(spark, sf).withColumn("estimate", r.step_estimate(F.col("rows"), 2, 8)).select(
    *_KEYS, "rows", "estimate", r.total_steps(F.col("estimate"), F.col("epochs"), F.col("fixed_steps")).alias("total_steps"),
    r.planned_epochs(F.col("estimate"), F.col("epochs"), F.col("fixed_steps")).alias("planned_epochs"))
ORACLES["step_estimate"] = f"WITH {_GRID} SELECT source, factor, rows, estimate, total_steps, planned_epochs FROM tot"

QUERIES["min_steps"] = lambda spark, sf: _sources(spark, sf).select(*_KEYS, r.min_steps(F.col("rows"), 2, 8).alias("min_stop_steps"))
ORACLES["min_steps"] = f"WITH {_GRID} SELECT source, factor, min_stop_steps FROM tot"

QUERIES["hard_cap"] = lambda spark, sf: _sources(spark, sf).withColumn("total", F.floor(F.col("rows") / 16)).select(
    *_KEYS, r.hard_cap_fraction(F.col("total")).alias("cap"), r.hard_cap_steps(F.col("total")).alias("cap_steps"))
ORACLES["hard_cap"] = f"""WITH {_GRID},
h AS (SELECT source, factor, rows // 16 AS total, round(0.95::DOUBLE - 0.3::DOUBLE * least(1, greatest(0, (log10(greatest(rows // 16, 10)) - 1) / 4)), 4) AS cap FROM grid)
SELECT source, factor, cap, floor(total * cap)::BIGINT AS cap_steps FROM h"""

_SCHED = """CASE WHEN greatest(1, rows) * greatest(1, {e}) < 1500 OR {e} <= 1 THEN 'linear'
  WHEN min_stop_steps / (greatest(1, rows) * greatest(1, {e}))::DOUBLE >= 0.36 THEN 'linear' ELSE 'cosine' END"""
QUERIES["scheduler"] = lambda spark, sf: _sources(spark, sf).withColumn("m", r.min_steps(F.col("rows"), 2, 8)).select(
    *_KEYS, r.scheduler(F.col("rows"), F.col("epochs"), F.col("m")).alias("scheduler"))
ORACLES["scheduler"] = f"WITH {_GRID} SELECT source, factor, {_SCHED.format(e='epochs')} AS scheduler FROM tot"

QUERIES["warmup"] = lambda spark, sf: _sources(spark, sf).select(*_KEYS, r.warmup_steps(F.col("rows")).alias("warmup_steps"))
ORACLES["warmup"] = f"WITH {_GRID} SELECT source, factor, least(greatest(75, floor(0.01::DOUBLE * rows)::BIGINT), greatest(1, rows // 10)) AS warmup_steps FROM grid"


def run_plan(spark, sf):
    model = F.when(F.col("factor") % 2 == 0, "/models/Phi-2").otherwise("/models/other")
    settings = profile_table(spark).select("profile", "grad_accum", "learning_rate")
    rows = _sources(spark, sf).withColumn("profile", profile_key(model)).join(F.broadcast(settings), "profile")
    return r.plan_runs(rows).select(*_KEYS, "profile", "rows", "epochs", "estimated_steps", "total_steps", "early_stop", "min_stop_steps",
                                    "hard_cap_steps", "scheduler", "warmup_steps", "effective_batch", "learning_rate", "valid")


QUERIES["run_plan"] = run_plan
ORACLES["run_plan"] = f"""
WITH {_GRID.split('est AS')[0]}
g AS (SELECT *, CASE WHEN factor % 2 = 0 THEN 16 ELSE 8 END AS acc FROM grid),
e AS (SELECT *, rows // acc AS est, greatest(1, rows // acc) AS per FROM g),
t AS (SELECT *, coalesce(fixed_steps, est * epochs)::BIGINT AS total_steps,
      CASE WHEN fixed_steps IS NOT NULL THEN greatest(1, fixed_steps // greatest(est, 1)) ELSE epochs END AS ep,
      greatest(floor(per * CASE WHEN per < 4000 THEN 0.22::DOUBLE ELSE 0.18::DOUBLE END)::BIGINT, 50) AS min_stop_steps FROM e)
SELECT source, factor, CASE WHEN acc = 16 THEN 'phi-2' ELSE 'default' END AS profile, rows, ep AS epochs, est AS estimated_steps, total_steps,
  fixed_steps IS NULL AS early_stop, min_stop_steps,
  CASE WHEN fixed_steps IS NULL THEN floor(total_steps * round(0.95::DOUBLE - 0.3::DOUBLE * least(1, greatest(0, (log10(greatest(total_steps, 10)) - 1) / 4)), 4))::BIGINT END AS hard_cap_steps,
  {_SCHED.format(e='ep')} AS scheduler,
  least(greatest(75, floor(0.01::DOUBLE * total_steps)::BIGINT), greatest(1, total_steps // 10)) AS warmup_steps,
  acc AS effective_batch, 2e-5::DOUBLE AS learning_rate, total_steps >= 1 AS valid FROM t"""
