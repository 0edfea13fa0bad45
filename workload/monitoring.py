"""Early-stop monitor over the event log: one run per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import monitor as m
from textloom.plans import runplan as r
from workload.common import EVENT_LOG_SQL, event_log, r6, r6_sql

QUERIES, ORACLES = {}, {}


def monitor_log(spark, sf):
    """Every eleventh event has no loss."""
    return event_log(spark, sf).withColumn("loss", F.when(F.col("seq") % 11 > 0, F.col("loss")))


def runs(log):
    """Plan of each run: as many steps as it logged."""
    total = log.groupBy("run_id").agg(F.max("step").alias("total_steps"))
    return total.select("run_id", "total_steps", r.warmup_steps(F.col("total_steps")).alias("warmup_steps"),
                        r.hard_cap_steps(F.col("total_steps")).alias("hard_cap_steps"))


def _entries(spark, sf):
    log = monitor_log(spark, sf)
    plan = m.monitor_windows(runs(log), "total_steps").select("run_id", "window", "slope_window", "min_history")
    return m.loss_entries(log, plan)


LOG_SQL = f"""
{EVENT_LOG_SQL},
monitor_log AS (
  SELECT run_id, seq, step,
         CASE WHEN seq % 11 > 0 THEN loss END AS loss, learning_rate FROM event_log),
runs AS (
  SELECT run_id, total_steps, least(greatest(75, floor(0.01::DOUBLE * total_steps)::BIGINT), greatest(1, total_steps // 10)) AS warmup_steps,
         floor(total_steps * round(0.95::DOUBLE - 0.3::DOUBLE * least(1, greatest(0, (log10(greatest(total_steps, 10)) - 1) / 4)), 4))::BIGINT AS hard_cap_steps
  FROM (SELECT run_id, max(step) AS total_steps FROM monitor_log GROUP BY 1)),
widths AS (
  SELECT *, greatest(48, floor(0.75::DOUBLE * win))::INT AS slope_window, greatest(24, win // 3)::INT AS min_history
  FROM (SELECT *, greatest(128, greatest(96, floor(0.015::DOUBLE * total_steps)))::INT AS win FROM runs))
"""
ENTRIES_SQL = """
entries AS (
  SELECT run_id, seq, step, loss, learning_rate, row_number() OVER (PARTITION BY run_id ORDER BY step) AS pos
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id, step ORDER BY seq) AS rn FROM {log} WHERE loss IS NOT NULL) WHERE rn = 1),
emas(run_id, pos, ema) AS (
  SELECT run_id, pos, loss FROM entries WHERE pos = 1
  UNION ALL
  SELECT e.run_id, e.pos, 0.9::DOUBLE * a.ema + (1 - 0.9::DOUBLE) * e.loss
  FROM emas a JOIN entries e ON e.run_id = a.run_id AND e.pos = a.pos + 1),
series AS (SELECT * FROM entries JOIN emas USING (run_id, pos))
"""
WITH_EMA = f"WITH RECURSIVE {LOG_SQL}, {ENTRIES_SQL.format(log='monitor_log')}"

QUERIES["loss_filter"] = lambda spark, sf: m.loss_entries(monitor_log(spark, sf)).select("run_id", "step", "seq", "loss", "pos")
ORACLES["loss_filter"] = f"""WITH {LOG_SQL},
prev AS (SELECT *, lag(step) OVER (PARTITION BY run_id ORDER BY step, seq) AS before FROM monitor_log WHERE loss IS NOT NULL)
SELECT run_id, step, seq, loss, row_number() OVER (PARTITION BY run_id ORDER BY step) AS pos FROM prev WHERE before IS NULL OR before <> step"""

QUERIES["ema"] = lambda spark, sf: m.signals(_entries(spark, sf)).select("run_id", "step", r6("ema", "ema"))
ORACLES["ema"] = f"{WITH_EMA} SELECT run_id, step, {r6_sql('ema', 'ema')} FROM series"

QUERIES["best_since"] = lambda spark, sf: m.best_so_far(m.signals(_entries(spark, sf))).select(
    "run_id", "step", r6("best_ema", "best_ema"), "since_best", "cooldown")
ORACLES["best_since"] = f"""{WITH_EMA},
b AS (SELECT *, min(ema) OVER (PARTITION BY run_id ORDER BY pos) AS best FROM series),
f AS (SELECT run_id, best, min(pos) AS best_pos FROM b GROUP BY 1, 2)
SELECT run_id, step, {r6_sql('best', 'best_ema')}, pos - best_pos AS since_best, greatest(0, 3 - (pos - best_pos)) AS cooldown
FROM b JOIN f USING (run_id, best)"""

SIGNALS_SQL = """
lists AS (
  SELECT *, list(ema) OVER (PARTITION BY run_id ORDER BY pos ROWS 127 PRECEDING) AS l,
    CASE WHEN count(*) OVER (PARTITION BY run_id ORDER BY pos ROWS 95 PRECEDING) >= 8
         THEN regr_slope(ema, pos) OVER (PARTITION BY run_id ORDER BY pos ROWS 95 PRECEDING) ELSE 0 END AS slope FROM series),
meds AS (SELECT *, list_median(l) AS med FROM lists),
signals AS (SELECT * EXCLUDE (l, med), CASE WHEN len(l) < 3 THEN 0 ELSE 1.4826::DOUBLE * list_median([abs(x - med) for x in l]) END AS sigma FROM meds)
"""
QUERIES["robust_sigma"] = lambda spark, sf: m.signals(_entries(spark, sf)).select("run_id", "step", r6("sigma", "sigma"))
ORACLES["robust_sigma"] = f"{WITH_EMA}, {SIGNALS_SQL} SELECT run_id, step, {r6_sql('sigma', 'sigma')} FROM signals"
QUERIES["trend_slope"] = lambda spark, sf: m.signals(_entries(spark, sf)).select("run_id", "step", r6("slope", "slope"))
ORACLES["trend_slope"] = f"{WITH_EMA}, {SIGNALS_SQL} SELECT run_id, step, {r6_sql('slope', 'slope')} FROM signals"

QUERIES["monitor_windows"] = lambda spark, sf: m.monitor_windows(
    runs(monitor_log(spark, sf)).withColumn("total_steps", F.col("total_steps") * 97 * (1 + F.col("run_id") % 9)), "total_steps"
).select("run_id", "window", "slope_window", "min_history")
ORACLES["monitor_windows"] = f"""WITH {LOG_SQL},
big AS (SELECT run_id, greatest(128, greatest(96, floor(0.015::DOUBLE * total_steps * 97 * (1 + run_id % 9))))::INT AS win FROM runs)
SELECT run_id, win AS window, greatest(48, floor(0.75::DOUBLE * win))::INT AS slope_window, greatest(24, win // 3)::INT AS min_history FROM big"""

# The decision itself, row by row, on the signals of the entries below the cap.
STOP_SQL = f"""WITH RECURSIVE {LOG_SQL},
below AS (SELECT l.* FROM monitor_log l JOIN runs USING (run_id) WHERE l.step < hard_cap_steps),
{ENTRIES_SQL.format(log='below')}, {SIGNALS_SQL},
gates AS (
  SELECT s.*, s.step >= warmup_steps AND s.step::DOUBLE / total_steps >= 0.18::DOUBLE AS past, pos >= min_history AS enough,
         greatest(sigma, 0.22::DOUBLE) AS sig, slope >= 0.010::DOUBLE AS worsening
  FROM signals s JOIN widths USING (run_id)),
rates AS (SELECT *, max(CASE WHEN past THEN learning_rate END) OVER (PARTITION BY run_id ORDER BY pos) AS top FROM gates),
ready AS (SELECT *, learning_rate <= top * 0.60::DOUBLE + 1e-12::DOUBLE AS lr_ok FROM rates),
walk(run_id, pos, before, ref, stopped) AS (
  SELECT run_id, 0::BIGINT, ema, ema, false FROM ready WHERE pos = 1
  UNION ALL
  SELECT r.run_id, r.pos, w.ref,
    CASE WHEN NOT past OR (lr_ok AND NOT enough) THEN ema WHEN NOT lr_ok THEN w.ref
         WHEN w.ref - ema >= 0.04::DOUBLE OR (w.ref - ema) / (sig + 1e-12::DOUBLE) >= 0.5::DOUBLE THEN ema ELSE w.ref END,
    past AND lr_ok AND enough AND worsening AND NOT (w.ref - ema >= 0.04::DOUBLE OR (w.ref - ema) / (sig + 1e-12::DOUBLE) >= 0.5::DOUBLE)
  FROM walk w JOIN ready r ON r.run_id = w.run_id AND r.pos = w.pos + 1 WHERE NOT w.stopped)
"""


def early_stop(spark, sf):
    log = monitor_log(spark, sf)
    return m.early_stop(log, runs(log))


QUERIES["early_stop"] = early_stop
ORACLES["early_stop"] = f"""{STOP_SQL},
stops AS (SELECT w.run_id, r.step FROM walk w JOIN ready r USING (run_id, pos) WHERE stopped),
caps AS (SELECT run_id, min(l.step) AS cap FROM monitor_log l JOIN runs USING (run_id) WHERE l.step >= hard_cap_steps GROUP BY 1)
SELECT run_id, coalesce(s.step, cap) AS stop_step,
       CASE WHEN s.step IS NOT NULL THEN 'worsening' WHEN cap IS NOT NULL THEN 'hard_cap' END AS reason
FROM runs LEFT JOIN stops s USING (run_id) LEFT JOIN caps USING (run_id)"""


def monitor_trace(spark, sf):
    log = monitor_log(spark, sf)
    t = m.monitor_trace(log, runs(log))
    return t.select("run_id", "step", "since_best", "plateau", "worsening",
                    *[r6(c, c) for c in ("ema", "best", "abs_drop", "sigma_drop", "sigma", "slope")])


QUERIES["monitor_trace"] = monitor_trace
ORACLES["monitor_trace"] = f"""{STOP_SQL},
b AS (SELECT run_id, pos, min(ema) OVER (PARTITION BY run_id ORDER BY pos) AS best FROM ready),
f AS (SELECT run_id, best, min(pos) AS best_pos FROM b GROUP BY 1, 2)
SELECT r.run_id, r.step, r.pos - best_pos AS since_best, false AS plateau, worsening, {r6_sql('ema', 'ema')}, {r6_sql('best', 'best')},
  {r6_sql('(before - ema)', 'abs_drop')}, {r6_sql('((before - ema) / (sig + 1e-12::DOUBLE))', 'sigma_drop')},
  {r6_sql('sig', 'sigma')}, {r6_sql('slope', 'slope')}
FROM walk w JOIN ready r USING (run_id, pos) JOIN b USING (run_id, pos) JOIN f USING (run_id, best)
WHERE past AND lr_ok AND enough"""
