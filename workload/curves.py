"""Loss-curve analytics over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import curves as cv
from textloom.sources import logs
from workload.common import EVENT_LOG_SQL, event_log, r6, r6_sql

QUERIES, ORACLES = {}, {}


def _log_with_short_runs(spark, sf):
    log = event_log(spark, sf)
    short = F.col("step") <= F.col("run_id") % 9  # the head of each run becomes a run of its own
    return log.withColumn("run_id", F.when(short, F.col("run_id") + 1_000_000).otherwise(F.col("run_id"))).withColumn(
        "step", F.when(F.col("seq") % 6 > 0, F.col("step")))


def _rows(spark, sf):
    return cv.indexed(_log_with_short_runs(spark, sf))


ROWS_SQL = f"""
{EVENT_LOG_SQL},
curve_log AS (
  SELECT CASE WHEN step <= run_id % 9 THEN run_id + 1000000 ELSE run_id END AS run_id, seq,
         CASE WHEN seq % 6 > 0 THEN step END AS step, loss, epoch, learning_rate, grad_norm FROM event_log),
points AS (
  SELECT run_id, seq, coalesce(step, p) AS step, loss, epoch, learning_rate, grad_norm, p AS pos, n FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS p, count(*) OVER (PARTITION BY run_id) AS n FROM curve_log)),
widths AS (
  SELECT run_id, max(n) AS n, CASE WHEN max(n) >= 5 THEN least(greatest(5, max(n) // 20), 51) END AS live_k,
         CASE WHEN max(n) >= 7 THEN 7 ELSE greatest(3, max(n) // 3 * 2 + 1) END AS k, least(greatest(10, max(n) // 10), 200) AS win,
         list(loss ORDER BY pos) AS l FROM points GROUP BY 1),
smoothed AS (
  SELECT p.*, w.win, w.live_k,
    list_sum([l[greatest(1, least(p.n, p.pos - k // 2 + d))] for d in range(k)]) / k AS smoothed,
    CASE WHEN live_k IS NULL THEN loss ELSE list_sum([l[greatest(1, least(p.n, p.pos - live_k // 2 + d))] for d in range(live_k)]) / live_k END AS live_smoothed
  FROM points p JOIN widths w USING (run_id))
"""
_smooth = lambda spark, sf: cv.analysis_smooth(_rows(spark, sf))

QUERIES["smooth"] = lambda spark, sf: _smooth(spark, sf).select("run_id", "pos", r6("smoothed", "smoothed"))
ORACLES["smooth"] = f"WITH {ROWS_SQL} SELECT run_id, pos, {r6_sql('smoothed', 'smoothed')} FROM smoothed"
QUERIES["smooth_live"] = lambda spark, sf: cv.smooth(_rows(spark, sf), cv.live_width(F.col("n")), cv.MAX_LIVE_WIDTH).select(
    "run_id", "pos", r6("smoothed", "smoothed"))
ORACLES["smooth_live"] = f"WITH {ROWS_SQL} SELECT run_id, pos, {r6_sql('live_smoothed', 'smoothed')} FROM smoothed"

QUERIES["smooth_width"] = lambda spark, sf: event_log(spark, sf).select("run_id", "seq", F.col("seq").alias("n")).select(
    "run_id", "seq", cv.live_width(F.col("n")).alias("live"), cv.analysis_width(F.col("n")).alias("analysis"), cv.recent_width(F.col("n")).alias("recent"))
ORACLES["smooth_width"] = """SELECT user_id AS run_id, event_id AS seq, CASE WHEN event_id >= 5 THEN least(greatest(5, event_id // 20), 51) END AS live,
  CASE WHEN event_id >= 7 THEN 7 ELSE greatest(3, event_id // 3 * 2 + 1) END AS analysis, least(greatest(10, event_id // 10), 200) AS recent FROM events"""

QUERIES["live_summary"] = lambda spark, sf: cv.live_summary(_log_with_short_runs(spark, sf))
ORACLES["live_summary"] = f"""WITH {ROWS_SQL} SELECT run_id, last(step ORDER BY pos) AS step, last(loss ORDER BY pos) AS current, min(loss) AS best, count(*) AS entries
FROM points GROUP BY 1"""

QUERIES["loss_stats"] = lambda spark, sf: cv.loss_stats(_log_with_short_runs(spark, sf)).select(
    "run_id", "entries", *[r6(c, c) for c in ("mean", "median", "std", "max", "drop_abs", "drop_pct")])
STATS_SQL = """
stats AS (SELECT run_id, count(*) AS entries, avg(loss) AS mean, median(loss) AS median, stddev_pop(loss) AS std, max(loss) AS max,
  max(loss) - min(loss) AS drop_abs, 100 * (max(loss) - min(loss)) / greatest(max(loss), 1e-8::DOUBLE) AS drop_pct FROM points GROUP BY 1)
"""
ORACLES["loss_stats"] = f"WITH {ROWS_SQL}, {STATS_SQL} SELECT run_id, entries, " + ", ".join(
    r6_sql(c, c) for c in ("mean", "median", "std", "max", "drop_abs", "drop_pct")) + " FROM stats"

_three = lambda spark, sf: cv.analysis_smooth(_rows(spark, sf).where("n >= 3"))
QUERIES["global_slope"] = lambda spark, sf: cv.global_slope(_three(spark, sf)).select("run_id", r6("global_slope", "global_slope"))
SLOPES_SQL = """
gslope AS (SELECT run_id, CASE WHEN max(step) > min(step) THEN regr_slope(smoothed, step) * 100 END AS global_slope FROM smoothed WHERE n >= 3 GROUP BY 1),
tail AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos) - 1 AS j, least(win, n) AS m, max(step) OVER (PARTITION BY run_id) AS x0
         FROM smoothed WHERE pos > n - win AND n >= 3),
weighted AS (SELECT run_id, pow(0.5::DOUBLE + 0.5::DOUBLE * j / greatest(m - 1, 1), 2) AS w, (step - x0)::DOUBLE AS x, smoothed AS y FROM tail),
centres AS (SELECT run_id, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM weighted GROUP BY 1),
rslope AS (SELECT run_id, sum(w * (x - mx) * (y - my)) / nullif(sum(w * (x - mx) * (x - mx)), 0) AS raw FROM weighted JOIN centres USING (run_id) GROUP BY 1),
spread AS (SELECT run_id, median(smoothed) AS med, stddev_pop(smoothed) AS sd FROM tail GROUP BY 1),
mads AS (SELECT run_id, 1.4826::DOUBLE * median(abs(smoothed - med)) AS mad, any_value(sd) AS sd FROM tail JOIN spread USING (run_id) GROUP BY 1),
recent AS (SELECT run_id, raw, raw * 100 AS recent_slope, sd, CASE WHEN mad > 1e-8::DOUBLE THEN mad ELSE sd END AS noise,
           abs(raw) / (CASE WHEN mad > 1e-8::DOUBLE THEN mad ELSE sd END + 1e-8::DOUBLE) AS snr FROM rslope JOIN mads USING (run_id))
"""
ORACLES["global_slope"] = f"WITH {ROWS_SQL}, {SLOPES_SQL} SELECT run_id, {r6_sql('global_slope', 'global_slope')} FROM gslope"
QUERIES["recent_slope"] = lambda spark, sf: cv.recent(_three(spark, sf)).select("run_id", r6("recent_slope", "recent_slope"))
ORACLES["recent_slope"] = f"WITH {ROWS_SQL}, {SLOPES_SQL} SELECT run_id, {r6_sql('recent_slope', 'recent_slope')} FROM recent"
QUERIES["noise_snr"] = lambda spark, sf: cv.recent(_three(spark, sf)).select("run_id", r6("noise", "noise"), r6("recent_std", "recent_std"), r6("snr", "snr"))
ORACLES["noise_snr"] = f"WITH {ROWS_SQL}, {SLOPES_SQL} SELECT run_id, {r6_sql('noise', 'noise')}, {r6_sql('sd', 'recent_std')}, {r6_sql('snr', 'snr')} FROM recent"

BEST_SQL = "best AS (SELECT run_id, min(loss) AS best, first(step ORDER BY loss, pos) AS best_step, max(n) - first(pos ORDER BY loss, pos) AS since_best FROM points GROUP BY 1)"
QUERIES["best_since_entry"] = lambda spark, sf: cv.best_entry(_rows(spark, sf))
ORACLES["best_since_entry"] = f"WITH {ROWS_SQL}, {BEST_SQL} SELECT * FROM best"

_grid = lambda spark, sf: event_log(spark, sf).withColumn("slope", F.col("learning_rate") * 1e5 - 7 + F.col("grad_norm") / 4)
_GRID_SQL = f"WITH {EVENT_LOG_SQL}, g AS (SELECT *, learning_rate * 1e5::DOUBLE - 7 + grad_norm / 4 AS slope FROM event_log)"
QUERIES["forecast"] = lambda spark, sf: _grid(spark, sf).select(
    "run_id", "seq", cv.steps_to_target(F.col("loss"), F.col("loss") * 0.9 - 0.2, F.col("slope") / 300).alias("more_steps"))
ORACLES["forecast"] = f"""{_GRID_SQL} SELECT run_id, seq, CASE WHEN slope / 300 < -1e-6::DOUBLE
  THEN greatest(0, trunc((loss - (loss * 0.9::DOUBLE - 0.2::DOUBLE + 0.05::DOUBLE)) / -(slope / 300)))::BIGINT END AS more_steps FROM g"""
QUERIES["exposure_pct"] = lambda spark, sf: event_log(spark, sf).select("run_id", "seq", cv.exposure_pct(F.col("epoch")).alias("exposure"))
ORACLES["exposure_pct"] = f"WITH {EVENT_LOG_SQL} SELECT run_id, seq, round(CASE WHEN epoch >= 1 THEN epoch - floor(epoch) ELSE epoch END * 100, 2) AS exposure FROM event_log"


def _grade_sql(slope, snr, exposure):
    return f"""CASE WHEN {slope} <= -3 THEN 4 WHEN {slope} <= -1.5 THEN 3 WHEN {slope} <= -0.5 THEN 2 WHEN {slope} <= -0.1::DOUBLE THEN 1 ELSE 0 END
  + CASE WHEN {snr} >= 3 THEN 3 WHEN {snr} >= 2 THEN 2 WHEN {snr} >= 1.2::DOUBLE THEN 1 ELSE 0 END
  + CASE WHEN {exposure} >= 36 THEN 2 WHEN {exposure} >= 18 THEN 1 ELSE 0 END"""


def _letter_sql(points):
    return f"CASE WHEN {points} >= 8 THEN 'A' WHEN {points} >= 6 THEN 'B' WHEN {points} >= 4 THEN 'C' ELSE 'D' END"


def _label_sql(x):
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= -3 THEN 'Strong Drop' WHEN {x} <= -1 THEN 'Moderate Drop' WHEN {x} < -0.1::DOUBLE THEN 'Weak Drop'
  WHEN {x} <= 0.1::DOUBLE THEN 'Flat' WHEN {x} < 1 THEN 'Weak Rise' WHEN {x} < 3 THEN 'Moderate Rise' ELSE 'Strong Rise' END"""


QUERIES["grade"] = lambda spark, sf: _grid(spark, sf).select(
    "run_id", "seq", cv.grade(F.col("slope") / 2, F.col("grad_norm") / 3, F.col("epoch") * 30).alias("grade"))
ORACLES["grade"] = f"{_GRID_SQL}, p AS (SELECT run_id, seq, {_grade_sql('slope / 2', 'grad_norm / 3', 'epoch * 30')} AS points FROM g) SELECT run_id, seq, {_letter_sql('points')} AS grade FROM p"
QUERIES["trend_label"] = lambda spark, sf: _grid(spark, sf).select("run_id", "seq", cv.trend_label(F.col("slope")).alias("label"))
ORACLES["trend_label"] = f"{_GRID_SQL} SELECT run_id, seq, {_label_sql('slope')} AS label FROM g"

QUERIES["outliers"] = lambda spark, sf: cv.outliers(_three(spark, sf)).select("run_id", "step", "pos", "loss", r6("smoothed", "smoothed"))
ORACLES["outliers"] = f"""WITH {ROWS_SQL}, {SLOPES_SQL}
SELECT run_id, step, pos, loss, {r6_sql('smoothed', 'smoothed')} FROM tail JOIN spread USING (run_id)
WHERE pos > 1 AND n > 1 AND sd > 0 AND abs(loss - smoothed) > sd * 1.5"""
QUERIES["epoch_ticks"] = lambda spark, sf: cv.epoch_ticks(_rows(spark, sf)).select("run_id", "step", "pos")
ORACLES["epoch_ticks"] = f"""WITH {ROWS_SQL}, h AS (SELECT *, floor(epoch * 100) AS h, lag(floor(epoch * 100)) OVER (PARTITION BY run_id ORDER BY pos) AS b FROM points)
SELECT run_id, step, pos FROM h WHERE b <> h"""


def analysis(spark, sf):
    a = cv.analysis(_log_with_short_runs(spark, sf))
    exact = ["run_id", "entries", "best_step", "since_best", "global_trend", "recent_trend", "exposure", "grade", "more_steps", "target_step"]
    return a.select(*exact, *[r6(c, c) for c in a.columns if c not in exact])


QUERIES["analysis"] = analysis
ORACLES["analysis"] = f"""WITH {ROWS_SQL}, {STATS_SQL}, {SLOPES_SQL}, {BEST_SQL},
ends AS (SELECT run_id, last(step ORDER BY pos) AS last_step, last(loss ORDER BY pos) AS last_loss, last(epoch ORDER BY pos) AS e FROM points GROUP BY 1),
j AS (SELECT *, round(CASE WHEN e >= 1 THEN e - floor(e) ELSE e END * 100, 2) AS exposure,
      CASE WHEN raw < -1e-6::DOUBLE THEN greatest(0, trunc((last_loss - (best + 0.05::DOUBLE)) / -raw))::BIGINT END AS more_steps
      FROM stats JOIN gslope USING (run_id) JOIN recent USING (run_id) JOIN best USING (run_id) JOIN ends USING (run_id)),
g AS (SELECT *, {_grade_sql('recent_slope', 'snr', 'exposure')} AS points FROM j)
SELECT run_id, entries, best_step, since_best, {_label_sql('global_slope')} AS global_trend, {_label_sql('recent_slope')} AS recent_trend,
  exposure, {_letter_sql('points')} AS grade, more_steps, last_step + more_steps AS target_step,
  {', '.join(r6_sql(c, c) for c in ('mean', 'median', 'std', 'max', 'best', 'drop_abs', 'drop_pct', 'global_slope', 'recent_slope', 'noise', 'snr'))} FROM g"""

QUERIES["log_rows"] = lambda spark, sf: logs.display_rows(_rows(spark, sf))
ORACLES["log_rows"] = f"""WITH {ROWS_SQL},
f AS (SELECT run_id, pos, step, printf('%.4f', loss) AS l, CASE WHEN learning_rate > 0 THEN printf('%.2e', learning_rate) ELSE '0' END AS r,
      printf('%.3f', grad_norm) AS g, printf('%.2f', epoch) AS e FROM points)
SELECT run_id, pos, '  step ' || rpad(step::VARCHAR, 6, ' ') || '  loss ' || rpad(l, greatest(8, length(l))::INT, ' ') || '  lr ' || rpad(r, 10, ' ')
  || '  gnorm ' || rpad(g, greatest(8, length(g))::INT, ' ') || '  ep ' || e AS line FROM f"""
