"""Run report over the event log, with evaluation and summary entries among the losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import report as rep
from textloom.session import scratch_path
from textloom.sources.tables import write_reports
from workload.common import EVENT_LOG_SQL, event_log, r6, r6_sql

QUERIES, ORACLES = {}, {}


def report_log(spark, sf):
    log = event_log(spark, sf)
    kind, value = F.col("event_type"), F.col("loss")
    return log.select(
        "run_id", "seq", F.when(F.col("seq") % 5 > 0, F.col("step")).alias("step"),
        F.when(~kind.isin("view", "purchase"), value).alias("loss"),
        F.when(kind == "view", value).alias("eval_loss"),
        F.when((kind == "view") & (F.col("run_id") % 3 > 0), value * 3).alias("eval_runtime"),
        F.when(kind == "view", value * 2 + 1).alias("eval_perplexity"),
        F.when(kind == "purchase", value * 10).alias("train_runtime"),
        F.when((kind == "purchase") & (F.col("run_id") % 2 == 0), value * 2).alias("train_samples_per_second"),
        F.when(kind == "purchase", value / 4).alias("train_steps_per_second"), "epoch")


LOG_SQL = f"""
{EVENT_LOG_SQL},
report_log AS (
  SELECT run_id, seq, CASE WHEN seq % 5 > 0 THEN step END AS step,
    CASE WHEN event_type NOT IN ('view', 'purchase') THEN loss END AS loss, CASE WHEN event_type = 'view' THEN loss END AS eval_loss,
    CASE WHEN event_type = 'view' AND run_id % 3 > 0 THEN loss * 3 END AS eval_runtime, CASE WHEN event_type = 'view' THEN loss * 2 + 1 END AS eval_perplexity,
    CASE WHEN event_type = 'purchase' THEN loss * 10 END AS train_runtime,
    CASE WHEN event_type = 'purchase' AND run_id % 2 = 0 THEN loss * 2 END AS sps,
    CASE WHEN event_type = 'purchase' THEN loss / 4 END AS stps, epoch FROM event_log),
train AS (
  SELECT run_id, seq, loss, coalesce(step, pos) AS step, pos, n FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS pos, count(*) OVER (PARTITION BY run_id) AS n
    FROM report_log WHERE loss IS NOT NULL AND eval_loss IS NULL))
"""
_entries = lambda spark, sf: rep.train_entries(report_log(spark, sf))

QUERIES["train_entries"] = lambda spark, sf: _entries(spark, sf).select("run_id", "seq", "step", "loss", "pos", "n")
ORACLES["train_entries"] = f"WITH {LOG_SQL} SELECT run_id, seq, step, loss, pos, n FROM train"

QUERIES["loss_summary"] = lambda spark, sf: rep.loss_summary(_entries(spark, sf)).withColumn(
    "delta_first_to_final", F.round(F.col("delta_first_to_final") + 1e-9, 6))
SUMMARY_SQL = """
summary AS (
  SELECT run_id, count(*) AS entries, first(loss ORDER BY pos) AS "first", last(loss ORDER BY pos) AS final, min(loss) AS best,
         first(step ORDER BY loss, pos) AS best_step, max(loss) AS worst FROM train GROUP BY 1)
"""
ORACLES["loss_summary"] = f"""WITH {LOG_SQL}, {SUMMARY_SQL} SELECT *, {r6_sql('(final - "first")', 'delta_first_to_final')} FROM summary"""

QUERIES["head_tail_trend"] = lambda spark, sf: rep.head_tail(_entries(spark, sf)).select(
    "run_id", r6("avg_first_20pct", "avg_first_20pct"), r6("avg_last_10pct", "avg_last_10pct"),
    r6("trend_delta", "trend_delta"), "trend")
HEAD_SQL = """
head AS (SELECT run_id, avg(loss) AS head FROM train WHERE pos <= greatest(1, n // 5) GROUP BY 1),
tail AS (SELECT run_id, avg(loss) AS tail FROM train WHERE pos > n - greatest(1, n // 10) GROUP BY 1),
trends AS (SELECT run_id, head, tail, tail - head AS d,
  CASE WHEN tail - head < -0.02 THEN 'improving  ' WHEN tail - head > 0.02 THEN 'worsening  ' ELSE 'plateau    ' END
  || '(' || CASE WHEN tail - head >= 0 THEN '+' ELSE '-' END || printf('%.4f', abs(tail - head)) || ' vs first 20%)' AS trend
  FROM head JOIN tail USING (run_id))
"""
ORACLES["head_tail_trend"] = f"""WITH {LOG_SQL}, {HEAD_SQL}
SELECT run_id, {r6_sql('head', 'avg_first_20pct')}, {r6_sql('tail', 'avg_last_10pct')}, {r6_sql('d', 'trend_delta')}, trend FROM trends"""

QUERIES["throughput"] = lambda spark, sf: rep.throughput(report_log(spark, sf))
THROUGHPUT_SQL = """
rates AS (SELECT run_id, coalesce(last(train_runtime ORDER BY seq) FILTER (train_runtime IS NOT NULL), 0) AS train_runtime,
  coalesce(last(sps ORDER BY seq) FILTER (sps IS NOT NULL), 0) AS samples_per_sec,
  coalesce(last(stps ORDER BY seq) FILTER (stps IS NOT NULL), 0) AS steps_per_sec FROM report_log GROUP BY 1)
"""
ORACLES["throughput"] = f"WITH {LOG_SQL}, {THROUGHPUT_SQL} SELECT * FROM rates"

QUERIES["exposure_totals"] = lambda spark, sf: rep.exposure_totals(report_log(spark, sf), 2, 8)
EXPOSURE_SQL = """
exposure AS (SELECT run_id, coalesce(max(step), 0)::BIGINT AS total_steps, 16::BIGINT AS effective_batch,
  coalesce(max(step), 0)::BIGINT * 16 AS samples_seen, last(epoch ORDER BY seq) AS epochs_completed FROM report_log GROUP BY 1)
"""
ORACLES["exposure_totals"] = f"WITH {LOG_SQL}, {EXPOSURE_SQL} SELECT * FROM exposure"

QUERIES["eval_list"] = lambda spark, sf: rep.eval_entries(report_log(spark, sf))
ORACLES["eval_list"] = f"WITH {LOG_SQL} SELECT run_id, seq, step, eval_loss, eval_runtime, eval_perplexity FROM report_log WHERE eval_loss IS NOT NULL"

QUERIES["sparkline"] = lambda spark, sf: rep.sparkline(_long(spark, sf))


def _long(spark, sf):
    return rep.train_entries(event_log(spark, sf).withColumn("eval_loss", F.lit(None).cast("double")))


ORACLES["sparkline"] = f"""WITH {EVENT_LOG_SQL},
runs AS (SELECT run_id, list(loss ORDER BY seq) AS l FROM event_log GROUP BY 1),
picked AS (SELECT run_id, len(l) AS entries,
  CASE WHEN len(l) > 48 THEN [l[floor(i * (len(l) / 48::DOUBLE))::INT + 1] for i in range(48)] ELSE l END AS s FROM runs),
bounds AS (SELECT *, list_min(s) AS lo, CASE WHEN list_max(s) > list_min(s) THEN list_max(s) - list_min(s) ELSE 1 END AS span FROM picked)
SELECT run_id, entries, array_to_string([('▁▂▃▄▅▆▇█')[floor((v - lo) / span * 7)::INT + 1] for v in s], '') AS sparkline FROM bounds"""

QUERIES["duration"] = lambda spark, sf: event_log(spark, sf).select(
    "run_id", "seq", rep.duration_text(F.col("loss") * F.col("seq") - 5).alias("duration"))
ORACLES["duration"] = f"""WITH {EVENT_LOG_SQL},
s AS (SELECT run_id, seq, greatest(0, trunc(loss * seq - 5)::BIGINT) AS s FROM event_log)
SELECT run_id, seq, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || lpad((s % 60)::VARCHAR, 2, '0') || 's'
  ELSE (s // 3600) || 'h ' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm ' || lpad((s % 60)::VARCHAR, 2, '0') || 's' END AS duration FROM s"""


def run_report(spark, sf):
    return rep.run_report(report_log(spark, sf), 2, 1000, 2, 8)


def _flat_report(df):
    r, loss = F.col("report"), F.col("report.loss")
    return df.select(
        "run_id", *[r[c].alias(c) for c in ("total_steps", "epochs_planned", "dataset_size", "effective_batch", "samples_seen",
                                                    "training_time_sec", "samples_per_sec")],
        *[loss[c].alias(f"loss_{c}") for c in ("first", "final", "best", "best_step", "worst", "trend")],
        r6(r["epochs_completed"], "epochs"), r6(loss["avg_last_10pct"], "avg_last"), r6(loss["delta_first_to_final"], "delta"),
        F.array_join(F.transform(r["eval"], lambda e: F.concat(
            F.coalesce(e["step"].cast("string"), F.lit("-")), F.lit("="), F.round(e["eval_loss"] * 1000).cast("bigint"), F.lit("/"),
            F.coalesce(F.round(e["eval_runtime"] * 1000).cast("bigint").cast("string"), F.lit("-")), F.lit("/"),
            F.round(e["eval_perplexity"] * 1000).cast("bigint"))), ",").alias("evals"))


REPORT_SQL = f"""WITH {LOG_SQL}, {SUMMARY_SQL}, {HEAD_SQL}, {THROUGHPUT_SQL}, {EXPOSURE_SQL},
parts AS (SELECT run_id, string_agg(coalesce(step::VARCHAR, '-') || '=' || round(eval_loss * 1000)::BIGINT || '/' ||
    coalesce(round(eval_runtime * 1000)::BIGINT::VARCHAR, '-') || '/' || round(eval_perplexity * 1000)::BIGINT, ',' ORDER BY seq) AS evals
  FROM report_log WHERE eval_loss IS NOT NULL GROUP BY 1)
SELECT run_id, total_steps, 2 AS epochs_planned, 1000 AS dataset_size, effective_batch, samples_seen,
  round(train_runtime, 2) AS training_time_sec, round(samples_per_sec, 4) AS samples_per_sec,
  round("first", 6) AS loss_first, round(final, 6) AS loss_final, round(best, 6) AS loss_best, best_step AS loss_best_step,
  round(worst, 6) AS loss_worst, coalesce(trend, 'n/a') AS loss_trend, {r6_sql('round(epochs_completed, 4)', 'epochs')},
  {r6_sql('round(tail, 6)', 'avg_last')}, {r6_sql('round(final - "first", 6)', 'delta')}, coalesce(evals, '') AS evals
FROM exposure JOIN rates USING (run_id) LEFT JOIN summary USING (run_id) LEFT JOIN trends USING (run_id) LEFT JOIN parts USING (run_id)"""
QUERIES["run_report"] = lambda spark, sf: _flat_report(run_report(spark, sf))
ORACLES["run_report"] = REPORT_SQL


def report_json(spark, sf):
    """The report written as JSON and read back."""
    reports = run_report(spark, sf)
    path = scratch_path(spark, "reports")
    write_reports(reports, path)
    return _flat_report(spark.read.schema(reports.schema).json(path))


QUERIES["report_json"] = report_json
ORACLES["report_json"] = REPORT_SQL
