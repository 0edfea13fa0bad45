"""Loss-curve analytics per run: smoothing, slopes, noise, grade, forecast.

Log columns: run_id, seq, step, loss, epoch. `indexed` adds pos and n; the other functions take
indexed rows. Sums, extremes and regressions aggregate partially on the map side. Only the recent
stretch of a run, 200 rows at most, is gathered per run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textloom.functions.numbers import round_exact
from textloom.operators.scans import BROADCAST_RUNS, CHUNK, exact_median, index_rows, median_bracket, neighbours, whole_groups, with_halo
from textloom.session import staged

MAX_RECENT = 200
MAX_LIVE_WIDTH = 51
MAD_SCALE = 1.4826


def indexed(log: DataFrame) -> DataFrame:
    """Entries with a loss, numbered per run by `seq`; a missing step becomes the position."""
    rows = index_rows(log.where(F.col("loss").isNotNull()), "run_id", "seq")
    return rows.withColumn("step", F.coalesce("step", "pos"))


def live_width(n: Column) -> Column:
    """Smoothing width of the live chart; null when the run is too short to smooth."""
    wide = F.least(F.greatest(F.lit(5), F.floor(n / 20)), F.lit(MAX_LIVE_WIDTH))
    return F.when(n >= 5, wide).cast("int")


def analysis_width(n: Column) -> Column:
    return F.when(n >= 7, F.lit(7)).otherwise(F.greatest(F.lit(3), F.floor(n / 3) * 2 + 1)).cast("int")


def recent_width(n: Column) -> Column:
    return F.least(F.greatest(F.lit(10), F.floor(n / 10)), F.lit(MAX_RECENT)).cast("int")


def _window_sums(x: np.ndarray, first: np.ndarray, last: np.ndarray, most: int) -> np.ndarray:
    """Sums of x[first] to x[last], windows of at most `most` values.

    Running sums begin anew with every block of `most`, so a window lies in two of them at most and no sum is
    long enough to lose digits. What is not finite is counted apart.
    """
    finite = np.isfinite(x)
    y = np.zeros(-(-len(x) // most) * most)
    y[:len(x)] = np.where(finite, x, 0.0)
    upto = np.cumsum(y.reshape(-1, most), axis=1)
    before = (upto - y.reshape(-1, most)).ravel()
    whole, upto = upto[:, -1], upto.ravel()
    total = upto[last] - before[first] + np.where(first // most == last // most, 0.0, whole[first // most])
    if finite.all():
        return total
    seen = lambda test: (lambda c: c[last + 1] - c[first] > 0)(np.concatenate([[0], np.cumsum(test)]))
    high, low, none = seen(x == np.inf), seen(x == -np.inf), seen(np.isnan(x))
    total = np.where(high, np.inf, np.where(low, -np.inf, total))
    return np.where(none | (high & low), np.nan, total)


def smooth(rows: DataFrame, width: Column, max_width: int, length: int = CHUNK) -> DataFrame:
    """Add `smoothed`: centred moving mean, end values repeated beyond both ends.

    `width` may differ between runs and is at most `max_width`; null leaves the loss as it is.
    """
    half, names, keys = max_width // 2, rows.columns, ["run_id", "_chunk"]
    near = with_halo(rows.withColumn("_k", width.cast("int")), half, half, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            home = np.flatnonzero(table["_home"].to_numpy())
            x = table["loss"].cast(pa.float64()).to_numpy(zero_copy_only=False)
            k = table["_k"].to_numpy(zero_copy_only=False)[home].astype(np.float64)
            pos, n = table["pos"].to_numpy()[home], table["n"].to_numpy()[home]
            kept = np.isnan(k)
            k = np.where(kept, 1, k).astype(np.int64)
            ahead, behind = k // 2, k - 1 - k // 2
            first, last = np.maximum(pos - ahead, 1), np.minimum(pos + behind, n)
            a, z = home + first - pos, home + last - pos  # positions of a chunk follow one another
            total = _window_sums(x, a, z, max_width)
            with np.errstate(invalid="ignore"):
                left, right = first - (pos - ahead), pos + behind - last
                total += np.where(left > 0, left * x[a], 0.0) + np.where(right > 0, right * x[z], 0.0)
            out = table.select(names).take(pa.array(home)).append_column("smoothed", pa.array(np.where(kept, x[home], total / k)))
            yield from out.combine_chunks().to_batches()

    schema = StructType([*rows.schema.fields, StructField("smoothed", DoubleType())])
    return near.repartition(*keys).sortWithinPartitions(*keys, "pos").mapInArrow(run, schema)


def analysis_smooth(rows: DataFrame) -> DataFrame:
    return smooth(rows, analysis_width(F.col("n")), 7)


def live_summary(log: DataFrame) -> DataFrame:
    """Step and loss of the latest entry, and the best loss; plain aggregates, so it streams too."""
    return log.where(F.col("loss").isNotNull()).groupBy("run_id").agg(
        F.coalesce(F.max_by("step", "seq"), F.count(F.lit(1))).alias("step"),
        F.max_by("loss", "seq").alias("current"),
        F.min("loss").alias("best"),
        F.count(F.lit(1)).alias("entries"),
    )


def loss_stats(log: DataFrame) -> DataFrame:
    rows = log.where(F.col("loss").isNotNull())
    out = staged(rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.avg("loss").alias("mean"),
        F.stddev_pop("loss").alias("std"),
        F.max("loss").alias("max"),
        (F.max("loss") - F.min("loss")).alias("drop_abs"),
        median_bracket(F.col("loss").cast("double")).alias("_bracket"),
    ), "loss-stats")
    median = exact_median(rows, "run_id", "loss", brackets=out.select("run_id", "_bracket"))
    out = out.withColumn("drop_pct", 100 * F.col("drop_abs") / F.greatest("max", F.lit(1e-8))).drop("_bracket")
    return out.join(median, "run_id")


def global_slope(smoothed: DataFrame) -> DataFrame:
    """Least-squares slope of the smoothed loss on the step, per 100 steps."""
    return smoothed.groupBy("run_id").agg((F.regr_slope("smoothed", "step") * 100).alias("global_slope"))


def _recent_rows() -> Column:
    recent = F.col("pos") > F.col("n") - recent_width(F.col("n"))
    point = F.struct("pos", F.col("step").cast("double").alias("step"),
                     F.col("loss").cast("double").alias("loss"), "smoothed")
    return F.array_sort(F.collect_list(F.when(recent, point)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _mean(values: Column) -> Column:
    return _sum(values) / F.size(values)


def _median(values: Column) -> Column:
    s = F.array_sort(values)
    m = F.size(values)
    low, high = F.floor((m + 1) / 2).cast("int"), (F.floor(m / 2) + 1).cast("int")
    return (F.element_at(s, low) + F.element_at(s, high)) / 2


def _weighted_slope(df: DataFrame, points: str) -> DataFrame:
    """Add `recent_raw`: slope over `points`, residual weights rising from 0.5 to 1.

    The weights apply to residuals, so the squares of them enter the fit. Steps count from the
    last one to keep the sums small. Null if all steps are equal.
    """
    p = F.col(points)
    m = F.size(p)
    weighted = F.transform(p, lambda r, i: F.struct(
        F.pow(F.when(m > 1, 0.5 + 0.5 * i / (m - 1)).otherwise(F.lit(0.5)), F.lit(2.0)).alias("w"),
        (r["step"] - F.element_at(p, -1)["step"]).alias("x"),
        (r["smoothed"] - F.element_at(p, -1)["smoothed"]).alias("y"),
    ))
    df = df.withColumn("_wp", weighted)
    wp = F.col("_wp")
    df = df.withColumn("_sw", _sum(F.transform(wp, lambda r: r["w"])))
    df = df.withColumn("_mx", _sum(F.transform(wp, lambda r: r["w"] * r["x"])) / F.col("_sw"))
    df = df.withColumn("_my", _sum(F.transform(wp, lambda r: r["w"] * r["y"])) / F.col("_sw"))
    sxy = _sum(F.transform(wp, lambda r: r["w"] * (r["x"] - F.col("_mx")) * (r["y"] - F.col("_my"))))
    sxx = _sum(F.transform(wp, lambda r: r["w"] * (r["x"] - F.col("_mx")) * (r["x"] - F.col("_mx"))))
    return df.withColumn("recent_raw", F.try_divide(sxy, sxx)).drop("_wp", "_sw", "_mx", "_my")


def _noise(df: DataFrame, points: str) -> DataFrame:
    """Add `noise` (robust spread of the recent smoothed loss) and `recent_std`."""
    df = df.withColumn("_ys", F.transform(points, lambda r: r["smoothed"]))
    df = df.withColumn("_med", _median(F.col("_ys"))).withColumn("_avg", _mean(F.col("_ys")))
    spread = _mean(F.transform("_ys", lambda y: (y - F.col("_avg")) * (y - F.col("_avg"))))
    df = df.withColumn("recent_std", F.sqrt(spread))
    df = df.withColumn("_mad", MAD_SCALE * _median(F.transform("_ys", lambda y: F.abs(y - F.col("_med")))))
    noise = F.when(F.col("_mad") > 1e-8, F.col("_mad")).otherwise(F.col("recent_std"))
    return df.withColumn("noise", noise).drop("_ys", "_med", "_avg", "_mad")


def recent(smoothed: DataFrame) -> DataFrame:
    """Per run: recent_raw (slope), recent_slope (per 100 steps), noise, recent_std, snr."""
    df = smoothed.groupBy("run_id").agg(_recent_rows().alias("_points"))
    return _with_recent(df).drop("_points")


def _with_recent(df: DataFrame) -> DataFrame:
    df = _noise(_weighted_slope(df, "_points"), "_points")
    return (df.withColumn("recent_slope", F.col("recent_raw") * 100)
            .withColumn("snr", F.abs("recent_raw") / (F.col("noise") + 1e-8)))


def _best() -> Column:
    return F.min(F.struct("loss", "pos", "step"))


def best_entry(rows: DataFrame) -> DataFrame:
    """Best loss (the first if tied), its step, and the entries after it."""
    return rows.groupBy("run_id").agg(_best().alias("_b"), F.count(F.lit(1)).alias("_n")).select(
        "run_id", F.col("_b.loss").alias("best"), F.col("_b.step").alias("best_step"),
        (F.col("_n") - F.col("_b.pos")).alias("since_best"))


def steps_to_target(last: Column, best: Column, slope: Column) -> Column:
    """Steps until the loss reaches best + 0.05 at the recent slope; null unless it is falling."""
    more = F.floor((last - (best + 0.05)) / -slope)
    return F.when(slope < -1e-6, F.greatest(F.lit(0), more)).cast("bigint")


def exposure_pct(epoch: Column) -> Column:
    return round_exact(F.when(epoch >= 1, epoch - F.floor(epoch)).otherwise(epoch) * 100, 2)


# (upper limit of the slope, points), (lower limit, points), (lower limit, points): fixed values
SLOPE_POINTS = [(-3.0, 4), (-1.5, 3), (-0.5, 2), (-0.1, 1)]
SNR_POINTS = [(3.0, 3), (2.0, 2), (1.2, 1)]
EXPOSURE_POINTS = [(36, 2), (18, 1)]
GRADES = [(8, "A"), (6, "B"), (4, "C")]


def _banded(bands: list, test, default) -> Column:
    out = F.lit(default)
    for limit, value in reversed(bands):
        out = F.when(test(limit), F.lit(value)).otherwise(out)
    return out


def grade(slope: Column, snr: Column, exposure: Column) -> Column:
    points = (_banded(SLOPE_POINTS, lambda v: slope <= v, 0)
              + _banded(SNR_POINTS, lambda v: snr >= v, 0)
              + _banded(EXPOSURE_POINTS, lambda v: exposure >= v, 0))
    return _banded(GRADES, lambda v: points >= v, "D")


def trend_label(slope: Column) -> Column:
    return (
        F.when(slope.isNull(), None).when(slope <= -3.0, "Strong Drop").when(slope <= -1.0, "Moderate Drop")
        .when(slope < -0.1, "Weak Drop").when(F.abs(slope) <= 0.1, "Flat")
        .when(slope < 1.0, "Weak Rise").when(slope < 3.0, "Moderate Rise")
        .otherwise("Strong Rise")
    )


def outliers(smoothed: DataFrame) -> DataFrame:
    """Recent entries further than 1.5 recent standard deviations from the smoothed loss."""
    spread = staged(recent(smoothed).select("run_id", "recent_std"), "spread")
    few = F.broadcast(spread) if spread.count() <= BROADCAST_RUNS else spread
    return smoothed.join(few, "run_id").where(
        (F.col("pos") > F.col("n") - recent_width(F.col("n"))) & (F.col("pos") > 1)
        & (F.col("n") > 1) & (F.col("recent_std") > 0)
        & (F.abs(F.col("loss") - F.col("smoothed")) > F.col("recent_std") * 1.5))


def epoch_ticks(rows: DataFrame) -> DataFrame:
    """Entries at which the epoch passes a hundredth."""
    hundredth = F.floor(F.coalesce("epoch", F.lit(0.0)) * 100).cast("bigint")
    out = neighbours(rows.withColumn("_h", hundredth), "run_id", {"_before": ("_h", -1)})
    return out.where(F.col("_before") != F.col("_h")).drop("_h", "_before")


def analysis(log: DataFrame) -> DataFrame:
    """One row per run with at least three entries: statistics, slopes, grade, forecast."""
    rows = indexed(log).where(F.col("n") >= 3)
    runs = staged(analysis_smooth(rows).groupBy("run_id").agg(
        median_bracket(F.col("loss").cast("double")).alias("_bracket"),
        F.count(F.lit(1)).alias("entries"),
        F.avg("loss").alias("mean"),
        F.stddev_pop("loss").alias("std"),
        F.max("loss").alias("max"),
        _best().alias("_best"),
        F.max_by(F.struct("step", "loss", "epoch"), "pos").alias("_last"),
        (F.regr_slope("smoothed", "step") * 100).alias("global_slope"),
        _recent_rows().alias("_points"),
    ), "analysis")
    median = exact_median(log, "run_id", "loss", brackets=runs.select("run_id", "_bracket"))
    runs = _with_recent(runs)
    best, last = F.col("_best.loss"), F.col("_last.loss")
    drop = F.col("max") - best
    more = steps_to_target(last, best, F.col("recent_raw"))
    runs = runs.withColumn("exposure", exposure_pct(F.coalesce("_last.epoch", F.lit(0.0))))
    return runs.join(median, "run_id").select(
        "run_id", "entries", "mean", "median", "std", "max",
        best.alias("best"), F.col("_best.step").alias("best_step"),
        (F.col("entries") - F.col("_best.pos")).alias("since_best"),
        drop.alias("drop_abs"), (100 * drop / F.greatest("max", F.lit(1e-8))).alias("drop_pct"),
        "global_slope", "recent_slope", "noise", "snr",
        trend_label(F.col("global_slope")).alias("global_trend"),
        trend_label(F.col("recent_slope")).alias("recent_trend"),
        "exposure",
        grade(F.col("recent_slope"), F.col("snr"), F.col("exposure")).alias("grade"),
        more.alias("more_steps"), (F.col("_last.step") + more).alias("target_step"),
    )
