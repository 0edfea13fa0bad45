"""The parallel early stop against the rule row by row, on many kinds of runs."""

import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.operators import monitor as m
from textloom.operators.falls import Falls, leave
from textloom.streaming import live


def make_log(seed=5, runs=40):
    rng = np.random.default_rng(seed)
    rows = []
    for run in range(runs):
        n = int(rng.integers(3, 420))
        kind = run % 8
        x = np.arange(n)
        base = {0: 5 - x / n * 4, 1: 2 + 0 * x, 2: 2 + x / n * 3, 3: 5 * np.exp(-x / 40), 4: 3 + np.sin(x / 25),
                5: np.abs(x - n / 2) / 30, 6: 4 - np.floor(x / 30) * 0.05, 7: 3 + np.cumsum(rng.normal(size=n)) / 5}[kind]
        noise = rng.normal(size=n) * [0, 0.01, 0.3][run % 3]
        seq = 0
        for i in range(n):
            for _ in range(2 if rng.random() < 0.05 else 1):  # a repeated step
                seq += 1
                loss = None if rng.random() < 0.03 else float(base[i] + noise[i])
                lr = None if run % 5 == 4 else float(1e-4 * (1 - i / n) * (1 + 0.3 * rng.random()))
                rows.append((run, seq, i + 1, loss, lr))
    return rows


SETTINGS = [
    m.MonitorSettings(),
    m.MonitorSettings(lr_fraction=1.0, exposure_floor=0.05),
    m.MonitorSettings(lr_fraction=0.9, std_floor=0.03, slope_threshold=0.002, patience=5),
    m.MonitorSettings(lr_fraction=1.0, window=96, std_floor=0.001, min_abs=0.5, min_sigma=0.8, slope_threshold=0.05, patience=3),
    m.MonitorSettings(beta=0.5, slope_window=12, lr_fraction=0.95, min_abs=0.01),
]


@pytest.fixture(scope="module")
def tables(spark):
    log = spark.createDataFrame(make_log(), "run_id bigint, seq bigint, step bigint, loss double, learning_rate double").repartition(5)
    runs = log.groupBy("run_id").agg(F.max("step").alias("total_steps")).withColumn(
        "warmup_steps", F.col("run_id") % 20).withColumn(
        "hard_cap_steps", F.when(F.col("run_id") % 4 > 0, F.floor(F.col("total_steps") * 0.9)))
    return log, runs


def plain_rule(rows, s):
    """The rule for the entries of one run, one after the other."""
    best, best_count, max_lr, count, last_step, emas = math.inf, 0, 0.0, 0, -1, []
    for r in rows.itertuples(index=False):
        if not math.isnan(r.hard_cap_steps) and r.step >= r.hard_cap_steps:
            return r.step, "hard_cap"
        if r.no_loss or r.step <= last_step:
            continue
        last_step, count = r.step, count + 1
        ema = r.loss if count == 1 else s.beta * ema + (1.0 - s.beta) * r.loss
        emas.append(ema)
        if count == 1:
            ref = ema
        if ema < best - 1e-12:
            best, best_count = ema, count
        if r.step < r.warmup_steps or max(r.step, 0) / r.total_steps < s.exposure_floor:
            ref = ema
            continue
        if s.lr_fraction < 1 and not math.isnan(r.learning_rate):
            max_lr = max(max_lr, r.learning_rate)
            if r.learning_rate > max_lr * s.lr_fraction + 1e-12:
                continue
        if count < r.min_history:
            ref = ema
            continue
        sigma = max(m.sigma_of(np.asarray(emas[-r.window:])), s.std_floor)
        slope = m.slope_of(np.asarray(emas[-r.slope_window:]))
        drop = ref - ema
        if drop >= s.min_abs or drop / (sigma + 1e-12) >= s.min_sigma:
            ref = ema
        elif slope >= s.slope_threshold:
            return r.step, "worsening"
        elif count - best_count >= s.patience and abs(slope) <= s.slope_threshold and sigma <= max(0.5 * s.std_floor, 0.05):
            return r.step, "plateau"
    return None, None


def entries_of(log, runs, settings):
    """Sorted entries of each run, with the run's plan."""
    plan = m.monitor_windows(runs, "total_steps", settings).toPandas().set_index("run_id")
    pdf = log.withColumn("no_loss", F.col("loss").isNull()).toPandas()
    for run, rows in pdf.groupby("run_id"):
        rows = rows.assign(**{c: plan.loc[run, c] for c in plan.columns}).sort_values(["step", "seq"])
        rows["hard_cap_steps"] = rows["hard_cap_steps"].astype(float)
        yield run, rows


def row_by_row(spark, log, runs, settings):
    return {run: plain_rule(rows, settings) for run, rows in entries_of(log, runs, settings)}


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("settings", SETTINGS)
def test_stream_state_in_parts(spark, tables, odd_tables, settings, odd):
    """Entries taken into the state of a stream in parts, each in any order."""
    log, runs = odd_tables if odd else tables
    for run, rows in entries_of(log, runs, settings):
        state, stop = live.RunState(), (None, None)
        plan = {c: float(rows[c].iloc[0]) for c in live._PLAN}
        edges = sorted({0, len(rows), *(i for i in (len(rows) // 3, len(rows) // 2, len(rows) - 1) if rows.step.iloc[i] > rows.step.iloc[i - 1])})
        for a, z in zip(edges, edges[1:]):
            found = live.advance(settings, state, plan, rows.iloc[a:z].sample(frac=1, random_state=1))
            stop = found or stop
        assert stop == plain_rule(rows, settings)


@pytest.mark.parametrize("chunk", [64, 1 << 16])
@pytest.mark.parametrize("settings", SETTINGS)
def test_parallel_equals_row_by_row(spark, tables, settings, chunk, monkeypatch):
    monkeypatch.setattr(m, "CHUNK", chunk)
    log, runs = tables
    got = {r.run_id: (r.stop_step, r.reason) for r in m.early_stop(log, runs, settings).collect()}
    assert got == row_by_row(spark, log, runs, settings)


@pytest.fixture(scope="module")
def odd_tables(spark, tables):
    """Losses that are not finite, early, in the middle and late, of all kinds."""
    log, runs = tables
    bad = F.element_at(F.array(*[F.lit(float(x)) for x in ("nan", "inf", "-inf")]), (F.col("run_id") % 3 + 1).cast("int"))
    at = F.element_at(F.array(F.lit(2), F.lit(10), F.lit(70), F.lit(150)), (F.col("run_id") % 4 + 1).cast("int"))
    second = F.when((F.col("run_id") % 2 == 0) & (F.col("step") == at + 30), F.lit(float("-inf")))
    loss = F.when((F.col("step") == at) & (F.col("run_id") % 5 > 0), bad).otherwise(F.coalesce(second, "loss"))
    return log.withColumn("loss", F.when(F.col("loss").isNotNull(), loss)), runs


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("chunk", [64, 600, 1 << 16])
def test_losses_that_are_not_finite(spark, odd_tables, chunk, monkeypatch):
    monkeypatch.setattr(m, "CHUNK", chunk)
    log, runs = odd_tables
    settings = SETTINGS[2]
    got = {r.run_id: (r.stop_step, r.reason) for r in m.early_stop(log, runs, settings).collect()}
    assert got == row_by_row(spark, log, runs, settings)


def test_smoothing_keeps_what_is_not_finite(spark, monkeypatch):
    y = np.linspace(3, 1, 4000)
    y[10], y[2000] = np.nan, np.inf
    rows = [(r, i + 1, float(v)) for r, s in ((1, y), (2, np.where(np.isnan(y), 1.0, y))) for i, v in enumerate(s)]
    log = spark.createDataFrame(rows, "run_id bigint, pos bigint, loss double").withColumn("n", F.lit(4000))
    log = log.withColumn("window", F.lit(128)).withColumn("slope_window", F.lit(96))
    for chunk in (64, 600, 65_536):
        monkeypatch.setattr(m, "CHUNK", chunk)
        got = m.signals(log).orderBy("run_id", "pos").toPandas()
        one, two = got[got.run_id == 1].ema.to_numpy(), got[got.run_id == 2].ema.to_numpy()
        assert np.isfinite(one[:10]).all() and np.isnan(one[10:]).all()
        assert np.isfinite(two[:2000]).all() and np.isposinf(two[2000:]).all()


def test_every_reason_occurs(spark, tables):
    log, runs = tables
    reasons = {r.reason for s in SETTINGS for r in m.early_stop(log, runs, s).collect()}
    assert reasons >= {"worsening", "plateau", "hard_cap", None}


def test_no_plateau_above_the_sigma_floor(spark, tables):
    log, runs = tables
    flat = m.MonitorSettings(std_floor=0.06, slope_threshold=10.0, patience=0, lr_fraction=1.0)
    assert "plateau" not in {r.reason for r in m.early_stop(log, runs, flat).collect()}
    assert not m.MonitorSettings().sigma_matters and m.MonitorSettings(std_floor=0.01).sigma_matters


def test_trace_ends_at_the_stop(spark, tables):
    log, runs = tables
    s = replace(SETTINGS[1], std_floor=0.02, min_abs=0.2)
    stops = {r.run_id: r.stop_step for r in m.early_stop(log, runs, s).collect() if r.reason in ("worsening", "plateau")}
    rows = m.monitor_trace(log, runs, 1, s).toPandas()
    last = rows.groupby("run_id").step.max()
    assert stops and all(last[run] == step for run, step in stops.items())
    ends = rows.merge(pd.Series(stops, name="step").rename_axis("run_id").reset_index(), on=["run_id", "step"])
    assert (ends.worsening | ends.plateau).all()
    kept = (rows.abs_drop >= s.min_abs) | (rows.sigma_drop >= s.min_sigma) | ~(rows.worsening | rows.plateau)
    assert kept[~rows.set_index(["run_id", "step"]).index.isin(stops.items())].all()


def test_signals_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(m, "CHUNK", 32)
    rng = np.random.default_rng(1)
    y = np.cumsum(rng.normal(size=1500)) / 20 + 3
    log = spark.createDataFrame([(1, i + 1, float(v)) for i, v in enumerate(y)], "run_id bigint, pos bigint, loss double")
    rows = log.withColumn("n", F.lit(1500)).withColumn("window", F.lit(600)).withColumn("slope_window", F.lit(520))
    got = m.signals(rows).orderBy("pos").toPandas()
    ema = [y[0]]
    for v in y[1:]:
        ema.append(0.9 * ema[-1] + 0.1 * v)
    ema = np.array(ema)
    np.testing.assert_allclose(got.ema, ema, atol=1e-13)
    for i in range(0, 1500, 37):
        w, t = ema[max(0, i - 599):i + 1], ema[max(0, i - 519):i + 1]
        assert got.sigma[i] == pytest.approx(1.4826 * np.median(np.abs(w - np.median(w))) if len(w) > 2 else 0, abs=1e-11)
        assert got.slope[i] == pytest.approx(np.polyfit(np.arange(len(t)), t, 1)[0] if len(t) > 7 else 0, abs=1e-10)


def test_best_counts_only_real_drops(spark):
    losses = [3.0, 3.0, 2.0, 2.0 - 1e-14, 2.0, 1.0]
    log = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(losses)], "run_id bigint, seq bigint, loss double")
    log = log.withColumn("step", F.col("seq"))
    rows = m.loss_entries(log).withColumn("window", F.lit(128)).withColumn("slope_window", F.lit(96))
    s = m.MonitorSettings(beta=0.0)
    got = m.best_so_far(m.signals(rows, s), s).orderBy("pos").collect()
    assert [r.since_best for r in got] == [0, 1, 0, 1, 2, 0]
    assert [r.cooldown for r in got] == [3, 2, 3, 2, 1, 3]


def test_first_step_at_the_cap(spark, tables):
    log, runs = tables
    runs = runs.withColumn("hard_cap_steps", F.when(F.col("run_id") % 4 > 0, F.col("total_steps") * 0.37 + F.col("run_id") * 3))
    want = {r.run_id: r.c for r in log.join(runs, "run_id").where("step >= hard_cap_steps").groupBy("run_id").agg(F.min("step").alias("c")).collect()}
    for bits in (2, 5, 18):
        assert {r.run_id: r.cap_step for r in m._first_capped(log, runs, bits).collect()} == want
    assert want


def falling(n, drop, noise=0.0):
    rng = np.random.default_rng(3)
    return 5 - drop * np.arange(n) + noise * rng.normal(size=n)


@pytest.mark.parametrize("key_over,noise", [(0.04, 0.0), (0.04, 0.3), (1e-12, 0.0), (0.5, 0.05), (0.0, 0.1)])
def test_falls(key_over, noise):
    """Chains and summaries against a plain loop, for every value on entry."""
    value = falling(400, 0.003, noise)
    value[[50, 51, 200]] = np.nan
    value = np.round(value, 3) if key_over else value
    key = value + key_over
    f = Falls(key, value)
    for start in [*np.linspace(3, 6, 60), *key[~np.isnan(key)][::7], *value[~np.isnan(value)][::11], math.inf, math.nan]:
        v, rows = start, []
        for i in range(len(key)):
            if v >= key[i]:
                v = value[i]
                rows.append(i)
        assert f.chain(start).tolist() == rows
        for low, high in ((-1e9, 1e9), (start - 0.01, start + 0.01), (start, start)):
            keys, values, last = f.summary(low, high)
            at = leave(keys, start)
            assert (None, None) == (at, rows[-1] if rows else None) or (values[at], last[at]) == (v, rows[-1])


def test_long_falling_run(spark, monkeypatch):
    """A loss that falls at every step: one row per chunk is put in order, whatever the number of its improvements."""
    n = 1_000_000
    monkeypatch.setattr(m, "CHUNK", 1 << 16)
    log = spark.range(1, n + 1).select(F.lit(1).cast("bigint").alias("run_id"), F.col("id").alias("seq"), F.col("id").alias("step"),
                                       (9 - F.col("id") * 8e-6).alias("loss"), F.lit(None).cast("double").alias("learning_rate"))
    runs = spark.createDataFrame([(1, n, 100, None)], "run_id bigint, total_steps bigint, warmup_steps bigint, hard_cap_steps bigint")
    s = m.MonitorSettings(slope_window=96)
    packed = m.staged(m._packed(m._prepared(log, runs, s), s, True), "chunks")
    ordered = []
    entered = m._entered
    monkeypatch.setattr(m, "_entered", lambda totals, summed: entered(totals, lambda several: ordered.append(summed(several)) or ordered[-1]))
    walked = m._walked(packed, s)
    chunks = packed.count()
    assert ordered[0].count() == chunks - 1 <= n // (1 << 16) + 1
    # A summary holds the values that the reference can have when the chunk is entered, not all its rows.
    assert max(len(r["ref_key"]) // 8 for r in ordered[0].collect()) < 8000
    assert m.decisions(walked, s).collect() == []
    ends = walked.orderBy(F.desc("chunk")).first()
    ema = [float(x) for x in ends["ema"]]
    assert ends["best"] == pytest.approx(ema[0] + 8e-6, abs=1e-9) and ema[0] <= ends["ref"] < ema[0] + 0.0401
