"""Chunked scans against plain loops, with chunks far smaller than the runs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import curves, report, scans


@pytest.fixture(scope="module")
def runs():
    """Run 0 holds a third of the rows; order values have gaps."""
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for i in range(900):
        at += int(rng.integers(1, 4))
        rows.append((0 if i % 3 == 0 else int(rng.integers(1, 9)), at, float(np.round(rng.normal(3, 2), 2))))
    return rows


@pytest.fixture(scope="module")
def log(spark, runs):
    return spark.createDataFrame(runs, "run_id bigint, seq bigint, loss double").repartition(7)


def by_run(runs):
    out = {}
    for r, s, x in sorted(runs, key=lambda t: t[1]):
        out.setdefault(r, []).append((s, x))
    return out


def test_index_rows(log, runs):
    got = {(r.run_id, r.seq): (r.pos, r.n) for r in scans.index_rows(log, "run_id", "seq", bits=4).collect()}
    want = {(r, s): (i + 1, len(v)) for r, v in by_run(runs).items() for i, (s, _) in enumerate(v)}
    assert got == want


def test_running(log, runs):
    rows = scans.index_rows(log, "run_id", "seq")
    out = scans.running(rows, "run_id", {"low": (F.col("loss"), "min", False), "top": (F.col("loss"), "max", True)}, 16)
    got = {(r.run_id, r.pos): (r.low, r.top) for r in out.collect()}
    for r, v in by_run(runs).items():
        x = [y for _, y in v]
        for i in range(len(x)):
            assert got[r, i + 1] == (min(x[:i]) if i else None, max(x[: i + 1]))


def test_neighbours_and_halo_size(log, runs):
    rows = scans.index_rows(log, "run_id", "seq")
    out = scans.neighbours(rows, "run_id", {"before": ("loss", -2), "after": ("loss", 1)}, length=8)
    got = {(r.run_id, r.pos): (r.before, r.after) for r in out.collect()}
    for r, v in by_run(runs).items():
        x = [y for _, y in v]
        for i in range(len(x)):
            assert got[r, i + 1] == (x[i - 2] if i >= 2 else None, x[i + 1] if i + 1 < len(x) else None)
    sizes = scans.with_halo(rows, 5, 3, 16).groupBy("run_id", "_chunk").count().agg(F.max("count")).first()[0]
    assert sizes <= 16 + 5 + 3


@pytest.mark.parametrize("width", [1, 4, 7, 51])
def test_smooth(log, runs, width):
    rows = scans.index_rows(log, "run_id", "seq")
    got = {(r.run_id, r.pos): r.smoothed for r in curves.smooth(rows, F.lit(width), 51, length=32).collect()}
    for r, v in by_run(runs).items():
        x = np.array([y for _, y in v])
        padded = np.pad(x, (width // 2, width - 1 - width // 2), mode="edge")
        want = np.convolve(padded, np.ones(width) / width, mode="valid")
        np.testing.assert_allclose([got[r, i + 1] for i in range(len(x))], want, atol=1e-12)


@pytest.mark.parametrize("most", [1, 3, 8])
def test_window_sums(most):
    rng = np.random.default_rng(most)
    x = rng.normal(size=60) * 10.0 ** rng.integers(-3, 4, 60)
    x[[5, 30, 31]] = np.nan, np.inf, -np.inf
    first = np.arange(60)
    last = np.minimum(first + rng.integers(0, most, 60), 59)
    with np.errstate(invalid="ignore"):
        want = [x[a:z + 1].sum() for a, z in zip(first, last)]
    np.testing.assert_allclose(curves._window_sums(x, first, last, most), want, rtol=1e-9, atol=1e-10)


def test_exact_median(spark, log, runs):
    got = {r.run_id: r.median for r in scans.exact_median(log, "run_id", "loss").collect()}
    assert got == pytest.approx({r: float(np.median([x for _, x in v])) for r, v in by_run(runs).items()})
    odd = [(1, -3.0), (1, 0.0), (1, 1e300), (2, 5.0), (3, 2.0), (3, 2.0), (3, 4.0), (3, 4.0), (4, -1e-9), (4, 1e-9)]
    df = spark.createDataFrame(odd, "run_id int, loss double")
    assert {r.run_id: r.median for r in scans.exact_median(df, "run_id", "loss").collect()} == {1: 0.0, 2: 5.0, 3: 3.0, 4: 0.0}


def test_whole_groups():
    keys = [1, 1, 1, 1, 1, 2, 3, 3, 4, 4, 4, 4]
    for size in range(1, 13):
        batches = [pa.record_batch({"k": keys[i:i + size], "v": list(range(i, min(i + size, 12)))}) for i in range(0, 12, size)]
        out = list(scans.whole_groups(iter(batches), ["k"]))
        assert [v for t in out for v in t["v"].to_pylist()] == list(range(12))
        seen = [set(t["k"].to_pylist()) for t in out]
        assert sum(len(s) for s in seen) == 4


def test_sparkline(spark):
    rows = [(r, i, float((i * 7) % 23)) for r, n in ((1, 1), (2, 48), (3, 49), (4, 500)) for i in range(n)] + [(5, i, 2.0) for i in range(3)]
    df = spark.createDataFrame(rows, "run_id int, pos bigint, loss double").withColumn("pos", F.col("pos") + 1)
    df = df.join(df.groupBy("run_id").agg(F.count("*").alias("n")), "run_id")
    got = {r.run_id: r.sparkline for r in report.sparkline(df).collect()}
    for run in range(1, 6):
        x = [v for r, _, v in rows if r == run]
        if len(x) > 48:
            x = [x[int(i * (len(x) / 48))] for i in range(48)]
        span = max(x) - min(x) or 1.0
        assert got[run] == "".join("▁▂▃▄▅▆▇█"[int((v - min(x)) / span * 7)] for v in x)


def test_report_holds_all_evaluations(spark):
    rows = [(1, i, i, None, 0.5 * i, 1.0, None, None, None) for i in range(10)] + [(2, 1, 1, 3.0, None, 0.5, 9.0, 2.0, 1.0)]
    log = spark.createDataFrame(rows, "run_id int, seq bigint, step bigint, loss double, eval_loss double, epoch double, "
                                      "train_runtime double, train_samples_per_second double, train_steps_per_second double")
    got = report.run_report(log, 1, 10, 1, 4).collect()
    assert sorted(r.run_id for r in got) == [1, 2]
    assert [e.eval_loss for r in got if r.run_id == 1 for e in r.report.eval] == [0.5 * i for i in range(10)]
    two = next(r for r in got if r.run_id == 2).report
    assert two.eval == [] and two.loss.trend == "plateau    (+0.0000 vs first 20%)" and two.training_time_sec == 9.0
    assert next(r for r in got if r.run_id == 1).report.loss.trend == "n/a"


def test_median_with_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    runs = {1: [1.0, 2.0, nan], 2: [inf, 1.0, 3.0], 3: [inf, inf, 1.0], 4: [-inf, 2.0, 5.0, inf], 5: [-inf], 6: [4.0, 8.0], 7: [nan] * 4}
    rows = [(r, i, float(v)) for r, vs in runs.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "run_id int, seq int, loss double")
    got = {r.run_id: r["median"] for r in scans.exact_median(df, "run_id", "loss").collect()}
    want = {r: float(np.median(vs)) for r, vs in runs.items()}
    assert {r: repr(v) for r, v in got.items()} == {r: repr(v) for r, v in want.items()}


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_one_diverged_run_leaves_the_others(spark, bad):
    rows = [(r, i, i, bad if r == 1 and i == 40 else 3.0 / (1 + i) + r, 0.01 * i) for r in (1, 2) for i in range(1, 90)]
    df = spark.createDataFrame(rows, "run_id int, seq bigint, step bigint, loss double, epoch double")
    alone = df.where("run_id = 2")
    for name in ("loss_stats", "analysis"):
        run = getattr(curves, name)
        assert [str(r) for r in run(df).where("run_id = 2").collect()] == [str(r) for r in run(alone).collect()]
        assert run(df).where("run_id = 1").count() == 1
