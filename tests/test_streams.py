"""Streams in several batches give what the batch operators give."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_monitor import make_log

from textloom.operators import monitor as m
from textloom.streaming import live
from workload import sources


def test_early_stop_in_batches(spark, tmp_path):
    schema = "run_id bigint, seq bigint, step bigint, loss double, learning_rate double"
    log = spark.createDataFrame(make_log(11, 16), schema)
    runs = log.groupBy("run_id").agg(F.max("step").alias("total_steps")).withColumn("warmup_steps", F.lit(5)).withColumn(
        "hard_cap_steps", F.when(F.col("run_id") % 2 == 0, F.floor(F.col("total_steps") * 0.8)))
    src, out = str(tmp_path / "log"), str(tmp_path / "out")
    s = m.MonitorSettings(lr_fraction=0.95, std_floor=0.03, slope_threshold=0.004)
    for low, high in ((0, 60), (60, 200), (200, 1000)):
        log.where((F.col("step") > low) & (F.col("step") <= high)).coalesce(3).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        live.live_early_stop(stream, runs, out, str(tmp_path / "state"), s, once=True).awaitTermination()
    got = {r.run_id: (r.stop_step, r.reason) for r in spark.read.parquet(out).collect()}
    want = {r.run_id: (r.stop_step, r.reason) for r in m.early_stop(log, runs, s).collect() if r.reason}
    assert got == want and len(want) > 5


def test_tail_in_batches(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    entries = live.log_stream(spark.readStream.schema("value string").text(str(src)))
    for i, text in enumerate(["{'run_id': 1, 'loss': 3.0, 'step': 1}\nnoise\n{'run_id': 2, 'loss': 5, 'step': 1}",
                              "{'run_id': 1, 'loss': 2.0, 'step': 2}", '{"run_id": 1, "loss": 2.5, "step": 3}']):
        (src / f"{i}.log").write_text(text)
        live.live_tail(entries, out, state, once=True).awaitTermination()
    rows = {r.run_id: (r.step, r.current, r.best, r.entries) for r in live.latest_tail(spark.read.parquet(out)).collect()}
    assert rows == {1: (3, 2.5, 2.0, 3), 2: (1, 5.0, 5.0, 1)}


def state_rows(spark, checkpoint, name):
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load().count()


def test_ended_runs_are_forgotten(spark, tmp_path):
    """State of a run goes when nothing came for it for some time; what it led to stays."""
    src = tmp_path / "lines"
    src.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    entries = live.log_stream(live.log_files(spark, str(src), 1000))
    (src / "0.log").write_text("\n".join(f"{{'run_id': {r}, 'loss': {r}.5, 'step': 1}}" for r in range(5)))
    live.live_tail(entries, out, state, once=True, idle_seconds=1).awaitTermination(60)
    assert state_rows(spark, state, "tail") == 5
    time.sleep(1.5)
    (src / "1.log").write_text("{'run_id': 9, 'loss': 1.0, 'step': 1}")
    live.live_tail(entries, out, state, once=True, idle_seconds=1).awaitTermination(60)
    assert state_rows(spark, state, "tail") == 1
    assert live.latest_tail(spark.read.parquet(out)).count() == 6


class Values(dict):
    """Stands for the map a stream keeps of a run; tells how many rows were read from it at once."""

    largest = 0

    def getValue(self, k):  # noqa: N802
        self.largest = max(self.largest, len(self[k][0]))
        return self[k]

    def updateValue(self, k, v):  # noqa: N802
        self[k] = v

    containsKey, removeKey = dict.__contains__, dict.pop  # noqa: N815


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Timers:
    def __init__(self):
        self.at = []

    listTimers = lambda self: iter(self.at)  # noqa: E731, N815
    registerTimer = lambda self, t: self.at.append(t)  # noqa: E731, N815
    deleteTimer = lambda self, t: self.at.remove(t)  # noqa: E731, N815
    getCurrentProcessingTimeInMs = lambda self: 5  # noqa: E731, N815


@pytest.mark.parametrize("split", [1, 2])
def test_backlog_of_a_run(monkeypatch, split):
    """Entries in many batches at once, in any order, lead where they lead in order; only a range of them is read at a time."""
    n = 5000
    monkeypatch.setattr(live.StopProcessor, "RANGE", 256)
    rng = np.random.default_rng(2)
    loss = 3 - np.minimum(np.arange(n), 3800) * 5e-4 + np.maximum(0, np.arange(n) - 4200) * 0.02
    rows = pd.DataFrame({"step": np.arange(n) + 1, "seq": np.arange(n), "loss": loss, "no_loss": rng.random(n) < 0.1, "learning_rate": np.nan,
                         "total_steps": n, "warmup_steps": 10, "hard_cap_steps": np.nan, "window": 128, "slope_window": 96, "min_history": 42})
    settings = m.MonitorSettings()
    want = live.advance(settings, live.RunState(), {c: float(rows[c].iloc[0]) for c in live._PLAN}, rows)
    p = live.StopProcessor(settings, 60)
    p.handle, p.run, p.waiting = Timers(), Value(), Values()
    found = []
    for part in (rows[rows.step <= n / split], rows[rows.step > n / split]):
        pieces = np.array_split(part.sample(frac=1, random_state=4), 10) if len(part) else []
        found += list(p.handleInputRows((7,), iter(pieces), p.handle)) if len(part) else []
    assert [(r.run_id[0], r.stop_step[0], r.reason[0]) for r in found] == [(7, *want)] and want[1] == "worsening"
    assert not p.waiting and p.waiting.largest <= 256 and len(p.handle.at) == 1 and len(p.run.value[6]) == 0


@pytest.mark.parametrize("texts", [["a plain text", "another text", " "], [" ", "", None]])
@pytest.mark.parametrize("parts", [0, 3])
def test_documents_in_one_file_or_a_folder(spark, tmp_path, texts, parts):
    """The streams read the table as the batch queries do: as a file, or as a folder of files."""
    path = tmp_path / "documents.parquet"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(k, t, "en", "web" if k else "books", len(t or "")) for k, t in enumerate(texts)]
    if parts:
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(path))
    else:
        types = {"doc_id": "int64", "n_chars": "int64"}
        pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype(types).to_parquet(path)
    clean = sources.live_clean(spark, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in clean.collect()) == [(k, t) for k, t in enumerate(texts) if (t or "").strip()]
    assert {r.dataset_name for r in sources.live_ledger(spark, str(tmp_path)).collect()} == {"books.en", "web.en"}
