"""The same operators on streams: live loss tail, early stop, cleaning, process-once ledger."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from textloom.functions.cleaning import clean_text
from textloom.operators.monitor import MonitorSettings, monitor_windows, walk, window_signals
from textloom.operators.prepare import prepared
from textloom.session import by_value
from textloom.sources.logs import entry_fields, parse_lines
from textloom.sources.tables import append_ledger, empty_ledger

#: A run without entries for this long has ended.
IDLE_SECONDS = 7 * 86_400


def _run(writer, checkpoint: str, once: bool) -> StreamingQuery:
    """Start a query, for what is there now (`once`) or to go on. State that may end would keep a query without new
    entries busy for ever, so one that takes what is there does no rounds without any."""
    writer = writer.option("checkpointLocation", checkpoint)
    if not once:
        return writer.trigger(processingTime="10 seconds").start()
    conf = SparkSession.active().conf
    before = conf.get(_IDLE_ROUNDS)
    conf.set(_IDLE_ROUNDS, "false")  # a query keeps the settings it starts with
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(_IDLE_ROUNDS, before)


_IDLE_ROUNDS = "spark.sql.streaming.noDataMicroBatches.enabled"


def log_stream(lines: DataFrame, field: str = "loss") -> DataFrame:
    """Typed entries of a stream of log lines that name their run in the field `run_id`.

    Only entries with `field`: the loss for charts, the step for the early stop, whose hard cap
    also holds for entries without a loss. The order within a run is the field `seq`, or the step.
    """
    number = lambda k: F.col("entry")[k].try_cast("bigint")
    parsed = parse_lines(lines, field=field).withColumns({"run_id": number("run_id"), "seq": F.coalesce(number("seq"), number("step"))})
    return entry_fields(parsed).drop("value")


def log_files(spark: SparkSession, path: str, max_bytes: int = 256 << 20) -> DataFrame:
    """A stream of the lines of log files in a folder, at most so many bytes of them at once, or one file."""
    return spark.readStream.schema("value string").option("maxBytesPerTrigger", max_bytes).text(path)


class _Idle(StatefulProcessor):
    """State of a key that ends when nothing came for it for some time."""

    def __init__(self, idle_seconds: float) -> None:
        self.idle = int(idle_seconds * 1000)

    def _renew(self, timers) -> None:  # noqa: ANN001
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at[0] if isinstance(at, tuple) else at)
        self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.idle)

    def close(self) -> None:
        pass


def _stateful(spark: SparkSession) -> None:
    """State with timers needs the store that is kept on disk."""
    if "RocksDB" not in spark.conf.get(_PROVIDER):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class TailProcessor(_Idle):
    """Step and loss of a run's latest entry, its best loss, and the number of entries with a loss."""

    def init(self, handle) -> None:  # noqa: ANN001
        self.handle = handle
        self.tail = handle.getValueState("tail", "seq bigint, step bigint, current double, best double, entries bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        seq, step, current, best, entries = self.tail.get() if self.tail.exists() else (None, None, None, math.nan, 0)
        for pdf in rows:
            latest = pdf.seq.idxmax()
            if seq is None or pdf.seq[latest] >= seq:
                seq, current = int(pdf.seq[latest]), float(pdf.loss[latest])
                step = None if pd.isna(pdf.step[latest]) else int(pdf.step[latest])
            best = float(np.fmin(best, pdf.loss.min()))  # a loss that is not a number is never the best of others
            entries += len(pdf)
        self.tail.update((seq, step, current, best, entries))
        self._renew(timerValues)
        yield pd.DataFrame({"run_id": [key[0]], "step": [entries if step is None else step], "current": [current], "best": [best], "entries": [entries]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        self.tail.clear()
        yield from ()


def live_tail(entries: DataFrame, out: str, checkpoint: str, once: bool = False, idle_seconds: float = IDLE_SECONDS) -> StreamingQuery:
    """Running step, current and best loss of each run; every batch adds the runs that changed.

    A run for which nothing came for `idle_seconds` is forgotten; its saved rows stay. Entries without a loss or an order are left out.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _stateful(entries.sparkSession)
    run_type = entries.schema["run_id"].dataType.simpleString()
    rows = entries.where("loss IS NOT NULL AND seq IS NOT NULL").select("run_id", "seq", "step", "loss")
    with by_value():
        tails = rows.groupBy("run_id").transformWithStateInPandas(
            TailProcessor(idle_seconds), f"run_id {run_type}, step bigint, current double, best double, entries bigint", "update", "ProcessingTime")
    return _run(tails.writeStream.outputMode("update").foreachBatch(save), checkpoint, once)


def latest_tail(df: DataFrame) -> DataFrame:
    """The last saved state of each run."""
    names = [c for c in df.columns if c not in ("run_id", "batch_id")]
    return df.groupBy("run_id").agg(F.max_by(F.struct(*names), "batch_id").alias("s")).select("run_id", "s.*")


def live_clean(rows: DataFrame, key: str, text: str, out: str, checkpoint: str, mode: str = "math",
               once: bool = False) -> StreamingQuery:
    cleaned = prepared(rows, clean_text(F.col(text), mode), key)
    return _run(cleaned.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint, once)


def live_ledger(paths: DataFrame, path: str, ledger_path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Log each dataset once. A batch that is run again finds its names listed already."""
    empty_ledger(paths.sparkSession, ledger_path)

    def save(batch: DataFrame, batch_id: int) -> None:
        append_ledger(batch, path, ledger_path)

    return _run(paths.select(path).writeStream.foreachBatch(save), checkpoint, once)


@dataclass
class RunState:
    """What the early stop keeps of a run: a few numbers and its last window of smoothed losses."""

    best: float = math.inf
    best_count: int = 0
    ref: float = math.nan
    max_lr: float = 0.0
    count: int = 0
    last_step: int = -1
    recent: list[float] = field(default_factory=list)
    stopped: bool = False


_STATE = ("best double, best_count bigint, ref double, max_lr double, count bigint, last_step bigint, "
          "recent array<double>, stopped boolean")
_PLAN = ["total_steps", "warmup_steps", "hard_cap_steps", "window", "slope_window", "min_history"]
_ENTRY = {"step": "bigint", "seq": "bigint", "loss": "double", "no_loss": "boolean", "learning_rate": "double"}


def advance(s: MonitorSettings, state: RunState, plan: dict[str, float], rows: pd.DataFrame) -> tuple[int, str] | None:
    """Take new entries of a run into its state, in the order of (step, seq); the stop they lead to, if any.

    The rule is that of the batch form, on the same signals; steps that come later than a higher one are skipped.
    """
    if state.stopped or not len(rows):
        return None
    rows = rows.sort_values(["step", "seq"])
    cap = plan["hard_cap_steps"]
    capped = rows.step[rows.step >= cap] if not math.isnan(cap) else rows.step[:0]
    rows = rows[(rows.step > state.last_step) & ~rows.no_loss.astype(bool)].drop_duplicates("step")
    if len(capped):
        rows = rows[rows.step < cap]
    found = _enter(s, state, plan, rows) if len(rows) else None
    if found is None and len(capped):
        found = int(capped.iloc[0]), "hard_cap"
    if found:
        state.stopped, state.recent = True, []
    return found


def _enter(s: MonitorSettings, state: RunState, plan: dict[str, float], rows: pd.DataFrame) -> tuple[int, str] | None:
    step, loss, lr = (rows[c].to_numpy(np.float64) for c in ("step", "loss", "learning_rate"))
    known = len(state.recent)
    smooth, ema = (state.recent[-1] if known else math.nan), np.empty(len(loss))
    for i, x in enumerate(loss.tolist()):
        smooth = x if state.count + i == 0 else s.beta * smooth + (1.0 - s.beta) * x
        ema[i] = smooth
    pos = state.count + 1 + np.arange(len(loss))
    past = (step >= plan["warmup_steps"]) & (np.maximum(step, 0) / plan["total_steps"] >= s.exposure_floor)
    top = np.maximum.accumulate(np.append(state.max_lr, np.where(past & ~np.isnan(lr), lr, 0.0)))[1:]
    with np.errstate(invalid="ignore"):
        settled = (lr <= top * s.lr_fraction + 1e-12) | np.isnan(lr) if s.lr_fraction < 1 else np.ones(len(lr), bool)
    enough = pos >= plan["min_history"]
    opened, waits = past & settled & enough, np.flatnonzero(~past | (settled & ~enough))
    if state.count == 0:
        state.ref = float(ema[0])
    if len(waits):  # no row decides before the last of these
        state.ref = float(ema[waits[-1]])
    series = np.concatenate([state.recent, ema])
    sigma, slope = window_signals(series, known + np.flatnonzero(opened), int(plan["window"]), int(plan["slope_window"]))
    w = walk(s, state.ref, state.best, state.best_count, pos, ema, sigma[known:], slope[known:], opened)
    if w.stop is not None:
        return int(step[w.stop]), w.reason
    if len(w.falls):
        state.ref = float(ema[w.falls[-1]])
    state.best, state.best_count = float(w.best[-1]), int(pos[-1] - w.since[-1])
    state.max_lr, state.count, state.last_step = float(top[-1]), int(pos[-1]), int(step[-1])
    state.recent = series[-int(max(plan["window"], plan["slope_window"])):].tolist()
    return None


class StopProcessor(_Idle):
    """Early stop of one run. Entries that come in several batches at once are first put by in the state, by ranges of
    steps, and taken from there in order, so that no more than a range is in memory however much has piled up."""

    RANGE = 4096

    def __init__(self, settings: MonitorSettings, idle_seconds: float) -> None:
        super().__init__(idle_seconds)
        self.settings = settings

    def init(self, handle) -> None:  # noqa: ANN001
        self.handle = handle
        self.run = handle.getValueState("run", _STATE)
        self.waiting = handle.getMapState("waiting", "range bigint", ", ".join(f"{c} array<{t}>" for c, t in _ENTRY.items()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        state = RunState(*self.run.get()) if self.run.exists() else RunState()
        state.recent = list(state.recent)
        found, plan, held, several = None, None, None, False
        for pdf in rows:
            plan = plan or {c: float(pdf[c].iloc[0]) for c in _PLAN}
            if held is not None:
                self._put_by(held)
                several = True
            held = pdf[list(_ENTRY)]
        if several:
            self._put_by(held)
            for k in sorted(k[0] for k in self.waiting.keys()):
                cells = self.waiting.getValue((k,))
                found = found or advance(self.settings, state, plan, pd.DataFrame(dict(zip(_ENTRY, cells, strict=True))))
                self.waiting.removeKey((k,))
        elif held is not None:
            found = advance(self.settings, state, plan, held)
        self.run.update((state.best, state.best_count, state.ref, state.max_lr, state.count, state.last_step, state.recent, state.stopped))
        self._renew(timerValues)
        if found:
            yield pd.DataFrame({"run_id": [key[0]], "stop_step": [found[0]], "reason": [found[1]]})

    def _put_by(self, pdf: pd.DataFrame) -> None:
        for k, own in pdf.groupby(pdf.step // self.RANGE):
            if self.waiting.containsKey((int(k),)):
                before = pd.DataFrame(dict(zip(_ENTRY, self.waiting.getValue((int(k),)), strict=True)))
                own = pd.concat([before, own])
            # Of a step the first entry with a loss counts, or any for the cap.
            own = own.sort_values(["step", "no_loss", "seq"]).drop_duplicates("step")
            self.waiting.updateValue((int(k),), tuple(own[c].tolist() for c in _ENTRY))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        self.run.clear()
        self.waiting.clear()
        yield from ()


def early_stops(entries: DataFrame, runs: DataFrame, settings: MonitorSettings = MonitorSettings(),
                idle_seconds: float = IDLE_SECONDS) -> DataFrame:
    """Stream of stop decisions, one per run at most.

    A run for which nothing came for `idle_seconds` is forgotten; what comes for it later begins a new one.
    """
    _stateful(entries.sparkSession)
    plan = monitor_windows(runs, "total_steps", settings).withColumn("hard_cap_steps", F.col("hard_cap_steps").cast("double"))
    rows = entries.select("run_id", "step", "seq", "loss", F.col("loss").isNull().alias("no_loss"), "learning_rate").join(
        plan.select("run_id", *_PLAN), "run_id")
    run_type = entries.schema["run_id"].dataType.simpleString()
    with by_value():
        return rows.groupBy("run_id").transformWithStateInPandas(
            StopProcessor(settings, idle_seconds), f"run_id {run_type}, stop_step bigint, reason string", "append", "ProcessingTime")


def live_early_stop(entries: DataFrame, runs: DataFrame, out: str, checkpoint: str, settings: MonitorSettings = MonitorSettings(),
                    once: bool = False, idle_seconds: float = IDLE_SECONDS) -> StreamingQuery:
    stops = early_stops(entries, runs, settings, idle_seconds)
    return _run(stops.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint, once)
