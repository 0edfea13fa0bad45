"""Early-stop monitor over the loss logs of many runs.

The rule itself is sequential: it compares the smoothed loss with a reference that moves when the loss
has improved. Everything it looks at is computed in parallel over chunks of runs (smoothed loss, robust
sigma, slope, gates). The state is two values that only fall, the reference and the best value (see `falls`): a row
of a chunk has a least reference from which it counts as an improvement, so what a chunk does to either is
known without what comes before. One summary per chunk is put in order; then all chunks walk through their
rows at once, each from the state it is entered with.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textloom.operators.falls import Falls, least_where, leave
from textloom.operators.scans import CHUNK, chunk_of, index_rows, running, whole_groups, with_halo
from textloom.session import staged

MAD_SCALE = 1.4826
_TINY = 1e-12
_NEVER = 1 << 62
#: Chunks of which a row of numbers is sent to every task; those of more are joined.
BROADCAST_CHUNKS = 200_000
_NARROW = 512  # windows up to this width are computed as rows of a matrix


@dataclass(frozen=True)
class MonitorSettings:
    """Settings of the monitor as a training run uses them."""

    exposure_floor: float = 0.18
    lr_fraction: float = 0.60
    window: int = 128
    beta: float = 0.90
    std_floor: float = 0.22
    min_abs: float = 0.04
    min_sigma: float = 0.50
    slope_window: int | None = None
    slope_threshold: float = 0.010
    patience: int = 8
    cooldown: int = 3

    @property
    def sigma_matters(self) -> bool:
        """Whether sigma can change a decision.

        Sigma is never below std_floor, so it cannot if a drop that passes the sigma test always
        passes the absolute test, and if it can never be low enough for a plateau.
        """
        return self.min_sigma * self.std_floor < self.min_abs or max(0.5 * self.std_floor, 0.05) >= self.std_floor

    @property
    def warm_rows(self) -> int:
        """Rows after which a value weighs less than 1e-18 in the smoothed loss."""
        if self.beta <= 0:
            return 1
        return math.ceil(math.log(1e-18) / math.log(self.beta))


def window_size(total: Column, base: int) -> Column:
    return F.greatest(F.lit(min(base, 512)), F.greatest(F.lit(96), F.floor(0.015 * total))).cast("int")


def slope_size(window: Column) -> Column:
    return F.greatest(F.lit(48), F.floor(0.75 * window)).cast("int")


def monitor_windows(runs: DataFrame, total: str, settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """Window widths of each run, from its planned steps."""
    w = window_size(F.greatest(F.lit(1), F.col(total)), settings.window)
    s = slope_size(F.col("window")) if settings.slope_window is None else F.lit(settings.slope_window)
    return (runs.withColumn("window", w).withColumn("slope_window", s.cast("int"))
            .withColumn("min_history", F.greatest(F.lit(24), F.floor(F.col("window") / 3)).cast("int")))


def loss_entries(log: DataFrame, per_run: DataFrame | None = None) -> DataFrame:
    """Entries with a loss, one per step: the first by `seq`. Adds `pos`, `n` and per-run columns."""
    rest = [c for c in log.columns if c not in ("run_id", "step")]
    first = log.where(F.col("loss").isNotNull()).groupBy("run_id", "step").agg(
        F.min_by(F.struct(*rest), F.col("seq")).alias("_e"))
    return index_rows(first.select("run_id", "step", "_e.*"), "run_id", "step", per_run=per_run)


def _group_starts(*keys: np.ndarray) -> np.ndarray:
    """For each row, the index of the first row of its group in sorted rows."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(n), 0))


def _smooth(loss: np.ndarray, start: np.ndarray, beta: float) -> np.ndarray:
    out = np.empty(len(loss))
    ema = 0.0
    for i, (x, s) in enumerate(zip(loss.tolist(), start.tolist())):
        ema = x if i == s else beta * ema + (1.0 - beta) * x
        out[i] = ema
    return out


def _trailing(y: np.ndarray, start: np.ndarray, width: np.ndarray, rows: np.ndarray):
    """Blocks (rows, values, count) of trailing windows: valid values first, NaN behind them."""
    at = 0
    while at < len(rows):
        w = int(width[rows[at:]].max())
        block = rows[at:at + max(1, (1 << 21) // w)]
        at += len(block)
        lo = np.maximum(start[block], block - width[block] + 1)
        idx = lo[:, None] + np.arange(min(w, int((block - lo).max()) + 1))[None, :]
        values = np.where(idx <= block[:, None], y[np.minimum(idx, len(y) - 1)], np.nan)
        yield block, values, block - lo + 1


def _row_medians(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    s = np.sort(values, axis=1)  # NaN sorts last
    at = np.stack([(count - 1) // 2, count // 2], axis=1)
    return np.take_along_axis(s, at, axis=1).mean(axis=1)


def _kth_gap(s: list[float], m: float, p: int, k: int) -> float:
    """The k-th smallest distance from m in the sorted list s; p is where m belongs in s."""
    lo, hi = max(0, k + 1 - (len(s) - p)), min(p, k + 1)
    while lo < hi:  # how many of the k + 1 nearest lie below m
        i = (lo + hi) // 2
        if m - s[p - 1 - i] < s[p + k - i] - m:
            lo = i + 1
        else:
            hi = i
    below = m - s[p - lo] if lo else -math.inf
    above = s[p + k - lo] - m if lo <= k else -math.inf
    return max(below, above)


def _sorted_mad(y: list[float], lo: np.ndarray, rows: np.ndarray) -> list[float]:
    """Median distance from the median of y[lo..row] for each row, for wide windows.

    One sorted window slides along; its middle and the middle distance are found by bisection.
    """
    out, window, left, right = [], [], 0, 0
    for first, row in zip(lo.tolist(), rows.tolist()):
        if first >= right:
            window, left, right = sorted(y[first:row + 1]), first, row + 1
        for v in y[right:row + 1]:
            insort(window, v)
        for v in y[left:first]:
            del window[bisect_left(window, v)]
        left, right = first, max(right, row + 1)
        c = len(window)
        m = (window[(c - 1) // 2] + window[c // 2]) / 2
        p = bisect_left(window, m)
        out.append((_kth_gap(window, m, p, (c - 1) // 2) + _kth_gap(window, m, p, c // 2)) / 2)
    return out


def sigma_of(values: np.ndarray) -> float:
    """Robust spread of one window."""
    if len(values) < 3:
        return 0.0
    with np.errstate(invalid="ignore"):
        return MAD_SCALE * float(np.median(np.abs(values - np.median(values))))


def slope_of(values: np.ndarray) -> float:
    """Least-squares slope of one window on the position."""
    if len(values) < 8:
        return 0.0
    x = np.arange(len(values)) - (len(values) - 1) / 2
    with np.errstate(invalid="ignore"):
        return float((x * (values - values[0])).sum() / (x * x).sum())


def _narrow(start: np.ndarray, width: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split rows by whether their window is narrow; also the first index of the wide windows."""
    lo = np.maximum(start[rows], rows - width[rows] + 1)
    narrow = rows - lo < _NARROW
    return rows[narrow], rows[~narrow], lo[~narrow]


def _sigma(y, start, width, rows) -> np.ndarray:
    out = np.zeros(len(y))
    rows, wide, lo = _narrow(start, width, rows)
    for block, values, count in _trailing(y, start, width, rows):
        med = _row_medians(values, count)
        mad = _row_medians(np.abs(values - med[:, None]), count)
        out[block] = np.where(count < 3, 0.0, MAD_SCALE * mad)
    if len(wide):
        out[wide] = MAD_SCALE * np.array(_sorted_mad(y.tolist(), lo, wide))
    return out


def _slope(y, start, width, rows) -> np.ndarray:
    out = np.zeros(len(y))
    rows, wide, lo = _narrow(start, width, rows)
    for block, values, count in _trailing(y, start, width, rows):
        m = count.astype(float)
        x = np.arange(values.shape[1])[None, :] - ((m - 1) / 2)[:, None]
        centred = np.where(np.isnan(values), 0.0, values - values[:, :1])
        x = np.where(np.isnan(values), 0.0, x)
        slope = (x * centred).sum(axis=1) / np.maximum((x * x).sum(axis=1), 1e-300)
        out[block] = np.where(count < 8, 0.0, slope)
    if len(wide):  # the wide windows divide by some m^3 / 12, which makes up for the long sums
        y = np.where(np.isfinite(y), y, 0.0)  # no window reaches the others
        centred = y - y.mean()
        at = np.arange(len(y)) - len(y) / 2
        sy = np.concatenate([[0.0], np.cumsum(centred)])
        sxy = np.concatenate([[0.0], np.cumsum(at * centred)])
        m = (wide - lo + 1).astype(float)
        total = sy[wide + 1] - sy[lo]
        middle = (wide + lo) / 2 - len(y) / 2
        out[wide] = (sxy[wide + 1] - sxy[lo] - middle * total) / (m * (m * m - 1) / 12)
    return out


def window_signals(ema: np.ndarray, rows: np.ndarray, window: int, slope_window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sigma and slope of the windows that end at `rows` of one series of smoothed losses; 0 elsewhere."""
    start, n = np.zeros(len(ema), np.int64), len(ema)
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(ema))])
    reach = max(window, slope_window)
    clean = odd[rows + 1] == odd[np.maximum(0, rows + 1 - reach)]
    sigma = _sigma(ema, start, np.full(n, window), rows[clean])
    slope = _slope(ema, start, np.full(n, slope_window), rows[clean])
    for i in rows[~clean]:
        sigma[i] = sigma_of(ema[max(0, i - window + 1):i + 1])
        slope[i] = slope_of(ema[max(0, i - slope_window + 1):i + 1])
    return sigma, slope


def signals(entries: DataFrame, settings: MonitorSettings = MonitorSettings(),
            only_decide: bool = False) -> DataFrame:
    """Add ema (smoothed loss), sigma and slope.

    Needs run_id, pos, n, loss, window and slope_window. A chunk starts early enough that the
    smoothed loss has forgotten where it started to beyond double precision. With the columns of
    `gated`, sigma and slope are computed for open rows only. With `only_decide`, sigma is left at 0
    where no decision can depend on it.
    """
    names = entries.columns

    def rows(table: pa.Table, home: np.ndarray, found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = table.select(names).take(pa.array(home))
        for name, values in found.items():
            out = out.append_column(name, pa.array(values[home]))
        yield from out.combine_chunks().to_batches()

    schema = StructType(entries.schema.fields + [StructField(c, DoubleType()) for c in ("ema", "sigma", "slope")])
    return _over_chunks(entries, settings, only_decide, rows, schema)


def _over_chunks(entries: DataFrame, settings: MonitorSettings, only_decide: bool, give: Callable, schema: StructType | str) -> DataFrame:
    """What `give(table, home, signals)` makes of some whole chunks: all their rows, which of these are their own, and the signals of each."""
    warm, s = settings.warm_rows, settings
    with_sigma = s.sigma_matters or not only_decide
    before = (F.greatest("window", "slope_window") if with_sigma else F.col("slope_window")) + warm
    length = F.greatest(F.lit(CHUNK), before)
    keys = ["run_id", "_chunk"]
    # A chunk forgets where it started, but never a loss that is not finite: those are told to all chunks.
    first = lambda test: F.coalesce(F.min(F.when(test, F.col("pos"))), F.lit(_NEVER))
    loss = F.col("loss").cast("double")
    odd = entries.where(F.isnan(loss) | (F.abs(loss) == math.inf)).groupBy("run_id").agg(
        first(F.isnan(loss)).alias("_nan"), first(loss == math.inf).alias("_high"), first(loss == -math.inf).alias("_low"))
    rows = with_halo(entries.join(odd, "run_id", "left"), before, 0, length)
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "pos")
    has_gates = "open" in entries.columns

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            col = {c: table[c].to_numpy() for c in ("run_id", "_chunk", "pos", "window", "slope_window", "_home")}
            start = _group_starts(col["run_id"], col["_chunk"])
            home = np.flatnonzero(col["_home"])
            opened = table["open"].to_numpy().astype(bool) if has_gates else None
            wanted = home[opened[home]] if has_gates else home
            ema = _smooth(table["loss"].cast(pa.float64()).to_numpy(), start, s.beta)
            nan, high, down = (pc.fill_null(table[c], _NEVER).to_numpy() for c in ("_nan", "_high", "_low"))
            pos, since = col["pos"], np.minimum(np.minimum(nan, high), down)
            lost = since <= pos
            ema[lost] = np.where((nan <= pos) | ((high <= pos) & (down <= pos)), np.nan, np.where(high <= pos, np.inf, -np.inf))[lost]
            sound = wanted[~lost[wanted]]
            sigma = _sigma(ema, start, col["window"], sound) if with_sigma else np.zeros(len(ema))
            slope = _slope(ema, start, col["slope_window"], sound)
            sigma[lost & (np.minimum(pos, col["window"]) >= 3)] = np.nan
            slope[lost & (np.minimum(pos, col["slope_window"]) >= 8)] = np.nan
            reach = np.maximum(col["window"], col["slope_window"])
            for i in wanted[lost[wanted] & (pos - since < reach)[wanted]]:  # windows that still hold finite values
                sigma[i] = sigma_of(ema[max(start[i], i - col["window"][i] + 1):i + 1]) if with_sigma else 0.0
                slope[i] = slope_of(ema[max(start[i], i - col["slope_window"][i] + 1):i + 1])
            yield from give(table, home, {"ema": ema, "sigma": sigma, "slope": slope})

    return rows.mapInArrow(compute, schema)


def gated(entries: DataFrame, settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """Add what the gates say: `waits` moves the reference along, `open` may decide.

    Needs step, total_steps, warmup_steps, min_history and learning_rate (may be null). The
    highest learning rate so far counts only entries past the warm-up and the exposure floor.
    """
    past = (F.col("step") >= F.col("warmup_steps")) & (
        F.greatest(F.col("step"), F.lit(0)) / F.col("total_steps") >= settings.exposure_floor)
    rows = entries.withColumn("_past", past)
    lr_ok = F.lit(True)
    if settings.lr_fraction < 1:
        rate = F.col("learning_rate")
        rows = running(rows, "run_id", {"_lr": (F.when(F.col("_past"), F.greatest(rate, F.lit(0.0))), "max", True)})
        lr_ok = rate.isNull() | F.coalesce(rate <= F.col("_lr") * settings.lr_fraction + _TINY, F.lit(False))
    enough = F.col("pos") >= F.col("min_history")
    return (rows.withColumn("_ok", lr_ok)
            .withColumn("open", F.col("_past") & F.col("_ok") & enough)
            .withColumn("waits", ~F.col("_past") | (F.col("_ok") & ~enough))
            .drop("_past", "_ok", "_lr"))


def _drop_key(s: MonitorSettings, ema: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """The least reference from which the drop to each smoothed loss counts as an improvement; NaN for none."""
    def improved(ref: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return (ref - ema >= s.min_abs) | ((ref - ema) / (sigma + _TINY) >= s.min_sigma)

    need = np.where(np.isfinite(sigma), np.minimum(s.min_abs, s.min_sigma * (sigma + _TINY)), s.min_abs)
    return _reached(improved, ema, ema + need, np.abs(ema) + np.abs(need))


def _best_key(ema: np.ndarray) -> np.ndarray:
    """The least best value that each smoothed loss is better than; NaN for none."""
    return _reached(lambda best: ema < best - _TINY, ema, ema + _TINY, np.abs(ema) + _TINY)


def _reached(holds, ema: np.ndarray, near: np.ndarray, scale: np.ndarray) -> np.ndarray:
    sound = np.isfinite(ema)
    key = least_where(holds, np.where(sound, near, 0.0), np.where(sound, scale, 0.0))
    return np.where(sound, key, np.where(np.isneginf(ema), -np.finfo(float).max, np.nan))


@dataclass
class Walk:
    """What the rule does on consecutive rows of a run, from the state before them."""

    falls: np.ndarray  #: rows at which the reference falls
    before: np.ndarray  #: the reference that each row is compared with
    best: np.ndarray  #: the best value so far, with the row itself
    since: np.ndarray  #: rows since the best value
    plateau: np.ndarray
    worsening: np.ndarray
    stop: int | None  #: the row that stops the run

    @property
    def reason(self) -> str:
        return "worsening" if self.worsening[self.stop] else "plateau"


def walk(s: MonitorSettings, ref: float, best: float, best_pos: int, pos: np.ndarray, ema: np.ndarray, sigma: np.ndarray,
         slope: np.ndarray, opened: np.ndarray) -> Walk:
    """The early-stop rule. `opened`: rows that may decide; `ref`, `best` and the position of the best are as before the first row."""
    sigma = _floored(sigma, s.std_floor)
    at = np.flatnonzero(opened)
    falls = at[Falls(_drop_key(s, ema[at], sigma[at]), ema[at]).chain(ref)]
    better = Falls(_best_key(ema), ema).chain(best)
    held = np.concatenate([[ref], ema[falls]])
    before = held[np.searchsorted(falls, np.arange(len(pos)), "left")]
    step = np.searchsorted(better, np.arange(len(pos)), "right")
    best_now = np.concatenate([[best], ema[better]])[step]
    since = pos - np.concatenate([[best_pos], pos[better]])[step]
    with np.errstate(invalid="ignore"):
        worsening = slope >= s.slope_threshold
        plateau = (since >= s.patience) & (np.abs(slope) <= s.slope_threshold) & (sigma <= max(0.5 * s.std_floor, 0.05))
    ends = opened & (worsening | plateau)
    ends[falls] = False
    stop = np.flatnonzero(ends)
    return Walk(falls, before, best_now, since, plateau, worsening, int(stop[0]) if len(stop) else None)


def _floored(sigma: np.ndarray, floor: float) -> np.ndarray:
    return np.where(sigma < floor, floor, sigma)


def _low(values: np.ndarray) -> float:
    values = values[~np.isnan(values)]
    return float(values.min()) if len(values) else math.inf


_LISTS = {"pos": "bigint", "step": "bigint", "ema": "double", "sigma": "double", "slope": "double", "open": "boolean"}
#: Per chunk: the first smoothed loss, that of the last waiting row, and the least key and value of the falls of
#: the reference and of the best value.
_TOTALS = {"first": "double", "wait": "double", "wait_pos": "bigint", "key": "double", "value": "double",
           "best_key": "double", "best_value": "double"}


def _packed(entries: DataFrame, settings: MonitorSettings, only_decide: bool) -> DataFrame:
    """The signals of gated entries, one row per chunk: its rows as lists, and its totals."""
    s = settings
    names = ["run_id", "chunk", *_LISTS, *_TOTALS]

    def pack(table: pa.Table, home: np.ndarray, found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        runs, chunk = table["run_id"].take(pa.array(home)), table["_chunk"].to_numpy()[home]
        own = {c: table[c].to_numpy()[home] for c in ("pos", "step", "waits", "open")} | {c: found[c][home] for c in ("ema", "sigma", "slope")}
        edges = np.append(np.flatnonzero(np.concatenate([[True], (own["pos"][1:] != own["pos"][:-1] + 1) | (chunk[1:] != chunk[:-1])])), len(home))
        rows = []
        for a, z in zip(edges, edges[1:], strict=False):
            x = {c: v[a:z] for c, v in own.items()}
            waits, opened = np.flatnonzero(x["waits"]), np.flatnonzero(x["open"])
            key = _drop_key(s, x["ema"][opened], _floored(x["sigma"][opened], s.std_floor))
            rows.append((runs[int(a)].as_py(), int(chunk[a]), *(x[c] for c in _LISTS), float(x["ema"][0]),
                         float(x["ema"][waits[-1]]) if len(waits) else None, int(x["pos"][waits[-1]]) if len(waits) else None,
                         _low(key), _low(x["ema"][opened]), _low(_best_key(x["ema"])), _low(x["ema"])))
        types = [table["run_id"].type, pa.int64(), *(pa.list_(_ARROW[t]) for t in _LISTS.values()), *(_ARROW[t] for t in _TOTALS.values())]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    run_type = entries.schema["run_id"].dataType.simpleString()
    schema = f"run_id {run_type}, chunk bigint, " + ", ".join(
        [*(f"{c} array<{t}>" for c, t in _LISTS.items()), *(f"{c} {t}" for c, t in _TOTALS.items())])
    return _over_chunks(entries, settings, only_decide, pack, schema)


_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def _numbers(b: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return b.column(b.schema.get_field_index(name))[row].values.to_numpy(zero_copy_only=False)


def _joined(chunks: DataFrame, small: DataFrame) -> DataFrame:
    """Chunks with what is known of each, a row of some numbers; many of these are not sent to every task."""
    return chunks.join(F.broadcast(small) if small.count() <= BROADCAST_CHUNKS else small, ["run_id", "chunk"])


def _entered(totals: DataFrame, summed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(run_id, chunk, ref, best, best_pos): the state with which every chunk is entered.

    The reference starts at the last waiting row, as no row decides before it. Between what the totals of
    the chunks before allow lies all that a chunk can be entered with. `summed` gives the summaries for these; one row per
    chunk is put in order, in one task per run.
    """
    ahead = Window.partitionBy("run_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("run_id")
    start = F.coalesce(F.max_by("wait", "wait_pos").over(whole), F.min_by("first", "chunk").over(whole))
    bands = totals.select("run_id", "chunk", start.alias("start"), F.max("chunk").over(whole).alias("last"), *[
        F.min(c).over(ahead).alias(f"low_{c}") for c in ("key", "value", "best_key", "best_value")])
    bands = staged(bands.select("run_id", "chunk", "start", "last", *[F.least("start", f"low_{c}").alias(f"low_{c}") for c in ("key", "value")], *[
        F.coalesce(f"low_{c}", F.lit(math.inf)).alias(f"low_{c}") for c in ("best_key", "best_value")]), "bands")
    # Only what another chunk follows is summed up.
    several = bands.where("chunk < last")
    if several.isEmpty():
        return bands.select("run_id", "chunk", F.col("start").alias("ref"), F.lit(math.inf).alias("best"), F.lit(0).cast("bigint").alias("best_pos"))
    run_type = totals.schema["run_id"].dataType.simpleString()

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, rows, state = None, [], []
        for b in batches:
            for r in range(b.num_rows):
                own = b.column(0)[r].as_py()
                if own != run or not state:
                    run, state = own, [b.column(2)[r].as_py(), math.inf, 0]
                rows.append((own, b.column(1)[r].as_py(), *state))
                if not b.column(3)[r].is_valid:
                    continue
                key, value, best_key, best_value, best_pos = (
                    np.frombuffer(b.column(k)[r].as_py(), np.int64 if k == 7 else np.float64) for k in range(3, 8))
                if (at := leave(key, state[0])) is not None:
                    state[0] = float(value[at])
                if (at := leave(best_key, state[1])) is not None:
                    state[1:] = [float(best_value[at]), int(best_pos[at])]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [
                b.column(0).type, pa.int64(), pa.float64(), pa.float64(), pa.int64()], strict=True)], ["run_id", "chunk", "ref", "best", "best_pos"])
            rows = []

    steps = summed(several)
    ordered = bands.select("run_id", "chunk", "start").join(steps, ["run_id", "chunk"], "left").select("run_id", "chunk", "start", *_STEPS)
    return staged(ordered.repartition("run_id").sortWithinPartitions("run_id", "chunk").mapInArrow(
        carry, f"run_id {run_type}, chunk bigint, ref double, best double, best_pos bigint"), "entered")


_STEPS = ["ref_key", "ref_value", "best_key", "best_value", "best_pos"]


def _summary(s: MonitorSettings, pos: np.ndarray, ema: np.ndarray, sigma: np.ndarray, opened: np.ndarray, low: float, high: float,
             best_low: float, best_high: float) -> list[bytes]:
    at = np.flatnonzero(opened)
    key, value, _ = Falls(_drop_key(s, ema[at], _floored(sigma[at], s.std_floor)), ema[at]).summary(low, high)
    best_key, best_value, row = Falls(_best_key(ema), ema).summary(best_low, best_high)
    return [x.tobytes() for x in (key, value, best_key, best_value, pos[row].astype(np.int64))]


def _summed(packed: DataFrame, settings: MonitorSettings) -> Callable[[DataFrame], DataFrame]:
    run_type = packed.schema["run_id"].dataType.simpleString()

    def summed(several: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for r in range(b.num_rows):
                    bands = [b.column(k)[r].as_py() for k in range(6, 10)]
                    rows.append(_summary(settings, *(_numbers(b, c, r) for c in ("pos", "ema", "sigma", "open")),
                                         bands[1], bands[0], bands[3], bands[2]))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.record_batch([b.column(0), b.column(1), *(pa.array(c, pa.binary()) for c in columns)], ["run_id", "chunk", *_STEPS])

        lists = packed.select("run_id", "chunk", "pos", "ema", "sigma", "open")
        bands = several.select("run_id", "chunk", "low_key", "low_value", "low_best_key", "low_best_value")
        return _joined(lists, bands).mapInArrow(run, f"run_id {run_type}, chunk bigint, " + ", ".join(f"{c} binary" for c in _STEPS))

    return summed


def _walked(packed: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Chunks with the state they are entered with: the totals are put in order, the rows stay where they are."""
    totals = packed.select("run_id", "chunk", *_TOTALS)
    return _joined(packed.select("run_id", "chunk", *_LISTS), _entered(totals, _summed(packed, settings)))


def decisions(walked: DataFrame, settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """(run_id, pos, step, reason): where the rule stops a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r, x, w in _walks(b, settings):
                if w.stop is not None:
                    rows.append((b.column(0)[r].as_py(), int(x["pos"][w.stop]), int(x["step"][w.stop]), w.reason))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [b.column(0).type, pa.int64(), pa.int64(), pa.string()], strict=True)],
                                  ["run_id", "pos", "step", "reason"])

    run_type = walked.schema["run_id"].dataType.simpleString()
    stops = walked.mapInArrow(run, f"run_id {run_type}, pos bigint, step bigint, reason string")
    return stops.groupBy("run_id").agg(F.min_by(F.struct("pos", "step", "reason"), "pos").alias("s")).select("run_id", "s.*")


def _walks(b: pa.RecordBatch, settings: MonitorSettings) -> Iterator[tuple[int, dict[str, np.ndarray], Walk]]:
    for r in range(b.num_rows):
        x = {c: _numbers(b, c, r) for c in _LISTS}
        state = [b.column(b.schema.get_field_index(c))[r].as_py() for c in ("ref", "best", "best_pos")]
        yield r, x, walk(settings, *state, x["pos"], x["ema"], x["sigma"], x["slope"], x["open"].astype(bool))


def best_so_far(rows: DataFrame, settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """Best smoothed loss, entries since it and cooldown left, for every row of `signals`."""
    rows = staged(rows.withColumn("chunk", chunk_of(CHUNK)), "signals")
    totals = rows.groupBy("run_id", "chunk").agg(F.min("ema").alias("best_value"))
    # A few roundings more than the key of the least: the band need only hold what is possible.
    key = F.col("best_value") + 2 * _TINY + F.abs("best_value") * 1e-14
    totals = totals.select("run_id", "chunk", *[F.lit(None).cast(t).alias(c) for c, t in _TOTALS.items() if not c.startswith("best")],
                           key.alias("best_key"), "best_value")
    keys, names = ["run_id", "chunk"], rows.columns
    run_type = rows.schema["run_id"].dataType.simpleString()

    def chunks(df: DataFrame) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, "pos")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for table in whole_groups(batches, keys):
            start = _group_starts(*(table[c].to_numpy() for c in keys))
            edges = np.append(np.flatnonzero(start == np.arange(len(start))), len(start))
            yield from (table.slice(a, z - a).combine_chunks() for a, z in zip(edges, edges[1:], strict=False))

    def summed(several: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in groups(batches):
                pos, ema = t["pos"].to_numpy(), t["ema"].to_numpy()
                none = np.zeros(len(pos))
                cells = _summary(settings, pos, ema, none, none, 0.0, 0.0, t["low_best_value"][0].as_py(), t["low_best_key"][0].as_py())
                yield pa.record_batch([t["run_id"].combine_chunks()[:1], t["chunk"].combine_chunks()[:1], *(pa.array([c], pa.binary()) for c in cells)],
                                      [*keys, *_STEPS])

        bands = several.select(*keys, "low_best_key", "low_best_value")
        return chunks(_joined(rows.select(*keys, "pos", "ema"), bands)).mapInArrow(
            run, f"run_id {run_type}, chunk bigint, " + ", ".join(f"{c} binary" for c in _STEPS))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches):
            pos, ema = t["pos"].to_numpy(), t["ema"].to_numpy()
            none = np.zeros(len(pos))
            w = walk(settings, math.nan, t["best"][0].as_py(), t["best_pos"][0].as_py(), pos, ema, none, none, none.astype(bool))
            out = t.select(names).append_column("best_ema", pa.array(w.best)).append_column("since_best", pa.array(w.since))
            yield from out.append_column("cooldown", pa.array(np.maximum(0, settings.cooldown - w.since))).combine_chunks().to_batches()

    entered = _entered(totals, summed).select(*keys, "best", "best_pos")
    schema = StructType([*rows.schema.fields]).add("best_ema", "double").add("since_best", "long").add("cooldown", "long")
    return chunks(_joined(rows, entered)).mapInArrow(finish, schema).drop("chunk")


def early_stop(log: DataFrame, runs: DataFrame, settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """Where and why each run stops: one row per run, null step if it runs to its end.

    log: run_id, seq, step, loss, learning_rate. runs: run_id, total_steps, warmup_steps and
    hard_cap_steps (null = none). The cap holds for every log entry, even without a loss.
    """
    packed = staged(_packed(_prepared(log, runs, settings), settings, only_decide=True), "chunks")
    stops = decisions(_walked(packed, settings), settings).select("run_id", "step", "reason")
    return runs.select("run_id").join(stops, "run_id", "left").join(_first_capped(log, runs), "run_id", "left").select(
        "run_id",
        F.coalesce("step", "cap_step").alias("stop_step"),
        F.when(F.col("step").isNotNull(), F.col("reason"))
        .when(F.col("cap_step").isNotNull(), F.lit("hard_cap")).alias("reason"),
    )


def _prepared(log: DataFrame, runs: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Loss entries below the cap with the run's settings and gates on each row."""
    plan = monitor_windows(runs, "total_steps", settings).select(
        "run_id", "total_steps", "warmup_steps", "hard_cap_steps", "window", "slope_window", "min_history")
    entries = loss_entries(log.select("run_id", "seq", "step", "loss", "learning_rate"), plan)
    below = F.col("hard_cap_steps").isNull() | (F.col("step") < F.col("hard_cap_steps"))
    return gated(staged(entries.where(below).drop("hard_cap_steps"), "entries"), settings)


def _first_capped(log: DataFrame, runs: DataFrame, bits: int = 18) -> DataFrame:
    """The first step at or above the cap of each run.

    Found among the least steps of later buckets of 2^bits steps, and among the rows of the one
    bucket the cap lies in, so rows never meet by run alone.
    """
    rows = log.select("run_id", "step", F.shiftright(F.col("step").cast("bigint"), bits).alias("_b"))
    caps = runs.where("hard_cap_steps IS NOT NULL").select(
        "run_id", "hard_cap_steps", F.shiftright(F.ceil("hard_cap_steps").cast("bigint"), bits).alias("_cb"))
    later = rows.groupBy("run_id", "_b").agg(F.min("step").alias("step")).join(caps, "run_id").where(
        F.col("_b") > F.col("_cb")).select("run_id", "step")
    same = rows.join(caps.withColumnRenamed("_cb", "_b"), ["run_id", "_b"]).where(
        F.col("step") >= F.col("hard_cap_steps")).select("run_id", "step")
    return later.unionByName(same).groupBy("run_id").agg(F.min("step").alias("cap_step"))


def monitor_trace(log: DataFrame, runs: DataFrame, every: int = 1,
                  settings: MonitorSettings = MonitorSettings()) -> DataFrame:
    """The state at every entry that reached the decision, up to the stop; each `every` steps."""
    walked = staged(_walked(staged(_packed(_prepared(log, runs, settings), settings, only_decide=False), "chunks"), settings), "walked")
    stops = decisions(walked, settings).select("run_id", F.col("pos").alias("stop"))
    chunks = walked.select("run_id", F.col("pos")[0].alias("from"), F.struct(*[c for c in walked.columns if c != "run_id"]).alias("x"))
    rows = chunks.join(stops, "run_id", "left").where("stop IS NULL OR from <= stop").select("run_id", "x.*", "stop")
    names = {"run_id": walked.schema["run_id"].dataType.simpleString(), "step": "bigint", "ema": "double", "best": "double", "abs_drop": "double",
             "sigma_drop": "double", "sigma": "double", "slope": "double", "since_best": "bigint", "plateau": "boolean", "worsening": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, x, w in _walks(b, settings):
                stop = b.column(b.schema.get_field_index("stop"))[r].as_py()
                at = np.flatnonzero(x["open"].astype(bool) & (x["step"] % every == 0) & (x["pos"] <= (_NEVER if stop is None else stop)))
                sigma, drop = _floored(x["sigma"], settings.std_floor)[at], (w.before - x["ema"])[at]
                found = [x["step"][at], x["ema"][at], w.best[at], drop, drop / (sigma + _TINY), sigma, x["slope"][at], w.since[at],
                         w.plateau[at], w.worsening[at]]
                yield pa.record_batch([b.column(0).take(pa.array(np.full(len(at), r))), *map(pa.array, found)], list(names))

    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in names.items()))
