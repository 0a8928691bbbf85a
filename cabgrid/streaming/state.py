"""Keyed event-time state for the order-dependent streaming queries.

``lag`` / ``lead`` are not available on a stream, and rows of a taxi can arrive
out of order within the watermark delay. So a first, plain aggregation gathers
what a taxi did in an hour; it comes out once, when the watermark has passed the
hour and no earlier row can still arrive, and hours of a taxi come out in order.
Only what one hour hands to the next is keyed by taxi here:

* idle: the last dropoff so far, for the gap to the first pickup of the hour;
* sliding idle windows: the last dropoff, and the sums of the panes (as long as
  the slide) that a window still reaches, with their running total: a new pane is
  added, one that has left the window is subtracted;
* congestion: the last four rides of the current day, and whether the day has
  had its alert.

No row is buffered in this state, it is small whatever a taxi does, and a busy
taxi's rows are spread over the hours of the aggregation before. Timers in event
time remove a taxi's state when it is of no more use.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StatefulProcessor

cloudpickle.register_pickle_by_value(sys.modules[__name__])

IDLE_OUTPUT = "medallion string, window_start timestamp, avg_idle_minutes double"
CONGESTION_OUTPUT = "medallion string, day timestamp, cell string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store; a query keeps the store that the
    session names when it starts."""
    spark.conf.set(_PROVIDER, _ROCKSDB)


def _us(t: pd.Timestamp | dt.datetime) -> int:
    return int(pd.Timestamp(t).value // 1000)


def _stamp(us: list[int]) -> pd.Series:
    return pd.Series(np.asarray(us, dtype="int64").astype("datetime64[us]"))


class IdleHours(StatefulProcessor):
    """Mean idle minutes of every window above ``threshold``. Rows: a taxi's window
    with its first pickup and last dropoff (in microseconds), and the seconds and number of positive
    gaps inside it."""

    def __init__(self, threshold: float, forget_us: int | None) -> None:
        self.threshold, self.forget_us = threshold, forget_us

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_dropoff", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("window_start")
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for h in hours.itertuples():
            total, n = int(h.gap_seconds), int(h.gaps)
            if last is not None and (gap := (int(h.first_pickup) - last) // 1_000_000) > 0:
                total, n = total + gap, n + 1
            last = int(h.last_dropoff)
            if n and float(total) / n / 60.0 > self.threshold:
                out.append((_us(h.window_start), float(total) / n / 60.0))
        due = None if self.forget_us is None else -(-(last + self.forget_us) // 1000)
        if due is not None and due <= timerValues.getCurrentWatermarkInMs():
            self.last.clear()
        else:
            self.last.update((last,))
            if due is not None:
                self.handle.registerTimer(due)
        if out:
            starts, means = zip(*out)
            yield pd.DataFrame({"medallion": [key[0]] * len(out), "window_start": _stamp(list(starts)), "avg_idle_minutes": list(means)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists() and self.last.get()[0] + self.forget_us <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


class IdlePanes(StatefulProcessor):
    """Mean idle minutes above ``threshold`` of every window of ``panes`` panes of
    ``step_us`` that has a positive gap. Rows: a taxi's pane with its first pickup and
    last dropoff (in microseconds), and the seconds and number of positive gaps inside it.

    Panes of a taxi come in order, so a window is final when a later pane arrives or
    the watermark has passed its last pane. The state has one map entry for each pane
    with gaps that an open window reaches (fewer than ``panes``), the totals over
    them, and the last dropoff; a timer at the end of the next open window takes out
    what has expired, until no entry is left."""

    def __init__(self, threshold: float, step_us: int, panes: int) -> None:
        self.threshold, self.step_us, self.panes = threshold, step_us, panes

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_dropoff", "us long")
        self.open = handle.getValueState("open_window", "at long, seconds long, gaps long, oldest long")
        self.ring = handle.getMapState("ring", "pane long", "seconds long, gaps long")

    def _emit(self, at: int, seconds: int, gaps: int, oldest: int, until: int, out: list) -> tuple[int, int, int, int]:
        """Windows from the one whose last pane is ``at`` up to ``until``, while any pane is left."""
        while gaps and at <= until:
            while oldest <= at - self.panes:
                if self.ring.containsKey((oldest,)):
                    s, n = self.ring.getValue((oldest,))
                    self.ring.removeKey((oldest,))
                    seconds, gaps = seconds - s, gaps - n
                oldest += 1
            if gaps:
                if float(seconds) / gaps / 60.0 > self.threshold:
                    out.append(((at - self.panes + 1) * self.step_us, float(seconds) / gaps / 60.0))
                at += 1
        return at, seconds, gaps, oldest

    def _settled(self, now: tuple[int, int, int, int], watermark_ms: int, out: list) -> None:
        """Emit what the watermark has passed, and wait for the rest."""
        now = self._emit(*now, watermark_ms * 1000 // self.step_us - 1, out)
        if now[2]:
            self.open.update(now)
            self.handle.registerTimer(-(-(now[0] + 1) * self.step_us // 1000))
        else:
            self.open.clear()

    def _rows(self, key, out: list) -> Iterator[pd.DataFrame]:
        if out:
            starts, means = zip(*out)
            yield pd.DataFrame({"medallion": [key[0]] * len(out), "window_start": _stamp(list(starts)), "avg_idle_minutes": list(means)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        at, seconds, gaps, oldest = self.open.get() if self.open.exists() else (0, 0, 0, 0)
        out: list = []
        for h in pd.concat(list(rows)).sort_values("window_start").itertuples():
            pane, total, n = _us(h.window_start) // self.step_us, int(h.gap_seconds), int(h.gaps)
            if last is not None and (gap := (int(h.first_pickup) - last) // 1_000_000) > 0:
                total, n = total + gap, n + 1
            last = int(h.last_dropoff)
            if n:
                at, seconds, gaps, oldest = self._emit(at, seconds, gaps, oldest, pane - 1, out)
                if not gaps:
                    at = oldest = pane
                self.ring.updateValue((pane,), (total, n))
                seconds, gaps = seconds + total, gaps + n
        self.last.update((last,))
        self._settled((at, seconds, gaps, oldest), timerValues.getCurrentWatermarkInMs(), out)
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out: list = []
        if self.open.exists():
            now = self.open.get()
            if (now[0] + 1) * self.step_us <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
                self._settled(now, timerValues.getCurrentWatermarkInMs(), out)
        yield from self._rows(key, out)

    def close(self) -> None:
        pass


def _first_peak(seq: np.ndarray, lo: int) -> int:
    """Index of the first i >= lo with seq[i] > seq[i-1], seq[i] > seq[i+1],
    seq[i+1] < seq[i+2] < seq[i+3]; -1 if none."""
    lo, hi = max(1, lo), len(seq) - 3
    if hi <= lo:
        return -1
    k = np.arange(lo, hi)
    hit = (seq[k] > seq[k - 1]) & (seq[k] > seq[k + 1]) & (seq[k + 1] < seq[k + 2]) & (seq[k + 2] < seq[k + 3])
    return int(k[np.argmax(hit)]) if hit.any() else -1


class CongestedDays(StatefulProcessor):
    """The first peak-then-rise of every taxi-day. Rows: a taxi's hour with the
    durations and cells of its rides in order."""

    DAY_US = 86_400_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "day long, done boolean, durations array<int>, cells array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("window_start")
        day, done, durations, cells = self.day.get() if self.day.exists() else (None, False, [], [])
        found = []
        for h in hours.itertuples():
            start = _us(h.window_start)
            if start - start % self.DAY_US != day:
                day, done, durations, cells = start - start % self.DAY_US, False, [], []
            before = len(durations)
            seq = np.array([*durations, *h.durations], dtype="int64")
            names = [*cells, *h.cells]
            if not done:
                # only peaks whose third successor is in this hour
                hit = _first_peak(seq, before - 3)
                if hit >= 0:
                    found.append((day, names[hit]))
                    done = True
            durations, cells = seq[-4:].tolist(), names[-4:]
        over = (day + self.DAY_US) // 1000
        if over > timerValues.getCurrentWatermarkInMs():
            self.day.update((day, done, durations, cells))
            self.handle.registerTimer(over)
        else:
            self.day.clear()
        if found:
            days, where = zip(*found)
            yield pd.DataFrame({"medallion": [key[0]] * len(found), "day": _stamp(list(days)), "cell": list(where)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.day.exists() and (self.day.get()[0] + self.DAY_US) // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.day.clear()
        yield from ()

    def close(self) -> None:
        pass
