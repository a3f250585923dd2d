"""Scoring of closed windows with state per tag.

Reads the stream of closed window counts (one row per tag and window, so a hot tag is no heavier
than a cold one), keeps the last few counts of every tag and emits an alert when a count stands out.
"""

from __future__ import annotations

import math
import statistics
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.streaming.jobs import instant

STATE = (
    "last bigint, counts array<bigint>, sums array<double>, posts array<bigint>, alerted bigint"
)
OUTPUT = (
    "hashtag string, window_start timestamp_ntz, n bigint, history bigint, baseline_mean double,"
    " baseline_std double, zscore double, sentiment_shift double, emitted boolean, late boolean"
)
HELD = "n bigint, sentiment_sum double, sentiment_n bigint"
MIN_HISTORY = 2


def _micros(at: Any) -> int:
    return pd.Timestamp(at).as_unit("ns").value // 1000


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in OUTPUT.split(", ")])


class TrendState(StatefulProcessor):
    """Last counts and last alert of one tag.

    Windows without posts count as zero. A tag silent for more than ``forget`` windows starts anew.
    That depends on event time only, so a replay gives the same result; an event-time timer takes
    the state of such a tag out of the store.

    With ``delay_us`` windows are held in state until the event-time watermark, which trails the latest
    window by that much, has passed them, and are then scored in order: batches change nothing. What comes
    after the watermark is dropped and counted in the query progress (``jobs.late_rows``). Rows without a
    tag only move the watermark. Without ``delay_us`` windows must come in order; one that comes after a
    later window of its tag was scored comes out without a score, marked ``late``.
    """

    def __init__(
        self,
        width_us: int,
        n_windows: int,
        threshold: float,
        cooldown_us: int,
        forget: int | None = None,
        delay_us: int | None = None,
    ):
        self.width_us = width_us
        self.n_windows = n_windows
        self.threshold = threshold
        self.cooldown_us = cooldown_us
        self.forget = forget
        self.delay_us = delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trend", STATE)
        if self.delay_us is not None:
            self.held = handle.getMapState("held", "at bigint", HELD)
            self.first = handle.getValueState("first", "at bigint")  # the earliest of them

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if self.delay_us is None:
            windows = pd.concat(list(rows)).sort_values("window_start")  # a few windows per batch
            yield self._scored(key, windows)
            return
        for part in rows:
            if key[0] is not None:
                self._hold(part)
        yield _frame([])

    def _hold(self, windows: pd.DataFrame) -> None:
        first = self.first.get()[0] if self.first.exists() else None
        for row in windows.itertuples():
            at = _micros(row.window_start)
            if not self.held.containsKey((at,)):  # delivered twice, it counts once
                self.held.updateValue((at,), (int(row.n), float(row.sentiment_sum), int(row.sentiment_n)))
                self.handle.registerTimer(-(-at // 1000))
                first = at if first is None else min(first, at)
        if first is not None:
            self.first.update((first,))

    def _due(self, key: Any, watermark_us: int) -> pd.DataFrame:
        """Held windows that the watermark has passed, scored in order."""
        if not self.first.exists() or self.first.get()[0] > watermark_us:
            return _frame([])
        held = sorted((at, *value) for (at,), value in self.held.iterator())
        due = [row for row in held if row[0] <= watermark_us]
        for row in due:
            self.held.removeKey((row[0],))
        if len(due) < len(held):
            self.first.update((held[len(due)][0],))
        else:
            self.first.clear()
        windows = pd.DataFrame(due, columns=["window_start", *(c.split()[0] for c in HELD.split(", "))])
        return self._scored(key, windows.assign(window_start=pd.to_datetime(windows["window_start"], unit="us")))

    def _scored(self, key: Any, windows: pd.DataFrame) -> pd.DataFrame:
        last, counts, sums, posts, alerted = self.state.get() if self.state.exists() else (None, [], [], [], None)
        counts, sums, posts = list(counts), list(sums), list(posts)
        out = []
        for row in windows.itertuples():
            at = _micros(row.window_start)
            if last is not None and at <= last:
                out.append((key[0], row.window_start, int(row.n), None, None, None, None, None, False, True))
                continue
            if last is not None:
                gap = (at - last) // self.width_us - 1
                if self.forget is not None and gap > self.forget:
                    counts, sums, posts, alerted = [], [], [], None
                else:
                    zeros = min(gap, self.n_windows)
                    counts += [0] * zeros
                    sums += [0.0] * zeros
                    posts += [0] * zeros
            counts, sums, posts = (x[-self.n_windows :] for x in (counts, sums, posts))
            scored = self._score(row, counts, sums, posts)
            hit = scored[2] is not None and scored[2] >= self.threshold
            emitted = hit and (alerted is None or at - alerted >= self.cooldown_us)
            alerted = at if emitted else alerted
            out.append((key[0], row.window_start, int(row.n), len(counts), *scored, emitted, False))
            counts.append(int(row.n))
            sums.append(float(row.sentiment_sum))
            posts.append(int(row.sentiment_n))
            last = at
        keep = (x[-self.n_windows :] for x in (counts, sums, posts))
        self.state.update((last, *keep, alerted))
        if self.forget is not None:
            self.handle.registerTimer(self._expiry_ms(last))
        return _frame(out)

    def _expiry_ms(self, last: int) -> int:
        return (last + (self.forget + 2) * self.width_us) // 1000

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.delay_us is not None:
            yield self._due(key, timerValues.getCurrentWatermarkInMs() * 1000)
        if self.forget is not None and self.state.exists() and self._expiry_ms(self.state.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        yield _frame([])

    def _score(self, row, counts, sums, posts):
        """(mean, deviation, z-score, sentiment shift) of a window against the ones before."""
        mean = statistics.fmean(counts) if counts else None
        std = statistics.stdev(counts) if len(counts) > 1 else None
        known = len(counts) >= MIN_HISTORY and std
        zscore = (row.n - mean) / std if known else None
        shift = None
        if row.sentiment_n and sum(posts):
            shift = row.sentiment_sum / row.sentiment_n - math.fsum(sums) / sum(posts)
        return mean, std, zscore, shift


def score_stream(counts: DataFrame, processor: TrendState) -> DataFrame:
    """All closed windows with their score; ``emitted`` marks the alerts."""
    mode = "None"
    if processor.forget is not None or processor.delay_us is not None:
        mode = "EventTime"
        slack = f"{2 * processor.width_us if processor.delay_us is None else processor.delay_us} microseconds"
        counts = counts.withColumn("at", instant(F.col("window_start"))).withWatermark("at", slack)
    return counts.groupBy("hashtag").transformWithStateInPandas(processor, OUTPUT, "append", mode)
