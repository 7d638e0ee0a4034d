"""Alert states and notifications on a stream of samples, with event-time timers.

The same definitions as ``operators.alerts`` in batch, kept in keyed state: one key per rule, series and stretch of time (a
day, or four times the longest duration and gap). As in batch, a stretch also gets the samples just before it that its states can
depend on, and those just after it that may come before a deadline, so that a long series is spread over all
tasks. Samples wait in state, packed as arrays, until the watermark has passed them, so they may arrive in any order within
``delay``; they are then evaluated in the order of their times, in one vectorised step per key and batch. What a key keeps
afterwards is its last sample and the beginning of its breach, and after its end, or a silence of more than the longest allowed gap, nothing at all.

A breach that becomes old enough between two samples fires at that moment by a timer, without a further
sample: such rows have ``by_timer`` and no value. All other rows are exactly those of the batch operators, whatever
the cuts between batches.

Notifications take sums per time stamp, packed before the shuffle, so that a group's task handles few rows.

The queries need the RocksDB state store; ``stateful_session`` gives a session with it. The number of
its shuffle partitions is that of the state's, and is fixed by the first batch of a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.alerts import (
    RECEIVER_CRITICAL,
    RECEIVER_DEFAULT,
    REPEAT_SECONDS,
    RULES,
    SCRAPE_SECONDS,
    AlertRule,
    evaluated,
)
from touchline.session import pin_utc

STATES = (
    "alertname string, severity string, series string, ts timestamp, value double, state string, by_timer boolean"
)
NOTIFICATIONS = (
    "alertname string, severity string, event string, repeat bigint, notified_at timestamp, samples bigint, receiver string"
)
_MICROS = 1_000_000
_DAY = 86_400
_PACKED = "alertname string, severity string, t binary, fires binary"
_PACKED_SCHEMA = pa.schema([("alertname", pa.string()), ("severity", pa.string()), ("t", pa.binary()), ("fires", pa.binary())])
_NEVER = np.iinfo(np.int64).max


def stateful_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", state_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return pin_utc(session)


def _timestamps(micros: np.ndarray) -> pd.Series:
    return pd.to_datetime(pd.Series(micros, dtype="int64"), unit="us", utc=True)


def _wake(handle: StatefulProcessorHandle, micros: int) -> None:
    """A timer at the first millisecond that is not before ``micros``."""
    handle.registerTimer(-(-int(micros) // 1000))


class SeriesStates(StatefulProcessor):
    """States of one series under one rule in one stretch; the key is (alertname, severity, series, for_seconds, stretch)."""

    def __init__(self, max_gap_seconds: int, stretch_micros: int) -> None:
        self._gap, self._stretch = max_gap_seconds * _MICROS, stretch_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "t binary, value binary, breached binary")
        self._last = handle.getValueState("last", "t bigint, breached boolean, since bigint, told boolean")
        #: Keys that this batch has brought up to its watermark; their further timers find nothing to do.
        self._done: set[tuple] = set()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [(f["t"].to_numpy(np.int64), f["value"].to_numpy(float), f["breached"].to_numpy(bool)) for f in rows if len(f)]
        if not parts:
            return
        t, value, breached = (np.concatenate(x) for x in zip(*parts, strict=True))
        now = timerValues.getCurrentWatermarkInMs() * 1000  # samples up to here are complete
        if t.min() > now:
            self._wait(t, value, breached)
        else:
            yield from self._advance(key, now, [(t, value, breached)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if key not in self._done:
            yield from self._advance(key, timerValues.getCurrentWatermarkInMs() * 1000, [])

    def _wait(self, t: np.ndarray, value: np.ndarray, breached: np.ndarray) -> None:
        self._waiting.appendList([(t.tobytes(), value.tobytes(), breached.tobytes())])
        _wake(self._handle, t.min())

    def _advance(self, key, now: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pd.DataFrame]:
        """Evaluate what the watermark has passed; ``parts`` are new samples."""
        self._done.add(key)
        stored = [tuple(np.frombuffer(x, kind) for x, kind in zip(row, (np.int64, float, bool), strict=True)) for row in self._waiting.get()]
        if stored or parts:
            t, value, breached = (np.concatenate(x) for x in zip(*stored, *parts, strict=True))
            order = np.lexsort((breached, value, t))
            n = int(np.searchsorted(t[order], now, side="right"))
            ready, rest = ((t[x], value[x], breached[x]) for x in (order[:n], order[n:]))
            if n and stored:
                self._waiting.clear()
            if len(rest[0]) and (n or parts):
                self._wait(*rest)
        else:
            ready = (np.empty(0, np.int64), np.empty(0), np.empty(0, bool))
        frame = self._evaluate(key, ready, self._last.get(), now)
        if len(frame):
            yield frame

    def _evaluate(self, key, ready: tuple[np.ndarray, ...], last: tuple | None, now: int) -> pd.DataFrame:
        name, severity, series, seconds, stretch = key
        hold, carried = seconds * _MICROS, last is not None
        t, value, breached = ready
        if carried:
            t, value, breached = np.insert(t, 0, last[0]), np.insert(value, 0, np.nan), np.insert(breached, 0, last[1])
        if not len(t):
            return pd.DataFrame()
        begins = breached.copy()
        begins[1:] &= ~breached[:-1] | (np.diff(t) > self._gap)
        since = np.where(begins, t, -1)
        if carried:
            since[0] = last[2] if breached[0] else -1
        since = np.maximum.accumulate(since)
        state = np.where(~breached, "inactive", np.where(t - since >= hold, "firing", "pending"))
        # Where a pending breach comes of age before the next sample, and is not older than a gap.
        due, following = since + hold, np.append(t[1:], _NEVER)
        fires = (state == "pending") & (due < following) & (due - t <= self._gap)
        told = fires & (due <= now)
        if carried and last[3]:
            told[0] = False
        home = t // self._stretch == stretch  # the others only lead to these, or end them
        shown, timed = home & (np.arange(len(t)) >= carried), told & home
        at = np.concatenate([t[shown], due[timed]])
        out = pd.DataFrame(
            {
                "alertname": name,
                "severity": severity,
                "series": series,
                "ts": _timestamps(at),
                "value": np.concatenate([value[shown], np.full(timed.sum(), np.nan)]),
                "state": np.concatenate([state[shown], np.full(timed.sum(), "firing")]),
                "by_timer": np.arange(len(at)) >= shown.sum(),
            }
        )
        already = bool(told[-1] or carried and len(t) == 1 and last[3])
        over = t[-1] // self._stretch > stretch
        self._keep(t[-1], breached[-1], since[-1], already, fires[-1] and home[-1], due[-1], over, now)
        return out

    def _keep(self, t, breached, since, told, fires, due, over, now) -> None:
        """The last sample, until its silence is a break or the stretch is over; then the key is forgotten."""
        ends = int(t) + self._gap + 1
        if over or ends <= now:
            self._last.clear()
            return
        self._last.update((int(t), bool(breached), int(since), bool(told)))
        if fires and not told:
            _wake(self._handle, due)
        _wake(self._handle, ends)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Times and their sums of ``fires``, one row per group and batch."""
    for batch in batches:
        out = {"alertname": [], "severity": [], "t": [], "fires": []}
        for (name, severity), rows in batch.to_pandas().groupby(["alertname", "severity"], dropna=False, sort=False):
            t, place = np.unique(rows["t"].to_numpy(np.int64), return_inverse=True)
            fires = np.zeros(len(t), np.int64)
            np.add.at(fires, place, rows["fires"].to_numpy(np.int64))
            for column, x in zip(out, (name, severity, t.tobytes(), fires.tobytes()), strict=True):
                out[column].append(None if x is not x else x)
        yield pa.RecordBatch.from_pydict(out, schema=_PACKED_SCHEMA)


class GroupNotifications(StatefulProcessor):
    """Firing episodes of one group, and the repeat intervals in them; the key is (alertname, severity)."""

    def __init__(self, repeat_seconds: int) -> None:
        self._repeat = repeat_seconds * _MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "t binary, samples binary")
        #: ``since`` of the open episode; ``repeat``, first time and samples of its open interval, if ``repeat`` is not negative;
        #: the time that was walked to, up to which nothing more is taken.
        self._episode = handle.getValueState("episode", "since bigint, repeat bigint, first bigint, samples bigint, walked bigint")
        self._done: set[tuple] = set()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [(np.frombuffer(t, np.int64), np.frombuffer(n, np.int64)) for f in rows for t, n in zip(f["t"], f["fires"], strict=True)]
        if not parts:
            return
        now = timerValues.getCurrentWatermarkInMs() * 1000
        if min(t.min() for t, _ in parts) > now:
            self._wait(parts)
        else:
            yield from self._advance(key, now, parts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if key not in self._done:
            yield from self._advance(key, timerValues.getCurrentWatermarkInMs() * 1000, [])

    def _wait(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self._waiting.appendList([(t.tobytes(), n.tobytes()) for t, n in parts])
        _wake(self._handle, min(t.min() for t, _ in parts))

    def _advance(self, key, now: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        self._done.add(key)
        stored = [(np.frombuffer(t, np.int64), np.frombuffer(n, np.int64)) for t, n in self._waiting.get()]
        t, n = np.empty(0, np.int64), np.empty(0, np.int64)
        if stored or parts:
            times, counts = (np.concatenate(x) for x in zip(*stored, *parts, strict=True))
            late = times > now
            if stored:
                self._waiting.clear()
            if late.any():
                self._wait([(times[late], counts[late])])
            t, place = np.unique(times[~late], return_inverse=True)
            n = np.zeros(len(t), np.int64)
            np.add.at(n, place, counts[~late])
        event, repeat, first, samples = self._walk(t, n, now)
        if len(event):
            name, severity = key
            yield pd.DataFrame(
                {
                    "alertname": name,
                    "severity": severity,
                    "event": event,
                    "repeat": repeat,
                    "notified_at": _timestamps(first),
                    "samples": samples,
                    "receiver": RECEIVER_CRITICAL if severity == "critical" else RECEIVER_DEFAULT,
                }
            )

    def _walk(self, t: np.ndarray, n: np.ndarray, now: int) -> tuple[np.ndarray, ...]:
        """Event, repeat, first time and samples of the intervals that open and close; the state after them is kept."""
        since, repeat, first, samples, walked = self._episode.get() or (-1, -1, -1, 0, -1)
        t, n = t[t > walked], n[t > walked]
        closed = np.empty((3, 0), np.int64)
        opened = closed
        if len(t):
            fires = n > 0
            begins = fires & ~np.append(since >= 0, fires[:-1])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(t)), -1))
            of = np.where(at >= 0, t[at], since)[fires]  # the beginning of each firing time's episode
            times, turn = t[fires], (t[fires] - of) // self._repeat
            # The open interval goes first, with its first time and samples so far.
            goes_on = repeat >= 0
            of, turn = np.append([since] * goes_on, of).astype(np.int64), np.append([repeat] * goes_on, turn).astype(np.int64)
            times, counts = np.append([first] * goes_on, times).astype(np.int64), np.append([samples] * goes_on, n[fires]).astype(np.int64)
            if len(of):
                new = np.append(True, (np.diff(of) != 0) | (np.diff(turn) != 0))
                found = np.array([turn[new], times[new], np.add.reduceat(counts, np.flatnonzero(new))])
                opened, closed = found[:, int(goes_on) :], found[:, : -1 if fires[-1] else None]
            since = repeat = -1
            if fires[-1]:
                since, (repeat, first, samples) = int(of[-1]), found[:, -1].tolist()
        if repeat >= 0 and since + (repeat + 1) * self._repeat - 1 <= now:  # nothing can be added to it
            closed = np.append(closed, [[repeat], [first], [samples]], axis=1)
            repeat = -1
        self._episode.update((since, repeat, first, samples, max(int(now), walked)))
        if repeat >= 0:
            _wake(self._handle, since + (repeat + 1) * self._repeat - 1)
        opened = np.array([opened[0], opened[1], np.zeros_like(opened[0])])
        event = np.repeat(np.array(["opened", "closed"], dtype=object), [opened.shape[1], closed.shape[1]])
        return event, *np.append(opened, closed, axis=1)


def stream_alert_states(
    samples: DataFrame,
    rules: Sequence[AlertRule] = RULES,
    max_gap_seconds: int = 2 * SCRAPE_SECONDS,
    delay: str = "30 seconds",
) -> DataFrame:
    """``inactive``, ``pending`` or ``firing`` for every sample and rule, and what fires between samples."""
    rules = [r for r in rules if r.enabled]
    if not rules:
        raise ValueError("no enabled rule")
    timed = samples.withWatermark("ts", delay)
    plain, summed = [r for r in rules if not r.sum_series], [r for r in rules if r.sum_series]
    parts = [evaluated(timed, plain)] if plain else []
    for rule in summed:
        total = timed.where(rule.applies()).groupBy("ts", "metric").agg(F.sum("value").alias("value"))
        parts.append(evaluated(total.withColumn("labels", F.expr("CAST(map() AS MAP<STRING,STRING>)")), [rule]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    stretch = max(_DAY, 4 * (max(r.for_seconds for r in rules) + max_gap_seconds)) * _MICROS
    into = F.pmod("t", F.lit(stretch))
    home = F.expr(f"(t - pmod(t, {stretch}L)) DIV {stretch}L")
    # A state depends on no more than its rule's duration and a gap before it; a deadline on what comes within a gap.
    leads = into + (F.col("for_seconds") + max_gap_seconds) * _MICROS >= stretch
    ends = into < max_gap_seconds * _MICROS
    stretches = F.array_compact(F.array(home, F.when(leads, home + 1), F.when(ends, home - 1)))
    return (
        rows.select("alertname", "severity", "series", "for_seconds", "ts", F.unix_micros("ts").alias("t"), "value", F.coalesce("breached", F.lit(False)).alias("breached"))
        .withColumn("stretch", F.explode(stretches))
        .groupBy("alertname", "severity", "series", "for_seconds", "stretch")
        .transformWithStateInPandas(
            SeriesStates(max_gap_seconds, stretch), STATES, "append", "eventTime", eventTimeColumnName="ts"
        )
    )


def stream_group_alerts(states: DataFrame, repeat_seconds: int = REPEAT_SECONDS) -> DataFrame:
    """Notifications of a stream of states (with a watermark on ``ts``): ``opened`` when one is due, ``closed`` with all its samples.

    The closed ones are the rows of the batch operator. States that a timer made are no samples and are left out.
    """
    fires = F.coalesce((F.col("state") == "firing").cast("long"), F.lit(0)).alias("fires")
    return (
        states.where("NOT by_timer AND ts IS NOT NULL")
        .select("alertname", "severity", F.unix_micros("ts").alias("t"), fires)
        .mapInArrow(_packed, _PACKED)
        .groupBy("alertname", "severity")
        .transformWithStateInPandas(GroupNotifications(repeat_seconds), NOTIFICATIONS, "append", "eventTime")
    )
