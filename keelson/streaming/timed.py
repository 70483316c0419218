"""Per-user rules in event time with ``transformWithState`` (T4, T5).

Rows wait in the state until the watermark has passed them, are then taken in
(time, id) order, and leave. A row's answer is therefore exact whatever order
the rows of a user arrive in, within the watermark's delay; rows behind the
watermark are dropped, as in any event-time aggregate.

State, per bucket of users (a hash of the user; ``BUCKETS`` of them, so calls,
timers and state transfers follow the batches and not the number of users; the
number must stay the same for a checkpoint's life):

* ``waiting``: a map of (time slice, part) to the users, times, ids and amounts of
  one incoming frame's rows in that slice. Frames are stored one by one as they
  come and never joined; one timer, at the end of the earliest slice that waits,
  takes the slices that the watermark has passed, in order and about ``AT_ONCE``
  rows at a time, so a task holds these or one slice of one bucket, however many
  rows a user has.
* velocity: the (user, time) pairs within ``span``, trimmed as slices are taken;
  a timer one span after the last empties it, so users who stop leave no state.
* profile: a map of each user's last ``depth`` amounts, kept as long as the rule
  asks; a call reads and writes those of its own users.

List and map states and timers need the RocksDB store: start the query inside
``with state_store(spark)``, which sets it and restores the session's own. Rows without a time or an amount are no events and are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keelson.functions.spans import span_us
from keelson.functions.time import event_time

#: The state store that list and map states need (a fixed name).
STORE = ("spark.sql.streaming.stateStore.providerClass",
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")



@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


#: Groups of users that share a state, and rows that a timer takes at once (a slice at least).
BUCKETS = 256
AT_ONCE = 200_000
_COLUMNS = ["_bucket", "_user", "_ts", "_id", "_amount", "_t"]
_WAITS = "user array<string>, t binary, id binary, amount binary"


def _longs(packed: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.int64)


class _Sliced(StatefulProcessor):
    """Rows wait by time slice; ``answer`` takes the rows of some slices, sorted by (user, time, id)."""

    def __init__(self, slice_us: int):
        self.slice_us, self.slice_ms = slice_us, slice_us // 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slice bigint, part bigint", _WAITS)
        self.parts = handle.getValueState("parts", "n bigint, first bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, first = self.parts.get() or (0, None)
        before = first
        for frame in rows:
            frame = frame.set_axis(_COLUMNS, axis=1)      # columns arrive by position
            users, t, ids, amounts = (frame[c].to_numpy() for c in ("_user", "_t", "_id", "_amount"))
            of = t // self.slice_us
            order = np.argsort(of, kind="stable")
            starts = np.flatnonzero(np.diff(of[order], prepend=of[order[0]] - 1)) if len(of) else []
            for at in np.split(order, starts[1:]) if len(of) else ():
                s = int(of[at[0]])
                self.waiting.updateValue((s, n), (users[at].tolist(), *(c[at].astype(np.int64).tobytes() for c in (t, ids, amounts))))
                n += 1
                first = s if first is None else min(first, s)
        self.parts.update((n, first))
        if first is not None and first != before:
            self.handle.registerTimer((first + 1) * self.slice_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = timerValues.getCurrentWatermarkInMs() // self.slice_ms      # slices before it are complete
        waiting = sorted(tuple(k) for k in self.waiting.keys())
        due = [k for k in waiting if k[0] < end]
        for held in self._portions(due):
            users = np.array([u for part in held for u in part[0]], dtype=object)
            t, ids, amounts = (_longs(part[c] for part in held) for c in (1, 2, 3))
            codes, names = pd.factorize(users)
            order = np.lexsort((ids, t, codes))
            found = self.answer(names, codes[order], t[order], amounts[order])
            yield pd.DataFrame({"_user": users[order], "_t": t[order], "_id": ids[order], "_amount": amounts[order], **found})
        if len(due) == len(waiting):
            self.parts.clear()
        elif due:
            later = waiting[len(due)][0]
            self.parts.update((self.parts.get()[0], later))
            self.handle.registerTimer((later + 1) * self.slice_ms)
        self.leave(end)

    def _portions(self, due: list[tuple[int, int]]) -> Iterator[list[tuple]]:
        """The parts of whole slices, in order, taken out in portions of about ``AT_ONCE`` rows."""
        held, rows = [], 0
        for _, keys in itertools.groupby(due, key=lambda k: k[0]):
            if rows > AT_ONCE:
                yield held
                held, rows = [], 0
            for k in keys:
                held.append(self.waiting.getValue(k))
                self.waiting.removeKey(k)
                rows += len(held[-1][0])
        if held:
            yield held

    def leave(self, end: int) -> None:
        """All slices before ``end`` are done."""

    def close(self) -> None:
        pass


class VelocityProcessor(_Sliced):
    """Events in ``[t - span, t]``, later ones of the same time excluded."""

    def __init__(self, slice_us: int, span: int):
        super().__init__(slice_us)
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.recent = handle.getValueState("recent", "user array<string>, t binary")

    def _recent(self) -> tuple[np.ndarray, np.ndarray]:
        users, t = self.recent.get() or ([], b"")
        return np.array(users, dtype=object), _longs([t])

    def _keep(self, users: np.ndarray, t: np.ndarray) -> None:
        if len(t):
            self.recent.update((users.tolist(), t.tobytes()))
        else:
            self.recent.clear()

    def answer(self, names: np.ndarray, codes: np.ndarray, t: np.ndarray, amounts: np.ndarray) -> dict:
        users, before = self._recent()
        mine = np.concatenate([pd.Index(names).get_indexer(users), codes])      # -1: not among these rows
        times = np.concatenate([before, t])
        # an event's window opens after all events of its user before (t - span)
        events = len(times)
        kind = np.concatenate([np.ones(events, dtype=np.int8), np.zeros(len(t), dtype=np.int8)])
        order = np.lexsort((kind, np.concatenate([times, t - self.span]), np.concatenate([mine, codes])))
        seen = np.empty(len(order), dtype=np.int64)
        seen[order] = np.cumsum(kind[order], dtype=np.int64)       # events up to here, this one included
        kept = times >= (t.max() // self.slice_us + 1) * self.slice_us - self.span
        self._keep(np.concatenate([users, names[codes]])[kept], times[kept])
        return {"velocity": seen[len(before):events] - seen[events:]}

    def leave(self, end: int) -> None:
        users, t = self._recent()
        kept = t >= end * self.slice_us - self.span
        if not kept.all():
            self._keep(users[kept], t[kept])
        if kept.any():
            # by then all of them are over a span old
            self.handle.registerTimer((end + -(-self.span // self.slice_us) + 1) * self.slice_ms)


class ProfileProcessor(_Sliced):
    """Number and sum of the previous ``depth`` amounts."""

    def __init__(self, slice_us: int, depth: int):
        super().__init__(slice_us)
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getMapState("last", "user string", "amount binary")

    def answer(self, names: np.ndarray, codes: np.ndarray, t: np.ndarray, amounts: np.ndarray) -> dict:
        held = [self.last.getValue((u,)) for u in names]
        before = [_longs(h or ()) for h in held]
        old = np.array([len(b) for b in before], dtype=np.int64)
        both = np.concatenate([np.repeat(np.arange(len(names)), old), codes])
        order = np.argsort(both, kind="stable")         # a user's history, then the new rows in their order
        amount = np.concatenate([*before, amounts])[order]
        ends = np.cumsum(np.bincount(both, minlength=len(names)))
        starts = np.concatenate([[0], ends[:-1]])
        at = np.empty(len(order), dtype=np.int64)
        at[order] = np.arange(len(order))
        at = at[old.sum():]
        n = np.minimum(at - starts[codes], self.depth)
        total = np.concatenate([[0], np.cumsum(amount)])
        for u, a, b in zip(names, starts, ends):
            self.last.updateValue((u,), (amount[max(a, b - self.depth):b].tobytes(),))
        return {"prior_n": n.astype(np.int32), "prior_sum": total[at] - total[at - n]}


def _run(stream: DataFrame, user: str, ts: str, id_col: str, amount: str, delay: str, processor: StatefulProcessor,
         answers: str) -> DataFrame:
    cents = (F.col(amount).cast("decimal(18,2)") * 100).cast("bigint")
    # as text, and never null: pandas would hold whole numbers with nulls among them as doubles
    name = F.coalesce(F.concat(F.lit("="), F.col(user).cast("string")), F.lit(""))
    rows = (stream.select(F.pmod(F.xxhash64(name), F.lit(BUCKETS)).alias("_bucket"), name.alias("_user"), event_time(F.col(ts)).alias("_ts"),
                          F.col(id_col).cast("bigint").alias("_id"), cents.alias("_amount"))
            .filter(F.col("_ts").isNotNull() & F.col("_amount").isNotNull() & F.col("_id").isNotNull())
            .withColumn("_t", F.unix_micros("_ts")).withWatermark("_ts", delay))
    return rows.groupBy("_bucket").transformWithStateInPandas(
        processor, f"_user string, _t bigint, _id bigint, _amount bigint, {answers}", "append", "EventTime")


def _slice(width: str) -> int:
    if (us := span_us(width)) % 1000:
        raise ValueError("a slice is a whole number of milliseconds")
    return us


def _named(out: DataFrame, stream: DataFrame, user: str, ts: str, id_col: str, amount: str, *answers) -> DataFrame:
    back = F.timestamp_micros("_t").cast(stream.schema[ts].dataType)
    money = (F.col("_amount").cast("decimal(20,0)") / 100).cast(
        stream.schema[amount].dataType if stream.schema[amount].dataType.typeName() == "decimal" else "decimal(18,2)")
    who = F.when(F.col("_user") != "", F.substring("_user", 2, 2**31 - 1).cast(stream.schema[user].dataType))
    return out.select(F.col("_id").alias(id_col), who.alias(user), back.alias(ts), money.alias(amount), *answers)


def velocity_events(stream: DataFrame, user: str, ts: str, id_col: str, amount: str, span: str = "60 seconds",
                    delay: str = "1 minute", slice_width: str = "1 minute", alias: str = "velocity") -> DataFrame:
    """T4: (id, user, ts, amount, ``alias``) of every event, once the watermark has passed its slice."""
    processor = VelocityProcessor(_slice(slice_width), span_us(span))
    out = _run(stream, user, ts, id_col, amount, delay, processor, "velocity bigint")
    return _named(out, stream, user, ts, id_col, amount, F.col("velocity").alias(alias))


def profile_events(stream: DataFrame, user: str, ts: str, id_col: str, amount: str, depth: int = 50,
                   delay: str = "1 minute", slice_width: str = "1 minute") -> DataFrame:
    """T5: (id, user, ts, amount, prior_n, prior_sum) of every event; flag it with
    :func:`keelson.operators.fraud.flag_outliers` (ratio rule)."""
    processor = ProfileProcessor(_slice(slice_width), depth)
    out = _run(stream, user, ts, id_col, amount, delay, processor, "prior_n int, prior_sum bigint")
    total = (F.col("prior_sum").cast("decimal(20,0)") / 100).cast("decimal(20,2)")
    return _named(out, stream, user, ts, id_col, amount, "prior_n", F.when(F.col("prior_n") > 0, total).alias("prior_sum"))
