"""J1, J2, J3 and J5 on live messages: orders and payments of an id meet in
one keyed state (``transformWithState``), in whatever order they arrive.

``live_match``: the first order of an id (J2, by arrival) is value state; a
payment that comes before it waits in list state and is released by it (J1).
With a horizon, event-time timers bound the state: a payment that has waited
for that long is given up, and emitted without a platform when
``unmatched=True`` (J3), and an id's first order is forgotten when nothing
came for the id for that long. Without a horizon the state is kept for the
whole run.

``arrived_match`` (J5): per platform, the arrival of the id's first order is
state; a payment is emitted for the platforms on which its order had arrived
before it, and never waits.

``end_marker`` is the end of a topic (S4) as a control row: its time lies past
the horizon, so the watermark that it moves fires every timer left.

Scale: ids are dealt to ``PAGES`` state keys by hash. A page has one value (its
ids' first orders, which of them have waiting payments, one timer) and a list
of the waiting payments in blobs, which is only read when an order or the
watermark releases some of them. Rows reach the processors and leave them in
packs (one binary of many rows of a page): Spark hands rows to a processor cell by
cell, which costs many times what the matching does. What is late is judged here,
not by Spark before the state: a row that is older than the watermark is matched,
or given up where its horizon has passed. A hot id
is split over pages: ``hot`` (of ``operators.skew.hot_keys``) names the ids and
the number of salts; a payment's salt is a hash of its row, an order goes to
each salt of its id. Payments without an id match nothing: they are dropped, or
with ``unmatched=True`` dealt over ``NULL_SALTS`` salts and given up like
others. Orders without an id are dropped.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyflow.constants import LATE_MINUTES
from tallyflow.functions.time import event_time
from tallyflow.operators.skew import with_salts
from tallyflow.sources.feeds import payments_source

# The processors are shipped by value (see streaming/state.py).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE_MS = 60_000
NULL_SALTS = 1024
#: Ids share this many state keys, so that a micro-batch goes to the state store
#: a few times per page and not several times per id.
PAGES = 8192
#: Payments that go to the state store at once.
CHUNK = 1000
PAYMENT = "arrival long, amount_cents long, pay_source int, pay_platform int, minute long, create_time_ms long"
FIELDS = ["arrival", "amount_cents", "pay_source", "pay_platform", "minute", "create_time_ms"]
MATCHED = "arrival long, order_id long, amount_cents long, pay_source int, pay_platform int, minute long, platform int"
MESSAGES = f"is_order boolean, order_id long, platform int, {PAYMENT}"
#: The columns of a packed row, as 64-bit integers and a last one that has a bit
#: per null.
PACKED = ["is_order", "order_id", "_salt", "platform", *FIELDS]
#: Rows that a task packs at a time.
PACK_ROWS = 1 << 18
#: Rows of a pack that a processor emits.
OUT_ROWS = 1 << 14


def messages(payments: DataFrame, orders: DataFrame, cents_mode: str = "exact") -> DataFrame:
    """Payments and orders (streams or tables, both with ``arrival`` and
    ``create_time_ms``) as one feed of tagged rows."""
    p = payments_source(payments, cents_mode).select(F.lit(False).alias("is_order"), "order_id", *FIELDS)
    o = orders.select(F.lit(True).alias("is_order"), "order_id", "platform", "arrival", "create_time_ms")
    rows = p.unionByName(o, allowMissingColumns=True)
    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in (f.split() for f in MESSAGES.split(", "))))


def end_marker(feed: DataFrame, horizon_minutes: int, late_minutes: int = LATE_MINUTES) -> DataFrame:
    """One control row (no kind, no id) after a whole ``feed`` of messages,
    far enough ahead for everything that waits to be given up."""
    ahead = (horizon_minutes + late_minutes + 3) * MINUTE_MS
    last = feed.agg(F.max("arrival").alias("arrival"), F.max("create_time_ms").alias("create_time_ms"))
    names = {f.split()[0]: f.split()[1] for f in MESSAGES.split(", ")}
    own = {"arrival": F.col("arrival") + 1, "create_time_ms": F.col("create_time_ms") + F.lit(ahead)}
    return last.select(*(own.get(c, F.lit(None)).cast(t).alias(c) for c, t in names.items()))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_page, rows) of each page among PACK_ROWS rows (_page, then PACKED)."""
    pages, parts, n = [], [], 0

    def packs():
        page, rows = np.concatenate(pages), np.concatenate(parts)
        order = np.argsort(page, kind="stable")
        page, rows = page[order], rows[order]
        cut = np.flatnonzero(np.diff(page)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(page)]))
        # One buffer: a pack is a run of its bytes.
        width = rows.shape[1] * 8
        at = np.concatenate((starts, ends[-1:])).astype(np.int64) * width
        packed = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(rows.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(page[starts]), packed.cast(pa.binary())], ["_page", "rows"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.zeros((batch.num_rows, len(PACKED) + 1), np.int64)
        for k in range(len(PACKED)):
            column = batch.column(k + 1)
            if column.null_count:
                rows[:, -1] |= column.is_null().to_numpy(zero_copy_only=False).astype(np.int64) << k
            rows[:, k] = pc.fill_null(column.cast(pa.int64()), 0).to_numpy()
        pages.append(batch.column(0).to_numpy())
        parts.append(rows)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield packs()
            pages, parts, n = [], [], 0
    if n:
        yield packs()


def _rows(packed: Iterator[Row]) -> Iterator[tuple]:
    """(is_order, key, platform, payment) of the rows of ``packed``; not the
    control rows."""
    for pack in packed:
        rows = np.frombuffer(pack["rows"], np.int64).reshape(-1, len(PACKED) + 1)
        for first in range(0, len(rows), OUT_ROWS):
            for *row, nulls in rows[first : first + OUT_ROWS].tolist():
                if nulls:
                    row = [None if nulls >> k & 1 else x for k, x in enumerate(row)]
                if row[0] is not None:
                    yield row[0], (row[1], row[2]), row[3], tuple(row[4:])


def _packs(matched: Iterator[tuple]) -> Iterator[Row]:
    out = []
    for row in matched:
        out.append(row)
        if len(out) >= OUT_ROWS:
            yield Row(rows=pickle.dumps(out))
            out = []
    if out:
        yield Row(rows=pickle.dumps(out))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f.split() for f in MATCHED.split(", ")]
    kinds = [pa.int64() if kind == "long" else pa.int32() for _, kind in fields]
    for batch in batches:
        rows = []
        for k, pack in enumerate(batch.column(0), 1):
            rows += pickle.loads(pack.as_py())
            if rows and (len(rows) >= OUT_ROWS or k == batch.num_rows):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])
                rows = []


def _matched(order_id: int | None, pay: tuple, platform: int | None) -> tuple:
    """A row of MATCHED."""
    arrival, cents, source, pay_platform, minute, _ = pay
    return arrival, order_id, cents, source, pay_platform, minute, platform


def _earlier(order: tuple, than: tuple | None) -> bool:
    """Whether an order's (arrival, platform) comes first; nulls come last."""
    return than is None or [(x is None, x or 0) for x in order] < [(x is None, x or 0) for x in than]


class _Waiting:
    """A list state of (key, payment) in blobs of up to ``CHUNK`` of them.
    The last ``CHUNK`` are in memory until ``close``."""

    def __init__(self, state):
        self.state, self.fresh, self.added, self.keys, self.oldest = state, [], 0, set(), None

    def add(self, key: tuple, pay: tuple) -> None:
        self.fresh.append((key, pay))
        self.added += 1
        self.keys.add(key)
        time_ms = pay[-1] or 0
        self.oldest = time_ms if self.oldest is None else min(self.oldest, time_ms)
        if len(self.fresh) >= CHUNK:
            self.close()

    def close(self) -> None:
        if self.fresh:
            self.state.appendValue((pickle.dumps(self.fresh),))
        self.fresh = []

    def __iter__(self) -> Iterator[tuple]:
        for blob in self.state.get():
            yield from pickle.loads(blob[0])
        yield from self.fresh


class _LiveMatch(StatefulProcessor):
    """A page of ids. ``page`` holds (first, waits, oldest, side, timer, low):
    per key (id, salt) the platform of its first order and the newest time seen;
    the keys with waiting payments and the oldest time of these; which of the
    two lists has them; the time of the page's timer; a time that none of the
    newest times is below."""

    def __init__(self, horizon_ms: int | None, unmatched: bool):
        self.horizon_ms = horizon_ms
        self.unmatched = unmatched

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "held binary")
        self.lists = [handle.getListState(f"waiting{side}", "payments binary") for side in (0, 1)]

    def _deadline(self, time_ms: int | None) -> int:
        # Whole minutes, so that a page's timer moves at most once per minute.
        return ((time_ms or 0) // MINUTE_MS + 1) * MINUTE_MS + self.horizon_ms

    def _load(self, now: int | None) -> None:
        held = self.page.get()
        self.stored = held is not None
        empty = ({}, set(), None, 0, None, None)
        self.first, waits, oldest, self.side, self.timer, self.low = pickle.loads(held[0]) if self.stored else empty
        self.waiting = _Waiting(self.lists[self.side])
        self.waiting.keys, self.waiting.oldest = waits, oldest
        if now is not None and self.first and self._deadline(self.low) <= now:  # what nothing came for is forgotten
            self.first = {k: v for k, v in self.first.items() if self._deadline(v[1]) > now}
            self.low = min((time_ms for _, time_ms in self.first.values()), default=None)

    def _released(self, now: int | None, first: dict) -> Iterator[tuple]:
        """What has run out is given up, what has its order in ``first`` is
        matched; the others go on to the other list."""
        late = now is not None and self.waiting.keys and self._deadline(self.waiting.oldest) <= now
        if not late and self.waiting.keys.isdisjoint(first):
            return
        side = 1 - self.side
        kept = _Waiting(self.lists[side])
        for key, pay in self.waiting:
            if now is not None and self._deadline(pay[-1]) <= now:
                if self.unmatched:
                    yield _matched(key[0], pay, None)
            elif key in first:
                yield _matched(key[0], pay, first[key])
            else:
                kept.add(key, pay)
        self.lists[self.side].clear()
        self.waiting, self.side = kept, side

    def _store(self, now: int | None) -> None:
        self.waiting.close()
        if not self.first and not self.waiting.keys:
            if self.stored:
                self.page.clear()
            at = None
        elif now is None:
            at = None
        else:
            oldest = [self._deadline(self.low)] if self.first else []
            if self.waiting.keys:
                oldest.append(self._deadline(self.waiting.oldest))
            at = max(min(oldest), now + 1)
        if at != self.timer:
            if self.timer is not None and self.timer > now:
                self.handle.deleteTimer(self.timer)
            if at is not None:
                self.handle.registerTimer(at)
        if self.first or self.waiting.keys:
            self.page.update((pickle.dumps((self.first, self.waiting.keys, self.waiting.oldest, self.side, at, self.low)),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from _packs(self._answers(_rows(rows), timerValues))

    def _answers(self, rows: Iterator[tuple], timerValues) -> Iterator[tuple]:
        # Spark fires timers after a batch's rows: what has run out is judged here.
        now = None if self.horizon_ms is None else timerValues.getCurrentWatermarkInMs()
        self._load(now)
        best, newest = {}, {}
        for is_order, k, platform, pay in rows:
            if now is not None:
                newest[k] = max(newest.get(k, 0), pay[-1] or 0)
            if is_order:
                order = (pay[0], platform)
                if k not in self.first and _earlier(order, best.get(k)):
                    best[k] = order
            elif k in self.first:
                yield _matched(k[0], pay, self.first[k][0])
            else:
                self.waiting.add(k, pay)
        yield from self._released(now, {k: platform for k, (_, platform) in best.items()})
        for k, (_, platform) in best.items():
            self.first[k] = (platform, 0)
        for k, time_ms in newest.items():
            if k in self.first:
                platform, before = self.first[k]
                last = max(before, time_ms)
                self.first[k] = (platform, last)
                self.low = last if self.low is None else min(self.low, last)
        self._store(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        self._load(now)
        yield from _packs(self._released(now, {}))
        self._store(now)

    def close(self) -> None:
        pass


class _ArrivedMatch(StatefulProcessor):
    """A page of ids: per key (id, salt) and platform its first order's arrival."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "held binary")
        self.held = handle.getListState("held", "payments binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from _packs(self._answers(_rows(rows)))

    def _answers(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        stored = self.seen.get()
        seen = {} if stored is None else pickle.loads(stored[0])
        fresh: dict[tuple, dict] = {}
        held = _Waiting(self.held)  # until the micro-batch's orders are known
        for is_order, k, platform, pay in rows:
            arrival = pay[0]
            if not is_order:
                held.add(k, pay)
            elif platform not in seen.get(k, ()) and arrival is not None:
                own = fresh.setdefault(k, {})
                own[platform] = min(arrival, own.get(platform, arrival))
        for k, own in fresh.items():
            seen[k] = seen.get(k, {}) | own
        if fresh:
            self.seen.update((pickle.dumps(seen),))
        spilled = len(held.fresh) < held.added
        for k, pay in held:
            for platform, arrival in seen.get(k, {}).items():
                if pay[0] is not None and pay[0] > arrival:
                    yield _matched(k[0], pay, platform)
        if spilled:
            self.held.clear()

    def close(self) -> None:
        pass


def _processed(keyed: DataFrame, processor: StatefulProcessor, mode: str) -> DataFrame:
    """The rows of MATCHED that ``processor`` makes of the pages of ``keyed``."""
    page = F.pmod(F.xxhash64("order_id", "_salt"), F.lit(PAGES)).cast("int").alias("_page")
    packed = keyed.select(page, *PACKED).mapInArrow(_pack, "_page int, rows binary")
    out = packed.groupBy("_page").transformWithState(processor, "rows binary", "append", mode)
    return out.mapInArrow(_unpack, MATCHED)


def _keyed(feed: DataFrame, hot: DataFrame | None, nulls: bool) -> DataFrame:
    """The messages with ``_salt``, orders once per salt of their id. One pass
    without filters: a control row must reach the watermark."""
    salts = F.lit(1) if hot is None else F.coalesce("_salts", F.lit(1))
    rows = feed if hot is None else with_salts(feed, hot, "order_id")
    dealt = lambda n: F.array(F.pmod(F.xxhash64(*FIELDS), n).cast("int"))
    none = F.array().cast("array<int>")
    no_id = F.col("order_id").isNull()
    at = (
        F.when(F.col("is_order").isNull(), F.array(F.lit(0)))
        .when(F.col("is_order"), F.when(no_id, none).otherwise(F.sequence(F.lit(0), salts - 1)))
        .otherwise(F.when(no_id, dealt(F.lit(NULL_SALTS)) if nulls else none).otherwise(dealt(salts)))
    )
    return rows.withColumn("_salt", F.explode(at)).drop("_salts")


def live_match(
    feed: DataFrame,
    horizon_minutes: int | None = None,
    unmatched: bool = False,
    late_minutes: int = LATE_MINUTES,
    hot: DataFrame | None = None,
) -> DataFrame:
    """J1/J2 over a stream of ``messages``: every payment whose order comes,
    with the platform of its id's first order; with ``unmatched=True`` also
    the payments whose order did not come within the horizon (J3), with a
    null platform."""
    if unmatched and horizon_minutes is None:
        raise ValueError("unmatched=True needs a horizon: without one a payment waits for the whole run")
    if horizon_minutes is not None:
        feed = feed.withColumn("_time", event_time("create_time_ms")).withWatermark("_time", f"{late_minutes + 1} minutes")
    keyed = _keyed(feed, hot, unmatched)
    horizon_ms = None if horizon_minutes is None else horizon_minutes * MINUTE_MS
    mode = "None" if horizon_minutes is None else "EventTime"
    return _processed(keyed, _LiveMatch(horizon_ms, unmatched), mode)


def arrived_match(feed: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """J5 over a stream of ``messages`` in arrival order (a micro-batch may
    hold its rows in any order)."""
    return _processed(_keyed(feed, hot, False), _ArrivedMatch(), "None")
