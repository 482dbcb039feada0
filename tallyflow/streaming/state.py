"""D2 on a stream: per order id, the fingerprint of its previous payment is
kept as state (``applyInPandasWithState``), and a payment is emitted only if
its fingerprint differs. Rows of one id within a micro-batch are taken in
arrival order; across batches the source's order is the arrival order.

Ids are dealt to pages by hash; a page's rows are compared as arrays in one
call, with one state row of three longs per order id. As in the reference it is never evicted
(``NoTimeout``); with ``timeout_minutes`` it is dropped after that much
event time without a payment for the order, bounding state on long runs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallyflow.functions.codes import payment_fingerprint
from tallyflow.functions.time import event_time
from tallyflow.sources.feeds import payments_source

CHANGED_SCHEMA = StructType(
    [
        StructField("arrival", LongType()),
        StructField("order_id", LongType()),
        StructField("minute", LongType()),
        StructField("amount_cents", LongType()),
        StructField("pay_platform", IntegerType()),
        StructField("fingerprint", LongType()),
    ]
)
STATE_SCHEMA = "ids binary, fps binary, ends binary"

#: Ids share this many state rows, so that a micro-batch calls the state
#: function once per page and not once per id.
PAGES = 1024
#: The page of the null id.
NO_ID = -1

# The state function runs in executor Python workers. Ship it by value (code
# and the globals it reads) so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _changed(
    key, batches: Iterator[pd.DataFrame], state: GroupState, timeout_ms: int | None = None
) -> Iterator[pd.DataFrame]:
    """One page of ids: their previous fingerprints (``ids`` ascending) and
    when they expire."""
    none = np.zeros(0, np.int64)
    ids, fps, ends = (np.frombuffer(b, np.int64) for b in state.get) if state.exists else (none, none, none)
    now = None if timeout_ms is None else state.getCurrentWatermarkMs()
    seen, changed = none, None
    if not state.hasTimedOut:
        rows = pd.concat(list(batches), ignore_index=True)
        # The page of the null id holds no other.
        oid = np.zeros(len(rows), np.int64) if key[0] == NO_ID else rows["order_id"].to_numpy(np.int64)
        fp = rows["fingerprint"].fillna(0).to_numpy(np.int64)
        order = np.lexsort((fp, rows["arrival"].to_numpy(), oid))
        rows, oid, fp = rows.iloc[order], oid[order], fp[order]
        null = rows["fingerprint"].isna().to_numpy()
        at = np.flatnonzero(np.concatenate(([True], oid[1:] != oid[:-1])))
        seen, last = oid[at], np.append(at[1:], len(oid)) - 1
        pos = np.searchsorted(ids, seen)
        known = np.zeros(len(seen), bool)
        known[pos < len(ids)] = ids[pos[pos < len(ids)]] == seen[pos < len(ids)]
        prev, none_before = np.append(0, fp[:-1]), np.append(True, null[:-1])
        prev[at[known]] = fps[pos[known]]
        none_before[at] = ~known
        changed = rows.loc[none_before | null | (prev != fp), [f.name for f in CHANGED_SCHEMA.fields]]
    kept = ~np.isin(ids, seen)
    if now is not None:
        kept &= ends >= now
    ids, fps, ends = ids[kept], fps[kept], ends[kept]
    if len(seen):
        # Expire after ``timeout_ms`` of event time without a payment for the
        # order; never at or before the current watermark (Spark rejects it).
        newest = np.zeros(len(seen), np.int64)
        if now is not None:
            time_ms = rows["create_time_ms"].fillna(0).to_numpy(np.int64)
            newest = np.maximum(np.maximum.reduceat(time_ms, at) + timeout_ms, now + 1)
        held = ~null[last]  # after a payment without a fingerprint any payment is a change
        ids, fps, ends = (np.append(x, y[held]) for x, y in ((ids, seen), (fps, fp[last]), (ends, newest)))
        order = np.argsort(ids)
        ids, fps, ends = ids[order], fps[order], ends[order]
    if len(ids):
        state.update((ids.tobytes(), fps.tobytes(), ends.tobytes()))
        if now is not None:
            state.setTimeoutTimestamp(max(int(ends.min()), now + 1))
    elif state.exists:
        state.remove()
    if changed is not None:
        yield changed


def changed_payments_stream(payments: DataFrame, timeout_minutes: int | None = None) -> DataFrame:
    """Streaming D2 over raw payments (``arrival`` and the payment columns)."""
    p = payments_source(payments)
    fp = payment_fingerprint("amount_cents", "pay_source", "pay_platform", "minute")
    d = p.select(
        "arrival", "order_id", "minute", "amount_cents", F.col("pay_platform").cast("int").alias("pay_platform"),
        fp.alias("fingerprint"), "create_time_ms",
    )
    page = F.when(F.col("order_id").isNull(), F.lit(NO_ID)).otherwise(F.pmod(F.xxhash64("order_id"), F.lit(PAGES)).cast("int"))
    d = d.withColumn("_page", page)
    if timeout_minutes is None:
        return d.groupBy("_page").applyInPandasWithState(
            _changed, CHANGED_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
        )
    timeout_ms = timeout_minutes * 60_000
    d = d.withColumn("event_ts", event_time("create_time_ms")).withWatermark("event_ts", f"{timeout_minutes} minutes")
    return d.groupBy("_page").applyInPandasWithState(
        partial(_changed, timeout_ms=timeout_ms), CHANGED_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout,
    )
