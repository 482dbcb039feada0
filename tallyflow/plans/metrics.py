"""End-to-end batch plans for the three published metrics.

M1/M2 (platform turnover): payments -> cents/minute -> D1 distinct ->
sum per (order, minute) -> join the first order of each id (J2, J1) -> sum
per (platform, minute) (A1).

D1 and the sum commute with the join (the platform is a function of the
order id once J2 has run), so both run below it, and all three are served
by ONE shuffle of the payments on ``order_id``: D1's five fields and the
(order, minute) sum both contain the id, and so does the join key. The
order side is shuffled once on ``order_id`` by J2's aggregate, which the
join reuses (or AQE broadcasts it when it measures small).

One shuffle on the id would put a hot id's rows in one task. Hot ids are
therefore found first (a sample of the ``order_id`` column, checkpointed,
about rows / ``rows_per_task`` ids at most) and salted: their payments spread
over as many salt values as their estimated rows need, derived from the five
D1 fields (so copies of a payment share a salt and D1 stays exact), and their
single order row is replicated per salt. The shuffle key becomes (order_id,
salt), after a first distinct (or sum) whose map side combines what a task
has of a payment. With no hot id the plain plan runs.
``rows_per_task=None`` skips the detection. The rows are counted, and beyond
``ROWS_PER_PART`` times the session's shuffle partitions both sides are dealt
over more partitions, so that a task's memory does not grow with the table.

M3 (ratio): payments only (no join, no dedup) -> A2 per minute -> W1
running totals (two-level, parallel per day) -> W2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.aggregates import device_minute_turnover, platform_minute_turnover
from tallyflow.operators.dedup import D1_KEYS, distinct_payments
from tallyflow.operators.matching import first_orders
from tallyflow.operators.skew import AUTO, hot_keys, hot_table, per_salt, salted
from tallyflow.operators.windows import cumulative_turnover, wireless_pc_ratio
from tallyflow.sources.feeds import payments_source


#: Rows of one task of the payments' shuffle (about 0.5 kB of memory each in
#: the distinct, the sum and the join together).
ROWS_PER_PART = 1_000_000


def shuffle_parts(rows: DataFrame) -> int | None:
    """The number of partitions that keeps a task at ``ROWS_PER_PART`` rows;
    None where the session's number of shuffle partitions does."""
    need = -(-rows.count() // ROWS_PER_PART)
    return need if need > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def platform_turnover(
    payments: DataFrame,
    orders: DataFrame,
    arrival_col: str = "arrival",
    cents_mode: str = "exact",
    dedup: bool = True,
    rows_per_task: int | None = AUTO,
) -> DataFrame:
    """M1/M2. Output: ``platform, minute, turnover_cents, turnover``.

    ``dedup=False`` gives A3 (sum without D1)."""
    p = payments_source(payments, cents_mode).select(*D1_KEYS)
    parts = shuffle_parts(p)
    if parts:
        orders = orders.repartition(parts, "order_id")
    first = first_orders(orders, arrival_col).select("order_id", "platform")
    table = None if rows_per_task is None else hot_table(hot_keys(p, "order_id", rows_per_task))
    if table is None:
        keys = ["order_id"]
        p = p.repartition(parts, "order_id") if parts else p.repartition("order_id")
    else:
        keys = ["order_id", "_salt"]
        p = salted(p, table, "order_id", D1_KEYS)
        # Copies of a payment share a salt: a map-side distinct (or sum) per
        # task comes before the shuffle, so the copies of one payment do not
        # travel one by one to the task of their salt.
        if dedup:
            p = p.dropDuplicates([*D1_KEYS, "_salt"])
        else:
            p = p.groupBy(*keys, "minute").agg(F.sum("amount_cents").alias("amount_cents"))
        p = p.repartition(parts, *keys) if parts else p.repartition(*keys)
        first = per_salt(first, table, "order_id")
    if dedup and table is None:
        p = p.dropDuplicates(D1_KEYS)
    per_order = p.groupBy(*keys, "minute").agg(F.sum("amount_cents").alias("amount_cents"))
    return platform_minute_turnover(per_order.join(first, keys, "inner"))


def ratio_metric(payments: DataFrame, cents_mode: str = "exact", dedup: bool = False) -> DataFrame:
    """M3. Output: ``minute, pc_cents, wl_cents, cum_pc_cents, cum_wl_cents, ratio``.

    ``dedup=True`` counts payments equal on the D1 fields once, as M1/M2 do."""
    p = payments_source(payments, cents_mode)
    if dedup:
        p = distinct_payments(p)
    return wireless_pc_ratio(cumulative_turnover(device_minute_turnover(p)))
