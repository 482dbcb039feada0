"""Streaming platform turnover (T1-T5, T7, T8) and the arrival-order ratio.

Turnover: payments stream -> cents/minute -> join the known first order per
id (stream-static; the order table is the dimension) -> D1 with a watermark
-> one-minute tumbling windows (T1) per platform.

Lateness (T2): the watermark trails the newest minute by ``late + 1``
minutes on the minute-start column, so dedup state keeps minute current-5
and drops current-6, as the reference's rewrite range does. Spark moves the
watermark between micro-batches, so the cut takes effect one batch later.

Emit modes: ``append`` publishes a minute once it is closed by the watermark
(T3: the newest minutes stay unpublished until later data closes them);
``update`` publishes every changed minute each batch (T4), which also
publishes the last minute (T5). A processing-time trigger gives the periodic
snapshot (T7: complete, T8: update).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.constants import DEFAULT_TEAM, LATE_MINUTES, PLATFORM_TAOBAO, RATIO_PREFIX, TAOBAO_PREFIX, TMALL_PREFIX
from tallyflow.functions.codes import result_key
from tallyflow.functions.money import from_cents
from tallyflow.functions.time import minute_epoch_seconds, minute_start
from tallyflow.operators.aggregates import device_minute_turnover
from tallyflow.operators.dedup import D1_KEYS
from tallyflow.operators.windows import running_aggregate
from tallyflow.sinks.metrics_store import MetricsTable
from tallyflow.sources.feeds import payments_source


def turnover_stream(
    payments: DataFrame,
    first_orders: DataFrame,
    late_minutes: int = LATE_MINUTES,
    cents_mode: str = "exact",
    platform: int | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Streaming M1/M2: ``platform, minute, turnover_cents, turnover``.

    ``first_orders`` is the static side, re-read by every micro-batch: pass
    a materialised table (one row per order id), not an unevaluated plan
    over the raw orders. With ``platform`` only that platform's payments
    reach the watermark, so lateness is judged against that platform's
    newest minute (one query per platform, as the reference had one
    counter per platform); without it the watermark spans both."""
    p = payments_source(payments, cents_mode).withColumn("minute_ts", minute_start("create_time_ms"))
    matched = p.join(first_orders.select("order_id", "platform"), "order_id", "inner")
    if platform is not None:
        matched = matched.where(F.col("platform") == F.lit(platform))
    # ``dedup=False`` is A3: every payment counts (published on close in
    # append mode, as the unwired minute-close saver intended).
    distinct = matched.withWatermark("minute_ts", f"{late_minutes + 1} minutes")
    if dedup:
        distinct = distinct.dropDuplicates([*D1_KEYS, "minute_ts"])
    agg = distinct.groupBy("platform", F.window("minute_ts", "1 minute").alias("w")).agg(
        F.sum("amount_cents").alias("turnover_cents")
    )
    return agg.select(
        "platform",
        (F.unix_seconds(F.col("w.start")) / F.lit(60)).cast("long").alias("minute"),
        "turnover_cents",
        from_cents("turnover_cents").alias("turnover"),
    )


def turnover_metric_rows(turnover: DataFrame, team: str = DEFAULT_TEAM) -> DataFrame:
    secs = minute_epoch_seconds("minute")
    key = F.when(F.col("platform") == PLATFORM_TAOBAO, result_key(TAOBAO_PREFIX, team, secs)).otherwise(
        result_key(TMALL_PREFIX, team, secs)
    )
    return turnover.select(key.alias("key"), F.col("turnover").alias("value"))


def start_turnover_upsert(
    turnover: DataFrame,
    table: MetricsTable,
    checkpoint: str,
    trigger: dict | None = None,
    team: str = DEFAULT_TEAM,
    output_mode: str = "update",
    compact_every: int = 50,
):
    """Publish into the versioned metrics table, one idempotent version per
    micro-batch (K1).

    ``update`` publishes the changed minutes of each batch (T4, T8 with
    ``trigger={"processingTime": "5 seconds"}``); ``complete`` republishes
    every minute each trigger (the periodic full snapshot, T7)."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        table.upsert(turnover_metric_rows(batch, team), batch_id)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            table.compact(batch_id)

    return (
        turnover.writeStream.outputMode(output_mode)
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_platform_turnover_upserts(
    payments: DataFrame,
    first_orders: DataFrame,
    tables: dict[int, MetricsTable],
    checkpoint_root: str,
    trigger: dict | None = None,
    team: str = DEFAULT_TEAM,
    late_minutes: int = LATE_MINUTES,
):
    """One turnover query per platform (``tables``: platform -> table), each
    with its own watermark. Read the published metrics as the union of the
    tables' ``read()``."""
    return [
        start_turnover_upsert(
            turnover_stream(payments, first_orders, late_minutes, platform=plat),
            table,
            f"{checkpoint_root.rstrip('/')}/platform={plat}",
            trigger,
            team,
        )
        for plat, table in tables.items()
    ]


def start_closed_minutes(turnover: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append mode into a parquet table; a minute appears once closed."""
    return (
        turnover.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class ArrivalOrderRatio:
    """The wireless/PC ratio in arrival order; payments of one arrival
    number (which repeats across the partitions of a topic) go by minute, so
    a retried batch has the same result in whatever order its rows come.

    A payment whose minute is older than the newest minute seen adds to the
    newest (current) minute's totals, never to its own. Each micro-batch
    takes the carried state (newest minute, running PC and wireless cents),
    assigns each payment its effective minute (running max of minute in
    arrival order, two-level), sums per effective minute, continues the
    running totals and upserts ``ratio_<team>_<secs>`` for every minute it
    touched. The state is three numbers, versioned by batch id next to the
    output (read as of the batches before it), so a retried batch starts
    from the same state. The carried totals are stored as doubles, exact
    up to 2^53 cents (about 9e13 in money).
    """

    def __init__(
        self, spark: SparkSession, root: str, team: str = DEFAULT_TEAM, compact_every: int = 50, cents_mode: str = "exact"
    ):
        self.cents_mode = cents_mode
        self.spark = spark
        self.root = root.rstrip("/")
        self.team = team
        self.compact_every = compact_every
        self.table = MetricsTable(spark, f"{self.root}/ratio")
        self.state = MetricsTable(spark, f"{self.root}/state")

    def _prior(self, batch_id: int) -> tuple[int | None, int, int]:
        if batch_id == 0:  # no state before the first batch: no listing, no job
            return None, 0, 0
        vals = {r["key"]: r["value"] for r in self.state.read(before=batch_id).collect()}  # three rows
        if not vals:
            return None, 0, 0
        return int(vals["minute"]), int(vals["pc"]), int(vals["wl"])

    def process(self, batch: DataFrame, batch_id: int) -> None:
        cur, pc0, wl0 = self._prior(batch_id)
        p = payments_source(batch, self.cents_mode).select("arrival", "minute", "pay_platform", "amount_cents")
        # Rows equal in arrival and minute have the same running maximum.
        eff = running_aggregate(p, "arrival", ["minute"], how="max", block=1 << 16, suffix="_eff", ties=("minute",))
        if cur is not None:
            eff = eff.withColumn("minute_eff", F.greatest("minute_eff", F.lit(cur)))
        per = device_minute_turnover(eff.drop("minute").withColumnRenamed("minute_eff", "minute"))
        cum = running_aggregate(per, "minute", ["pc_cents", "wl_cents"], suffix="_cum").select(
            "minute",
            (F.col("pc_cents_cum") + F.lit(pc0)).alias("cum_pc"),
            (F.col("wl_cents_cum") + F.lit(wl0)).alias("cum_wl"),
        ).cache()
        try:
            emitted = cum.where(F.col("cum_pc") != 0).select(
                result_key(RATIO_PREFIX, self.team, minute_epoch_seconds("minute")).alias("key"),
                (F.col("cum_wl").cast("double") / F.col("cum_pc").cast("double")).alias("value"),
            )
            self.table.upsert(emitted, batch_id)
            last = cum.orderBy(F.col("minute").desc()).limit(1)
            state = last.select(
                F.explode(
                    F.array(
                        F.struct(F.lit("minute").alias("key"), F.col("minute").cast("double").alias("value")),
                        F.struct(F.lit("pc").alias("key"), F.col("cum_pc").cast("double").alias("value")),
                        F.struct(F.lit("wl").alias("key"), F.col("cum_wl").cast("double").alias("value")),
                    )
                ).alias("s")
            ).select("s.*")
            # An empty batch writes no state row: the previous one stays newest.
            self.state.upsert(state, batch_id)
            if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
                self.state.compact(batch_id)
                self.table.compact(batch_id)
        finally:
            cum.unpersist()

    def start(self, payments: DataFrame, checkpoint: str, trigger: dict | None = None):
        return (
            payments.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
