"""The whole live flow on Structured Streaming: payment and order streams in,
the three metrics (M1, M2, M3) out, in one key -> value view.

M1/M2: D1 with a watermark on the payments, then payments ⋈ orders as a
stream-stream join (J1; the first order of an id wins, J2), then
``foreachBatch`` adds each micro-batch's cents per (platform, minute) to a
cents table. A
stream-stream join only runs in append mode, so the running sums are kept
by the sink rather than by a streaming aggregation: every batch publishes
the minutes it changed, the newest included (T4, T5).

M3: the arrival-order ratio (T6) on the payment stream alone.

Both sinks read their state as of the batches before the current one and
write one folder per batch id, so a retried batch rewrites the same result.
The cents table is compacted every ``compact_every`` batches so reads stay
bounded on long runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.constants import DEFAULT_TEAM, LATE_MINUTES
from tallyflow.functions.money import from_cents
from tallyflow.functions.time import minute_start
from tallyflow.operators.dedup import D1_KEYS
from tallyflow.sinks.metrics_store import MetricsTable
from tallyflow.sources.feeds import payments_source
from tallyflow.streaming.matching import match_payments_stream
from tallyflow.streaming.turnover import ArrivalOrderRatio, turnover_metric_rows


class LiveMetrics:
    """Runs M1/M2 and M3 as two streaming queries over the same payment
    stream and exposes the published metrics as one ``key, value`` frame.

    ``payments``: payment columns plus ``arrival``; ``orders``: ``order_id,
    platform, create_time_ms``. Works on file or Kafka streams alike. The
    cents table stores sums as doubles, exact up to 2^53 cents per minute.
    ``cents_mode="truncate"`` truncates cents on both streams (F1);
    ``horizon_minutes`` bounds the join state, at the price of matches further
    apart than that (off by default: state is kept for the whole run)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        team: str = DEFAULT_TEAM,
        compact_every: int = 50,
        cents_mode: str = "exact",
        horizon_minutes: int | None = None,
    ):
        self.cents_mode = cents_mode
        self.horizon_minutes = horizon_minutes
        self.spark = spark
        self.team = team
        self.compact_every = compact_every
        self.cents = MetricsTable(spark, f"{root.rstrip('/')}/turnover_cents")
        self.ratio = ArrivalOrderRatio(spark, f"{root.rstrip('/')}/ratio", team, cents_mode=cents_mode)

    def _add_cents(self, batch: DataFrame, batch_id: int) -> None:
        delta = batch.groupBy("platform", "minute").agg(F.sum("amount_cents").alias("turnover"))
        keyed = turnover_metric_rows(delta, self.team).withColumnRenamed("value", "cents")
        current = self.cents.read(before=batch_id, keys=keyed.select("key"))
        merged = keyed.join(current, "key", "left").select(
            "key", (F.col("cents") + F.coalesce("value", F.lit(0.0))).alias("value")
        )
        self.cents.upsert(merged, batch_id)
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.cents.compact(batch_id)

    def turnover_matches(self, payments: DataFrame, orders: DataFrame, late_minutes: int = LATE_MINUTES) -> DataFrame:
        """Deduplicated, matched payments (D1 -> J2 -> J1) on streams.

        D1 runs before the join (it commutes with it: the platform is a
        function of the order id): a payment released from the join state
        when its order finally arrives may be far behind the watermark, and
        must still be counted. The join itself has no event-time condition,
        so it drops nothing as late."""
        p = (
            payments_source(payments, self.cents_mode)
            .withColumn("minute_ts", minute_start("create_time_ms"))
            .withWatermark("minute_ts", f"{late_minutes + 1} minutes")
            .dropDuplicates([*D1_KEYS, "minute_ts"])
        )
        return match_payments_stream(p, orders, horizon_minutes=self.horizon_minutes, normalised=True)

    def start(self, payments: DataFrame, orders: DataFrame, checkpoint_root: str, trigger: dict | None = None):
        trig = trigger or {"availableNow": True}
        q_turnover = (
            self.turnover_matches(payments, orders)
            .writeStream.outputMode("append")
            .foreachBatch(self._add_cents)
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/turnover")
            .trigger(**trig)
            .start()
        )
        q_ratio = self.ratio.start(payments, f"{checkpoint_root.rstrip('/')}/ratio", trig)
        return [q_turnover, q_ratio]

    def metrics(self) -> DataFrame:
        """All published metrics as ``key, value``."""
        turnover = self.cents.read().select("key", from_cents("value").alias("value"))
        return turnover.unionByName(self.ratio.table.read())
