"""W3 on a stream: the gap-resetting wireless/PC ratio, micro-batch by
micro-batch (``foreachBatch``).

State: the cents of every (device, minute) seen, two rows a minute, in a
table versioned by batch id. Each batch adds its own sums, runs the two-level
run detection (``island_totals``) over the minutes kept, and publishes every
minute from the earliest one that it touched: a late payment changes its own
minute and all later ones of its run, and closes or opens gaps, as the
per-minute maps of a message-at-a-time implementation would show it. The
result equals batch W3 in whatever order the payments arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.constants import DEFAULT_TEAM, RATIO_PREFIX
from tallyflow.functions.codes import result_key
from tallyflow.functions.time import minute_epoch_seconds
from tallyflow.operators.windows import device_minute_cents, device_ratios
from tallyflow.sinks.metrics_store import MetricsTable
from tallyflow.sources.feeds import payments_source


class ResetRatioStream:
    """Cents are kept as doubles, exact up to 2**53 per device and minute."""

    def __init__(
        self, spark: SparkSession, root: str, team: str = DEFAULT_TEAM, compact_every: int = 50, cents_mode: str = "exact"
    ):
        self.spark = spark
        self.team = team
        self.compact_every = compact_every
        self.cents_mode = cents_mode
        self.table = MetricsTable(spark, f"{root.rstrip('/')}/ratio")
        self.state = MetricsTable(spark, f"{root.rstrip('/')}/state")

    def _kept(self, batch_id: int) -> DataFrame:
        part = F.split("key", ":")
        return self.state.read(before=batch_id).select(
            part[0].cast("int").alias("device"), part[1].cast("long").alias("minute"), F.col("value").cast("long").alias("cents")
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        # Two rows a minute of the batch: read by the branches below.
        new = device_minute_cents(payments_source(batch, self.cents_mode)).cache()
        try:
            first = new.agg(F.min("minute")).first()[0]
            if first is None:
                return
            kept = self._kept(batch_id)
            merged = kept.unionByName(new).groupBy("device", "minute").agg(F.sum("cents").alias("cents"))
            ratios = device_ratios(merged).where(F.col("minute") >= first)
            self.table.upsert(
                ratios.select(
                    result_key(RATIO_PREFIX, self.team, minute_epoch_seconds("minute")).alias("key"), F.col("ratio").alias("value")
                ),
                batch_id,
            )
            touched = merged.join(new.select("device", "minute"), ["device", "minute"], "left_semi")
            self.state.upsert(
                touched.select(
                    F.concat_ws(":", "device", "minute").alias("key"), F.col("cents").cast("double").alias("value")
                ),
                batch_id,
            )
        finally:
            new.unpersist()
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.state.compact(batch_id)
            self.table.compact(batch_id)

    def start(self, payments: DataFrame, checkpoint: str, trigger: dict | None = None):
        return (
            payments.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
