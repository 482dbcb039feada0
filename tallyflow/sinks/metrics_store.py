"""The key -> value metrics table: rows (K4), lookup (K2), removal (K3) and
an idempotent, log-structured upsert (K1).

Plain parquet has no MERGE. Each micro-batch therefore writes only its own
updates, reduced to one row per key, into a delta folder named by its batch
id (overwrite: a retried batch rewrites exactly its own folder, so replays
are idempotent). A read resolves the newest value per key with a hash
aggregate (``max_by`` on the batch id, partial step map-side).

``compact`` folds everything up to a batch into ``snapshots/at=<id>`` and
starts a new generation: later deltas go to ``deltas/gen=<id + 1>/``, so a
read lists one snapshot and the deltas written since, never the whole
history. Deletions are tombstones, so they replay like any update. Writing
costs O(updates of the batch), never O(table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyflow.constants import DEFAULT_TEAM, PLATFORM_TAOBAO, RATIO_PREFIX, TAOBAO_PREFIX, TMALL_PREFIX
from tallyflow.functions.codes import result_key
from tallyflow.functions.time import minute_epoch_seconds

METRICS_SCHEMA = StructType([StructField("key", StringType()), StructField("value", DoubleType())])


def metrics_rows(turnover: DataFrame, ratio: DataFrame, team: str = DEFAULT_TEAM) -> DataFrame:
    """K4: all three metrics as one ``(key, value)`` frame.

    ``turnover``: ``platform, minute, turnover``; ``ratio``: ``minute, ratio``.
    """
    secs = minute_epoch_seconds("minute")
    platform_key = F.when(
        F.col("platform") == PLATFORM_TAOBAO, result_key(TAOBAO_PREFIX, team, secs)
    ).otherwise(result_key(TMALL_PREFIX, team, secs))
    m12 = turnover.select(platform_key.alias("key"), F.col("turnover").cast("double").alias("value"))
    m3 = ratio.select(result_key(RATIO_PREFIX, team, secs).alias("key"), F.col("ratio").alias("value"))
    return m12.unionByName(m3)


def lookup_metrics(metrics: DataFrame, keys: DataFrame) -> DataFrame:
    """K2: the metrics rows whose key is in ``keys``."""
    return metrics.join(keys.select("key"), "key", "left_semi")


def remove_metrics(metrics: DataFrame, keys: DataFrame) -> DataFrame:
    """K3: the metrics table without the keys in ``keys``."""
    return metrics.join(keys.select("key"), "key", "left_anti")


class MetricsTable:
    """K1: log-structured key -> value table under ``root`` (a shared folder)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.deltas = f"{self.root}/deltas"
        self.snapshots = f"{self.root}/snapshots"

    def _list(self, folder: str, prefix: str) -> list[int]:
        """Ids of the committed sub-folders ``<prefix><id>`` (one listing;
        the ``_SUCCESS`` check only on the folders a reader needs)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(path))
        return sorted(int(name[len(prefix):]) for name in names if name.startswith(prefix))

    def _committed(self, folder: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def versions(self) -> list[int]:
        """Batch ids written so far, oldest first (all generations)."""
        out: list[int] = []
        for gen in self._list(self.deltas, "gen="):
            out.extend(self._list(f"{self.deltas}/gen={gen:012d}", "batch="))
        return sorted(out)

    def _latest_snapshot(self, before: int | None) -> int | None:
        for sid in reversed(self._list(self.snapshots, "at=")):
            if (before is None or sid < before) and self._committed(f"{self.snapshots}/at={sid:012d}"):
                return sid
        return None

    def _generation(self, snap: int | None) -> str:
        return f"{self.deltas}/gen={0 if snap is None else snap + 1:012d}"

    def _entries(self, before: int | None = None, snapshot_before: int | None = None) -> DataFrame:
        """All (key, value, deleted, batch) entries visible before ``before``:
        the newest snapshot older than it (or than ``snapshot_before``) plus
        that generation's deltas."""
        schema = "key string, value double, deleted boolean"
        parts = []
        snap = self._latest_snapshot(before if snapshot_before is None else snapshot_before)
        if snap is not None:
            parts.append(
                self.spark.read.schema(schema)
                .parquet(f"{self.snapshots}/at={snap:012d}")
                .withColumn("batch", F.lit(snap).cast("long"))
            )
        gen = self._generation(snap)
        if self._list(gen, "batch="):
            d = self.spark.read.schema(schema + ", batch long").option("basePath", gen).parquet(gen)
            if before is not None:
                d = d.where(F.col("batch") < before)
            parts.append(d)
        if not parts:
            return self.spark.createDataFrame([], schema + ", batch long")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Current ``(key, value)`` rows: newest entry per key, tombstones
        dropped. With ``keys`` (one column, ``key``) only those, filtered
        before the newest entries are found."""
        entries = self._entries(before)
        if keys is not None:
            entries = entries.join(keys, "key", "left_semi")
        return _newest(entries)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        gen = self._generation(self._latest_snapshot(before=batch_id))
        rows.write.mode("overwrite").parquet(f"{gen}/batch={batch_id:012d}")

    def upsert(self, updates: DataFrame, batch_id: int, order_col: str | None = None) -> None:
        """Last write wins per key. With ``order_col`` the batch's updates are
        first reduced to their latest row per key; otherwise keys must be
        unique within the batch."""
        if order_col is not None:
            updates = updates.groupBy("key").agg(F.max_by("value", order_col).alias("value"))
        self._write(
            updates.select("key", F.col("value").cast("double"), F.lit(False).alias("deleted")), batch_id
        )

    def remove(self, keys: DataFrame, batch_id: int) -> None:
        """K3 on the table: tombstones for ``keys``."""
        self._write(
            keys.select("key").distinct().select(
                "key", F.lit(None).cast("double").alias("value"), F.lit(True).alias("deleted")
            ),
            batch_id,
        )

    def compact(self, up_to_batch: int) -> None:
        """Fold every entry up to ``up_to_batch`` into one snapshot and start
        a new generation. ``up_to_batch`` must be the newest batch written
        (the sinks compact right after writing it), or later deltas of the
        current generation would be left behind. A snapshot that this batch
        has committed before (a retried batch) is written again from the
        entries that it was made of, not from itself."""
        gen = self._generation(self._latest_snapshot(before=up_to_batch))
        if any(b > up_to_batch for b in self._list(gen, "batch=")):
            raise ValueError(f"batches after {up_to_batch} exist; compact at the newest batch")
        snap = _newest(self._entries(before=up_to_batch + 1, snapshot_before=up_to_batch))
        snap.withColumn("deleted", F.lit(False)).write.mode("overwrite").parquet(
            f"{self.snapshots}/at={up_to_batch:012d}"
        )


def _newest(entries: DataFrame) -> DataFrame:
    """Newest entry per key (a batch writes each key at most once), without
    tombstones. Two ``max_by`` on primitive columns keep it a hash aggregate."""
    latest = entries.groupBy("key").agg(
        F.max_by("value", "batch").alias("value"), F.max_by("deleted", "batch").alias("deleted")
    )
    return latest.where(~F.coalesce(F.col("deleted"), F.lit(False))).select("key", "value")
