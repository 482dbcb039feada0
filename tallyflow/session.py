"""Session settings and the shared working folder.

Jobs that must cut lineage or materialise an intermediate table write under
the folder the cluster names in ``spark.checkpoint.dir``. Without that
setting a local master gets a private folder; on a cluster it is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every entry point applies. All are session-scoped and
# safe to set on a running session.
RUNTIME_CONF = {
    # The reference has no zone logic; minutes are epoch-based.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, and turn a shuffle join into a broadcast join when the
    # measured size of a side is under the threshold. (The planner's own
    # threshold, on estimated sizes, stays as the cluster sets it.)
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state in RocksDB (spills to local disk of the executor and is
    # checkpointed to the shared folder); commits write a changelog instead
    # of a full snapshot every micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[8]",
    app_name: str = "tallyflow",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session. On a cluster, size ``shuffle_partitions`` to the
    data (about 128 MB per partition) and let AQE coalesce."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path in the shared checkpoint folder.

    ``unique=True`` appends a fresh id so concurrent or repeated runs never
    share a folder (nothing is ever cleared in place).
    """
    segments = [_checkpoint_root(spark), "tallyflow", *parts]
    if unique:
        segments.append(uuid.uuid4().hex)
    return "/".join(segments)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared checkpoint folder (survives executor loss; never local).

    Meant for small intermediate tables (one row per minute or per block)
    that several branches of a plan read."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
