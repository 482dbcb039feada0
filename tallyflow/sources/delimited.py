"""The ``;;\\n``-delimited order log.

Frame of one file: a record count, then one record per order, each record
``<platform digit><body>`` and every record terminated by ``;;\\n``. The body
here is JSON (the reference used a binary codec).

Writing and reading are both parallel: every output file is written by one
task with its own header, and the reader splits files on the separator
(``lineSep``), tells headers from records by their shape, and checks each
file's record count against its header instead of silently capping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyflow.constants import RECORD_SEPARATOR

ORDER_BODY_SCHEMA = StructType(
    [
        StructField("arrival", LongType()),
        StructField("order_id", LongType()),
        StructField("create_time_ms", LongType()),
    ]
)

_HEADER = r"^[0-9]+$"
_CORRUPT = "_corrupt"


def write_delimited_orders(orders: DataFrame, path: str, n_files: int | None = None) -> str:
    """Write ``orders`` (platform + ORDER_BODY_SCHEMA columns) as ``n_files``
    delimited files under ``path`` (one ``part=<i>`` folder each, one task
    per file); by default as many files as shuffle partitions."""
    if n_files is None:
        n_files = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body_cols = [f.name for f in ORDER_BODY_SCHEMA.fields]
    records = orders.select(
        # Deterministic file assignment: a task retry writes the same rows.
        F.pmod(F.xxhash64(*body_cols), F.lit(n_files)).alias("part"),
        F.concat(F.col("platform").cast("string"), F.to_json(F.struct(*body_cols))).alias("value"),
        F.lit(1).alias("k"),
    )
    headers = records.groupBy("part").agg(F.count(F.lit(1)).cast("string").alias("value")).withColumn(
        "k", F.lit(0)
    )
    (
        records.unionByName(headers)
        .repartition(n_files, "part")
        .sortWithinPartitions("part", "k")
        .select("part", "value")
        .write.mode("overwrite")
        .partitionBy("part")
        .option("lineSep", RECORD_SEPARATOR)
        .text(path)
    )
    return path


def _raw(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", RECORD_SEPARATOR)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
        .where(F.length("value") > 0)
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its platform digit and decoded body; ``ok`` is false
    for a record without a platform digit or with a body that is not one."""
    rec = _raw(spark, path).where(~F.col("value").rlike(_HEADER))
    schema = StructType([*ORDER_BODY_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    body = F.from_json(F.expr("substring(value, 2)"), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    platform = F.substring("value", 1, 1).try_cast("int")
    whole = F.col(f"b.{_CORRUPT}").isNull() & F.col("b.order_id").isNotNull()
    return rec.select("value", "file", platform.alias("platform"), body.alias("b")).withColumn(
        "ok", F.coalesce(F.col("platform").isNotNull() & F.col("b").isNotNull() & whole, F.lit(False))
    )


def read_delimited_orders(spark: SparkSession, path: str) -> DataFrame:
    """The orders of every record that decodes: platform digit + JSON body.
    The others are in ``delimited_rejects``."""
    return _records(spark, path).where("ok").select("platform", *(f"b.{f.name}" for f in ORDER_BODY_SCHEMA.fields))


def delimited_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``file, value`` of the records that do not decode."""
    return _records(spark, path).where("not ok").select("file", "value")


def delimited_file_check(spark: SparkSession, path: str) -> DataFrame:
    """Per file: declared count, records found, and whether they agree."""
    raw = _raw(spark, path)
    is_header = F.col("value").rlike(_HEADER)
    return raw.groupBy("file").agg(
        F.sum(F.when(is_header, F.col("value").cast("long"))).alias("declared"),
        F.sum(F.when(~is_header, F.lit(1)).otherwise(F.lit(0))).alias("found"),
    ).withColumn("ok", F.col("declared") == F.col("found"))
