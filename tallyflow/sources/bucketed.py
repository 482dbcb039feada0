"""Co-located joins: write payments and orders once, bucketed and sorted by
``order_id`` into the same number of buckets, and every later join on
``order_id`` between them runs without a shuffle (a bucketed sort-merge
join reads bucket i of both sides in the same task).

The tables are external: their files live in the shared folder passed as
``path``, registered in the session catalog under ``name``. Bucketing fixes
the partitioning on one key, so a hot id lands in one bucket; use it where
ids are not skewed, and the salted joins (``operators.skew``) where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "order_id") -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``key``;
    return the table."""
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
