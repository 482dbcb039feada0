"""Shared helpers: staged tables, skew-safe lookups, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import shared_path

#: A key is hot when it holds more than one row in HOT_SHARE, so there are
#: fewer than HOT_SHARE hot keys whatever the size of the table.
HOT_SHARE = 4096

#: A table of at most this many ids may be broadcast (some 30 MB with its hash
#: table); above it the same result comes from a shuffle join.
BROADCAST_ROWS = 250_000


#: Bytes of an Arrow batch that goes to a Python worker (and one row more): a
#: worker holds a few copies of a batch, whatever the length of the texts.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after limiting the session's Arrow batches to BATCH_BYTES. Only
    the memory of Python workers depends on it, no result does."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: computed
    once, lineage cut, and still there when an executor is lost."""
    path = shared_path(df.sparkSession, "llm", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def skew_lookup(rows: DataFrame, table: DataFrame, on: str, weight: str, total: int, spread: Column) -> DataFrame:
    """``rows`` left-joined with ``table`` (unique per ``on``; ``weight`` is
    the number of rows that hold the key, ``total`` that of all rows).

    Keys with more than total / HOT_SHARE rows number fewer than HOT_SHARE:
    they are broadcast, and their rows are dealt by ``spread`` (any column
    that differs between rows) instead of by the key. The other keys go
    through a shuffle join in which no key has more than total / HOT_SHARE
    rows. Columns of ``table`` other than ``on`` and ``weight`` keep their
    names; ``weight`` is dropped.
    """
    values = [c for c in table.columns if c not in (on, weight)]
    is_hot = F.col(weight) * F.lit(HOT_SHARE) > F.lit(int(total))
    hot = table.where(is_hot).select(F.col(on).alias("_hot"), *(F.col(c).alias(f"_hot_{c}") for c in values))
    cold = table.where(~is_hot).select(
        F.col(on).alias("_cold"), F.lit(0).cast("long").alias("_zero"), *(F.col(c).alias(f"_cold_{c}") for c in values)
    )
    matched = rows.join(F.broadcast(hot), F.col(on) == F.col("_hot"), "left")
    at = matched.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(on))).withColumn(
        "_deal", F.when(F.col("_key").isNull(), F.xxhash64(spread)).otherwise(F.lit(0))
    )
    joined = at.join(cold, (F.col("_key") == F.col("_cold")) & (F.col("_deal") == F.col("_zero")), "left")
    return joined.select(*rows.columns, *(F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values))


def keep_ids(rows: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """``rows`` whose ``column`` is in ``ids`` (one column of that name; a
    staged table). Broadcast when the counted ids fit, else a shuffle join."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, column, how)


def one_row(df: DataFrame, columns: Sequence[Column]) -> dict:
    """A global aggregate, as a dict."""
    return df.agg(*columns).first().asDict()
