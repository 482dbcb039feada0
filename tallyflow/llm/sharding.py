"""Operator 4, sharding: longest-processing-time scheduling of groups.

Rows of one group (equal texts) stay together. The groups, largest first, go
to the least-loaded shard through a heap. So that the heap never holds the
corpus, it schedules at most two items per 1/(shards * BINS) of the bytes:

* a group of at least that size is an item of its own (there are at most
  shards * BINS of them);
* smaller groups are dealt to shards * BINS bins by a hash of the group, and
  a bin is an item.

Both lists have a bound that does not depend on the input (2 * shards *
BINS rows), so collecting them for the heap and broadcasting the answer is
safe at any size. On small inputs a bin holds one group, and the schedule is
the plain one.

Slots (positions in a shard) are numbered by blocks of a shard, each sorted
by itself, with the blocks' sizes summed up beforehand: a shard is never
sorted in one task.

Defined cases: a null text is an empty payload, and null texts form a group
of their own, apart from empty texts; repeated rows get a slot each; null
ids come first within a block; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import one_row, staged

SHARDS = 40
#: Bytes each row costs besides its text.
ROW_BYTES = 16
#: Items per shard that the heap may see.
BINS = 1024
#: Rows of a shard that one task numbers, on average.
BLOCK_ROWS = 16_384


def longest_first(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """item -> shard. ``items``: (size, item); ties go by the item."""
    heap = [(0, s) for s in range(shards)]
    where = {}
    for size, item in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, shard = heapq.heappop(heap)
        where[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return where


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS
) -> DataFrame:
    """One row per row of ``docs``: id_col, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("crc"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("grp"),
        ),
        "sharding_rows",
    )
    n_bins = shards * bins
    groups = staged(
        rows.groupBy("grp").agg(F.sum("size").alias("bytes")).withColumn("bin", _bin(n_bins)), "sharding_groups"
    )
    total = one_row(groups, [F.sum("bytes").alias("b")])["b"] or 0
    n_rows = rows.count()
    large = F.col("bytes") * F.lit(n_bins) >= F.lit(int(total))
    small = groups.where(~large).groupBy("bin").agg(F.sum("bytes").alias("bytes"))
    items = [(r["bytes"], ("g", bytes(r["grp"]))) for r in groups.where(large).select("grp", "bytes").toLocalIterator()]
    items += [(r["bytes"], ("b", r["bin"])) for r in small.toLocalIterator()]
    where = longest_first(items, shards)
    alone = _table(spark, [(k[1], s) for k, s in where.items() if k[0] == "g"], "lgrp binary, lshard int")
    binned = _table(spark, [(k[1], s) for k, s in where.items() if k[0] == "b"], "sbin long, sshard int")
    placed = (
        rows.withColumn("bin", _bin(n_bins))
        .join(F.broadcast(alone), F.col("grp") == F.col("lgrp"), "left")
        .join(F.broadcast(binned), F.col("bin") == F.col("sbin"), "left")
        .withColumn("shard", F.coalesce("lshard", "sshard"))
        .select("id", "size", "crc", "shard")
    )
    blocks = max(1, -(-n_rows // (shards * BLOCK_ROWS)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    sizes = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy("id", "size", "crc")
    return (
        placed.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, ["shard", "block"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("start") + F.col("at")).cast("long").alias("slot"),
        )
    )


def _bin(n: int):
    return F.pmod(F.xxhash64("grp"), F.lit(n))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
