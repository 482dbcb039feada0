"""File feeds for Structured Streaming.

A topic is replayed as parquet files in slices of arrival order: a slice is
one append of ``FILES_PER_SLICE`` files, written by as many tasks, and with
``maxFilesPerTrigger`` set to that number each slice becomes one micro-batch
(the file source takes files oldest first). Within a slice the files come in
any order, as the partitions of a topic do, so the streaming operators must
not rely on row order. The number of slices follows from the number of rows;
the driver only holds the slice boundaries (``approxQuantile``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyflow.session import shared_path
from tallyflow.sources.feeds import bounded_ingest_options

FILES_PER_SLICE = 2
ROWS_PER_SLICE = 1_000_000
#: A replay has several micro-batches however small it is.
LEAST_SLICES = 4


def _file_of(at: Column, starts: list[int], first: int = 0) -> Column:
    """The number of the ``starts`` (ascending) up to ``at``, by halving; 0 for null."""
    if not starts:
        return F.lit(first)
    mid = len(starts) // 2
    later = _file_of(at, starts[mid + 1 :], first + mid + 1)
    return F.when(at >= F.lit(starts[mid]), later).otherwise(_file_of(at, starts[:mid], first))


def write_feed(
    df: DataFrame,
    path: str,
    order_col: str = "arrival",
    slices: int | None = None,
    files_per_slice: int = FILES_PER_SLICE,
) -> str:
    """Append ``df`` under ``path`` in ``slices`` slices of arrival order.

    One pass deals the rows to the files of all slices in a folder of its own;
    the slices are then appended one after the other, each from its own files,
    so ``df`` is computed once however many slices there are. A slice holds
    exactly ``files_per_slice`` files, the last one maybe fewer. Rows without
    an arrival come first."""
    at = F.col(order_col)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("low")).first()
    if slices is None:
        slices = max(LEAST_SLICES, -(-size["n"] // ROWS_PER_SLICE))
    files = slices * files_per_slice
    marks = df.approxQuantile(order_col, [i / files for i in range(1, files)], 0.0005) if size["n"] else []
    starts = sorted({int(m) for m in marks if m > size["low"]})
    staged = shared_path(df.sparkSession, "feed_files", unique=True)
    (
        df.withColumn("_file", _file_of(at, starts))
        .repartition(len(starts) + 1, "_file")
        .write.partitionBy("_file")
        .parquet(staged)
    )
    # Listed once; each slice reads the folders of its own files.
    whole = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_file", IntegerType())])).parquet(staged)
    for first in range(0, len(starts) + 1, files_per_slice):
        last = min(first + files_per_slice, len(starts) + 1) - 1
        (
            whole.where(F.col("_file").between(first, last))
            .withColumn("_part", F.col("_file") - F.lit(first))
            .drop("_file")
            .repartition(last - first + 1, "_part")
            .sortWithinPartitions("_part", order_col)
            .write.mode("append")
            .partitionBy("_part")
            .parquet(path)
        )
    return path


def read_feed(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Stream the feed back, one file per micro-batch by default."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .options(**bounded_ingest_options(max_files=max_files_per_trigger))
        .parquet(path)
    )
