"""Skew-safe equi-joins for a payment side with hot keys.

The order side of every matching join is reduced to at most a few rows per
id before the join, so it reaches the join through an aggregate: AQE's
skew-join split (which needs both children to be plain shuffle stages) does
not apply. Hot ids are therefore salted explicitly:

* ``hot_keys`` estimates, on a seeded sample of the join key column, the
  ids whose rows exceed what one task should process, and from the estimate
  into how many salts each must be split. The sample only decides which ids
  are split and how finely; every row is still joined. A hot id holds about
  ``rows_per_task`` rows at least, so there are at most about rows /
  rows_per_task of them; their table is counted, and broadcast only while it
  has at most ``BROADCAST_ROWS`` rows (else it is shuffled like any other).
* ``salted_join`` spreads a hot id's rows over its salt values by a
  deterministic hash of the row (a retried task salts identically) and
  replicates that id's few order-side rows once per salt: no salt holds much
  more than ``rows_per_task`` rows, however large the id grows. Other ids
  keep salt 0 and are joined as usual. The result is exactly the plain join's,
  for inner, left outer, left semi and left anti joins. With no hot id the
  plain join is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.session import materialize

DEFAULT_ROWS_PER_TASK = 5_000_000
DEFAULT_SAMPLE_FRACTION = 1e-3
BROADCAST_ROWS = 1_000_000

# Session settings that override the defaults (e.g. smaller tasks).
ROWS_PER_TASK_CONF = "spark.tallyflow.skew.rowsPerTask"
SAMPLE_FRACTION_CONF = "spark.tallyflow.skew.sampleFraction"

# ``rows_per_task=AUTO`` reads the session setting (default above).
AUTO = -1


def configured_rows_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK)))


def configured_fraction(df: DataFrame) -> float:
    return float(df.sparkSession.conf.get(SAMPLE_FRACTION_CONF, str(DEFAULT_SAMPLE_FRACTION)))


def hot_keys(
    df: DataFrame,
    key: str,
    rows_per_task: int = AUTO,
    fraction: float | None = None,
    seed: int = 17,
) -> DataFrame:
    """Ids estimated to hold more than ``rows_per_task`` rows, and ``_salts``,
    the number of tasks that their rows need."""
    if rows_per_task == AUTO:
        rows_per_task = configured_rows_per_task(df)
    if fraction is None:
        fraction = configured_fraction(df)
    min_hits = max(2, int(rows_per_task * fraction))
    return (
        df.select(key)
        .sample(fraction=fraction, seed=seed)
        .groupBy(key)
        .count()
        .where(F.col("count") >= min_hits)
        .select(key, F.greatest(F.lit(2), F.ceil(F.col("count") / F.lit(fraction * rows_per_task))).cast("int").alias("_salts"))
    )


def hot_table(hot: DataFrame) -> DataFrame | None:
    """``hot`` computed once in the shared folder, marked for broadcast where
    its counted size allows it; None when no id is hot."""
    table = materialize(hot)
    n = table.limit(BROADCAST_ROWS + 1).count()
    return None if not n else F.broadcast(table) if n <= BROADCAST_ROWS else table


def with_salts(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``rows`` with the ``_salts`` of their id, a null id's too: null ids
    match no order, but they must not all go to one task."""
    table = hot.select(F.col(key).alias("_hot_key"), "_salts")
    return rows.join(table, F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")


def salted(rows: DataFrame, hot: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``rows`` with ``_salt``: 0, or for a hot id a hash of the columns
    ``by`` modulo its number of salts."""
    spread = F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int")
    return (
        with_salts(rows, hot, key)
        .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(spread))
        .drop("_salts")
    )


def per_salt(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``rows`` (few per id) once per salt value of their id."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    return with_salts(rows, hot, key).withColumn("_salt", F.explode(salts)).drop("_salts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    rows_per_task: int = AUTO,
) -> DataFrame:
    """``left.join(right, on, how)`` with the hot ids of ``left`` split over
    as many tasks as their rows need. ``right`` must be small per key (a
    reduced order side). ``hot``: the result of ``hot_keys``."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    # The sample scans the whole key column: once, for both sides.
    table = hot_table(hot_keys(left, on, rows_per_task) if hot is None else hot)
    if table is None:
        return left.join(right, on, how)
    return salted(left, table, on, left.columns).join(per_salt(right, table, on), [on, "_salt"], how).drop("_salt")
