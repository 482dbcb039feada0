"""Ordered (window) operators: cumulative turnover (W1), wireless/PC ratio
(W2), gap-resetting ratio (W3), plus the two-level building blocks they use.

A window ordered over the whole data set runs in one task. Every ordered
operator here is therefore split in two levels:

1. rows are cut into blocks of the order column (a day of minutes, a range
   of arrivals); the window runs per block, in parallel;
2. one row per block carries what earlier blocks contribute (a running
   total, the last value); that table has one row per block, so its own
   window is small whatever the row count, and is joined back on the block.

No group can grow beyond one block, so a hot key (one order id with a third
of all rows) is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.constants import DEVICE_PC, JAVA_DOUBLE_MAX
from tallyflow.session import materialize

MINUTES_PER_DAY = 1440


def _block(order_col: str, block: int) -> Column:
    return F.floor(F.col(order_col) / F.lit(block)).cast("long")


def _join_blocks(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of its block. A null key or order value
    forms a group and a block of its own, so no row is lost."""
    right = blocks.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), *(c for c in blocks.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return rows.join(right, on, "inner").drop(*(f"_r{i}" for i in range(len(keys))))


def running_aggregate(
    df: DataFrame,
    order_col: str,
    value_cols: list[str],
    by: tuple[str, ...] = (),
    block: int = MINUTES_PER_DAY,
    how: str = "sum",
    suffix: str = "",
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value_cols`` over ``order_col`` (rows
    up to and including the current one), per ``by`` group, in two levels.

    Output columns are named ``<value><suffix>``; with an empty suffix the
    input columns are replaced. ``ties`` order rows of an equal order value
    (without them such rows may be taken in any order). Rows with a null
    order value come first.
    """
    if how not in ("sum", "max"):
        raise ValueError(how)
    fn = F.sum if how == "sum" else F.max
    d = df.withColumn("_blk", _block(order_col, block))
    w_in = (
        Window.partitionBy(*by, "_blk")
        .orderBy(order_col, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = d.select(*d.columns, *[fn(v).over(w_in).alias(f"_in_{v}") for v in value_cols])
    # Block totals straight from the input: a partial aggregate, so this
    # branch shuffles one row per block per map task, not the rows.
    per_block = d.groupBy(*by, "_blk").agg(*[fn(v).alias(f"_b_{v}") for v in value_cols])
    w_b = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *by, "_blk", *[fn(f"_b_{v}").over(w_b).alias(f"_o_{v}") for v in value_cols]
    )
    out = _join_blocks(inner, offsets, [*by, "_blk"])
    for v in value_cols:
        inn, off = F.col(f"_in_{v}"), F.col(f"_o_{v}")
        combined = inn + F.coalesce(off, F.lit(0)) if how == "sum" else F.greatest(inn, off)
        out = out.withColumn(f"{v}{suffix}", combined)
    return out.drop("_blk", *[f"_in_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])


def previous_value(
    df: DataFrame,
    key_cols: list[str],
    order_col: str,
    value_col: str,
    out_col: str,
    block: int = 1 << 16,
) -> DataFrame:
    """``lag(value)`` per key in ``order_col`` order, in two levels.

    Rows of an equal order value are taken by value, and rows with a null
    one come first. Level 1 takes the lag inside (key, block of ``order_col``). The first row
    of a block takes the last value of the key's nearest earlier non-empty
    block, found by a lag over the one-row-per-(key, block) tails table.
    """
    d = df.withColumn("_blk", _block(order_col, block))
    w_in = Window.partitionBy(*key_cols, "_blk").orderBy(order_col, value_col)
    inner = d.withColumn("_lag_in", F.lag(value_col).over(w_in)).withColumn(
        "_first_in_blk", F.row_number().over(w_in) == 1
    )
    tails = d.groupBy(*key_cols, "_blk").agg(F.max_by(value_col, F.struct(order_col, value_col)).alias("_tail"))
    w_t = Window.partitionBy(*key_cols).orderBy("_blk")
    tails = tails.select(*key_cols, "_blk", F.lag("_tail").over(w_t).alias("_prev_tail"))
    out = _join_blocks(inner, tails, [*key_cols, "_blk"]).withColumn(
        out_col, F.when(F.col("_first_in_blk"), F.col("_prev_tail")).otherwise(F.col("_lag_in"))
    )
    return out.drop("_blk", "_lag_in", "_first_in_blk", "_prev_tail")


def cumulative_turnover(device_minute: DataFrame) -> DataFrame:
    """Running PC and wireless totals since the start, per minute.

    Input: ``minute, pc_cents, wl_cents`` (A2), one row per minute; it is
    materialised first so the two levels read it, not the payments.
    Output adds ``cum_pc_cents, cum_wl_cents``.
    """
    return running_aggregate(
        materialize(device_minute), "minute", ["pc_cents", "wl_cents"], suffix="_cum"
    ).withColumnRenamed("pc_cents_cum", "cum_pc_cents").withColumnRenamed("wl_cents_cum", "cum_wl_cents")


def wireless_pc_ratio(cumulative: DataFrame) -> DataFrame:
    """Cumulative wireless / cumulative PC; a minute is published only
    once the PC total is non-zero."""
    return cumulative.where(F.col("cum_pc_cents") != 0).withColumn(
        "ratio", F.col("cum_wl_cents").cast("double") / F.col("cum_pc_cents").cast("double")
    )


def _java_div(num: Column, den: Column) -> Column:
    """Double division with Java's x/0 results (ANSI mode would raise)."""
    n, d = num.cast("double"), den.cast("double")
    return (
        F.when(d != 0, n / d)
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def island_totals(device_minute_rows: DataFrame, by: str = "device") -> DataFrame:
    """Per ``by`` and minute: the total since the start of the current run of
    consecutive minutes (a missing minute restarts it).

    Input: ``<by>, minute, cents`` with one row per present (by, minute), so
    its size follows the time span, not the data. Output adds ``run_cents``.
    A run is named by its first minute; both windows use the one exchange by
    ``by`` (a run's rows are together wherever its group's are).
    """
    order = Window.partitionBy(by).orderBy("minute")
    starts = F.when(F.coalesce(F.lag("minute").over(order) != F.col("minute") - 1, F.lit(True)), F.col("minute"))
    run = Window.partitionBy(by, "_run").orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        device_minute_rows.select(by, "minute", "cents")
        .withColumn("_start", starts)
        .withColumn("_run", F.max("_start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("run_cents", F.sum("cents").over(run))
        .select(by, "minute", "cents", "run_cents")
    )


def device_ratios(device_minute_rows: DataFrame) -> DataFrame:
    """``minute, pc_run, wl_run, ratio`` of the runs of both devices (0: PC).

    A minute with no PC payment gives Double.MAX_VALUE; with PC but no
    wireless, 0.0."""
    runs = island_totals(device_minute_rows, "device")
    both = runs.groupBy("minute").agg(
        F.max(F.when(F.col("device") == 0, F.col("run_cents"))).alias("pc_run"),
        F.max(F.when(F.col("device") == 1, F.col("run_cents"))).alias("wl_run"),
    )
    ratio = F.when(F.col("pc_run").isNull(), F.lit(JAVA_DOUBLE_MAX)).otherwise(
        _java_div(F.coalesce("wl_run", F.lit(0)), F.col("pc_run"))
    )
    return both.select("minute", "pc_run", "wl_run", ratio.alias("ratio"))


def device_minute_cents(payments: DataFrame, device_col: str = "pay_platform") -> DataFrame:
    """``device, minute, cents`` of normalised payments."""
    dev = F.when(F.col(device_col) == DEVICE_PC, F.lit(0)).otherwise(F.lit(1))
    return payments.groupBy(dev.alias("device"), "minute").agg(F.sum("amount_cents").cast("long").alias("cents"))


def wireless_pc_ratio_reset(payments: DataFrame, device_col: str = "pay_platform") -> DataFrame:
    """Ratio where each device's total carries over only from the
    immediately preceding minute, so a gap restarts it.

    Input: normalised payments (``minute, amount_cents, <device_col>``).
    """
    return device_ratios(device_minute_cents(payments, device_col))
