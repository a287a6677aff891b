"""Distributed dense numbering and prefix sums.

``row_number().over(Window.orderBy(...))`` without a partition key moves the
whole table into one task.  Both helpers below keep the work spread out:

* dense_index: global range-partitioned sort, a row id within each sorted
  partition, per-partition sizes (one row per partition), and offsets from a
  running sum over that tiny table, joined back by broadcast.
* prefix_sum: on a dense 0..n-1 index, running sums inside fixed-size blocks
  of the index (one window partition per block), block totals, and block
  offsets from the small block table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fits_broadcast, write_table

_PART_SHIFT = 33                      # monotonically_increasing_id layout
_ROW_MASK = (1 << _PART_SHIFT) - 1
DEFAULT_BLOCK = 1 << 16               # rows per prefix-sum block


def _small(offsets: DataFrame) -> DataFrame:
    """Offsets hold one row per partition or block: counted, then broadcast."""
    return F.broadcast(offsets) if fits_broadcast(offsets.count(), 32) else offsets


def dense_index(df: DataFrame, order_cols, idx_col: str = "idx") -> DataFrame:
    """Add ``idx`` = 0-based position of each row in the total order
    ``order_cols`` (which must be a strict order: ties broken by the caller).

    The sorted table is written with its row ids, so they cannot change between
    the size count and the join, and every consumer reads it from there.
    """
    cols = df.columns
    tagged = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    tagged = write_table(tagged, "sorted")
    part = F.shiftright(F.col("_mid"), _PART_SHIFT)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running sum over it is tiny and exact (integers).
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    joined = tagged.join(_small(offsets), part == F.col("_part"))
    return joined.select(
        (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_ROW_MASK))).cast("bigint").alias(idx_col),
        *cols)


def prefix_sum(df: DataFrame, idx_col: str, value_col: str,
               incl_col: str = "cum_incl", excl_col: str = "cum_excl",
               block: int = DEFAULT_BLOCK) -> DataFrame:
    """Running sums of ``value_col`` in ``idx_col`` order (idx dense from 0).

    ``cum_excl`` of row i equals ``cum_incl`` of row i-1 bit for bit, also
    across block borders, because block offsets are running sums of the
    blocks' own last running values.
    """
    b = F.floor(F.col(idx_col) / F.lit(block)).cast("bigint")
    w_in_block = Window.partitionBy("_blk").orderBy(idx_col)
    local = df.withColumn("_blk", b).select(
        "*",
        F.sum(value_col).over(w_in_block.rowsBetween(Window.unboundedPreceding, 0)).alias("_li"),
        F.sum(value_col).over(w_in_block.rowsBetween(Window.unboundedPreceding, -1)).alias("_le"),
    )
    # Values are non-negative, so the block's last running value is its max.
    totals = local.groupBy("_blk").agg(F.max("_li").alias("_tot"))
    offsets = totals.select(
        "_blk",
        F.coalesce(F.sum("_tot").over(Window.orderBy("_blk").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_boff"))
    out = local.join(_small(offsets), "_blk")
    return out.select(
        *[c for c in df.columns],
        (F.col("_boff") + F.col("_li")).alias(incl_col),
        (F.col("_boff") + F.coalesce(F.col("_le"), F.lit(0.0))).alias(excl_col),
    )
