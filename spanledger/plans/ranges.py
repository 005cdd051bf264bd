"""Cutting intervals into the fixed ranges that are loaded and tracked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions.columns import align_down, align_start
from spanledger.operators.joins import explode_steps


def split_ranges(intervals: DataFrame, batch: int) -> DataFrame:
    """Each row's [start_block, end_block) cut into pieces of `batch` from its start; the last
    one may be shorter. Other columns are kept; empty intervals give no rows."""
    others = [c for c in intervals.columns if c not in ("start_block", "end_block")]
    steps = explode_steps(
        intervals.filter(F.col("end_block") > F.col("start_block")),
        F.col("start_block"),
        F.col("end_block") - 1,
        batch,
        "__from",
        int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    return steps.select(
        *others,
        F.col("__from").alias("start_block"),
        F.least(F.col("__from") + batch, F.col("end_block")).alias("end_block"),
    )


def plan_ranges(spark: SparkSession, start: int, end: int, batch: int) -> DataFrame:
    """The ranges of one interval known to the driver."""
    return spark.range(start, max(end, start), batch).select(
        F.col("id").alias("start_block"),
        F.least(F.col("id") + batch, F.lit(end)).alias("end_block"),
    )


def safe_ranges(head: DataFrame, next_block: int, batch: int, confirmations: int) -> DataFrame:
    """Whole aligned ranges at or after `next_block` that end `confirmations` below the head.

    `head` has one row with head_block.
    """
    safe = F.col("head_block") - confirmations
    return split_ranges(
        head.select(
            align_start(F.lit(next_block).cast("bigint"), batch).alias("start_block"),
            align_down(F.greatest(safe, F.lit(0)), batch).alias("end_block"),
        ),
        batch,
    )


def confirmed(
    df: DataFrame, head: DataFrame, confirmations: int, position: str = "block_number"
) -> DataFrame:
    """Rows at least `confirmations` below the head; `head` is a single row.

    The bound is a scalar subquery, so it becomes a filter value and no join.
    """
    bound = head.select(F.col("head_block") - confirmations).scalar()
    return df.filter(F.col(position) <= bound)
