"""Block timestamps for child rows while both they and their blocks stream in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import block_timestamp, usable_timestamp
from spanledger.operators.enrich import invalid_reason


def _place() -> Column:
    # The first watermark is second 0, and what is not above it counts as late.
    return F.timestamp_seconds(F.col("block_number") + 1)


def enrich_stream(children: DataFrame, blocks: DataFrame, depth: int) -> DataFrame:
    """Child rows with block_timestamp, or with NULL and the reason once their block can't come any more.

    Event time is the place in the chain: block number n stands for second n + 1. The watermark follows the lower of the two heads at
    `depth` blocks, and the join waits that long: a child whose usable block has come goes on at once, one whose block
    has not come by the watermark is rejected, as `enrich_strict` and `split_valid` would over all rows. Rows that come later
    than the watermark are dropped by Spark and counted in the stream's progress, so `depth` must cover how far files run behind the
    head. Both sides keep no more than the rows of `depth` blocks. Of replayed blocks the first counts. A child without a block number is
    rejected without waiting.
    """
    parents = (
        blocks.filter(usable_timestamp() & F.col("block_number").isNotNull())
        .select(
            F.col("block_number").alias("__block"), F.col("timestamp").alias("__seconds"),
            _place().alias("__block_place"),
        )
        .withWatermark("__block_place", f"{depth} seconds")
        .dropDuplicatesWithinWatermark(["__block"])
    )
    placed = (
        children.filter(F.col("block_number").isNotNull())
        .withColumn("__place", _place())
        .withWatermark("__place", f"{depth} seconds")
    )
    joined = placed.join(
        parents, (F.col("__place") == F.col("__block_place")) & (F.col("block_number") == F.col("__block")), "leftOuter"
    )
    stamped = joined.select(*children.columns, block_timestamp("__seconds").alias("block_timestamp"))
    lost = children.filter(F.col("block_number").isNull()).withColumn("block_timestamp", F.lit(None).cast("timestamp"))
    return stamped.unionByName(lost).withColumn("reason", invalid_reason())
