"""Chain reorganisation check against canonical hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import normal_hash


def detect_reorg(stored: DataFrame, canonical: DataFrame, last_block: int | None = None) -> DataFrame:
    """One row (last_block, reorg_detected, common_ancestor).

    Both inputs hold (block_number, block_hash); `stored` may have versions. A reorg is there
    when the hashes at the last block differ; the ancestor is the highest block up to it
    with equal hashes, else 0. A last block missing on either side is no reorg. Without
    `last_block` the highest stored block is taken.
    """
    if "insert_version" in stored.columns:
        stored = stored.groupBy("block_number").agg(
            F.max_by("block_hash", "insert_version").alias("block_hash")
        )
    ours = stored.select("block_number", normal_hash("block_hash").alias("__ours"))
    theirs = canonical.select("block_number", normal_hash("block_hash").alias("__theirs"))
    if last_block is not None:
        ours = ours.filter(F.col("block_number") <= last_block)
    n = F.col("block_number")
    same = F.col("__ours") == F.col("__theirs")
    # The outer join keeps the highest stored block when the canonical side lacks it.
    facts = ours.join(theirs, "block_number", "left").agg(
        F.max(n).alias("__top"),
        F.max_by(F.struct(same.alias("same")), n).alias("__at_top"),
        F.max(F.when(same & (n > 0), n)).alias("__ancestor"),
    )
    last = F.lit(last_block).cast("bigint") if last_block is not None else F.col("__top")
    reorg = F.coalesce((F.col("__top") == last) & ~F.col("__at_top.same"), F.lit(False))
    return facts.select(
        last.alias("last_block"),
        reorg.alias("reorg_detected"),
        F.when(reorg, F.coalesce("__ancestor", F.lit(0).cast("bigint"))).otherwise(last).alias(
            "common_ancestor"
        ),
    )
