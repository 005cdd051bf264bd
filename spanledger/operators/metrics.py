"""Figures about ingestion that follow from the state table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import align_down
from spanledger.operators.latest import latest_status
from spanledger.operators.running import sum_over_ranges
from spanledger.schemas import COMPLETED, DURATION_BUCKETS, FAILED, PROCESSING, STATE_KEY


def ingest_metrics(state: DataFrame, head_block: int) -> DataFrame:
    """Per dataset: counters over all events, gauges over the latest status, lag to the head."""
    status = F.col("status")
    counters = state.groupBy("dataset").agg(
        F.count_if(status == COMPLETED).alias("ranges_completed_total"),
        F.count_if(status == FAILED).alias("ranges_failed_total"),
        F.coalesce(F.sum(F.when(status == COMPLETED, F.col("rows_indexed"))), F.lit(0)).alias(
            "rows_inserted_total"
        ),
        F.coalesce(F.max(F.when(status == COMPLETED, F.col("end_block"))), F.lit(0)).alias(
            "highest_completed_block"
        ),
    )
    gauges = latest_status(state).groupBy("dataset").agg(
        F.count_if(status == PROCESSING).alias("ranges_in_progress")
    )
    return counters.join(gauges, "dataset").withColumns(
        {
            "chain_head_block": F.lit(head_block).cast("bigint"),
            "chain_lag_blocks": F.lit(head_block).cast("bigint") - F.col("highest_completed_block"),
        }
    )


def range_durations(state: DataFrame) -> DataFrame:
    """Seconds from the last claim to completion, for ranges that are completed now."""
    order = F.struct("created_at", "insert_version")
    return (
        state.groupBy(*STATE_KEY)
        .agg(
            F.max_by("status", order).alias("__status"),
            F.max_by("completed_at", order).alias("__done"),
            F.max(F.when(F.col("status") == PROCESSING, F.col("created_at"))).alias("__claimed"),
        )
        .filter(
            (F.col("__status") == COMPLETED)
            & F.col("__done").isNotNull()
            & F.col("__claimed").isNotNull()
        )
        .select(
            *STATE_KEY,
            ((F.unix_micros("__done") - F.unix_micros("__claimed")) / 1e6).alias("seconds"),
        )
    )


def duration_histogram(state: DataFrame, buckets: Sequence[float] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative histogram per dataset: ranges that took at most `le` seconds."""
    counted = range_durations(state).groupBy("dataset").agg(
        *[F.count_if(F.col("seconds") <= float(b)).alias(f"__le_{i}") for i, b in enumerate(buckets)],
        F.count(F.lit(1)).alias("__all"),
    )
    rows = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"__le_{i}").alias("ranges"))
        for i, b in enumerate(buckets)
    ]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("__all").alias("ranges")))
    return counted.select("dataset", F.inline(F.array(*rows)))


def rows_per_range(
    rows: DataFrame, ranges: DataFrame, position: str = "block_number", n_ranges: int | None = None
) -> DataFrame:
    """rows_indexed for every requested range, 0 where nothing was loaded."""
    ones = rows.select(position).withColumn("__one", F.lit(1))
    return sum_over_ranges(ones, ranges, position, {"rows_indexed": F.count("__one")}, n_ranges=n_ranges)


def rows_per_batch(rows: DataFrame, batch: int, position: str = "block_number") -> DataFrame:
    """Row count of each fixed aligned range that holds rows."""
    return (
        rows.groupBy(align_down(position, batch).alias("start_block"))
        .agg(F.count(F.lit(1)).alias("rows_indexed"))
        .select(
            "start_block", (F.col("start_block") + batch).alias("end_block"), "rows_indexed"
        )
    )
