"""Progress, gaps and segments over the range state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.columns import bucket_of, is_diff_dataset, overall_status, range_label
from spanledger.operators.latest import latest_state, latest_status
from spanledger.operators.ranges import merge_ranges
from spanledger.operators.running import positioned, running_before
from spanledger.schemas import (
    COMPLETED,
    DATASETS,
    DIFF_GAP_START,
    FAILED,
    PENDING,
    PROCESSING,
    STATE_KEY,
    STATUSES,
)


def _status_counts() -> list:
    status = F.col("status")
    return [
        F.count(F.lit(1)).alias("total_ranges"),
        F.count_if(status == COMPLETED).alias("completed_ranges"),
        F.count_if(status == PROCESSING).alias("processing_ranges"),
        F.count_if(status == FAILED).alias("failed_ranges"),
        F.count_if(status == PENDING).alias("pending_ranges"),
    ]


def _status_word(total) -> object:
    return overall_status(
        F.col("completed_ranges"),
        F.col("processing_ranges"),
        F.col("failed_ranges"),
        F.col("pending_ranges"),
        total,
    )


def progress(state: DataFrame) -> DataFrame:
    """Per dataset, over the latest state of each range."""
    counted = (
        latest_state(state)
        .groupBy("dataset")
        .agg(
            *_status_counts(),
            F.min("start_block").alias("lowest_block_attempted"),
            F.max("end_block").alias("highest_block_attempted"),
            F.coalesce(
                F.max(F.when(F.col("status") == COMPLETED, F.col("end_block"))), F.lit(0)
            ).alias("highest_block_completed"),
            F.sum("rows_indexed").alias("total_rows_indexed"),
            F.min("created_at").alias("first_attempt"),
            F.max("completed_at").alias("last_completion"),
        )
    )
    total = F.col("total_ranges")
    return counted.withColumns(
        {
            "completion_percentage": F.round(F.col("completed_ranges") / total * 100, 2),
            "overall_status": _status_word(total),
        }
    )


def history_summary(state: DataFrame) -> DataFrame:
    """Per dataset, over every event ever written (a range counts once per event)."""
    counted = state.groupBy("dataset").agg(
        *_status_counts(),
        F.coalesce(F.max("end_block"), F.lit(0)).alias("highest_attempted_block"),
        F.coalesce(
            F.max(F.when(F.col("status") == COMPLETED, F.col("end_block"))), F.lit(0)
        ).alias("highest_completed_block"),
        F.coalesce(F.sum("rows_indexed"), F.lit(0)).alias("total_rows_indexed"),
    )
    return summarised(counted)


def summarised(counted: DataFrame) -> DataFrame:
    """Counts of events per dataset with their percentage and status word."""
    known = (
        F.col("completed_ranges")
        + F.col("processing_ranges")
        + F.col("failed_ranges")
        + F.col("pending_ranges")
    )
    return counted.withColumns(
        {
            "completion_percentage": F.col("completed_ranges") / F.col("total_ranges") * 100,
            "overall_status": _status_word(known),
        }
    )


def highest_attempted(state: DataFrame) -> DataFrame:
    """Per dataset, the end of the furthest range in any known status."""
    return (
        state.filter(F.col("status").isin(*STATUSES))
        .groupBy("dataset")
        .agg(F.coalesce(F.max("end_block"), F.lit(0)).alias("highest_attempted"))
    )


def last_synced(state: DataFrame, datasets: Sequence[str] = DATASETS, strict: bool = False) -> DataFrame:
    """One row: the lowest of the datasets' highest completed blocks.

    A dataset without a completed range is left out, or pulls the result to 0 with `strict`.
    """
    wanted = list(dict.fromkeys(datasets))
    per_dataset = (
        state.filter(F.col("dataset").isin(wanted) & (F.col("status") == COMPLETED))
        .groupBy("dataset")
        .agg(F.max("end_block").alias("last_block"))
    )
    lowest = F.coalesce(F.min("last_block"), F.lit(0))
    if strict:
        lowest = F.when(F.count(F.lit(1)) < len(wanted), F.lit(0)).otherwise(lowest)
    return per_dataset.agg(lowest.cast("bigint").alias("last_synced_block"))


def non_completed_ranges(
    state: DataFrame, datasets: Sequence[str] = DATASETS, start_block: int = 0, end_block: int = 0
) -> DataFrame:
    """Ranges whose latest status is not completed; a bound of 0 is no bound."""
    wanted = state.filter(F.col("dataset").isin(list(datasets)))
    if start_block > 0:
        wanted = wanted.filter(F.col("start_block") >= start_block)
    if end_block > 0:
        wanted = wanted.filter(F.col("end_block") <= end_block)
    return (
        latest_status(wanted)
        .filter(F.col("status") != COMPLETED)
        .filter(~(is_diff_dataset() & (F.col("start_block") == 0)))
        .select(*STATE_KEY)
    )


def _completed(state: DataFrame) -> DataFrame:
    return latest_status(state).filter(F.col("status") == COMPLETED).select(*STATE_KEY)


def continuous_ranges(state: DataFrame, batch_size: int = 100) -> DataFrame:
    """Runs of completed ranges, told apart by start minus the running total of lengths.

    The key is right as long as all ranges have one length; `coverage_segments` holds for any
    lengths and for overlap.
    """
    ranges = _completed(state).withColumn("__length", F.col("end_block") - F.col("start_block"))
    keyed = running_before(
        ranges, ["dataset"], "start_block", {"__before": ("__length", "sum")}, then_by=["end_block"]
    ).withColumn("group_key", F.col("start_block") - F.col("__before") - F.col("__length"))
    runs = keyed.groupBy("dataset", "group_key").agg(
        F.min("start_block").alias("continuous_start"),
        F.max("end_block").alias("continuous_end"),
        F.count(F.lit(1)).alias("num_segments"),
    )
    total = F.col("continuous_end") - F.col("continuous_start")
    n = F.col("num_segments")
    return runs.select(
        "dataset",
        "continuous_start",
        "continuous_end",
        "num_segments",
        total.alias("total_blocks"),
        range_label("continuous_start", "continuous_end").alias("range_description"),
        F.round(n * float(batch_size) / total * 100, 2).alias("coverage_percentage"),
        F.when(n == total / batch_size, "complete")
        .when(n < total / batch_size, "has_gaps")
        .otherwise("overlapping")
        .alias("continuity_status"),
    )


def coverage_segments(state: DataFrame) -> DataFrame:
    """Maximal covered segments per dataset over the completed ranges."""
    return merge_ranges(_completed(state), ["dataset"]).withColumn(
        "covered_blocks", F.col("segment_end") - F.col("segment_start")
    )


def range_summary(state: DataFrame, batch_size: int = 100) -> DataFrame:
    """Progress with the number and bounds of the continuous runs.

    The runs are counted per dataset before the join, so both sides have one row per dataset.
    """
    runs = (
        continuous_ranges(state, batch_size)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("__runs"),
            F.min("continuous_start").alias("first_continuous_block"),
            F.max("continuous_end").alias("last_continuous_block"),
        )
    )
    n = F.col("continuous_segments")
    return (
        progress(state)
        .select(
            "dataset",
            "total_ranges",
            "completed_ranges",
            "processing_ranges",
            "failed_ranges",
            "pending_ranges",
            "completion_percentage",
            "overall_status",
            "highest_block_completed",
            "total_rows_indexed",
        )
        .join(runs, "dataset", "left")
        .withColumn("continuous_segments", F.coalesce("__runs", F.lit(0)))
        .drop("__runs")
        .withColumn(
            "continuity_description",
            F.when(n == 1, "fully_continuous")
            .when(n > 1, F.concat(F.lit("fragmented_"), n.cast("string"), F.lit("_segments")))
            .otherwise("no_completed_data"),
        )
    )


def find_gaps(
    state: DataFrame,
    datasets: Sequence[str] = DATASETS,
    start_block: int = 0,
    end_block: int = 0,
    min_gap: int = 100,
    history: str = "raw",
    lookback_blocks: int | None = None,
    align: int = 1,
) -> DataFrame:
    """(dataset, gap_start, gap_end) missing inside the attempted scope, for all datasets.

    The window per dataset is [start_block, end_block), cut to the highest block attempted;
    end_block 0 means up to there. With `lookback_blocks` the window is instead that many
    blocks below the highest one attempted, its start rounded down to `align`. A gap is a
    hole between completed ranges, the missing tail below any work in flight, or a failed
    range that never completed. Gaps shorter than `min_gap` are dropped.

    `datasets` bounds the per-dataset window rows, which is why they may be broadcast.
    """
    wanted = list(dict.fromkeys(datasets))
    events = state.filter(F.col("dataset").isin(wanted))
    if history == "latest":
        events = latest_status(events)
    elif history != "raw":
        raise ValueError(f"unknown history {history}")
    events = events.select(*STATE_KEY, "status")
    status = F.col("status")

    highest = F.col("highest_attempted")
    if lookback_blocks is None:
        lo, hi = F.lit(start_block).cast("bigint"), highest
        if end_block > 0:
            hi = F.least(F.lit(end_block).cast("bigint"), highest)
    else:
        below = F.greatest(highest - lookback_blocks, F.lit(0).cast("bigint"))
        lo, hi = below - below % align, highest
    windows = F.broadcast(
        highest_attempted(events)
        .select(
            "dataset",
            F.when(is_diff_dataset() & (lo == 0), DIFF_GAP_START).otherwise(lo).alias("lo"),
            hi.alias("hi"),
        )
        .filter(F.col("hi") > F.col("lo"))
    )

    def inside(rows: DataFrame) -> DataFrame:
        return rows.join(windows, "dataset").filter(
            (F.col("start_block") >= F.col("lo")) & (F.col("end_block") <= F.col("hi"))
        )

    completed = positioned(
        inside(events.filter(status == COMPLETED))
        .groupBy("dataset", "lo", "start_block")
        .agg(F.max("end_block").alias("end_block")),
        ["dataset"],
        "start_block",
    )
    holes = running_before(
        completed, ["dataset"], "start_block", {"__reach": ("end_block", "max")}
    ).select(
        "dataset",
        F.greatest("lo", "__reach").alias("gap_start"),
        F.col("start_block").alias("gap_end"),
    )

    # Tail: from the last completed block to the window end, below the first range that is
    # (in any event of its history) being processed there.
    reach = completed.groupBy("dataset").agg(F.max("end_block").alias("__reach"))
    tail = windows.join(F.broadcast(reach), "dataset", "left").select(
        "dataset", F.greatest("lo", "__reach").alias("__current"), "hi"
    )
    in_flight = (
        events.filter(status == PROCESSING)
        .join(F.broadcast(tail), "dataset")
        .filter((F.col("end_block") > F.col("__current")) & (F.col("start_block") < F.col("hi")))
        .groupBy("dataset")
        .agg(F.min("start_block").alias("__in_flight"))
    )
    tails = tail.join(F.broadcast(in_flight), "dataset", "left").select(
        "dataset",
        F.col("__current").alias("gap_start"),
        F.least("hi", "__in_flight").alias("gap_end"),
    )

    # A hole or tail cannot equal a completed range, which would have closed it, so only
    # failed ranges need the check.
    failed = (
        inside(events.filter(status.isin(FAILED, COMPLETED)))
        .groupBy(*STATE_KEY)
        .agg(F.bool_and(status == FAILED).alias("__never_completed"))
        .filter("__never_completed")
        .select(
            "dataset",
            F.col("start_block").alias("gap_start"),
            F.col("end_block").alias("gap_end"),
        )
    )
    length = F.col("gap_end") - F.col("gap_start")
    return (
        holes.unionByName(tails)
        .unionByName(failed)
        .filter((length > 0) & (length >= min_gap))
        .filter(~(is_diff_dataset() & (F.col("gap_start") == 0)))
        .distinct()
    )


def block_islands(blocks: DataFrame, number: str = "block_number", width: int = 1 << 20) -> DataFrame:
    """Maximal runs of consecutive block numbers as [start_block, end_block).

    Islands are found inside buckets first. Only those that touch a bucket edge, two per
    bucket at most, can continue in a neighbour and take part in the second pass.
    """
    numbers = (
        blocks.select(F.col(number).cast("bigint").alias("n"))
        .filter(F.col("n").isNotNull())
        .distinct()
        .withColumn("__bucket", bucket_of("n", width))
    )
    in_bucket = Window.partitionBy("__bucket").orderBy("n")
    local = (
        numbers.withColumn("__key", F.col("n") - F.row_number().over(in_bucket))
        .groupBy("__bucket", "__key")
        .agg(F.min("n").alias("start_block"), (F.max("n") + 1).alias("end_block"))
    )
    at_edge = (F.col("start_block") == F.col("__bucket") * width) | (
        F.col("end_block") == (F.col("__bucket") + 1) * width
    )
    columns = ["start_block", "end_block"]
    stitched = merge_ranges(local.filter(at_edge).select(*columns), []).select(
        F.col("segment_start").alias("start_block"), F.col("segment_end").alias("end_block")
    )
    return local.filter(~at_edge).select(*columns).unionByName(stitched)
