"""State transitions. Each takes ranges and returns new state rows to append."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import first_block, timestamp_at
from spanledger.operators.latest import last_events, latest_status
from spanledger.schemas import (
    COMPLETED,
    ERROR_TEXT_LIMIT,
    FAILED,
    PROCESSING,
    REPROCESS_MESSAGE,
    SKIPPED,
    STATE_KEY,
    STATE_SCHEMA,
    STUCK_MESSAGE,
)


def state_rows(ranges: DataFrame, as_of, version: int, **values: Column) -> DataFrame:
    """Ranges as state rows; columns not named in `values` take their table default."""
    defaults = {
        "worker_id": F.lit(""),
        "attempt_count": F.lit(0),
        "created_at": timestamp_at(as_of),
        "insert_version": F.lit(version),
    }
    defaults.update(values)
    return ranges.select(
        *STATE_KEY,
        *[
            defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STATE_SCHEMA.fields
            if f.name not in STATE_KEY
        ],
    )


def claim_ranges(state: DataFrame, requested: DataFrame, worker: str, as_of, version: int) -> DataFrame:
    """`processing` rows for the requested ranges nobody has completed or is working on.

    Reads, then appends, so two claimers at the same moment can both win; versions absorb it.
    """
    taken = latest_status(state).filter(F.col("status").isin(COMPLETED, PROCESSING))
    free = requested.select(*STATE_KEY).distinct().join(taken, list(STATE_KEY), "left_anti")
    return state_rows(free, as_of, version, status=F.lit(PROCESSING), worker_id=F.lit(worker))


def complete_ranges(ranges: DataFrame, as_of, version: int) -> DataFrame:
    """`completed` rows for ranges that carry rows_indexed."""
    return state_rows(
        ranges,
        as_of,
        version,
        status=F.lit(COMPLETED),
        completed_at=timestamp_at(as_of),
        rows_indexed=F.coalesce("rows_indexed", F.lit(0)),
    )


def fail_ranges(state: DataFrame, failures: DataFrame, as_of, version: int) -> DataFrame:
    """`failed` rows for (range, error_message), one row per range, attempt = highest ever + 1."""
    attempts = state.groupBy(*STATE_KEY).agg(F.max("attempt_count").alias("__attempts"))
    counted = failures.select(*STATE_KEY, "error_message").join(attempts, list(STATE_KEY), "left")
    return state_rows(
        counted,
        as_of,
        version,
        status=F.lit(FAILED),
        attempt_count=F.coalesce("__attempts", F.lit(0)) + 1,
        error_message=F.substring(F.coalesce("error_message", F.lit("")), 1, ERROR_TEXT_LIMIT),
    )


def fail_dependents(
    state: DataFrame, bad_ranges: DataFrame, datasets: Sequence[str], as_of, version: int
) -> DataFrame:
    """`failed` rows for the datasets given up on because their blocks are not usable.

    `bad_ranges` has (start_block, end_block, reason). A dataset that completed the range is
    left alone, and a diff dataset's range starts at its first possible block.
    """
    others = [d for d in datasets if d != "blocks"]
    ranges = (
        bad_ranges.withColumn("dataset", F.explode(F.array(*[F.lit(d) for d in others])))
        .withColumn("start_block", first_block("dataset", "start_block"))
        .withColumn("error_message", F.concat(F.lit(SKIPPED), F.col("reason")))
        .groupBy(*STATE_KEY)
        .agg(F.min("error_message").alias("error_message"))
    )
    done = latest_status(state).filter(F.col("status") == COMPLETED)
    return fail_ranges(state, ranges.join(done, list(STATE_KEY), "left_anti"), as_of, version)


def stuck_ranges(state: DataFrame, as_of, timeout_hours: int = 2) -> DataFrame:
    """Ranges whose last event is `processing` and older than the timeout."""
    return (
        last_events(state)
        .filter(
            (F.col("status") == PROCESSING)
            & (F.col("created_at") < timestamp_at(as_of) - F.make_dt_interval(hours=F.lit(timeout_hours)))
        )
        .select(*STATE_KEY, "status", "worker_id", "created_at")
    )


def recover_stuck(state: DataFrame, as_of, version: int, timeout_hours: int = 2) -> DataFrame:
    """`failed` rows that free the stuck ranges for repair."""
    stuck = stuck_ranges(state, as_of, timeout_hours).withColumnRenamed("created_at", "__since")
    return state_rows(
        stuck,
        as_of,
        version,
        status=F.lit(FAILED),
        attempt_count=F.lit(1),
        error_message=F.concat(F.lit(STUCK_MESSAGE), F.date_format("__since", "yyyy-MM-dd HH:mm:ss")),
    )


def mark_reprocess(ranges: DataFrame, as_of, version: int) -> DataFrame:
    """`failed` rows that send completed but empty ranges through repair again."""
    return state_rows(
        ranges,
        as_of,
        version,
        status=F.lit(FAILED),
        attempt_count=F.lit(1),
        error_message=F.lit(REPROCESS_MESSAGE),
    )
