"""What has to be loaded again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.operators.coverage import find_gaps, highest_attempted, non_completed_ranges
from spanledger.operators.latest import last_events
from spanledger.operators.quality import is_empty
from spanledger.operators.running import at_marks, positioned
from spanledger.plans.ranges import split_ranges
from spanledger.schemas import BLOCKS_PER_HOUR, DATASETS, FAILED, PROCESSING, STATE_KEY

# Why a range is in the plan; the first that applies is reported.
REASONS = ("not_completed", "gap", "failed", "zero_rows")


def without_overlap(candidates: DataFrame, busy: DataFrame) -> DataFrame:
    """Candidate ranges that overlap no busy range of their dataset; neither side has NULLs.

    A busy range overlaps [s, e) iff it starts before e and ends after s, so the furthest end
    among busy ranges that start before e decides. That is one running maximum; no
    (candidate, busy) pair is formed.
    """
    # Candidates are read twice. With the same rows and columns wanted on both sides, Spark
    # runs the shuffle below them once.
    candidates = positioned(candidates.dropna(), ["dataset"], "end_block")
    points = (
        busy.select("dataset", F.col("start_block").alias("__at"), F.col("end_block").alias("__reach"))
        .withColumn("__mark", F.lit(0))
        .unionByName(
            candidates.select(
                "dataset",
                F.col("end_block").alias("__at"),
                F.lit(None).cast("bigint").alias("__reach"),
                F.lit(1).alias("__mark"),
            )
        )
        .groupBy("dataset", "__at")
        .agg(F.max("__reach").alias("__reach"), F.max("__mark").alias("__mark"))
    )
    reach = at_marks(points, ["dataset"], "__at", {"__busy_until": ("__reach", "max")}).select(
        "dataset", F.col("__at").alias("end_block"), "__busy_until"
    )
    return (
        candidates.join(reach, ["dataset", "end_block"], "left")
        .filter(F.coalesce(F.col("__busy_until") <= F.col("start_block"), F.lit(True)))
        .select(*candidates.columns)
    )


def _with_reason(df: DataFrame, reason: str) -> DataFrame:
    return df.select(*STATE_KEY, F.lit(REASONS.index(reason)).alias("__why"))


def repair_plan(
    state: DataFrame,
    mode: str = "maintain",
    datasets: Sequence[str] = DATASETS,
    start_block: int = 0,
    end_block: int = 0,
    batch: int = 100,
    lookback_hours: int = 48,
    min_gap: int = 100,
) -> DataFrame:
    """(dataset, start_block, end_block, reason, load_order), each range once.

    "maintain" takes all ranges not completed and all gaps, and assumes that nothing else is
    loading. "auto" looks back from the highest block attempted, takes gaps, failed and
    empty ranges, and leaves out whatever overlaps a range in process. Blocks have
    load_order 0, since the other datasets need them.
    """
    gap_range = [
        "dataset", F.col("gap_start").alias("start_block"), F.col("gap_end").alias("end_block")
    ]
    if mode == "maintain":
        gaps = find_gaps(state, datasets, start_block, end_block, min_gap)
        found = _with_reason(
            non_completed_ranges(state, datasets, start_block, end_block), "not_completed"
        ).unionByName(_with_reason(split_ranges(gaps.select(*gap_range), batch), "gap"))
    elif mode == "auto":
        lookback = lookback_hours * BLOCKS_PER_HOUR
        mine = state.filter(F.col("dataset").isin(list(datasets)))
        gaps = find_gaps(
            state, datasets, min_gap=min_gap, lookback_blocks=lookback, align=batch
        )
        below = F.greatest(F.col("highest_attempted") - lookback, F.lit(0).cast("bigint"))
        windows = highest_attempted(mine).select(
            "dataset", (below - below % batch).alias("__lo"), F.col("highest_attempted").alias("__hi")
        )

        last = last_events(mine)
        why = F.when(F.col("status") == FAILED, REASONS.index("failed")).when(
            is_empty(), REASONS.index("zero_rows")
        )
        issues = (
            last.withColumn("__why", why)
            .filter(F.col("__why").isNotNull())
            .join(F.broadcast(windows), "dataset")
            .filter((F.col("start_block") >= F.col("__lo")) & (F.col("end_block") <= F.col("__hi")))
            .select(*STATE_KEY, "__why")
        )
        found = _with_reason(split_ranges(gaps.select(*gap_range), batch), "gap").unionByName(issues)
    else:
        raise ValueError(f"unknown mode {mode}")
    found = found.groupBy(*STATE_KEY).agg(F.min("__why").alias("__why"))
    if mode == "auto":
        found = without_overlap(found, last.filter(F.col("status") == PROCESSING).select(*STATE_KEY))
    return found.select(
        *STATE_KEY,
        F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.col("__why") + 1).alias("reason"),
        F.when(F.col("dataset") == "blocks", 0).otherwise(1).alias("load_order"),
    )
