"""State events folded to one row per range, mergeable with later events.

A folded row keeps what the readers of the state ask of a range's history: the last event, the last known value of
the columns that only some events fill, and counts. All of it merges by maximum and sum, so that events that were folded need not be read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.operators.coverage import summarised
from spanledger.schemas import COMPLETED, PROCESSING, STATE_KEY, STATE_SCHEMA, STATUSES

KNOWN = ("completed_at", "rows_indexed", "error_message")
_LARGEST = ("last", *(f"known_{c}" for c in KNOWN), "attempts", "claimed_at")
_SUMS = ("n_events", *(f"n_{s}" for s in STATUSES), "rows_total", "rows_completed")


def fold(events: DataFrame) -> DataFrame:
    """One row per range out of its events."""
    status, rows = F.col("status"), F.col("rows_indexed")
    at = (F.col("created_at"), F.col("insert_version"))

    def known(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(*at, F.col(c).alias("value")))).alias(f"known_{c}")

    return events.groupBy(*STATE_KEY).agg(
        F.max(F.struct(*at, "status", "worker_id", "attempt_count")).alias("last"),
        *[known(c) for c in KNOWN],
        F.max("attempt_count").alias("attempts"),
        F.max(F.when(status == PROCESSING, F.col("created_at"))).alias("claimed_at"),
        F.count(F.lit(1)).alias("n_events"),
        *[F.count_if(status == s).alias(f"n_{s}") for s in STATUSES],
        F.sum(rows).alias("rows_total"),
        F.sum(F.when(status == COMPLETED, rows)).alias("rows_completed"),
    )


def merge(folded: DataFrame) -> DataFrame:
    """One row per range out of folded rows of disjoint sets of events."""
    return folded.groupBy(*STATE_KEY).agg(
        *[F.max(c).alias(c) for c in _LARGEST], *[F.sum(c).alias(c) for c in _SUMS]
    )


def latest_of(folded: DataFrame) -> DataFrame:
    """What `latest_state` gives for the events."""
    return folded.select(
        *STATE_KEY, "last.status", "last.worker_id", "last.attempt_count", "last.created_at",
        *[F.col(f"known_{c}.value").alias(c) for c in KNOWN], "last.insert_version",
    )


def history_of(folded: DataFrame) -> DataFrame:
    """A short history that stands for the events: at most one row per range and status.

    The last event comes with the values known. Every other status the range ever had follows as an older event, with the
    highest attempt, so that readers of the latest event, of statuses ever seen and of the highest attempt find what they would
    find in all events. Those who count events take `history_summary_of`.
    """
    last = latest_of(folded)
    last = last.select(*[F.col(f.name).cast(f.dataType) for f in STATE_SCHEMA.fields])
    seen = F.array(*[F.when(F.col(f"n_{s}") > 0, F.lit(s)) for s in STATUSES])
    other = F.filter(
        seen, lambda s: s.isNotNull() & ((s != F.col("last.status")) | (F.col("attempts") > F.col("last.attempt_count")))
    )
    values = {"status": F.col("__status"), "attempt_count": F.col("attempts"), "created_at": F.col("last.created_at")}
    older = folded.withColumn("__status", F.explode(other)).select(
        *[(F.col(f.name) if f.name in STATE_KEY else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields]
    )
    return last.unionByName(older)


def history_summary_of(folded: DataFrame) -> DataFrame:
    """What `history_summary` gives for the events."""
    counted = folded.groupBy("dataset").agg(
        F.sum("n_events").alias("total_ranges"),
        *[F.sum(f"n_{s}").alias(f"{s}_ranges") for s in STATUSES],
        F.coalesce(F.max("end_block"), F.lit(0)).alias("highest_attempted_block"),
        F.coalesce(F.max(F.when(F.col(f"n_{COMPLETED}") > 0, F.col("end_block"))), F.lit(0)).alias("highest_completed_block"),
        F.coalesce(F.sum("rows_total"), F.lit(0)).alias("total_rows_indexed"),
    )
    return summarised(counted)
