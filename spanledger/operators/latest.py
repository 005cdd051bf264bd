"""Latest-version reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.schemas import STATE_KEY


def latest_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("insert_version",)
) -> DataFrame:
    """The last version of every key, over the whole key and all partitions.

    `row_number() = 1` lets Spark place a group limit before the shuffle, so each map task
    sends at most one row per key; a key with very many versions does not grow its reducer.
    NULL key parts group together. `order` should be total, else equal versions tie.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return (
        df.withColumn("__version_rank", F.row_number().over(window))
        .filter(F.col("__version_rank") == 1)
        .drop("__version_rank")
    )


def _state_order() -> Column:
    # created_at has one-second resolution, insert_version breaks its ties.
    return F.struct("created_at", "insert_version")


def latest_state(state: DataFrame) -> DataFrame:
    """One row per range. completed_at, rows_indexed and error_message are the last ones
    known (NULL does not replace a value); the other columns come from the last event.

    A plain aggregate: combined before the shuffle, and unused columns are pruned.
    """
    order = _state_order()

    def last(c: str) -> Column:
        return F.max_by(c, order).alias(c)

    def last_known(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)

    return state.groupBy(*STATE_KEY).agg(
        last("status"),
        last("worker_id"),
        last("attempt_count"),
        F.max("created_at").alias("created_at"),
        last_known("completed_at"),
        last_known("rows_indexed"),
        last_known("error_message"),
        last("insert_version"),
    )


def latest_status(state: DataFrame) -> DataFrame:
    return latest_state(state).select(*STATE_KEY, "status")


def last_events(state: DataFrame) -> DataFrame:
    """The last event of every range as it was written, without values of older ones.

    The columns travel in one struct, so that plans which filter the result in several ways
    all ask for one and the same shuffle.
    """
    columns = ("status", "worker_id", "rows_indexed", "created_at")
    last = state.groupBy(*STATE_KEY).agg(F.max_by(F.struct(*columns), _state_order()).alias("__last"))
    return last.select(*STATE_KEY, "__last.*")


def range_status(state: DataFrame, dataset: str, start: int, end: int) -> DataFrame:
    """Status of one range; no row when it was never attempted."""
    return latest_status(
        state.filter(
            (F.col("dataset") == dataset)
            & (F.col("start_block") == start)
            & (F.col("end_block") == end)
        )
    )
