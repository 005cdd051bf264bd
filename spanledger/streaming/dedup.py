"""Replay suppression and lateness on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import timestamp_at


def stream_dedup(
    rows: DataFrame, keys: Sequence[str], stamp: str = "block_timestamp", lateness: str = "2 days"
) -> DataFrame:
    """First arrival per key; state is kept for `lateness` of event time only.

    Meant for identical replays of a batch. Corrections of a row need the stored versions and
    `latest_wins`, since here the first arrival stays.
    """
    return rows.withWatermark(stamp, lateness).dropDuplicatesWithinWatermark(list(keys))


def confirmed_by_time(
    rows: DataFrame, confirmations: int, seconds_per_block: int = 5, stamp: str = "block_timestamp"
) -> DataFrame:
    """Watermark at the confirmation depth, for event-time operators downstream."""
    return rows.withWatermark(stamp, f"{confirmations * seconds_per_block} seconds")


def unexpired_stream(
    rows: DataFrame,
    keep_days: int,
    stamp: str = "block_timestamp",
    lateness: str | None = None,
    as_of=None,
) -> DataFrame:
    """Live-tier rows: a watermark at the retention, and no row that is already past it as of a
    given time, else as of each micro-batch's."""
    keep = F.make_dt_interval(days=F.lit(keep_days))
    return rows.withWatermark(stamp, lateness or f"{keep_days} days").filter(
        F.col(stamp) + keep > (F.current_timestamp() if as_of is None else timestamp_at(as_of))
    )
