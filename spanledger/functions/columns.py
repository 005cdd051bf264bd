"""Column expressions shared by the operators. All of them are built-ins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanledger.schemas import DIFF_DATASETS, EPOCH_FLOOR_SECONDS, TABLES


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_at(as_of: datetime | str | Column) -> Column:
    """A point in time as a column; plain values are read in the session time zone."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def usable_timestamp(seconds: Column | str = "timestamp") -> Column:
    """True when a unix time is present and later than 1971-01-01 UTC; never NULL."""
    return F.coalesce(col(seconds) > F.lit(EPOCH_FLOOR_SECONDS), F.lit(False))


def block_timestamp(seconds: Column | str = "timestamp") -> Column:
    return F.timestamp_seconds(col(seconds))


def bucket_of(position: Column | str, width: int) -> Column:
    """Whole-number bucket of a non-negative block number (no trip through double)."""
    return F.call_function("div", col(position), F.lit(width))


def align_down(position: Column | str, batch: int) -> Column:
    p = col(position)
    return p - p % F.lit(batch)


def align_start(position: Column | str, batch: int) -> Column:
    """First multiple of `batch` at or after `position`."""
    p = col(position)
    return align_down(p, batch) + F.when(p % F.lit(batch) > 0, batch).otherwise(0)


def first_block(dataset: Column | str, start: Column | str) -> Column:
    """Start moved up to the earliest block the dataset can hold rows for."""
    d = col(dataset)
    floor = F.lit(0)
    for table in TABLES.values():
        if table.first_block:
            floor = F.when(d == table.name, table.first_block).otherwise(floor)
    return F.greatest(col(start), floor.cast("bigint"))


def is_diff_dataset(dataset: Column | str = "dataset") -> Column:
    return col(dataset).isin(*DIFF_DATASETS)


def range_label(start: Column | str, end: Column | str) -> Column:
    return F.concat_ws("-", col(start).cast("string"), col(end).cast("string"))


def overall_status(completed, processing, failed, pending, total) -> Column:
    """One word for a dataset from its range counts."""
    return (
        F.when(total == 0, "no_data")
        .when(completed == total, "complete")
        .when(processing > 0, "in_progress")
        .when((failed > 0) & (pending == 0), "failed")
        .when(pending > 0, "pending")
        .otherwise("mixed")
    )


def normal_hash(c: Column | str) -> Column:
    """Hash text without 0x and in lower case, so that both notations compare equal."""
    return F.regexp_replace(F.lower(col(c)), "^0x", "")
