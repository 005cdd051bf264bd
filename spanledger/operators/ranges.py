"""Sets of ranges: merging them, and picking the rows that lie in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import bucket_of
from spanledger.operators.joins import BROADCAST_ROWS, explode_steps, has_at_most
from spanledger.operators.running import running_before

# Buckets a span is cut into when its ranges are merged before they are broadcast.
SPAN_BUCKETS = 100_000


def merge_ranges(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Touching or overlapping ranges merged, per `by` group, for any lengths."""
    starts = ranges.groupBy(*by, "start_block").agg(F.max("end_block").alias("end_block"))
    opened = running_before(
        starts, by, "start_block", {"__reach": ("end_block", "max")}
    ).withColumn(
        "__opens",
        F.when(
            F.col("__reach").isNull() | (F.col("start_block") > F.col("__reach")),
            F.col("start_block"),
        ),
    )
    placed = running_before(opened, by, "start_block", {"__open": ("__opens", "max")})
    return (
        placed.withColumn("segment_start", F.greatest("__open", "__opens"))
        .groupBy(*by, "segment_start")
        .agg(F.max("end_block").alias("segment_end"))
    )


def range_pieces(ranges: DataFrame, width: int) -> DataFrame:
    """Ranges cut at multiples of `width`: distinct (bucket, lo, hi)."""
    wanted = (
        ranges.select("start_block", "end_block")
        .filter(F.col("end_block") > F.col("start_block"))
        .distinct()
    )
    buckets = explode_steps(
        wanted, bucket_of("start_block", width), bucket_of(F.col("end_block") - 1, width), 1, "__bucket"
    )
    return buckets.select(
        "__bucket",
        F.greatest("start_block", F.col("__bucket") * width).alias("__lo"),
        F.least("end_block", (F.col("__bucket") + 1) * width).alias("__hi"),
    ).distinct()


def rows_in_ranges(
    df: DataFrame,
    ranges: DataFrame,
    position: str = "block_number",
    inside: bool = True,
    width: int = 1000,
    broadcast_rows: int = BROADCAST_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Rows whose position lies in any of the ranges (or in none, with inside=False).

    Semi or anti join on the bucket of the position, so a row is never multiplied. Pieces that
    pass the size check are broadcast and the rows do not move. Too many pieces are first
    merged, after which a plan of adjoining ranges is a few long ones whatever their number;
    only a set that stays too large makes both sides shuffle, and AQE then splits a hot bucket.
    With `at_most`, a bound on the pieces of width 1000 that the caller knows, none are counted where it suffices.
    """
    pieces = range_pieces(ranges, width)
    small = (at_most is not None and at_most <= broadcast_rows) or has_at_most(pieces, broadcast_rows)
    if not small:
        span = ranges.agg(F.min("start_block").alias("lo"), F.max("end_block").alias("hi")).first()
        width = max(width, (span["hi"] - span["lo"]) // SPAN_BUCKETS)
        merged = merge_ranges(ranges, []).select(
            F.col("segment_start").alias("start_block"), F.col("segment_end").alias("end_block")
        )
        pieces = range_pieces(merged, width)
        small = has_at_most(pieces, broadcast_rows)
    if small:
        pieces = F.broadcast(pieces)
    p = F.col(position)
    condition = (
        (bucket_of(p, width) == F.col("__bucket")) & (p >= F.col("__lo")) & (p < F.col("__hi"))
    )
    return df.join(pieces, condition, "left_semi" if inside else "left_anti")
