"""Checks over loaded ranges and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import block_timestamp, usable_timestamp
from spanledger.operators.coverage import find_gaps, history_summary
from spanledger.operators.latest import last_events, latest_wins
from spanledger.operators.running import sum_over_ranges
from spanledger.schemas import COMPLETED, DATASETS, ROWS_EXPECTED, STATE_KEY, TABLES


def validate_timestamps(
    ranges: DataFrame, blocks: DataFrame, n_ranges: int | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """(start_block, end_block, ok, reason, expected, valid, present) for each distinct range.

    ok: every block is there with a usable timestamp; invalid: all there, some unusable;
    not_visible: some are not there. All ranges are answered by one pass over the blocks. `n_ranges`
    is a bound on the number of ranges, where the caller knows one. With `rows` the same pass counts them per
    range, as rows_indexed.
    """
    points = blocks.select(
        "block_number", "insert_version", usable_timestamp().cast("int").alias("usable")
    )
    extra = {}
    if rows is not None:
        counted = rows.select("block_number", F.lit(1).alias("__one"))
        points = points.unionByName(counted, allowMissingColumns=True)
        extra = {"rows_indexed": F.count("__one")}
    counted = sum_over_ranges(
        points,
        ranges,
        "block_number",
        {
            "present": F.least(F.count("usable"), F.lit(1)),
            "valid": F.max_by("usable", F.struct("insert_version", "usable")),  # the latest version decides
            **extra,
        },
        n_ranges=n_ranges,
    )
    return gate_columns(counted, *extra)


def gate_columns(counted: DataFrame, *more: str) -> DataFrame:
    """The verdict per range from its counts `present` and `valid`; an empty range is ok."""
    expected = F.greatest(F.col("end_block") - F.col("start_block"), F.lit(0).cast("bigint"))
    empty = expected == 0
    return counted.select(
        "start_block",
        "end_block",
        expected.alias("expected"),
        F.when(empty, 0).otherwise(F.col("valid")).alias("valid"),
        F.when(empty, 0).otherwise(F.col("present")).alias("present"),
        *more,
    ).withColumns(
        {
            "ok": F.col("valid") >= F.col("expected"),
            "reason": F.when(F.col("valid") >= F.col("expected"), "ok")
            .when(F.col("present") >= F.col("expected"), "invalid")
            .otherwise("not_visible"),
        }
    )


def sample_bad_blocks(blocks: DataFrame, start: int, end: int, rows: int = 5) -> DataFrame:
    """The first blocks of a range with their timestamp spelled out, for an error report."""
    wanted = blocks.filter((F.col("block_number") >= start) & (F.col("block_number") < end))
    return (
        latest_wins(wanted, ["block_number"])
        .select("block_number", "timestamp", block_timestamp().alias("formatted_timestamp"))
        .orderBy("block_number")
        .limit(rows)
    )


def zero_row_ranges(
    state: DataFrame,
    datasets: Sequence[str] = DATASETS,
    start_block: int = 0,
    end_block: int | None = None,
) -> DataFrame:
    """Latest-completed ranges without rows, in datasets where every range should have some."""
    checked = [d for d in datasets if d in ROWS_EXPECTED]
    wanted = state.filter(F.col("dataset").isin(checked) & (F.col("start_block") >= start_block))
    if end_block is not None:
        wanted = wanted.filter(F.col("end_block") <= end_block)
    return last_events(wanted).filter(is_empty()).select(*STATE_KEY)


def is_empty() -> Column:
    """On a last event: completed without rows of its own where rows are due."""
    return (
        (F.col("status") == COMPLETED)
        & (F.coalesce("rows_indexed", F.lit(0)) == 0)
        & F.col("dataset").isin(*ROWS_EXPECTED)
    )


def check_schema(df: DataFrame, table: str) -> DataFrame:
    """One row per column of the contract or the frame: missing, extra, type_differs or ok."""
    expected = {f.name: f.dataType.simpleString() for f in TABLES[table].schema.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in [*expected, *[c for c in actual if c not in expected]]:
        want, have = expected.get(name), actual.get(name)
        verdict = (
            "missing" if have is None else "extra" if want is None
            else "ok" if want == have else "type_differs"
        )
        rows.append((name, want, have, verdict))
    columns = "name STRING, expected STRING, actual STRING, verdict STRING"
    return df.sparkSession.createDataFrame(rows, columns)


def validate_report(
    state: DataFrame,
    datasets: Sequence[str] = DATASETS,
    start_block: int = 0,
    end_block: int = 0,
    min_gap: int = 100,
) -> DataFrame:
    """History summary, gap count and verdict per dataset.

    With a window the verdict is "no gaps in it"; without one it is "nothing failed or in
    process". Both sides of the join have one row per dataset.
    """
    gaps = (
        find_gaps(state, datasets, start_block, end_block, min_gap)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("gap_count"),
            F.sum(F.col("gap_end") - F.col("gap_start")).alias("gap_blocks"),
        )
    )
    report = (
        history_summary(state)
        .join(F.broadcast(gaps), "dataset", "left")
        .withColumns(
            {
                "gap_count": F.coalesce("gap_count", F.lit(0)),
                "gap_blocks": F.coalesce("gap_blocks", F.lit(0)),
            }
        )
    )
    if start_block or end_block:
        healthy = F.col("gap_count") == 0
    else:
        healthy = (F.col("failed_ranges") == 0) & (F.col("processing_ranges") == 0)
    return report.withColumn("healthy", healthy)

