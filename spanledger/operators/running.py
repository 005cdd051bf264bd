"""Running aggregates and range sums that no single task has to hold.

A window over one dataset would put all of its rows into one task. Here positions are cut
into buckets: a window runs inside each (group, bucket), one small window runs over the
bucket totals, and the two are added. With one row per position, which every caller makes
sure of by aggregating first, a bucket has at most BUCKET_WIDTH rows, and block numbers
below 2^40 have at most 2^20 buckets per group, whatever the distribution of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.columns import bucket_of
from spanledger.operators.joins import join_unique

BUCKET_WIDTH = 1 << 20
_AGG = {"max": F.max, "sum": F.sum}


def positioned(df: DataFrame, by: Sequence[str], position: str, width: int = BUCKET_WIDTH) -> DataFrame:
    """The rows that take part in a running aggregate."""
    for c in by:
        df = df.filter(F.col(c).isNotNull())
    return df.filter(bucket_of(position, width).isNotNull())


def running_before(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    values: dict[str, tuple[str, str]],
    then_by: Sequence[str] = (),
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Add, for each `out: (column, "max" | "sum")`, the aggregate over all earlier rows.

    Rows are ordered by `position` (not negative) and then `then_by` inside each `by` group.
    A sum over no rows is 0, a maximum over no rows is NULL.
    """
    by = list(by)
    # The join below drops NULL keys; said here, both of its sides read the same rows and
    # Spark runs the shuffle they share once.
    bucketed = positioned(df, by, position, width).withColumn("__bucket", bucket_of(position, width))
    totals = bucketed.groupBy(*by, "__bucket").agg(
        *[_AGG[how](c).alias(f"__total_{out}") for out, (c, how) in values.items()]
    )
    over_buckets = (
        Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *by,
        "__bucket",
        *[
            _AGG[how](f"__total_{out}").over(over_buckets).alias(f"__carry_{out}")
            for out, (_, how) in values.items()
        ],
    )
    inside = (
        Window.partitionBy(*by, "__bucket")
        .orderBy(position, *then_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = bucketed.join(carry, [*by, "__bucket"])
    for out, (c, how) in values.items():
        here, before = _AGG[how](c).over(inside), F.col(f"__carry_{out}")
        joined = joined.withColumn(
            out,
            F.greatest(here, before)
            if how == "max"
            else F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)),
        )
    return joined.drop("__bucket", *[f"__carry_{out}" for out in values])


def at_marks(df: DataFrame, by: Sequence[str], position: str, values: dict, width: int = BUCKET_WIDTH) -> DataFrame:
    """`running_before`, for the rows with `__mark` = 1 only.

    The running maximum of the mark is always positive or NULL. Asking for it makes both
    passes over `df` want the same columns, so that Spark runs the shuffle below them once.
    """
    running = running_before(df, by, position, values | {"__mark_before": ("__mark", "max")}, width=width)
    return running.filter(
        (F.col("__mark") == 1) & (F.coalesce("__mark_before", F.lit(0)) >= 0)
    ).drop("__mark", "__mark_before")


def sum_over_ranges(
    points: DataFrame,
    ranges: DataFrame,
    position: str,
    measures: dict[str, Column],
    width: int = BUCKET_WIDTH,
    n_ranges: int | None = None,
) -> DataFrame:
    """Totals over the points inside each distinct range [start, end).

    `measures` are aggregates over all points of one position, 0 or NULL over no points; the
    result is their sum over the positions of the range. Total = running total at end -
    running total at start, so ranges may overlap, nest or have any length, and no (point,
    range) pair is ever formed. `n_ranges` is a bound on the number of ranges, where the caller knows one.
    """
    wanted = ranges.select("start_block", "end_block").distinct()
    marks = wanted.select(
        F.explode(F.array("start_block", "end_block")).alias(position), F.lit(1).alias("__mark")
    )
    per_position = (
        points.withColumn("__mark", F.lit(0))
        .unionByName(marks, allowMissingColumns=True)
        .groupBy(position)
        .agg(
            *[F.coalesce(m, F.lit(0)).cast("bigint").alias(name) for name, m in measures.items()],
            F.max("__mark").alias("__mark"),
        )
    )
    before = at_marks(
        per_position, [], position, {f"__b_{m}": (m, "sum") for m in measures}, width
    ).select(position, *[f"__b_{m}" for m in measures])
    ends = wanted.select(
        "start_block",
        "end_block",
        F.explode(
            F.array(
                F.struct(F.col("start_block").alias(position), F.lit(-1).alias("__sign")),
                F.struct(F.col("end_block").alias(position), F.lit(1).alias("__sign")),
            )
        ).alias("__e"),
    ).select("start_block", "end_block", "__e.*")
    return (
        join_unique(
            ends, before, [position], "inner", sized_by=marks, at_most=None if n_ranges is None else 2 * n_ranges
        )
        .groupBy("start_block", "end_block")
        .agg(*[F.sum(F.col("__sign") * F.col(f"__b_{m}")).alias(m) for m in measures])
    )
