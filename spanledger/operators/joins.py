"""Equi-join against a side that has one row per key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A right side of at most this many rows is sent to every executor. Right sides here have two
# or three long columns, so that is some 100 MB as a hash table.
BROADCAST_ROWS = 2_000_000
# Left keys with more rows than this are hot; at most HOT_KEYS of them are set apart. A key
# ranked below the first 10,000 holds under 1/10,000 of the rows, no more than a usual task.
HOT_KEY_ROWS = 1_000_000
HOT_KEYS = 10_000
# Steps of one array, of what is dealt to a task as one row, and of what follows each other in the result; each is a
# multiple of the next.
STEPS_PER_ARRAY = 4096
STEPS_DEALT = 512
STEPS_TOGETHER = 32


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Size check: a count that every task combines, so that it sends one row."""
    return df.count() <= rows


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_key_rows: int | None = HOT_KEY_ROWS,
    sized_by: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """`left` joined ("left" or "inner") to `right`, which has one narrow row per key.

    A right side that passes the size check is broadcast and `left` does not move at all. The
    check counts `sized_by` where given, a frame that is cheaper to count and has at least
    as many rows; with `at_most`, a bound that the caller knows, nothing runs here. Beyond it, rows of hot left keys meet their few parents in a broadcast join, rows
    without a key need no join, and all others meet in an ordinary shuffled join. The three
    parts are disjoint and complete, so the result is the same as that of a plain join.

    Setting hot keys apart computes `left` once to count its keys and again for the parts. With `hot_key_rows` None it is computed
    once and hot keys are left to the adaptive skew join, which splits them as long as nothing behind the join relies on how its
    rows are dealt: for a left side that is itself dear, and a result that is written as it is.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    columns = left.columns + [c for c in right.columns if c not in on]
    if at_most is not None:
        small = at_most <= broadcast_rows
    else:
        small = has_at_most(right if sized_by is None else sized_by, broadcast_rows)
    if small:
        return left.join(F.broadcast(right), on, how).select(*columns)
    if hot_key_rows is None:
        return left.join(right, on, how).select(*columns)

    has_key = F.lit(True)
    for c in on:
        has_key = has_key & F.col(c).isNotNull()
    keyed = left.filter(has_key)
    hot = F.broadcast(
        keyed.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > hot_key_rows)
        .orderBy(F.desc("__rows"), *on)
        .limit(HOT_KEYS)
        .select(*on)
    )
    hot_parents = F.broadcast(right.join(hot, on, "left_semi"))
    joined = (
        keyed.join(hot, on, "left_semi").join(hot_parents, on, how).select(*columns)
    ).unionByName(keyed.join(hot, on, "left_anti").join(right, on, how).select(*columns))
    if how == "left":
        joined = joined.unionByName(left.filter(~has_key), allowMissingColumns=True)
    return joined.select(*columns)


def explode_steps(
    df: DataFrame, first: Column, last: Column, step: int, out: str, partitions: int | None = None
) -> DataFrame:
    """One row per first, first + step, ... up to and including `last`.

    Done in stages with a shuffle of cut ranges between them, so neither one array nor one task has to hold all steps of a
    very long range. Ranges on the same steps are cut at the same places, and equal cuts are dealt and sorted
    together; written, equal values are then near each other and take less room. Only cuts are shuffled and
    sorted, one row for up to 512 and 32 steps. As they are that few, Spark may coalesce them to one task that makes
    all steps; with `partitions` they are dealt to so many.
    """
    begin, end, at, phase = F.col("__first"), F.col("__last"), F.col("__at"), F.col("__phase")
    array, dealt, together = (
        step * min(n, STEPS_PER_ARRAY) for n in (STEPS_PER_ARRAY, STEPS_DEALT, STEPS_TOGETHER)
    )

    def steps(lo: Column, hi: Column, width: int) -> Column:
        # sequence() refuses to run backwards, even for a row that a filter is about to drop.
        return F.explode(F.sequence(lo, F.greatest(lo, F.least(hi, end)), F.lit(width)))

    def cut(rows: DataFrame, width: int, into: int) -> DataFrame:
        finer = rows.withColumn("__at", steps(at, at + F.lit(width - into), into))
        return finer.filter(at + F.lit(into) > begin)

    lo, hi = F.greatest(at, begin), F.least(at + F.lit(together - step), end)
    rows = (
        df.withColumns({"__first": first, "__last": last})
        .filter(begin <= end)
        .withColumn("__phase", F.pmod(begin, F.lit(step)))
        .withColumn("__at", steps(begin - F.pmod(begin - phase, F.lit(array)), end, array))
    )
    rows = cut(rows, array, dealt).repartition(*[] if partitions is None else [partitions], phase, at)
    return (
        cut(rows, dealt, together)
        .sortWithinPartitions(phase, at, lo, hi)
        .withColumn(out, steps(lo, hi, step))
        .drop("__first", "__last", "__phase", "__at")
    )
