"""Presence of blocks as words of 64 bits: what is there and usable, folded, counted and cut into runs.

A word row (word, covered, present, usable) says of blocks 64 * word ... 64 * word + 63 which ones it decides, and which of those
are there and have a usable time. Words of one load are OR-ed; later words overrule the bits that they cover. All of it is
integer arithmetic inside generated code, on a 64th of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import bucket_of, usable_timestamp
from spanledger.operators.joins import explode_steps, join_unique
from spanledger.operators.quality import gate_columns
from spanledger.operators.ranges import merge_ranges
from spanledger.operators.running import at_marks

BITS = 64
# A word as a row, and the order of events: (insert_version, step).
WORD_ROW = "word BIGINT, covered BIGINT, present BIGINT, usable BIGINT, insert_version BIGINT, step INT"
GONE, LOADED = 0, 1  # of one version, deletes come first
_MASKS = ("covered", "present", "usable")


def _low_bits(n: Column) -> Column:
    """The n lowest bits set, for n from 0 to 64."""
    return F.when(n <= 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), (BITS - n).cast("int"))
    )


def _or(*names: str) -> list[Column]:
    return [F.bit_or(n).alias(n) for n in names]


def words_of(blocks: DataFrame, version: int | Column) -> DataFrame:
    """Words of rows loaded under one version; of equal blocks one usable row is enough. Rows without a block number have none."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("block_number") % BITS).cast("int"))
    return (
        blocks.filter(F.col("block_number").isNotNull())
        .select(
            bucket_of(F.col("block_number").cast("bigint"), BITS).alias("word"), bit.alias("present"),
            F.when(usable_timestamp(), bit).otherwise(F.lit(0).cast("bigint")).alias("usable"),
        )
        .groupBy("word")
        .agg(*_or("present", "usable"))
        .select(
            "word", F.col("present").alias("covered"), "present", "usable",
            F.lit(version).cast("bigint").alias("insert_version"), F.lit(LOADED).alias("step"),
        )
    )


def gone_words(ranges: DataFrame, version: int) -> DataFrame:
    """Words that clear every block of the ranges."""
    some = ranges.select("start_block", "end_block").filter(F.col("end_block") > F.col("start_block")).distinct()
    words = explode_steps(some, bucket_of("start_block", BITS), bucket_of(F.col("end_block") - 1, BITS), 1, "word")
    first = F.greatest(F.col("start_block") - F.col("word") * BITS, F.lit(0))
    past = F.least(F.col("end_block") - F.col("word") * BITS, F.lit(BITS))
    covered = _low_bits(past).bitwiseAND(F.bitwise_not(_low_bits(first)))
    nothing = F.lit(0).cast("bigint")
    return (
        words.select("word", covered.alias("covered"))
        .groupBy("word")
        .agg(*_or("covered"))
        .select(
            "word", "covered", nothing.alias("present"), nothing.alias("usable"),
            F.lit(version).cast("bigint").alias("insert_version"), F.lit(GONE).alias("step"),
        )
    )


def fold_words(events: DataFrame) -> DataFrame:
    """One row (word, covered, present, usable) per word; the last event that covers a bit decides it.

    Events of one (word, version, step) are OR-ed before the shuffle; then a word's list has one entry per load that touched
    its 64 blocks.
    """
    per_load = events.groupBy("word", "insert_version", "step").agg(*_or(*_MASKS))
    none = F.struct(*[F.lit(0).cast("bigint").alias(m) for m in _MASKS])

    def put(so_far: Column, e: Column) -> Column:
        kept = F.bitwise_not(e["covered"])
        return F.struct(
            so_far["covered"].bitwiseOR(e["covered"]).alias("covered"),
            *[so_far[m].bitwiseAND(kept).bitwiseOR(e[m]).alias(m) for m in _MASKS[1:]],
        )

    entries = F.array_sort(F.collect_list(F.struct("insert_version", "step", *_MASKS)))
    return per_load.groupBy("word").agg(entries.alias("__e")).select("word", F.aggregate("__e", none, put).alias("__w")).select("word", "__w.*")


def word_gate(words: DataFrame, ranges: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """The rows of `validate_timestamps`, from folded words.

    A range's count is that below its end minus that below its start; below a point lie whole words, by running sums, and the
    low bits of the point's own word. No (word, range) pair is formed.
    """
    wanted = ranges.select("start_block", "end_block").distinct()
    edge = F.explode(
        F.array(
            F.struct(F.col("start_block").alias("at"), F.lit(-1).alias("sign")),
            F.struct(F.col("end_block").alias("at"), F.lit(1).alias("sign")),
        )
    )
    ends = wanted.select("start_block", "end_block", edge.alias("__e")).select(
        "start_block", "end_block", "__e.sign", bucket_of("__e.at", BITS).alias("word"), (F.col("__e.at") % BITS).alias("bit")
    )
    marks = ends.select("word", F.lit(1).alias("__mark"))
    counts = {"present": "__n_present", "valid": "__n_usable"}
    per_word = (
        words.select("word", "present", "usable", F.lit(0).alias("__mark"))
        .unionByName(marks, allowMissingColumns=True)
        .groupBy("word")
        .agg(
            *[F.coalesce(F.max(m), F.lit(0).cast("bigint")).alias(m) for m in ("present", "usable")],
            F.max("__mark").alias("__mark"),
        )
        .select("*", *[F.bit_count(m).cast("bigint").alias(f"__n_{m}") for m in ("present", "usable")])
    )
    before = at_marks(per_word, [], "word", {f"__b_{out}": (n, "sum") for out, n in counts.items()})
    before = before.select("word", "present", "usable", *[f"__b_{out}" for out in counts]).withColumnsRenamed(
        {"present": "__present", "usable": "__usable"}
    )
    below = {
        "present": F.col("__b_present") + F.bit_count(F.col("__present").bitwiseAND(_low_bits(F.col("bit")))),
        "valid": F.col("__b_valid") + F.bit_count(F.col("__usable").bitwiseAND(_low_bits(F.col("bit")))),
    }
    counted = (
        join_unique(ends, before, ["word"], "inner", sized_by=marks, at_most=None if n_ranges is None else 2 * n_ranges)
        .groupBy("start_block", "end_block")
        .agg(*[F.sum(F.col("sign") * below[out]).alias(out) for out in counts])
    )
    return gate_columns(counted)


def word_islands(words: DataFrame, mask: str = "present") -> DataFrame:
    """Maximal runs of set bits as [start_block, end_block): runs inside words, and those that touch an edge of their word merged."""
    bits = F.col(mask)
    begins = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    runs = words.filter(bits != 0).select(
        "word", bits.alias("bits"),
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit(begins, i) == 1)).alias("first"),
    )
    # Ones from the first bit on: the zeros at the low end of the complement.
    rest = F.bitwise_not(F.call_function("shiftrightunsigned", F.col("bits"), F.col("first")))
    less = F.coalesce(F.try_subtract(rest, F.lit(1).cast("bigint")), F.lit(2**63 - 1))
    length = F.bit_count(F.bitwise_not(rest).bitwiseAND(less))
    start = F.col("word") * BITS + F.col("first")
    runs = runs.select("word", start.alias("start_block"), (start + length).alias("end_block"))
    at_edge = (F.col("start_block") % BITS == 0) | (F.col("end_block") % BITS == 0)
    columns = ["start_block", "end_block"]
    stitched = merge_ranges(runs.filter(at_edge).select(*columns), []).select(
        F.col("segment_start").alias("start_block"), F.col("segment_end").alias("end_block")
    )
    return runs.filter(~at_edge).select(*columns).unionByName(stitched)
