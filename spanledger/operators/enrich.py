"""Block timestamps for child rows, withdrawals out of block rows, row checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.columns import block_timestamp, usable_timestamp
from spanledger.operators.joins import BROADCAST_ROWS, HOT_KEY_ROWS, join_unique
from spanledger.schemas import EPOCH_FLOOR_SECONDS


def usable_parents(blocks: DataFrame) -> DataFrame:
    """(block_number, timestamp): the timestamp of every block whose latest version has a usable one.

    Two long columns and one row per block, so joining it cannot multiply child rows. The
    aggregate combines versions before the shuffle; of equal versions the later time counts.
    """
    order = F.struct("insert_version", "timestamp")
    return (
        blocks.filter(F.col("block_number").isNotNull())
        .groupBy("block_number")
        .agg(F.max_by("timestamp", order).alias("timestamp"))
        .filter(F.col("timestamp") > EPOCH_FLOOR_SECONDS)
    )


def enrich_strict(
    child: DataFrame,
    blocks: DataFrame,
    on_missing: str = "fail",
    broadcast_rows: int = BROADCAST_ROWS,
    max_blocks: int | None = None,
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Child rows with block_timestamp, taken from their block.

    "fail" stops the job at the first row whose block is unknown or has no usable
    timestamp; "keep" leaves those timestamps NULL for `split_valid` or `missing_parents`.
    `max_blocks` is a bound on the different block numbers, where the caller knows one; `hot_key_rows` as for `join_unique`.
    """
    if on_missing not in ("fail", "keep"):
        raise ValueError(f"unknown on_missing {on_missing}")
    parents = usable_parents(blocks).withColumnRenamed("timestamp", "__seconds")
    joined = join_unique(
        child, parents, ["block_number"], "left", broadcast_rows, hot_key_rows,
        sized_by=blocks.select("block_number"), at_most=max_blocks,
    )
    stamp = block_timestamp("__seconds")
    if on_missing == "fail":
        message = F.concat(
            F.lit("no usable timestamp for block "),
            F.coalesce(F.col("block_number").cast("string"), F.lit("NULL")),
        )
        stamp = F.when(F.col("__seconds").isNull(), F.raise_error(message).cast("timestamp")).otherwise(stamp)
    return joined.withColumn("block_timestamp", stamp).drop("__seconds")


def missing_parents(child: DataFrame, blocks: DataFrame) -> DataFrame:
    """Distinct child block numbers without a usable block."""
    wanted = child.filter(F.col("block_number").isNotNull()).select("block_number").distinct()
    return wanted.join(usable_parents(blocks), "block_number", "left_anti")


def invalid_reason(stamp: str = "block_timestamp") -> Column:
    seconds = F.unix_seconds(stamp)
    return F.when(F.col(stamp).isNull(), "null_timestamp").when(
        seconds <= EPOCH_FLOOR_SECONDS, "invalid_timestamp"
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit for insertion, rows that are not with the reason)."""
    tagged = df.withColumn("reason", invalid_reason())
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(
        F.col("reason").isNotNull()
    )


def validate_rows(df: DataFrame) -> DataFrame:
    """The same rows; the job fails on a NULL or too early block_timestamp."""
    reason = invalid_reason()
    return df.withColumn(
        "block_timestamp",
        F.when(reason.isNotNull(), F.raise_error(reason).cast("timestamp")).otherwise(
            F.col("block_timestamp")
        ),
    )


def explode_withdrawals(
    blocks: DataFrame,
    keys: dict[str, str] | None = None,
    carry: tuple[str, ...] = ("block_number", "block_hash", "withdrawals_root", "chain_id"),
) -> DataFrame:
    """One row per JSON object in the `withdrawals` text array of a block.

    Text that is no JSON array gives no rows for that block; an element that is no object is
    skipped and its siblings stay; blocks without a usable timestamp are skipped. Elements
    parse to VARIANT, where an object differs from a text that looks like one.
    """
    keys = keys or {
        "withdrawal_index": "index",
        "validator_index": "validatorIndex",
        "address": "address",
        "amount": "amount",
    }
    elements = F.try_variant_get(F.try_parse_json("withdrawals"), "$", "array<variant>")
    return (
        blocks.filter(F.col("withdrawals").isNotNull() & usable_timestamp())
        .select(*carry, block_timestamp().alias("block_timestamp"), F.explode(elements).alias("__w"))
        .filter(F.startswith(F.schema_of_variant("__w"), F.lit("OBJECT")))
        .select(
            *carry[:-1],
            *[F.try_variant_get("__w", f"$.{k}", "string").alias(out) for out, k in keys.items()],
            carry[-1],
            "block_timestamp",
        )
    )


def split_blocks(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned block rows as (blocks with block_timestamp, withdrawals)."""
    blocks = raw.drop("withdrawals").withColumn("block_timestamp", block_timestamp())
    return blocks, explode_withdrawals(raw)
