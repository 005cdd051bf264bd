"""Staging of children whose blocks are too many to be broadcast."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.operators.joins import join_unique
from spanledger.plans import operations as ops
from spanledger.sources.tables import TableStore


@pytest.fixture
def staged(spark, tmp_path):
    """The staged transactions of a plan over 3,000,000 blocks."""
    store, folder = TableStore(spark, str(tmp_path / "store")), str(tmp_path / "children")
    stamps = [(1, 10**9), (2, 0), (4, 10**9 + 12)]
    blocks = spark.createDataFrame(stamps, "block_number BIGINT, timestamp BIGINT")
    store.append(blocks.withColumn("block_timestamp", F.timestamp_seconds("timestamp")), "blocks", 1)
    hot = [(1, i, "x") for i in range(50)]
    children = [*hot, (2, 0, " "), (3, 0, "y"), (4, 0, "z"), (None, 0, "n"), (3_000_000, 0, "far")]
    spark.createDataFrame(children, "block_number BIGINT, transaction_index BIGINT, input STRING").write.parquet(folder)
    raw = ops.RawZone(frames={"transactions": spark.read.parquet(folder)})
    ranges = spark.createDataFrame([("transactions", 0, 3_000_000)], "dataset STRING, start_block BIGINT, end_block BIGINT")
    return ops._staged(store, raw, "transactions", ranges, ops.Bounds(0, 3_000_000, 1, 3001))


def test_children_are_read_from_the_raw_zone_once(staged):
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # children and blocks


def test_staged_children_have_the_time_of_their_block_or_a_reason(staged):
    found = rows(staged.withColumn("s", F.unix_seconds("block_timestamp")), "block_number", "transaction_index", "input", "s", "error")
    expected = [(1, i, "x", 10**9, None) for i in range(50)] + [
        (2, 0, None, None, "null_timestamp"), (3, 0, "y", None, "null_timestamp"), (4, 0, "z", 10**9 + 12, None)
    ]
    assert found == sorted(expected, key=repr)


def test_staged_children_carry_no_column_that_was_not_extracted(staged):
    assert staged.columns == ["block_number", "transaction_index", "input", "timestamp", "error", "block_timestamp"]


def test_columns_that_a_frame_lacks_are_stored_as_null_and_not_sorted_along(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lacking"))
    df = spark.createDataFrame([(2, "b"), (1, "a")], "block_number BIGINT, block_hash STRING")
    assert store.append(df, "blocks", 5) == 2
    stored = store.read("blocks")
    assert rows(stored, "block_number", "block_hash", "gas_used", "block_timestamp", "insert_version", "part_month") == [
        (1, "a", None, None, 5, None), (2, "b", None, None, 5, None)
    ]
    plan = store._laid_out(df.withColumn("block_timestamp", F.timestamp_seconds("block_number")), "blocks")
    assert plan.schema.names == stored.schema.names
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    below = optimized[optimized.index("Sort"):]
    assert "block_hash" in below and "gas_used" not in below


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique_without_hot_keys_set_apart(spark, how):
    l = spark.createDataFrame([(7, i) for i in range(60)] + [(None, 1), (3, 2)], "k BIGINT, i INT")
    r = spark.createDataFrame([(7, "hot"), (None, "never")], "k BIGINT, v STRING")
    expected = [(7, i, "hot") for i in range(60)] + ([(None, 1, None), (3, 2, None)] if how == "left" else [])
    assert rows(join_unique(l, r, ["k"], how, 0, None)) == sorted(expected, key=repr)
