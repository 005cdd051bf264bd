"""Words of presence against the rows they stand for."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.operators import presence as P
from spanledger.operators.coverage import block_islands
from spanledger.operators.quality import validate_timestamps
from spanledger.plans import operations as ops
from spanledger.session import work_folder
from spanledger.sources.presence import PresenceIndex
from spanledger.sources.tables import TableStore
from tests.conftest import rows
from tests.test_tables import AT, zone

GOOD, BAD = 1_700_000_000, 5


@pytest.fixture
def index(spark):
    return PresenceIndex(TableStore(spark, work_folder(spark, "presence"), "day"))


def load(spark, numbers, version):
    """(block_number, timestamp, insert_version): each number with a usable time or not."""
    return spark.createDataFrame(
        [(n, t, version) for n, t in numbers], "block_number BIGINT, timestamp BIGINT, insert_version BIGINT"
    )


def some(seed, n=150, top=700):
    random.seed(seed)
    return [(random.randint(0, top), random.choice([GOOD, GOOD, BAD, None])) for _ in range(n)]


def ranges_of(spark, found):
    return spark.createDataFrame(found, "start_block BIGINT, end_block BIGINT")


RANGES = [(0, 1), (0, 64), (1, 65), (63, 64), (64, 128), (100, 300), (0, 701), (700, 2000), (5, 5), (5, 4), (640, 705), (0, 1)]


def same(spark, index, blocks):
    ranges = ranges_of(spark, RANGES)
    assert rows(index.gate(ranges)) == rows(validate_timestamps(ranges, blocks), *index.gate(ranges).columns)
    assert rows(index.islands()) == rows(block_islands(blocks))
    last = blocks.groupBy("block_number").agg(
        F.max_by(F.coalesce(F.col("timestamp") > GOOD - 1, F.lit(False)), F.struct("insert_version", "timestamp")).alias("ok")
    )
    assert rows(index.islands("usable")) == rows(block_islands(last.filter("ok")))


def test_loads_of_several_versions_equal_their_rows(spark, index):
    every = None
    for version in (10, 30, 20):  # 20 comes late
        part = load(spark, some(version), version)
        index.add(part, version)
        every = part if every is None else every.unionByName(part)
        same(spark, index, every)
        index.fold()
        same(spark, index, every)
    assert index.fold() is None
    index.add(load(spark, some(20), 20), 20)  # a replay
    same(spark, index, every)


def test_late_version_is_seen_although_a_later_one_is_folded(spark, index):
    index.add(load(spark, [(1, BAD)], 30), 30)
    assert index.fold() == 30
    index.add(load(spark, [(1, GOOD), (2, GOOD)], 20), 20)
    assert rows(index.gate(ranges_of(spark, [(1, 3)])), "valid", "present") == [(1, 2)]


def test_fold_without_its_list_does_not_count(spark, index):
    index.add(load(spark, [(1, GOOD)], 1), 1)
    folded = index.words().withColumn("present", F.lit(-1).cast("bigint"))
    folded.write.parquet(index._path("folds", "upto", 1))  # a crash before the list was written
    assert rows(index.islands()) == [(1, 2)]
    assert index.fold() == 1 and rows(index.islands()) == [(1, 2)]


def test_deletes_clear_what_has_no_later_version(spark, index):
    numbers = [(n, GOOD) for n in range(300)]
    index.add(load(spark, numbers, 1), 1)
    index.remove(ranges_of(spark, [(10, 20), (63, 129), (299, 400), (7, 7)]), 2)
    assert rows(index.islands()) == [(0, 10), (129, 299), (20, 63)]
    index.add(load(spark, [(n, GOOD) for n in range(60, 70)], 3), 3)
    assert rows(index.islands()) == [(0, 10), (129, 299), (20, 70)]
    index.fold()
    index.remove(ranges_of(spark, [(0, 300)]), 4)
    assert rows(index.islands()) == [] and rows(index.gate(ranges_of(spark, [(0, 10)])), "present") == [(0,)]


def test_recheck_equals_a_new_gate_and_reads_touched_ranges_only(spark, index):
    ranges = ranges_of(spark, [(k, k + 90) for k in range(0, 900, 90)])
    index.add(load(spark, some(1, 600, 899), 1), 1)
    known = spark.createDataFrame(index.gate(ranges).collect(), index.gate(ranges).schema)
    index.add(load(spark, [(n, GOOD) for n in range(180, 270)] + [(450, BAD)], 2), 2)
    index.remove(ranges_of(spark, [(809, 811)]), 3)
    assert rows(index.touched(ranges, 1)) == [(180, 270), (450, 540), (720, 810), (810, 900)]
    assert rows(index.recheck(known, 1)) == rows(index.gate(ranges))
    index.fold()
    assert rows(index.recheck(known, 1)) == rows(index.gate(ranges))
    assert rows(index.touched(ranges, 3)) == []


def test_edges_of_words_and_empty_tables(spark, index):
    assert rows(index.islands()) == [] and index.fold() is None
    assert rows(index.gate(ranges_of(spark, [(3, 5), (4, 4)])), "ok", "reason", "expected") == [(False, "not_visible", 2), (True, "ok", 0)]
    numbers = [0, 62, 63, 64, 127, 128, *range(192, 384), 2**40, 2**40 + 1]
    index.add(load(spark, [(n, GOOD) for n in numbers] + [(None, GOOD)] * 3, 1), 1)
    assert rows(index.islands()) == sorted(
        [(0, 1), (62, 65), (127, 129), (192, 384), (2**40, 2**40 + 2)], key=repr
    )
    for first in range(64):  # every run that ends with its word, the sign bit among them
        words = spark.range(1).select(
            F.lit(7).cast("bigint").alias("word"), F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(first)).alias("present")
        )
        if first % 21 in (0, 1):
            assert rows(P.word_islands(words)) == [(7 * 64 + first, 8 * 64)]
    words = spark.sql("SELECT 0L AS word, 9223372036854775807L AS present")
    assert rows(P.word_islands(words)) == [(0, 63)]


def test_plan_has_no_python_and_no_pairs(spark, index):
    index.add(load(spark, some(1), 1), 1)
    plan = index.gate(ranges_of(spark, RANGES), 20)._jdf.queryExecution().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_loads_record_their_blocks(spark, index):
    store = index.store
    ops.historical(store, zone(spark, 40), 0, 40, ["blocks"], 10, as_of=AT, version=100, presence=index)
    ranges = ranges_of(spark, [(0, 40), (5, 25), (30, 50)])
    assert rows(index.gate(ranges)) == rows(validate_timestamps(ranges, store.read("blocks")), *index.gate(ranges).columns)
    plan = ranges_of(spark, [(10, 20)]).select(F.lit("blocks").alias("dataset"), "*")
    fewer = ops.RawZone(frames={"blocks": zone(spark, 40).frames["blocks"].filter("block_number <> 13")})
    ops.load_plan(store, fewer, plan, "w", AT, 200, replace=True, claim=False, presence=index)
    assert rows(index.islands()) == rows(block_islands(store.read("blocks"))) == [(0, 13), (14, 40)]
