"""Running aggregates, islands, segments, splitting, overlap and range sums."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.operators import joins
from spanledger.operators.coverage import block_islands, continuous_ranges, coverage_segments
from spanledger.operators.quality import validate_timestamps
from spanledger.operators.ranges import merge_ranges
from spanledger.operators.running import running_before, sum_over_ranges
from spanledger.plans.ranges import plan_ranges, safe_ranges, split_ranges
from spanledger.plans.repair import without_overlap
from tests.conftest import rows

RANGE = "start_block BIGINT, end_block BIGINT"


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_before_equals_a_loop(spark, width):
    rng = random.Random(width)
    data = [(g, p, rng.randint(-50, 50)) for g in "ab" for p in rng.sample(range(200), 60)]
    df = spark.createDataFrame(data, "g STRING, p BIGINT, v BIGINT")
    out = running_before(df, ["g"], "p", {"s": ("v", "sum"), "m": ("v", "max")}, width=width)
    expected = []
    for g, p, v in data:
        before = [w for h, q, w in data if h == g and q < p]
        expected.append((g, p, sum(before), max(before, default=None)))
    assert rows(out, "g", "p", "s", "m") == sorted(expected, key=repr)


@pytest.mark.parametrize("width", [2, 5, 1 << 20])
def test_block_islands(spark, width):
    rng = random.Random(3)
    numbers = [n for n in range(60) if rng.random() < 0.7] + [5, 5, 100, None]
    df = spark.createDataFrame([(n,) for n in numbers], "block_number BIGINT")
    expected, present = [], sorted({n for n in numbers if n is not None})
    for n in present:
        if expected and expected[-1][1] == n:
            expected[-1][1] = n + 1
        else:
            expected.append([n, n + 1])
    assert rows(block_islands(df, width=width)) == sorted(map(tuple, expected), key=repr)


def merged(ranges):
    out = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_merge_ranges(spark, seed):
    rng = random.Random(seed)
    ranges = [(s, s + rng.randint(1, 40)) for s in rng.choices(range(500), k=40)]
    out = merge_ranges(spark.createDataFrame(ranges, RANGE), [])
    assert rows(out, "segment_start", "segment_end") == merged(ranges)


def test_segments_hold_for_uneven_lengths_where_the_simple_key_does_not(state_frame):
    state = state_frame(
        [("logs", s, e, "completed") for s, e in [(0, 100), (100, 200), (200, 250), (250, 350), (400, 500)]]
        + [("logs", 600, 700, "completed", 1), ("logs", 600, 700, "failed", 2)]
    )
    assert rows(coverage_segments(state), "segment_start", "segment_end") == [(0, 350), (400, 500)]
    # One run torn apart and joined to a separate one.
    assert rows(continuous_ranges(state), "range_description") == [("0-350",), ("200-500",)]


def test_continuous_ranges_status(state_frame):
    state = state_frame([("logs", s, s + 100, "completed") for s in (0, 100, 300)])
    out = continuous_ranges(state)
    assert rows(out, "range_description", "num_segments", "coverage_percentage", "continuity_status") == [
        ("0-200", 2, 100.0, "complete"),
        ("300-400", 1, 100.0, "complete"),
    ]


def test_split_ranges_partitions_its_input(spark, monkeypatch):
    monkeypatch.setattr(joins, "STEPS_PER_ARRAY", 3)
    data = [("a", 0, 1050), ("b", 7, 8), ("c", 5, 5), ("d", 9, 3)]
    out = split_ranges(spark.createDataFrame(data, f"k STRING, {RANGE}"), 100)
    expected = [("a", s, min(s + 100, 1050)) for s in range(0, 1050, 100)] + [("b", 7, 8)]
    assert rows(out) == sorted(expected, key=repr)


def test_pieces_of_overlapping_ranges_are_written_small(spark, tmp_path):
    rng = random.Random(9)
    starts = [rng.randrange(40_000) for _ in range(9000)]
    spans = spark.createDataFrame([(k, s, s + rng.randint(90_000, 110_000)) for k, s in enumerate(starts)], f"k BIGINT, {RANGE}")
    out = split_ranges(spans, 1000).coalesce(1)
    out.write.parquet(str(tmp_path / "pieces"))
    size, n = sum(f.stat().st_size for f in (tmp_path / "pieces").glob("*.parquet")), out.count()
    assert n > 890_000 and size < 6 * n


def test_long_ranges_that_begin_anywhere_are_written_small_by_several_tasks(spark, tmp_path):
    rng = random.Random(10)
    starts = [rng.randrange(100_000) // 50 * 50 for _ in range(200)]
    spans = spark.createDataFrame([(k, s, s + 5_000_000 + k) for k, s in enumerate(starts)], f"k BIGINT, {RANGE}")
    out = split_ranges(spans.coalesce(1), 1000)
    out.write.parquet(str(tmp_path / "pieces"))
    files = list((tmp_path / "pieces").glob("*.parquet"))
    written = spark.read.parquet(str(tmp_path / "pieces"))
    expected = [(k, len(range(s, s + 5_000_000 + k, 1000)), s, s + 5_000_000 + k) for k, s in enumerate(starts)]
    found = written.groupBy("k").agg(
        F.count_distinct("start_block").alias("n"), F.min("start_block").alias("lo"), F.max("end_block").alias("hi")
    )
    assert rows(found) == sorted(expected, key=repr) and written.count() == sum(n for _, n, _, _ in expected)
    assert len(files) > 1 and sum(f.stat().st_size for f in files) < 2 * written.count()


@pytest.mark.parametrize("per_array", [3, 4, 4096])
def test_steps_of_ranges_that_are_cut_anywhere(spark, monkeypatch, per_array):
    monkeypatch.setattr(joins, "STEPS_PER_ARRAY", per_array)
    monkeypatch.setattr(joins, "STEPS_DEALT", 4)
    monkeypatch.setattr(joins, "STEPS_TOGETHER", 2)
    if per_array == 3:
        monkeypatch.setattr(joins, "STEPS_TOGETHER", 3)
    spans = [(f, f + n) for f in range(-9, 9) for n in (0, 1, 2, 5, 6, 7, 24, 40)] + [(5, 4), (None, 3), (3, None)]
    frame = spark.createDataFrame(spans, "a INT, b INT")
    for step in (1, 3):
        out = joins.explode_steps(frame, F.col("a"), F.col("b"), step, "x")
        expected = [(a, b, x) for a, b in spans if None not in (a, b) for x in range(a, b + 1, step)]
        assert rows(out) == sorted(expected, key=repr) and dict(out.dtypes)["x"] == "int"


def test_plan_and_safe_ranges(spark):
    assert rows(plan_ranges(spark, 5, 26, 10)) == [(15, 25), (25, 26), (5, 15)]
    assert plan_ranges(spark, 5, 5, 10).count() == 0
    head = spark.createDataFrame([(412,)], "head_block BIGINT")
    assert rows(safe_ranges(head, 101, 100, 12)) == [(200, 300), (300, 400)]
    assert rows(safe_ranges(head, 300, 100, 13)) == []
    low = spark.createDataFrame([(5,)], "head_block BIGINT")
    assert rows(safe_ranges(low, 0, 100, 12)) == []
    assert rows(safe_ranges(spark.sql("SELECT 30L AS head_block"), 30, 10, 0)) == []


@pytest.mark.parametrize("seed", range(3))
def test_without_overlap(spark, seed):
    rng = random.Random(seed)

    def some(n):
        return [
            (d, s, s + rng.randint(1, 60))
            for d, s in zip(rng.choices("xy", k=n), rng.choices(range(300), k=n))
        ]

    busy, wanted = some(4), sorted(set(some(40)))
    schema = f"dataset STRING, {RANGE}"
    out = without_overlap(spark.createDataFrame(wanted, schema), spark.createDataFrame(busy, schema))
    expected = [
        w for w in wanted if not any(b[0] == w[0] and b[1] < w[2] and b[2] > w[1] for b in busy)
    ]
    assert rows(out) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", [4, 1 << 20])
@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_sum_over_ranges(spark, width, broadcast_rows, monkeypatch):
    monkeypatch.setattr(joins.join_unique, "__defaults__", ("left", broadcast_rows, 5, None, None))
    rng = random.Random(1)
    points = [(rng.choice([3, 3, 3, rng.randrange(100)]), 1, rng.randint(0, 9)) for _ in range(300)]
    points += [(None, 1, 1)]
    ranges = [(s, s + rng.randint(0, 40)) for s in rng.choices(range(100), k=25)] + [(0, 7)] * 3
    out = sum_over_ranges(
        spark.createDataFrame(points, "n BIGINT, a INT, b INT"),
        spark.createDataFrame(ranges, RANGE), "n", {"a": F.sum("a"), "b": F.sum("b")}, width=width,
    )
    expected = [
        (s, e, sum(a for n, a, _ in points if n is not None and s <= n < e),
         sum(b for n, _, b in points if n is not None and s <= n < e))
        for s, e in set(ranges)
    ]
    assert rows(out, "start_block", "end_block", "a", "b") == sorted(expected, key=repr)


@pytest.mark.parametrize(
    "present, valid, ok, reason",
    [(100, 100, True, "ok"), (100, 98, False, "invalid"), (0, 0, False, "not_visible"),
     (99, 99, False, "not_visible"), (98, 90, False, "not_visible")],
)
def test_validate_timestamps(spark, present, valid, ok, reason):
    start = 73_001_500
    blocks = spark.range(start, start + present).selectExpr(
        "id AS block_number", f"if(id < {start + valid}, 1700000000, 31536000) AS timestamp",
        "1L AS insert_version",
    )
    ranges = spark.createDataFrame([(start, start + 100), (start, start)], RANGE)
    out = validate_timestamps(ranges, blocks)
    found = {(r.start_block, r.end_block): r for r in out.collect()}
    r = found[(start, start + 100)]
    assert (r.ok, r.reason, r.expected, r.valid, r.present) == (ok, reason, 100, valid, present)
    empty = found[(start, start)]
    assert (empty.ok, empty.reason, empty.expected) == (True, "ok", 0)


def test_validation_sees_only_the_latest_version(spark):
    blocks = spark.createDataFrame(
        [(0, 1_700_000_000, 1), (0, 0, 2), (1, None, 1), (1, 1_700_000_000, 2)],
        "block_number BIGINT, timestamp BIGINT, insert_version BIGINT",
    )
    ranges = spark.createDataFrame([(0, 1), (1, 2)], RANGE)
    out = validate_timestamps(ranges, blocks)
    assert rows(out, "start_block", "reason") == [(0, "invalid"), (1, "ok")]
