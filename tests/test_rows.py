"""Row-level operators: versions, joins, cleaning, enrichment, withdrawals, checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from spanledger.functions.cleaning import clean, conform
from spanledger.functions.columns import align_start, first_block, usable_timestamp
from spanledger.operators import enrich
from spanledger.operators.joins import join_unique
from spanledger.operators.ranges import rows_in_ranges
from spanledger.operators.latest import latest_state, latest_wins, range_status
from spanledger.operators.quality import check_schema, sample_bad_blocks
from spanledger.operators.reorg import detect_reorg
from spanledger.schemas import TABLES
from spanledger.sources.extracts import dataset_of, project_dataset, read_dataset, route_by_filename
from tests.conftest import rows

RANGE = "start_block BIGINT, end_block BIGINT"
TIME = 1_700_000_000


def test_latest_wins_groups_null_keys_and_is_idempotent(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 5, "x"), (None, 6, "y"), (2, None, "n"), (2, 1, "m")],
        "k INT, insert_version BIGINT, v STRING",
    )
    once = latest_wins(df, ["k"])
    assert rows(once, "k", "v") == [(1, "c"), (2, "m"), (None, "y")]
    assert rows(latest_wins(once, ["k"])) == rows(once)


def test_latest_wins_sends_one_row_per_key_and_task_to_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS insert_version")
    plan = latest_wins(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_latest_state_keeps_last_known_values_and_breaks_ties_by_version(state_frame):
    state = state_frame(
        [("logs", 0, 100, "completed", 5, 7), ("logs", 0, 100, "processing", 5), ("logs", 0, 100, "failed", 1)]
    )
    last = latest_state(state).first()
    assert (last.status, last.rows_indexed, last.insert_version) == ("processing", 7, 1)
    assert last.completed_at is not None
    assert rows(range_status(state, "logs", 0, 100), "status") == [("processing",)]
    assert range_status(state, "logs", 0, 200).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("broadcast_rows, hot", [(1000, 10), (0, 10), (0, 1000), (0, 0)])
def test_join_unique_is_a_plain_join_whatever_the_way(spark, how, broadcast_rows, hot):
    rng = random.Random(4)
    left = [(7, i) for i in range(60)] + [(None, i) for i in range(30)] + [
        (rng.randrange(40), i) for i in range(90)
    ]
    right = [(k, f"v{k}") for k in range(0, 40, 2)] + [(7, "hot"), (None, "never")]
    l = spark.createDataFrame(left, "k BIGINT, i INT")
    r = spark.createDataFrame(right, "k BIGINT, v STRING")
    got = join_unique(l, r, ["k"], how, broadcast_rows, hot)
    assert got.columns == ["k", "i", "v"]
    known = {k: v for k, v in right if k is not None}
    expected = [(k, i, known.get(k)) for k, i in left if how == "left" or k in known]
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("broadcast_rows, span_buckets", [(0, 100), (1000, 100), (21, 100), (5, 2)])
def test_rows_in_ranges(spark, broadcast_rows, span_buckets, monkeypatch):
    from spanledger.operators import ranges as module

    monkeypatch.setattr(module, "SPAN_BUCKETS", span_buckets)
    df = spark.range(0, 50).withColumnRenamed("id", "block_number")
    ranges = spark.createDataFrame([(3, 17), (5, 9), (30, 31), (40, 40), (48, 99)], RANGE)
    inside = {*range(3, 17), 30, 48, 49}
    for keep in (True, False):
        got = rows_in_ranges(df, ranges, inside=keep, width=4, broadcast_rows=broadcast_rows)
        assert {r[0] for r in got.collect()} == {n for n in range(50) if (n in inside) == keep}
        assert got.count() == sum((n in inside) == keep for n in range(50))


def test_clean(spark):
    df = spark.createDataFrame(
        [
            (1, "", 1.5, bytearray(b"\xab\x01"), 9),
            (2, " \t\n", float("nan"), bytearray(b""), 9),
            (3, " x ", None, None, 9),
            (4, None, math.inf, bytearray(b"\x00"), 9),
        ],
        "id INT, t STRING, d DOUBLE, b BINARY, insert_version BIGINT",
    )
    out = clean(df)
    assert out.columns == ["id", "t", "d", "b"]
    assert rows(out) == [
        (1, None, 1.5, "ab01"), (2, None, None, None), (3, " x ", None, None), (4, None, math.inf, "00"),
    ]
    odd = [("\u00a0\u3000\u2028",), ("\x1c\x1f",), ("\n",), ("\u200b",), ("a\n",), ("\n\n b",)]
    kept = clean(spark.createDataFrame(odd, "t STRING"))
    assert [r[0] for r in kept.collect()] == [None if t.strip() == "" else t for (t,) in odd]
    dropped = clean(df.withColumn("difficulty", F.lit(1)), "blocks")
    assert "difficulty" not in dropped.columns
    assert "difficulty" in clean(df.withColumn("difficulty", F.lit(1)), "logs").columns


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, "x", 2)], "block_number BIGINT, address STRING, more INT")
    verdicts = {r.name: r.verdict for r in check_schema(df, "withdrawals").collect()}
    assert verdicts["block_number"] == "ok"
    assert verdicts["amount"] == "missing"
    assert verdicts["more"] == "extra"
    retyped = df.withColumn("block_number", F.col("block_number").cast("int"))
    assert {r.name: r.verdict for r in check_schema(retyped, "withdrawals").collect()}[
        "block_number"
    ] == "type_differs"
    assert conform(retyped, "withdrawals").schema == TABLES["withdrawals"].schema


def test_usable_timestamp_and_alignment(spark):
    df = spark.createDataFrame([(None,), (0,), (31_536_000,), (31_536_001,), (TIME,)], "timestamp BIGINT")
    assert [r[0] for r in df.select(usable_timestamp()).collect()] == [False, False, False, True, True]
    n = spark.createDataFrame([(0,), (1,), (99,), (100,), (101,)], "n BIGINT")
    assert [r[0] for r in n.select(align_start("n", 100)).collect()] == [0, 100, 100, 100, 200]
    starts = spark.createDataFrame([("logs", 0), ("code_diffs", 0), ("code_diffs", 5)], "d STRING, s BIGINT")
    assert [r[0] for r in starts.select(first_block("d", "s")).collect()] == [0, 1, 5]


@pytest.fixture
def blocks(spark):
    return spark.createDataFrame(
        [(0, TIME, 1), (1, TIME + 5, 1), (1, TIME + 6, 2), (2, None, 1), (3, 0, 1), (4, TIME, 1), (4, 0, 2)],
        "block_number BIGINT, timestamp BIGINT, insert_version BIGINT",
    )


def test_enrich_strict(spark, blocks):
    child = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "block_number BIGINT, x STRING")
    out = enrich.enrich_strict(child, blocks).withColumn("s", F.unix_seconds("block_timestamp"))
    assert rows(out, "x", "s") == [("a", TIME), ("b", TIME + 6), ("c", TIME + 6)]
    # An unusable newer version does not hide a usable one.
    four = spark.createDataFrame([(4, "d")], child.schema)
    assert enrich.enrich_strict(four, blocks).count() == 1


@pytest.mark.parametrize("bad", [2, 3, 9, None])
@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_enrich_strict_fails_on_any_missing_parent(spark, blocks, bad, broadcast_rows):
    child = spark.createDataFrame([(0, "a"), (bad, "b")], "block_number BIGINT, x STRING")
    with pytest.raises(Exception, match="no usable timestamp for block"):
        enrich.enrich_strict(child, blocks, broadcast_rows=broadcast_rows).collect()
    kept = enrich.enrich_strict(child, blocks, on_missing="keep", broadcast_rows=broadcast_rows)
    good, rejected = enrich.split_valid(kept)
    assert rows(good, "x") == [("a",)] and rows(rejected, "x", "reason") == [("b", "null_timestamp")]
    with pytest.raises(Exception, match="null_timestamp"):
        enrich.validate_rows(kept).collect()
    missing = enrich.missing_parents(child, blocks)
    assert rows(missing) == ([] if bad is None else [(bad,)])


def test_explode_withdrawals(spark):
    texts = [
        None, "", "[]", "null", "[bad", '{"index":"0x1"}',
        '[{"index":"0x1","validatorIndex":12,"address":"ab","amount":3.5},7,"{}",null,[1]]',
        '[{"index":"2"},{"amount":"99999999999999999999"}]',
        '[{"index":"3","amount":12345678901234567890123,"address":"\\u00e9"}]',
        '[{"index":"4","index":"5"}]',
    ]
    df = spark.createDataFrame(
        [(i, "h", "r", 100, TIME, t) for i, t in enumerate(texts)]
        + [(50, "h", "r", 100, None, texts[-1]), (51, "h", "r", 100, 0, texts[-1])],
        "block_number BIGINT, block_hash STRING, withdrawals_root STRING, chain_id BIGINT, "
        "timestamp BIGINT, withdrawals STRING",
    )
    out = enrich.explode_withdrawals(df)
    assert out.columns == TABLES["withdrawals"].schema.names + ["block_timestamp"]
    assert rows(out, "block_number", "withdrawal_index", "validator_index", "address", "amount") == [
        (6, "0x1", "12", "ab", "3.5"),
        (7, "2", None, None, None),
        (7, None, None, None, "99999999999999999999"),
        (8, "3", None, "é", "12345678901234567890123"),
        (9, "5", None, None, None),
    ]


def test_sample_bad_blocks(spark, blocks):
    out = sample_bad_blocks(blocks, 1, 5, rows=3)
    assert [(r.block_number, r.timestamp) for r in out.collect()] == [(1, TIME + 6), (2, None), (3, 0)]


@pytest.mark.parametrize(
    "canonical, last, expected",
    [
        ([(1, "0xAA"), (2, "bb"), (3, "CC")], None, (3, False, 3)),
        ([(1, "aa"), (2, "bb"), (3, "xx")], None, (3, True, 2)),
        ([(1, "x"), (2, "y"), (3, "z")], None, (3, True, 0)),
        ([(1, "aa"), (2, "bb")], None, (3, False, 3)),
        ([(1, "aa"), (2, "x"), (3, "cc")], 2, (2, True, 1)),
        ([(1, "aa")], 7, (7, False, 7)),
    ],
)
def test_detect_reorg(spark, canonical, last, expected):
    schema = "block_number BIGINT, block_hash STRING"
    stored = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "cc")], schema)
    got = detect_reorg(stored, spark.createDataFrame(canonical, schema), last).collect()
    assert [tuple(r) for r in got] == [expected]


def test_files_are_found_and_routed_by_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "deep").mkdir()
    names = ["net__logs__0_to_99.parquet", "deep/logs_100.parquet", "net__balance_diffs__0.parquet",
             "balance_diffs__1.parquet", "other.parquet"]
    for i, name in enumerate(names):
        pq.write_table(pa.table({"block_number": [i]}), tmp_path / name)
    assert rows(read_dataset(spark, str(tmp_path), "logs")) == [(0,), (1,)]
    files = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path))
    assert rows(route_by_filename(files), "block_number", "dataset") == [
        (0, "logs"), (1, "logs"), (2, "balance_diffs"), (3, "balance_diffs"), (4, "unknown"),
    ]
    odd = spark.createDataFrame([("net__anything__5.parquet",), ("xlogsx.parquet",)], "f STRING")
    assert [r[0] for r in odd.select(dataset_of(F.col("f"))).collect()] == ["anything", "unknown"]


def test_project_dataset(spark):
    df = spark.createDataFrame([(1, 2, 3)], "block_number INT, log_index INT, more INT")
    assert project_dataset(df, "logs").columns == ["block_number", "log_index"]
    assert project_dataset(df, "transactions").columns == df.columns
    assert project_dataset(df, ["logs", "blocks"]).columns == df.columns
