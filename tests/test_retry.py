"""Streams with state of their own: claims that run out, children that wait for their block."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries
from spanledger.operators.latest import latest_state
from spanledger.operators.enrich import enrich_strict, split_valid
from spanledger.session import work_folder
from spanledger.sources.tables import TableStore
from spanledger.streaming.enrich import enrich_stream
from spanledger.streaming.retry import state_stream, stuck_claims, watch_claims
from tests.conftest import rows

HOUR = 3600


def stuck_of(spark, folder, checkpoint, out, schema, hours=2):
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    found = stuck_claims(events, hours)
    found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    base = 1_700_000_000
    return rows(spark.read.schema(found.schema).parquet(out).select(
        "dataset", "start_block", "attempt_count", (F.unix_seconds("claimed_at") - base).alias("c"), (F.unix_seconds("failed_at") - base).alias("f")
    ))


EVENTS = [
    [("a", 0, 10, "processing", 0), ("a", 10, 20, "processing", 0), ("a", 10, 20, "completed", HOUR), ("b", 0, 10, "processing", HOUR)],
    [("b", 0, 10, "processing", 5 * HOUR), ("a", 20, 30, "processing", 5 * HOUR)],  # b ran out at 3 h, a at 2 h
    [("a", 20, 30, "failed", 6 * HOUR), ("a", 20, 30, "processing", 6 * HOUR + 1), ("c", 0, 10, "completed", 20 * HOUR)],
]
WANT = [
    ("a", 0, 1, 0, 2 * HOUR), ("a", 20, 1, 6 * HOUR + 1, 8 * HOUR + 1), ("b", 0, 1, HOUR, 3 * HOUR), ("b", 0, 2, 5 * HOUR, 7 * HOUR),
]


@pytest.mark.parametrize("restart", [False, True])
def test_timers_and_attempts_survive_a_restart(spark, state_frame, tmp_path, restart):
    folder, version = str(tmp_path / "in"), 0
    schema = None
    for i, batch in enumerate(EVENTS):
        frame = state_frame(batch).withColumn("insert_version", F.col("insert_version") + 100 * i)
        frame.coalesce(1).write.mode("append").parquet(folder)
        schema = frame.schema
        if restart or i == len(EVENTS) - 1:
            got = stuck_of(spark, folder, str(tmp_path / "cp"), str(tmp_path / "out"), schema)
    assert got == sorted(WANT, key=repr)


def test_open_ranges_of_a_stretch_share_a_row_of_the_store(spark, state_frame, tmp_path):
    claims = [("a", s, None if s > 4000 else s + 10, "processing", s // 200) for s in range(0, 5000, 10)] + [("a", None, None, "processing", 7)]
    schema = None
    for batch in (claims, [("a", 0, 10, "completed", HOUR), ("z", 0, 10, "completed", HOUR + 20)]):
        frame = state_frame(batch)
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        schema = frame.schema
        found = stuck_claims(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 1)
        query = found.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet").start(
            str(tmp_path / "out")
        )
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    got = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    want = [("a", s, e, 1) for _, s, e, _, at in claims if at < 20 and s != 0]
    assert rows(got, "dataset", "start_block", "end_block", "attempt_count") == sorted(want, key=repr)


def test_a_step_of_many_files_is_one_micro_batch(spark, tmp_path):
    folder = queries._empty_folder(spark, "steps")
    batches = []
    seen = spark.readStream.schema("id BIGINT").parquet(folder)
    out = queries._in_steps(seen, "seen", batches_of(spark, folder, batches))
    assert rows(out) == [(n,) for n in sorted(range(300), key=lambda n: repr((n,)))]
    assert [b for b in batches if b < 2] == []  # a step is written by all its tasks


def batches_of(spark, folder, files):
    before = 0
    for k in range(3):
        yield [(folder, spark.range(100 * k, 100 * (k + 1), 1, 4))]
        now = sum(n.endswith(".parquet") for n in os.listdir(folder))
        files.append(now - before)
        before = now


def test_failed_rows_are_appended_to_the_state_and_free_the_range(spark, state_frame, tmp_path):
    store = TableStore(spark, work_folder(spark, "claims"), "day")
    store.append_state(state_frame([("a", 0, 10, "processing", 0), ("a", 10, 20, "processing", 0), ("a", 10, 20, "completed", HOUR)]))
    for k in range(3):
        store.append_state(state_frame([("z", 0, 10, "completed", (k + 3) * HOUR)]).withColumn("insert_version", F.lit(10 + k).cast("bigint")))
        watch_claims(store, state_stream(store), str(tmp_path / "cp")).awaitTermination()
    failed = store.state().filter("status = 'failed'")
    assert rows(failed, "dataset", "start_block", "attempt_count") == [("a", 0, 1)]
    assert failed.first().error_message.startswith("Auto-recovered: stuck processing since 20")
    assert rows(latest_state(store.state()), "dataset", "start_block", "status") == [
        ("a", 0, "failed"), ("a", 10, "completed"), ("z", 0, "completed"),
    ]


def test_children_wait_for_their_block_and_are_rejected_without_one(spark, tmp_path):
    def put(side, numbers, **columns):
        extra = ", ".join(f"{v} AS {k}" for k, v in columns.items())
        rows = spark.createDataFrame([(n,) for n in numbers], "block_number BIGINT").selectExpr("block_number", extra)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / side))
        return rows.schema

    late = "CAST(if(block_number = 7, 0, 1700000000 + block_number) AS BIGINT)"
    blocks = [put("blocks", some, timestamp=late) for some in ([0, 1, 3], [2, 4, 4, 7], [30, 31], [500])][0]
    kids = [put("kids", some, hash="concat('t', block_number)") for some in ([0, 2, 5, None], [1, 4, 4, 7], [30, 32], [500])][0]
    streams = [
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / side))
        for side, schema in (("kids", kids), ("blocks", blocks))
    ]
    out = str(tmp_path / "out")
    found = enrich_stream(*streams, depth=10)
    found.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    got = spark.read.schema(found.schema).parquet(out)
    every = spark.read.schema(blocks).parquet(str(tmp_path / "blocks")).withColumn("insert_version", F.lit(1))
    want = enrich_strict(spark.read.schema(kids).parquet(str(tmp_path / "kids")), every, on_missing="keep")
    good, bad = split_valid(want)
    assert rows(got.filter("reason IS NULL").drop("reason")) == rows(good)
    assert rows(got.filter("reason IS NOT NULL").drop("block_timestamp"), "block_number", "reason") == rows(bad, "block_number", "reason")
    assert sorted(r[0] or -1 for r in rows(bad, "block_number")) == [-1, 5, 7, 32]
