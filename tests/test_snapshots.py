"""State snapshots: the same answers as the whole history, without reading it again."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.operators import coverage, fold
from spanledger.operators.latest import latest_state
from spanledger.operators.state import claim_ranges, complete_ranges, fail_ranges
from spanledger.plans import operations as ops
from spanledger.schemas import STATE_KEY, STATE_TABLE
from spanledger.session import work_folder
from spanledger.sources.snapshots import StateView
from spanledger.sources.tables import TableStore
from spanledger.streaming.ingest import ingest_batch
from tests.conftest import rows
from tests.test_tables import AT, NAMES, outcome, zone

DATASETS = ["blocks", "logs", "nonce_diffs"]


@pytest.fixture
def store(spark):
    return TableStore(spark, work_folder(spark, "snapshots"), "day")


def events(state_frame, seed, n=120):
    """Events of few ranges of uneven lengths, some overlapping, block 0 among them, in any order of time."""
    random.seed(seed)
    out = []
    for k in range(n):
        start = random.choice([0, 1, 100, 130, 250, 400, 900])
        status = random.choice(["completed", "processing", "failed", "pending"])
        count = random.choice([None, 0, 7]) if status == "completed" else None
        out.append((random.choice(DATASETS), start, start + random.choice([30, 100, 500]), status, random.randint(0, 300_000), count))
    frame = state_frame(out)
    version = F.col("insert_version") + seed * 1000
    attempt = F.when(F.col("status") == "failed", (F.col("insert_version") % 5).cast("int")).otherwise(0)
    error = F.when(F.col("status") == "failed", F.concat(F.lit("e"), F.col("insert_version")))
    return frame.withColumn("insert_version", version).withColumn("attempt_count", attempt).withColumn("error_message", error)


def same_answers(store, view):
    assert rows(view.latest()) == rows(latest_state(store.state()))
    assert rows(view.unsettled()) == rows(latest_state(store.state()).filter("status <> 'completed'"))


def same_answers_from_history(store, view):
    state, history = store.state(), view.history()
    for ask in (
        coverage.progress, coverage.highest_attempted, lambda s: coverage.find_gaps(s, DATASETS, min_gap=1),
        lambda s: coverage.find_gaps(s, DATASETS, 50, 800, 1, "latest"), lambda s: coverage.last_synced(s, DATASETS),
        lambda s: fail_ranges(s, latest_state(s).select(*STATE_KEY, F.lit("x").alias("error_message")), AT, 1),
    ):
        assert rows(ask(history)) == rows(ask(state))
    assert rows(fold.history_summary_of(view.folded())) == rows(coverage.history_summary(state))
    assert view.last_synced(DATASETS) == coverage.last_synced(state, DATASETS).first()[0]


def test_snapshot_and_later_events_answer_as_the_whole_history(store, state_frame):
    view = StateView(store)
    for seed in range(4):
        store.append_state(events(state_frame, seed))
        if seed in (0, 2):
            assert view.take() is not None and view.take() is None
            same_answers(store, view)
    same_answers(store, view)
    same_answers_from_history(store, view)


def test_a_crash_between_the_writes_leaves_the_version_before(spark, store, state_frame, monkeypatch):
    view = StateView(store)
    store.append_state(events(state_frame, 1))
    first = view.take()
    store.append_state(events(state_frame, 2))
    real = StateView._path

    def dying(self, part, version=None):
        if part == "files" and version is not None and version > first:
            raise RuntimeError("lost")
        return real(self, part, version)

    monkeypatch.setattr(StateView, "_path", dying)
    with pytest.raises(RuntimeError):
        view.take()
    monkeypatch.setattr(StateView, "_path", real)
    assert view.versions() == [first]
    same_answers(store, view)
    assert view.take() > first
    same_answers(store, view)


def test_only_files_after_the_snapshot_are_read(store, state_frame):
    view = StateView(store)
    store.append_state(events(state_frame, 1))
    view.take()
    old = set(store.state().inputFiles())
    store.append_state(events(state_frame, 2, 5))
    new = set(store.state().inputFiles()) - old
    for asked in (view.latest(), view.history(100, 200), view.unsettled()):
        read = set(asked.inputFiles())
        assert new <= read and not read & old
    plan = view.history(100, 200)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(start_block,100)") >= 2
    settled = view.unsettled()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(settled" in settled


def test_a_snapshot_that_outlived_its_files_is_not_used(store, state_frame):
    view = StateView(store)
    store.append_state(events(state_frame, 1))
    store.append_state(events(state_frame, 2).withColumn("created_at", F.expr("created_at + INTERVAL 90 DAYS")))
    view.take()
    days = sorted(store._partitions(STATE_TABLE))
    store._drop_partition(STATE_TABLE, days[0])
    same_answers(store, view)
    view.take()
    same_answers(store, view)
    assert view.versions()[0] and len(view.versions()) == 2


def test_old_versions_go(store, state_frame):
    view = StateView(store)
    for seed in range(5):
        store.append_state(events(state_frame, seed, 3))
        view.take()
    assert len(view.versions()) == 2 and view.take_if(1) is None
    assert StateView(TableStore(store.spark, work_folder(store.spark, "none"), "day")).latest().count() == 0


@pytest.mark.parametrize("files", [1, 1000])
def test_batches_with_and_without_snapshots_end_alike(spark, store, files):
    raw = zone(spark, 40, bad=[13])
    for batch_id, head in ((0, 20), (0, 20), (1, 30), (2, 40), (2, 40)):
        frame = spark.createDataFrame([(head,)], "block_number BIGINT")
        ingest_batch(store, raw, frame, batch_id, NAMES, batch_size=10, confirmations=0, max_retries=2, snapshot_files=files)
    assert bool(StateView(store).versions()) == (files == 1)
    state = latest_state(store.state())
    assert rows(state.filter("status = 'failed'"), "dataset", "start_block", "attempt_count") == [
        ("blocks", 10, 2), ("transactions", 10, 2),
    ]
    assert [r for r in outcome(store) if r[3] == "completed"] == [
        (name, s, s + 10, "completed", 20) for name in NAMES for s in (0, 20, 30)
    ]
    assert store.state().filter("status = 'completed'").groupBy(*STATE_KEY, "insert_version").count().filter("count > 1").count() == 0


def test_a_plan_sees_claims_of_others_through_the_snapshot(spark, store):
    view = StateView(store)
    ranges = spark.createDataFrame([("blocks", 0, 10), ("blocks", 10, 20)], "dataset STRING, start_block BIGINT, end_block BIGINT")
    store.append_state(claim_ranges(store.state(), ranges.limit(1), "other", AT, 1))
    view.take()
    ops.load_plan(store, zone(spark, 20), ranges, "me", AT, 10, view=view)
    assert outcome(store) == [("blocks", 0, 10, "processing", None), ("blocks", 10, 20, "completed", 20)]
    store.append_state(complete_ranges(ranges.limit(1).withColumn("rows_indexed", F.lit(3)), AT, 20))
    same = view.history(0, 20)
    assert rows(latest_state(same), "start_block", "status") == [(0, "completed"), (10, "completed")]
