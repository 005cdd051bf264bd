"""State transitions and the repair plan."""

from spanledger.operators import state as st
from spanledger.operators.coverage import history_summary, last_synced, non_completed_ranges, progress
from spanledger.operators.metrics import duration_histogram, ingest_metrics
from spanledger.operators.quality import validate_report, zero_row_ranges
from spanledger.plans.repair import repair_plan
from spanledger.schemas import STATE_SCHEMA
from tests.conftest import rows

AT = "2024-01-01 00:00:00"
KEY = "dataset STRING, start_block BIGINT, end_block BIGINT"


def test_claim_leaves_completed_and_running_ranges(spark, state_frame):
    state = state_frame(
        [("logs", 0, 100, "completed"), ("logs", 100, 200, "processing"), ("logs", 200, 300, "failed"),
         ("logs", 300, 400, "completed", 1), ("logs", 300, 400, "failed", 2)]
    )
    wanted = spark.createDataFrame([("logs", s, s + 100) for s in (0, 100, 200, 200, 300, 400)], KEY)
    out = st.claim_ranges(state, wanted, "w", AT, 9)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in STATE_SCHEMA]
    assert rows(out, "start_block", "status", "worker_id") == [
        (s, "processing", "w") for s in (200, 300, 400)
    ]


def test_fail_counts_over_all_attempts_and_cuts_the_message(spark, state_frame):
    state = state_frame([("logs", 0, 100, "failed"), ("logs", 0, 100, "completed")]).selectExpr(
        "* EXCEPT (attempt_count)", "if(status = 'failed', 300, 0) AS attempt_count"
    )
    failures = spark.createDataFrame(
        [("logs", 0, 100, "é'" * 400), ("logs", 100, 200, None)], KEY + ", error_message STRING"
    )
    out = {r.start_block: r for r in st.fail_ranges(state, failures, AT, 9).collect()}
    assert out[0].attempt_count == 301 and out[0].error_message == "é'" * 250
    assert out[100].attempt_count == 1 and out[100].error_message == ""


def test_fail_dependents(spark, state_frame):
    state = state_frame([("logs", 0, 100, "completed")])
    bad = spark.createDataFrame([(0, 100, "why")], "start_block BIGINT, end_block BIGINT, reason STRING")
    out = st.fail_dependents(state, bad, ["blocks", "transactions", "logs", "code_diffs"], AT, 9)
    assert rows(out, "dataset", "start_block", "error_message") == [
        ("code_diffs", 1, "Skipped: why"), ("transactions", 0, "Skipped: why"),
    ]


def test_stuck_ranges_are_those_whose_last_event_is_old(state_frame):
    hour = 3600
    state = state_frame(
        [("logs", 0, 100, "processing", 0), ("logs", 100, 200, "processing", 2 * hour),
         ("logs", 200, 300, "processing", 0), ("logs", 200, 300, "completed", 1)]
    )
    as_of = "2023-11-15 00:13:21"  # two hours and one second after the first event
    out = st.recover_stuck(state, as_of, 9, timeout_hours=2)
    assert rows(out, "start_block", "status", "attempt_count", "error_message") == [
        (0, "failed", 1, "Auto-recovered: stuck processing since 2023-11-14 22:13:20")
    ]


def test_zero_rows_only_where_rows_are_expected(state_frame):
    state = state_frame(
        [("logs", 0, 100, "completed", 0, 0), ("logs", 100, 200, "completed", 0, 5),
         ("contracts", 0, 100, "completed", 0, 0), ("logs", 200, 300, "completed", 0, 0),
         ("logs", 200, 300, "failed", 1), ("logs", 300, 400, "completed", 1, 9),
         ("logs", 300, 400, "completed", 2, 0)]
    )
    assert rows(zero_row_ranges(state), "start_block") == [(0,), (300,)]
    assert rows(zero_row_ranges(state, ["logs"], 0, 100), "start_block") == [(0,)]


def test_summaries_differ_between_history_and_latest(state_frame):
    state = state_frame(
        [("logs", 0, 100, "failed", 0), ("logs", 0, 100, "completed", 1, 4), ("blocks", 0, 100, "odd", 0)]
    )
    now = {r.dataset: r for r in progress(state).collect()}
    ever = {r.dataset: r for r in history_summary(state).collect()}
    assert (now["logs"].total_ranges, now["logs"].overall_status) == (1, "complete")
    assert (ever["logs"].total_ranges, ever["logs"].overall_status) == (2, "failed")
    assert ever["logs"].completion_percentage == 50.0
    assert (now["blocks"].overall_status, ever["blocks"].overall_status) == ("mixed", "no_data")
    assert now["blocks"].highest_block_completed == 0


def test_last_synced(state_frame):
    state = state_frame([("logs", 0, 300, "completed"), ("blocks", 0, 500, "completed")])
    assert last_synced(state, ["logs", "blocks", "traces"]).first()[0] == 300
    assert last_synced(state, ["logs", "blocks", "traces"], strict=True).first()[0] == 0
    assert last_synced(state, ["traces"]).first()[0] == 0


def test_non_completed_ranges_leave_out_block_zero_of_diffs(state_frame):
    state = state_frame(
        [("code_diffs", 0, 100, "failed"), ("code_diffs", 100, 200, "failed"), ("logs", 0, 100, "pending"),
         ("logs", 100, 200, "failed", 0), ("logs", 100, 200, "completed", 1)]
    )
    assert rows(non_completed_ranges(state)) == [("code_diffs", 100, 200), ("logs", 0, 100)]
    assert rows(non_completed_ranges(state, ["logs"], 50, 0)) == []


def test_repair_plan_maintain(state_frame):
    state = state_frame(
        [("logs", 0, 100, "completed"), ("logs", 350, 450, "completed"), ("logs", 450, 550, "failed"),
         ("blocks", 0, 100, "processing")]
    )
    plan = repair_plan(state, "maintain", ["logs", "blocks"])
    assert rows(plan) == [
        ("blocks", 0, 100, "not_completed", 0),
        ("logs", 100, 200, "gap", 1), ("logs", 200, 300, "gap", 1), ("logs", 300, 350, "gap", 1),
        ("logs", 450, 550, "not_completed", 1),
    ]


def test_repair_plan_auto_looks_back_and_spares_work_in_flight(state_frame):
    state = state_frame(
        [("logs", s, s + 100, "completed", 0, 3) for s in range(0, 3000, 100) if s not in (200, 1000, 2000, 2500)]
        + [("logs", 2000, 2100, "processing"), ("logs", 2500, 2600, "completed", 0, 0),
           ("logs", 3000, 3100, "failed")]
    )
    plan = repair_plan(state, "auto", ["logs"], lookback_hours=4)  # 2,880 blocks: from 200 on
    assert rows(plan, "start_block", "reason") == [
        (1000, "gap"), (200, "gap"), (2500, "zero_rows"), (3000, "gap"),
    ]
    shorter = repair_plan(state, "auto", ["logs"], lookback_hours=3)  # 2,160 blocks: from 900 on
    assert rows(shorter, "start_block") == [(1000,), (2500,), (3000,)]


def test_report_and_metrics(state_frame):
    state = state_frame(
        [("logs", 0, 100, "processing", 0), ("logs", 0, 100, "completed", 3, 8),
         ("logs", 100, 200, "processing", 0), ("logs", 100, 200, "completed", 30, 2),
         ("blocks", 0, 100, "completed", 0, 1), ("blocks", 300, 400, "completed", 0, 1)]
    )
    healthy = {r.dataset: r.healthy for r in validate_report(state).collect()}
    assert healthy == {"logs": False, "blocks": True}
    windowed = {r.dataset: (r.healthy, r.gap_count) for r in validate_report(state, end_block=400).collect()}
    assert windowed == {"logs": (True, 0), "blocks": (False, 1)}
    m = {r.dataset: r for r in ingest_metrics(state, 450).collect()}
    assert (m["logs"].rows_inserted_total, m["logs"].ranges_in_progress, m["logs"].chain_lag_blocks) == (10, 0, 250)
    counts = {r.le: r.ranges for r in duration_histogram(state).filter("dataset = 'logs'").collect()}
    assert (counts[2.5], counts[5.0], counts[25.0], counts[50.0], counts[float("inf")]) == (0, 1, 1, 2, 2)
