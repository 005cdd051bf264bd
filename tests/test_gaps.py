"""Gap detection: the documented cases, and random histories against a plain loop."""

import random

import pytest

from spanledger.operators.coverage import find_gaps


def batches(start, end, status="completed", dataset="transactions", step=100):
    return [(dataset, s, s + step, status) for s in range(start, end, step)]


# The ranges and expected gaps of the documented cases, up to "no bound means ...".
BEYOND = [("transactions", 5000, 5100, "completed")]

CASES = {
    "middle hole": (batches(1000, 1300) + batches(1400, 1700), 1000, 1700, [(1300, 1400)]),
    "tail hole with work beyond": (batches(1000, 1600) + BEYOND, 1000, 1700, [(1600, 1700)]),
    "tail complete": (batches(1000, 1700) + BEYOND, 1000, 1700, []),
    "short tail dropped": (
        batches(1000, 1600) + [("transactions", 1600, 1650, "completed")] + BEYOND, 1000, 1700, [],
    ),
    "nothing beyond": (batches(1000, 1600), 1000, 1700, []),
    "below work in flight": (
        batches(1000, 1500) + batches(1600, 1700, "processing"), 1000, 1700, [(1500, 1600)],
    ),
    "only the tip in flight": (batches(1000, 1600) + batches(1600, 1700, "processing"), 1000, 1700, []),
    "never past the highest attempt": (batches(1000, 1700), 1000, 99999, []),
    "failed tail once": (batches(1000, 1600) + batches(1600, 1700, "failed"), 1000, 1700, [(1600, 1700)]),
    "chunk boundary": (
        batches(66_999_600, 66_999_900) + batches(67_000_000, 67_000_100), 61_000_000, 67_000_000,
        [(61_000_000, 66_999_600), (66_999_900, 67_000_000)],
    ),
    "no bound means up to the highest attempt": (
        batches(0, 300) + batches(500, 600), 0, 0, [(300, 500)],
    ),
    "nothing known": ([("logs", 0, 100, "completed")], 0, 0, []),
}


@pytest.mark.parametrize("name", CASES)
def test_documented_cases(name, state_frame):
    state, start, end, expected = CASES[name]
    found = find_gaps(state_frame(state), ["transactions"], start, end)
    assert sorted((r.gap_start, r.gap_end) for r in found.collect()) == expected


def test_diff_datasets_start_late(state_frame):
    state = state_frame(
        [
            ("nonce_diffs", 0, 100, "failed"),
            ("nonce_diffs", 1500, 1600, "completed"),
            ("blocks", 200, 300, "completed"),
        ]
    )
    found = find_gaps(state, ["nonce_diffs", "blocks"])
    assert sorted(tuple(r) for r in found.collect()) == [
        ("blocks", 0, 200),
        ("nonce_diffs", 1000, 1500),
    ]


def test_failed_and_completed_later_depends_on_history(state_frame):
    state = state_frame(
        batches(0, 100) + batches(100, 200) + batches(100, 200, "failed") + batches(200, 300)
    )
    assert find_gaps(state, ["transactions"]).count() == 0
    latest = find_gaps(state, ["transactions"], history="latest")
    assert [tuple(r) for r in latest.collect()] == [("transactions", 100, 200)]


def by_loop(history, dataset, start, end, min_gap):
    """Gap search for one dataset, step by step over sorted rows."""
    mine = [(s, e, st) for d, s, e, st in history if d == dataset]
    highest = max((e for _, e, _ in mine), default=0)
    diff = dataset.endswith("_diffs")
    lo = 1000 if diff and start == 0 else start
    hi = highest if end == 0 else min(end, highest)
    if not mine or hi <= lo:
        return set()
    gaps, position = set(), lo
    for s, e, status in sorted(mine):
        if status == "completed" and s >= lo and e <= hi:
            if position < s:
                gaps.add((position, s))
            position = max(position, e)
    if position < hi:
        flying = [s for s, e, st in mine if st == "processing" and e > position and s < hi]
        if position < min([hi, *flying]):
            gaps.add((position, min([hi, *flying])))
    gaps |= {(s, e) for s, e, st in mine if st == "failed" and s >= lo and e <= hi}
    done = {(s, e) for s, e, st in mine if st == "completed"}
    return {
        (s, e) for s, e in gaps if e - s >= min_gap and (s, e) not in done and not (diff and s == 0)
    }


@pytest.mark.parametrize("seed", range(6))
def test_random_histories(seed, state_frame, monkeypatch):
    """Many datasets at once, uneven and overlapping ranges, buckets far smaller than ranges."""
    from spanledger.operators import coverage, running

    rng = random.Random(seed)
    names = ["blocks", "transactions", "logs", "traces", "nonce_diffs", "code_diffs"]
    history = []
    for name in names:
        for _ in range(rng.randint(0, 25)):
            start = rng.randrange(0, 3000, 50)
            status = rng.choice(["completed"] * 4 + ["failed", "processing", "pending"])
            history.append((name, start, start + rng.choice([50, 100, 150, 400]), status))
    history.append(("contracts", 0, 100, "completed"))
    width = rng.choice([64, 300, 1 << 20])
    monkeypatch.setattr(
        coverage, "running_before",
        lambda *a, **k: running.running_before(*a, **(k | {"width": width})),
    )
    start, end = rng.choice([(0, 0), (500, 2500), (0, 1800)])
    min_gap = rng.choice([1, 100])
    found = find_gaps(state_frame(history), names, start, end, min_gap)
    got = {n: set() for n in names}
    for r in found.collect():
        assert (r.gap_start, r.gap_end) not in got[r.dataset]
        got[r.dataset].add((r.gap_start, r.gap_end))
    assert got == {n: by_loop(history, n, start, end, min_gap) for n in names}
