"""Loading, repair and validation of whole sets of ranges.

Ranges are data, not tasks: one Spark job per dataset loads all ranges of a plan. The loop
over dataset names is the only one on the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.cleaning import clean, conform_checked
from spanledger.functions.columns import first_block
from spanledger.operators.enrich import enrich_strict, invalid_reason, split_blocks, split_valid
from spanledger.operators.ranges import rows_in_ranges
from spanledger.operators.metrics import rows_per_range
from spanledger.operators.quality import validate_report, validate_timestamps
from spanledger.operators.state import (
    claim_ranges,
    complete_ranges,
    fail_ranges,
    mark_reprocess,
    recover_stuck,
)
from spanledger.plans.ranges import plan_ranges
from spanledger.plans.repair import repair_plan
from spanledger.schemas import GATE_MESSAGE, PROCESSING, SKIPPED, STATE_KEY, STATE_TABLE, TABLES
from spanledger.sources.extracts import project_dataset, read_dataset, slice_range
from spanledger.sources.presence import PresenceIndex
from spanledger.sources.snapshots import StateView
from spanledger.sources.tables import TableStore


class Bounds(NamedTuple):
    """What one aggregate tells about a dataset's ranges: their outer bounds, their number, and a bound on the
    pieces of 1000 blocks they are cut into. Known sizes spare the operators a count each."""

    start: int
    end: int
    n_ranges: int
    n_pieces: int


def within(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows between the outer bounds of a plan; a scan filter that skips row groups."""
    return slice_range(rows, bounds.start, bounds.end)


class RawZone:
    """Extracted rows: Parquet files below a folder, found by dataset name, or given frames."""

    def __init__(self, folder: str | None = None, frames: dict[str, DataFrame] | None = None):
        self.folder = folder
        self.frames = frames or {}

    def read(self, store: TableStore, dataset: str, ranges: DataFrame | None = None) -> DataFrame:
        """The dataset's rows; with `ranges` only files whose named range overlaps one of them."""
        if dataset in self.frames:
            raw = self.frames[dataset]
        else:
            raw = read_dataset(store.spark, self.folder, dataset, ranges=ranges)
        return project_dataset(raw, dataset)

    def rows(self, store: TableStore, dataset: str, ranges: DataFrame, bounds: Bounds) -> DataFrame:
        """Cleaned rows of the dataset that lie in any of the ranges.

        Files are picked by name; the outer bounds go to the scan as a plain filter, the exact ranges by a semi join.
        """
        near = within(self.read(store, dataset, ranges), bounds)
        return clean(rows_in_ranges(near, ranges, at_most=bounds.n_pieces), dataset)


def now_utc() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def load_plan(
    store: TableStore,
    raw: RawZone,
    plan: DataFrame,
    worker: str,
    as_of: str | None = None,
    version: int | None = None,
    replace: bool = False,
    claim: bool = True,
    view: StateView | None = None,
    presence: PresenceIndex | None = None,
) -> None:
    """Load every range of the plan (dataset, start_block, end_block) and record the outcome.

    Every dataset is read from the raw zone once, into a work table from which rows, counts and
    verdicts come. A range with a row that does not fit its table, or without a usable time, is
    failed; the other ranges of the dataset are loaded by the same job. Blocks go first; where the
    plan holds blocks, ranges whose blocks are not all present with a usable timestamp are
    failed and their children skipped with a failed row. A plan without blocks has no such gate.
    An error of a job itself fails what the job would have loaded, and the other datasets go
    on. All rows carry `version`, so running the same call again changes nothing that a reader
    of latest versions sees. With `replace`, old rows go only after the new ones are staged. With a
    `view`, the state of the plan's ranges comes from its snapshot and the events after it; a `presence`
    index records the blocks that were loaded.
    """
    as_of = as_of or now_utc()
    version = time.time_ns() if version is None else version
    todo = plan.select(*STATE_KEY).withColumn("start_block", first_block("dataset", "start_block"))
    span = todo.agg(F.min("start_block").alias("lo"), F.max("start_block").alias("hi")).first() if view else None

    def state() -> DataFrame:
        if view is None:
            return store.state()
        return view.history(span["lo"] or 0, (span["hi"] or 0) + 1)

    store.append_state(claim_ranges(state() if claim else store.state().limit(0), todo, worker, as_of, version))
    # From here on the plan is what was written, not what might be computed again. A replay
    # skips the ranges whose outcome is already recorded.
    todo = (
        state()
        .filter(F.col("insert_version").isin(version, version + 1))
        .groupBy(*STATE_KEY)
        .agg(F.bool_and((F.col("status") == PROCESSING) & (F.col("worker_id") == worker)).alias("open"))
        .filter("open")
        .select(*STATE_KEY)
    )
    # One row per dataset of the plan, at most the declared ones.
    pieces = F.ceil((F.col("end_block") - F.col("start_block")) / 1000) + 1
    names = {
        r["dataset"]: Bounds(r["lo"], r["hi"], r["n"], r["pieces"])
        for r in todo.groupBy("dataset")
        .agg(
            F.min("start_block").alias("lo"), F.max("end_block").alias("hi"),
            F.count(F.lit(1)).alias("n"), F.sum(pieces).alias("pieces"),
        )
        .collect()
    }
    if not names:
        return
    work = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        work.append(f"{name}-{version}")
        return store.put_work(df, work[-1])

    def load(name: str, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Loads the dataset's ranges; returned are those that did not fail on their own rows, and the block
        numbers of all rows loaded; failed ranges are recorded."""
        staged = kept(_staged(store, raw, name, ranges, names[name]), f"rows-{name}")
        such = staged.agg(F.min("error")).first()[0]
        good, fit = ranges.select(*STATE_KEY), staged.drop("error")
        if such is not None:
            counts = rows_per_range(
                staged.filter(F.col("error").isNotNull()), ranges, n_ranges=names[name].n_ranges
            ).filter("rows_indexed > 0")
            broken = ranges.join(counts.withColumnRenamed("rows_indexed", "n"), ["start_block", "end_block"]).select(
                *STATE_KEY, F.concat(F.col("n"), F.lit(f" rows rejected, such as: {such}")).alias("error_message")
            )
            broken = kept(broken, f"broken-{name}")
            good = good.join(broken, list(STATE_KEY), "left_anti")
            fit = rows_in_ranges(staged.filter(F.col("error").isNull()).drop("error"), good)
        parts = {name: fit}
        if name == "blocks":
            blocks, withdrawals = split_blocks(_widened(fit, name))
            blocks = blocks.select(*[c for c in blocks.columns if c in fit.columns or c == "block_timestamp"])
            # Their JSON is parsed once, for the rows and for the count.
            parts = {"blocks": blocks, "withdrawals": kept(split_valid(withdrawals)[0], "withdrawals")}
        for table, rows in parts.items():
            if replace:
                store.replace_ranges(table, good, rows, version, staged=True)
            else:
                store.append(rows, table, version)
        if presence is not None and name == "blocks":
            presence.add(parts[name], version, good if replace else None)
        loaded = reduce(DataFrame.unionByName, [rows.select("block_number") for rows in parts.values()])
        if such is not None:
            store.append_state(fail_ranges(state(), broken, as_of, version + 1))
        return good, loaded

    def attempt(name: str, ranges: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        try:
            return load(name, ranges)
        except Exception as error:  # of the job itself; recorded per range, the other datasets go on
            failed = ranges.select(*STATE_KEY, F.lit(str(error)).alias("error_message"))
            store.append_state(fail_ranges(state(), failed, as_of, version + 1))
            return None

    if "blocks" in names:
        every = list(names.values())
        n_ranges, n_pieces = sum(b.n_ranges for b in every), sum(b.n_pieces for b in every)
        bounds = Bounds(min(b.start for b in every), max(b.end for b in every), n_ranges, n_pieces)
        done = attempt("blocks", todo.filter(F.col("dataset") == "blocks"))
        # Timestamp gate, for all ranges of the plan in one pass over the blocks table and the rows loaded.
        loaded = done[1] if done else store.read("blocks").select("block_number").limit(0)
        gate = validate_timestamps(todo, within(store.read("blocks"), bounds), n_ranges, loaded).withColumn(
            "message",
            F.format_string(GATE_MESSAGE, "reason", "valid", "expected", "present"),
        )
        checked = todo.join(gate, ["start_block", "end_block"]).select(*STATE_KEY, "ok", "message", "rows_indexed")
        checked = kept(checked, "gate")
        is_block_range = F.col("dataset") == "blocks"
        outcome = checked.filter(~F.col("ok"))
        skipped = outcome.filter(~is_block_range).select(
            *STATE_KEY, F.concat(F.lit(SKIPPED), "message").alias("error_message")
        )
        if done:  # else its ranges are failed already
            gated = done[0].join(checked.filter(is_block_range), list(STATE_KEY))
            unfit = gated.filter(~F.col("ok")).select(*STATE_KEY, F.col("message").alias("error_message"))
            store.append_state(
                fail_ranges(state(), skipped.unionByName(unfit), as_of, version + 1).unionByName(
                    complete_ranges(gated.filter("ok"), as_of, version + 1)
                )
            )
        else:
            store.append_state(fail_ranges(state(), skipped, as_of, version + 1))
        todo = checked.filter("ok").select(*STATE_KEY)

    for name in (n for n in TABLES if n in names and n != "blocks"):
        done = attempt(name, todo.filter(F.col("dataset") == name))
        if done:
            good, loaded = done
            counted = rows_per_range(loaded, good, n_ranges=names[name].n_ranges)
            store.append_state(complete_ranges(good.join(counted, ["start_block", "end_block"]), as_of, version + 1))
    for name in work:
        store.drop_work(name)


def _staged(store: TableStore, raw: RawZone, name: str, ranges: DataFrame, bounds: Bounds) -> DataFrame:
    """Cleaned rows of the ranges under those of the declared columns that were extracted, with what is wrong with a row.

    Declared columns that the raw zone doesn't have are left to the sink, so that no shuffle, sort or work table carries them.
    """
    found = raw.rows(store, name, ranges, bounds)
    absent = set(TABLES[name].schema.names) - set(found.columns) - {"block_number", "timestamp", "error"}
    rows = conform_checked(*_with_columns(found, name)).drop(*absent)
    if name == "blocks":
        return rows
    parents = within(store.read("blocks"), bounds)
    # The rows only go to a work table, so they are read from the raw zone once and hot blocks are split by the adaptive join.
    stamped = enrich_strict(rows, parents, on_missing="keep", max_blocks=bounds.end - bounds.start, hot_key_rows=None)
    return stamped.withColumn("error", F.coalesce("error", invalid_reason()))


def _widened(rows: DataFrame, name: str) -> DataFrame:
    """Rows with all declared columns, NULL where they have none."""
    have = set(rows.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in TABLES[name].schema.fields if f.name not in have}
    return rows.withColumns(missing) if missing else rows


def _with_columns(rows: DataFrame, name: str) -> tuple[DataFrame, str, tuple[str, ...]]:
    """Rows with the inputs that are read but not stored, and what `conform_checked` asks for."""
    have = set(rows.columns)
    for extra in TABLES[name].extra_input:
        if extra not in have:
            rows = rows.withColumn(extra, F.lit(None).cast("string"))
    return rows, name, TABLES[name].extra_input


def historical(
    store: TableStore, raw: RawZone, start: int, end: int, datasets: Sequence[str], batch: int = 100, **how
) -> None:
    """Load [start, end) in ranges of `batch`; completed ranges are left alone."""
    if end <= start:
        raise ValueError("end must be greater than start")
    names = F.array(*[F.lit(d) for d in datasets])
    plan = plan_ranges(store.spark, start, end, batch).withColumn("dataset", F.explode(names))
    load_plan(store, raw, plan, "historical", **how)


def maintain(
    store: TableStore, raw: RawZone, datasets: Sequence[str], start: int = 0, end: int = 0,
    batch: int = 100, min_gap: int = 100, **how,
) -> None:
    """Load again all that is not completed; assumes that nothing else is loading."""
    plan = repair_plan(store.state(), "maintain", datasets, start, end, batch, min_gap=min_gap)
    load_plan(store, raw, plan, "maintain", replace=True, claim=False, **how)


def auto_maintain(
    store: TableStore, raw: RawZone, datasets: Sequence[str], batch: int = 100,
    lookback_hours: int = 48, stuck_hours: int = 2, min_gap: int = 100,
    as_of: str | None = None, version: int | None = None,
) -> None:
    """Repair of recent ranges that may run beside a loader."""
    as_of = as_of or now_utc()
    version = time.time_ns() if version is None else version
    store.append_state(recover_stuck(store.state(), as_of, version, stuck_hours))
    plan = repair_plan(
        store.state(), "auto", datasets, batch=batch, lookback_hours=lookback_hours, min_gap=min_gap
    )
    plan = store.put_work(plan, f"repair-{version}")
    empty = plan.filter(F.col("reason") == "zero_rows")
    store.append_state(mark_reprocess(empty, as_of, version + 1))
    load_plan(store, raw, plan, "auto_maintain", as_of, version + 2, replace=True)
    store.drop_work(f"repair-{version}")


def validate(
    store: TableStore, datasets: Sequence[str], start: int = 0, end: int = 0
) -> DataFrame:
    """Read-only report per dataset over the latest state; see `validate_report`."""
    return validate_report(store.latest(STATE_TABLE), datasets, start, end)
