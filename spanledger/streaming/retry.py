"""Timers over claims: a range that stays `processing` too long is failed while the events stream in.

The state table is read as a stream and grouped by dataset and stretch of the chain. Each range that is not completed keeps two
numbers in the state store, the time of its open claim and its attempts; a timer in event time fails it when the watermark passes the
claim by the timeout. A completed range leaves the store. Both survive a restart on the same checkpoint. The ranges that start in one
stretch share one row of the store and one call of Python, which costs about as much for hundreds of ranges as for one.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanledger.functions.columns import bucket_of
from spanledger.operators.state import state_rows
from spanledger.schemas import COMPLETED, FAILED, PROCESSING, STATE_KEY, STATE_SCHEMA, STATE_TABLE, STUCK_MESSAGE
from spanledger.sources.tables import TableStore

_NO_CLAIM = -1
# Blocks of a stretch: some hundred ranges of the usual lengths.
STRETCH = 1 << 16
# Parallel arrays, one place per open range.
_STORED = "starts ARRAY<BIGINT>, ends ARRAY<BIGINT>, claimed ARRAY<BIGINT>, attempts ARRAY<INT>"
_OUT = "dataset STRING, start_block BIGINT, end_block BIGINT, attempt_count INT, claimed BIGINT, deadline BIGINT"


def stuck_claims(events: DataFrame, timeout_hours: int = 2, lateness: str = "0 seconds") -> DataFrame:
    """A streaming frame with one row per claim that was still open when its time ran out.

    dataset, start_block, end_block, attempt_count (the highest since the range was last completed, and one more), claimed_at and
    failed_at (claim plus timeout). A claim is open until the next event of its range; one whose next event comes
    after the timeout ran out too. Which events a micro-batch holds makes no difference, as long as they
    come in the order of their time, give or take `lateness`.
    """
    limit = timeout_hours * 3_600_000

    def whole(numbers: pd.Series) -> list:  # a column of NULLs comes as floats
        return numbers.tolist() if numbers.notna().all() else [None] * len(numbers)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ranges = {(start, end): (claimed, attempts) for start, end, claimed, attempts in zip(*state.get)} if state.exists else {}
        out = []

        def run_out(place: tuple, claimed: int, attempts: int, until: int) -> tuple[int, int]:
            if claimed != _NO_CLAIM and claimed + limit < until:
                out.append((key[0], *place, attempts + 1, claimed, claimed + limit))
                return _NO_CLAIM, attempts + 1
            return claimed, attempts

        if not state.hasTimedOut:
            rows = pd.concat(list(frames)).sort_values(["ms", "insert_version"])
            places = zip(whole(rows["start_block"]), whole(rows["end_block"]))
            for place, ms, status, attempt in zip(places, rows["ms"].tolist(), rows["status"].tolist(), rows["attempt_count"].tolist()):
                _, attempts = run_out(place, *ranges.get(place, (_NO_CLAIM, 0)), ms)
                if status == COMPLETED:
                    ranges.pop(place, None)
                else:
                    ranges[place] = (ms if status == PROCESSING else _NO_CLAIM, max(attempts, int(attempt or 0)))
        now = state.getCurrentWatermarkMs()
        ranges = {place: run_out(place, *kept, now) for place, kept in ranges.items()}
        if ranges:
            state.update(tuple(map(list, zip(*[(*place, *kept) for place, kept in ranges.items()]))))
            opened = [claimed for claimed, _ in ranges.values() if claimed != _NO_CLAIM]
            if opened:
                state.setTimeoutTimestamp(max(min(opened) + limit, now + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["dataset", "start_block", "end_block", "attempt_count", "claimed", "deadline"])

    timed = events.withWatermark("created_at", lateness).select(
        *STATE_KEY, "status", F.coalesce("attempt_count", F.lit(0)).alias("attempt_count"), "insert_version", "created_at",
        F.unix_millis("created_at").alias("ms"), bucket_of("start_block", STRETCH).alias("stretch"),
        F.col("end_block").isNull().alias("endless"),
    )
    # With "endless" a group has NULL for all of its ends or for none, as it has for its starts.
    found = timed.groupBy("dataset", "stretch", "endless").applyInPandasWithState(
        step, _OUT, _STORED, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(
        *STATE_KEY, "attempt_count", F.timestamp_millis("claimed").alias("claimed_at"), F.timestamp_millis("deadline").alias("failed_at")
    )


def failed_rows(stuck: DataFrame, version: int) -> DataFrame:
    """`failed` state rows for the claims that ran out."""
    message = F.concat(F.lit(STUCK_MESSAGE), F.date_format("claimed_at", "yyyy-MM-dd HH:mm:ss"))
    return state_rows(stuck, F.col("failed_at"), version, status=F.lit(FAILED), attempt_count=F.col("attempt_count"), error_message=message)


def state_stream(store: TableStore, files_per_batch: int | None = None) -> DataFrame:
    """The events of the state table as a stream."""
    reader = store.spark.readStream.schema(STATE_SCHEMA).options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(store.path(STATE_TABLE))


def watch_claims(
    store: TableStore, events: DataFrame, checkpoint: str, timeout_hours: int = 2, lateness: str = "0 seconds",
    available_now: bool = True, poll_seconds: int = 60,
) -> StreamingQuery:
    """Start the stream that appends a `failed` row to the state for every claim that ran out.

    The version is a function of the batch, so a replayed batch writes the same rows. They come back as events of the
    stream and only confirm what its store holds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        base = int(datetime(2000, 1, 1, tzinfo=timezone.utc).timestamp()) * 10**9
        store.append_state(failed_rows(batch, base + batch_id))

    writer = stuck_claims(events, timeout_hours, lateness).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()
