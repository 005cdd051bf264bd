"""Run one operation over a store: spark-submit ... -m spanledger OPERATION --root R --raw F."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spanledger.plans import operations as ops
from spanledger.schemas import (
    BATCH_SIZE,
    CONFIRMATIONS,
    FAILED,
    LIVE_BATCH_SIZE,
    LIVE_CONFIRMATIONS,
    MODES,
)
from spanledger.operators.latest import latest_state
from spanledger.session import configure
from spanledger.sources.tables import TableStore
from spanledger.streaming.ingest import block_stream, stream_ingest


def arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="spanledger", description=__doc__)
    p.add_argument(
        "operation", choices=["historical", "continuous", "maintain", "auto-maintain", "validate"]
    )
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--raw", help="folder of the extracted Parquet files")
    p.add_argument("--mode", choices=list(MODES), default="minimal")
    p.add_argument("--datasets", help="comma-separated list instead of a mode")
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--end", type=int, default=0)
    p.add_argument("--batch", type=int)
    p.add_argument("--confirmations", type=int)
    p.add_argument("--live", action="store_true", help="day partitions and the live defaults")
    p.add_argument("--lookback-hours", type=int, default=48)
    p.add_argument("--stuck-hours", type=int, default=2)
    p.add_argument("--poll-seconds", type=int, default=10)
    p.add_argument("--once", action="store_true", help="continuous: stop when caught up")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    spark = configure(SparkSession.builder.appName("spanledger").getOrCreate())
    store = TableStore(spark, a.root, "day" if a.live else "month")
    raw = ops.RawZone(a.raw)
    datasets = [d.strip() for d in a.datasets.split(",")] if a.datasets else list(MODES[a.mode])
    batch = a.batch or (LIVE_BATCH_SIZE if a.live else BATCH_SIZE)
    min_gap = LIVE_BATCH_SIZE if a.live else BATCH_SIZE

    if a.operation == "historical":
        ops.historical(store, raw, a.start, a.end, datasets, batch)
        in_span = (F.col("start_block") < a.end) & (F.col("end_block") > a.start)
        failed = latest_state(store.state()).filter(in_span & (F.col("status") == FAILED))
        return int(not failed.isEmpty())
    if a.operation == "maintain":
        ops.maintain(store, raw, datasets, a.start, a.end, batch, min_gap)
        return 0
    if a.operation == "auto-maintain":
        ops.auto_maintain(store, raw, datasets, batch, a.lookback_hours, a.stuck_hours, min_gap)
        return 0
    if a.operation == "continuous":
        schema = spark.read.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*blocks*.parquet"
        ).parquet(a.raw).schema
        stream_ingest(
            store, raw, block_stream(spark, a.raw, schema), datasets, store.path("_checkpoint"),
            available_now=a.once, poll_seconds=a.poll_seconds, batch_size=batch, start_block=a.start,
            confirmations=a.confirmations
            if a.confirmations is not None
            else (LIVE_CONFIRMATIONS if a.live else CONFIRMATIONS),
        ).awaitTermination()
        return 0
    report = ops.validate(store, datasets, a.start, a.end)  # one row per dataset
    report.show(len(datasets) + 50, truncate=False)
    return int(not report.filter(~F.col("healthy")).isEmpty())


if __name__ == "__main__":
    sys.exit(main())
