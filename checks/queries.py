"""Every operator run over whole driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from spanledger.functions.cleaning import clean, conform
from spanledger.functions.columns import align_start, block_timestamp, first_block, usable_timestamp
from spanledger.operators import coverage, enrich, fold, metrics, quality, reorg, state as st
from spanledger.operators.latest import latest_state, latest_wins, range_status
from spanledger.operators.ranges import rows_in_ranges
from spanledger.plans import operations as ops
from spanledger.plans.ranges import confirmed, plan_ranges, safe_ranges, split_ranges
from spanledger.plans.repair import repair_plan
from spanledger.schemas import STATE_KEY, STATE_TABLE
from spanledger.session import configure, work_folder
from spanledger.sources import extracts
from spanledger.sources.presence import PresenceIndex
from spanledger.sources.snapshots import StateView
from spanledger.sources.tables import TableStore, partition_value, unexpired
from spanledger.streaming.dedup import confirmed_by_time, stream_dedup, unexpired_stream
from spanledger.streaming.enrich import enrich_stream
from spanledger.streaming.ingest import block_stream, stream_ingest
from spanledger.streaming.retry import stuck_claims

VERSION = 1_000_000_000_000
TX_COLUMNS = [*V.TX_KEY, "gas_limit", "gas_used", "value_f64", "input"]


def _state(spark: SparkSession, d: str) -> DataFrame:
    return V.spark_view(spark, d, V.RANGE_STATE)


def _txs(spark: SparkSession, d: str) -> DataFrame:
    return V.spark_view(spark, d, V.TXS)


def _newest_txs(spark: SparkSession, d: str) -> DataFrame:
    return latest_wins(_txs(spark, d), V.TX_KEY, V.TX_ORDER)


def _head(df: DataFrame, position: str = "block_number") -> int:
    return df.agg(F.max(position)).first()[0]


def _store(spark: SparkSession, name: str, unit: str = "month") -> TableStore:
    return TableStore(spark, work_folder(spark, name), unit)


def _no_null_count(df: DataFrame) -> DataFrame:
    """-1 for "no row count": integer columns with NULLs look different per client."""
    return df.withColumn("rows_indexed", F.coalesce("rows_indexed", F.lit(-1)))


def _event(df: DataFrame) -> DataFrame:
    """State rows without the columns that only completed rows fill."""
    return df.drop("completed_at", "rows_indexed")


# -- sources ------------------------------------------------------------------------------
def read_dataset(spark, d):
    return (
        extracts.read_dataset(spark, d, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("sum_orderkey"))
    )


def route_by_filename(spark, d):
    routed = [
        extracts.route_by_filename(V.table(spark, d, name), V.TABLES).select("dataset") for name in V.TABLES
    ]
    return reduce(DataFrame.unionByName, routed).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def slice_range(spark, d):
    events = V.table(spark, d, "events")
    quarter = _head(events, "event_id") // 4
    return extracts.slice_range(events, quarter, 3 * quarter, "event_id").select(
        "event_id", "user_id", "event_type"
    )


def project_dataset(spark, d):
    logs = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("block_number"),
        F.col("l_linenumber").alias("log_index"),
        F.col("l_returnflag").alias("topic0"),
        F.col("l_linestatus").alias("topic1"),
        F.col("l_partkey").alias("n_data_bytes"),
        "l_tax",
        "l_discount",
    )
    return extracts.project_dataset(logs, "logs")


def head_block(spark, d):
    return extracts.head_block(V.spark_view(spark, d, V.EVENT_BLOCKS))


# -- cleaning and schema ------------------------------------------------------------------
def clean_documents(spark, d):
    docs = V.table(spark, d, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("lang") == "en", F.lit(" \t\n")).otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("source") == "src5", F.lit(float("nan")))
        .otherwise(F.col("n_chars").cast("double"))
        .alias("n_chars"),
        F.lit(1).alias("insert_version"),
    )
    return clean(docs)


def hex_pages(spark, d):
    pages = V.table(spark, d, "pages").select(
        "page_id",
        F.col("html").cast("binary").alias("html"),
        F.when(F.length("url") > 30, F.lit(b"")).otherwise(F.col("url").cast("binary")).alias("url"),
    )
    return clean(pages)


def clean_blocks(spark, d):
    raw = V.spark_view(spark, d, V.BLOCKS).select(
        "block_number",
        F.unhex("block_hash").alias("block_hash"),
        F.lit("1").alias("difficulty"),
        F.lit(1.0).alias("total_difficulty_f64"),
        "timestamp",
        "insert_version",
    )
    return clean(raw, "blocks")


def conform_schema(spark, d):
    rows = _txs(spark, d).withColumn("block_number", F.col("block_number").cast("int"))
    return conform(rows, "transactions").select(
        "block_number", "transaction_index", "gas_limit", "gas_used", "value_f64", "input", "to_address"
    )


def schema_contract(spark, d):
    """The columns of the transaction rows against the contract, with how many rows fill each."""
    rows = _txs(spark, d).withColumn("gas_used", F.col("gas_used").cast("string"))
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    filled = filled.unpivot([], rows.columns, "name", "n_filled")
    return (
        quality.check_schema(rows, "transactions").join(filled, "name", "left")
        .withColumn("n_filled", F.coalesce("n_filled", F.lit(0)))
    )


def usable_timestamps(spark, d):
    return V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS).select(
        "block_number",
        usable_timestamp().alias("usable"),
        F.when(usable_timestamp(), block_timestamp()).alias("block_timestamp"),
    )


# -- versions -----------------------------------------------------------------------------
def latest_txs(spark, d):
    return _newest_txs(spark, d).select(*TX_COLUMNS)


def latest_range_state(spark, d):
    return _no_null_count(latest_state(_state(spark, d)))


def point_status(spark, d):
    return range_status(_state(spark, d), "transactions", 10_000, 10_100)


# -- enrichment ---------------------------------------------------------------------------
def enrich_strict(spark, d):
    blocks = V.spark_view(spark, d, V.BLOCKS)
    return enrich.enrich_strict(_txs(spark, d), blocks).select(
        *TX_COLUMNS, "l_quantity", "block_timestamp"
    )


def missing_parents(spark, d):
    return enrich.missing_parents(_txs(spark, d), V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS))


def rejected_rows(spark, d):
    blocks = V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)
    _, bad = enrich.split_valid(enrich.enrich_strict(_txs(spark, d), blocks, on_missing="keep"))
    return bad.select(*TX_COLUMNS, "l_quantity", "reason")


def validate_rows(spark, d):
    return enrich.validate_rows(V.spark_view(spark, d, V.EVENT_BLOCKS)).select(
        "block_number", "block_timestamp"
    )


def explode_withdrawals(spark, d):
    return enrich.explode_withdrawals(V.spark_view(spark, d, V.WITHDRAWALS))


def load_blocks(spark, d):
    """Rows per 100-block range as recorded for a block load: blocks plus withdrawals."""
    blocks, withdrawals = enrich.split_blocks(V.spark_view(spark, d, V.BLOCKS))
    return metrics.rows_per_batch(
        blocks.select("block_number").unionByName(withdrawals.select("block_number")), 100
    )


# -- coverage -----------------------------------------------------------------------------
def progress(spark, d):
    return coverage.progress(_state(spark, d))


def history_summary(spark, d):
    return coverage.history_summary(_state(spark, d))


def highest_attempted(spark, d):
    return coverage.highest_attempted(_state(spark, d))


def last_synced(spark, d):
    return coverage.last_synced(_state(spark, d), V.DATASETS)


def non_completed_ranges(spark, d):
    return coverage.non_completed_ranges(_state(spark, d), V.DATASETS)


def continuous_ranges(spark, d):
    return coverage.continuous_ranges(_state(spark, d))


def coverage_segments(spark, d):
    return coverage.coverage_segments(_state(spark, d))


def range_summary(spark, d):
    return coverage.range_summary(_state(spark, d))


def find_gaps(spark, d):
    return coverage.find_gaps(_state(spark, d), V.DATASETS)


def find_gaps_window(spark, d):
    state = _state(spark, d)
    end = _head(state, "end_block")
    return coverage.find_gaps(state, V.DATASETS, end // 4, end // 2, min_gap=10)


def find_gaps_latest(spark, d):
    return coverage.find_gaps(_state(spark, d), V.DATASETS, history="latest")


def block_islands(spark, d):
    seen = V.table(spark, d, "events").filter(F.col("event_type") != "error")
    return coverage.block_islands(seen, "event_id")


# -- checks -------------------------------------------------------------------------------
def validate_timestamps(spark, d):
    blocks = V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)
    ranges = plan_ranges(spark, 0, _head(blocks) + 1, 100)
    return quality.validate_timestamps(ranges, blocks)


def validate_uneven_ranges(spark, d):
    """Overlapping ranges of many lengths: each customer's span of orders."""
    blocks = V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)
    ranges = V.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("start_block"), F.max("o_orderkey").alias("end_block")
    )
    return quality.validate_timestamps(ranges, blocks)


def _indexed(spark, d, loads=3, folded=2) -> PresenceIndex:
    """Blocks with defects as words of several loads, of which some are folded."""
    index, blocks = PresenceIndex(_store(spark, "presence")), V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)
    for k in range(loads):
        index.add(blocks.filter(F.col("block_number") % 3 == k), VERSION + k)
        if k + 1 == folded:
            index.fold()
    return index


def presence_gate(spark, d):
    ranges = plan_ranges(spark, 0, _head(V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)) + 1, 100)
    return _indexed(spark, d).gate(ranges)


def presence_recheck(spark, d):
    """Verdicts of each customer's span after two of three loads, brought up to date after the third."""
    ranges = V.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("start_block"), F.max("o_orderkey").alias("end_block")
    )
    index = _indexed(spark, d, loads=2)
    known = index.store.put_work(index.gate(ranges), "known")
    index.add(V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS).filter("block_number % 3 = 2"), VERSION + 2)
    return index.recheck(known, VERSION + 1)


def presence_islands(spark, d):
    """Runs of blocks with a usable time, after the first 150 blocks of every 1000 were deleted."""
    index = _indexed(spark, d)
    head = _head(V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS))
    index.remove(
        spark.range(0, head + 1, 1000).select(F.col("id").alias("start_block"), (F.col("id") + 150).alias("end_block")), VERSION + 3
    )
    return index.islands("usable")


def sample_bad_blocks(spark, d):
    blocks = V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS)
    half = _head(blocks) // 2
    return quality.sample_bad_blocks(blocks, half, half + 100)


def zero_row_ranges(spark, d):
    return quality.zero_row_ranges(_state(spark, d), V.DATASETS)


def validate_report(spark, d):
    return quality.validate_report(_state(spark, d), V.DATASETS)


def validate_report_window(spark, d):
    state = _state(spark, d)
    return quality.validate_report(state, V.DATASETS, 1000, _head(state, "end_block"))


# -- state transitions --------------------------------------------------------------------
def stuck_ranges(spark, d):
    return st.stuck_ranges(_state(spark, d), V.AS_OF, 24 * 30)


def recover_stuck(spark, d):
    return _event(st.recover_stuck(_state(spark, d), V.AS_OF, VERSION, 24 * 30))


def claim_ranges(spark, d):
    """Claims one range per customer and dataset, attempted before or not."""
    names = F.array(*[F.lit(x) for x in V.DATASETS])
    wanted = V.table(spark, d, "customer").select(
        F.explode(names).alias("dataset"),
        (F.col("c_custkey") * 100).alias("start_block"),
        (F.col("c_custkey") * 100 + 100).alias("end_block"),
    )
    return _event(st.claim_ranges(_state(spark, d), wanted, "w1", V.AS_OF, VERSION))


def complete_ranges(spark, d):
    rows = V.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "block_number")
    counted = metrics.rows_per_range(
        rows, plan_ranges(spark, 0, _head(rows) + 1, 100)
    ).withColumn("dataset", F.lit("transactions"))
    return st.complete_ranges(counted, V.AS_OF, VERSION)


def fail_ranges(spark, d):
    state = _state(spark, d)
    failures = (
        latest_state(state)
        .filter(F.col("status") == "processing")
        .select(*STATE_KEY, F.repeat(F.concat("dataset", F.lit(" broke; ")), 50).alias("error_message"))
    )
    return _event(st.fail_ranges(state, failures, V.AS_OF, VERSION))


def fail_dependents(spark, d):
    """Datasets given up on for every block range whose blocks are not all usable."""
    bad = (
        validate_timestamps(spark, d)
        .filter(~F.col("ok"))
        .select("start_block", "end_block", "reason")
    )
    return _event(st.fail_dependents(_state(spark, d), bad, V.DATASETS, V.AS_OF, VERSION))


def mark_reprocess(spark, d):
    return _event(st.mark_reprocess(zero_row_ranges(spark, d), V.AS_OF, VERSION))


# -- planning -----------------------------------------------------------------------------
def split_ranges_query(spark, d):
    """Each customer's span of orders, cut into pieces of 1000 after the first valid block."""
    spans = V.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("start_block"), F.max("o_orderkey").alias("end_block")
    )
    spans = spans.withColumn(
        "dataset", F.explode(F.array(F.lit("blocks"), F.lit("nonce_diffs")))
    ).withColumn("start_block", first_block("dataset", "start_block"))
    return split_ranges(spans, 1000)


def align_starts(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey", align_start("o_orderkey", 100).alias("aligned_start")
    )


def safe_ranges_query(spark, d):
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS)
    return safe_ranges(extracts.head_block(blocks), 150, 100, 12)


def confirmed_blocks(spark, d):
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS)
    return confirmed(blocks, extracts.head_block(blocks), 12).select("block_number", "block_hash")


def repair_plan_maintain(spark, d):
    return repair_plan(_state(spark, d), "maintain", V.DATASETS)


def repair_plan_auto(spark, d):
    return repair_plan(_state(spark, d), "auto", V.DATASETS, lookback_hours=100)


# -- reorg and metrics --------------------------------------------------------------------
def detect_reorg(spark, d):
    """Canonical hashes differ above 99 % of the chain, and the fork block is unknown; every
    seventh block is stored in an older version too."""
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS).select("block_number", "block_hash")
    fork = _head(blocks) * 99 // 100
    older = blocks.filter("block_number % 7 = 0").select("block_number", F.lit("old").alias("block_hash"))
    stored = blocks.withColumn("insert_version", F.lit(2)).unionByName(older.withColumn("insert_version", F.lit(1)))
    changed = F.md5(F.concat(F.col("block_number").cast("string"), F.lit("x")))
    canonical = blocks.select(
        "block_number",
        F.concat(
            F.lit("0x"),
            F.upper(F.when(F.col("block_number") > fork, changed).otherwise(F.col("block_hash"))),
        ).alias("block_hash"),
    )
    canonical = canonical.withColumn("block_hash", F.regexp_replace("block_hash", "^0X", "0x"))
    return reorg.detect_reorg(stored, canonical.filter(F.col("block_number") != fork))


def ingest_metrics(spark, d):
    state = _state(spark, d)
    return metrics.ingest_metrics(state, _head(state, "end_block") + 12)


def duration_histogram(spark, d):
    day = 86_400
    return metrics.duration_histogram(
        _state(spark, d), [30 * day, 90 * day, 180 * day, 365 * day, 730 * day]
    )


def rows_per_batch(spark, d):
    return metrics.rows_per_batch(V.spark_view(spark, d, V.EVENT_BLOCKS), 100)


def rows_per_range(spark, d):
    rows = V.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "block_number")
    return metrics.rows_per_range(rows, plan_ranges(spark, 0, _head(rows) + 1, 3))


# -- stored tables ------------------------------------------------------------------------
def partition_keys(spark, d):
    return (
        V.table(spark, d, "orders")
        .select(
            partition_value("month", F.col("o_orderdate").cast("timestamp"))
            .cast("string")
            .alias("part_month"),
            partition_value("day", F.col("o_orderdate").cast("timestamp")).alias("part_day"),
        )
        .groupBy("part_month", "part_day")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def retention(spark, d):
    events = V.spark_view(spark, d, V.EVENT_BLOCKS)
    return unexpired(events, "block_timestamp", "2024-01-31 00:00:00", 2).select("block_number")


def append_versioned(spark, d):
    """Every version is appended in two loads; the table then reads as the newest rows."""
    store = _store(spark, "append")
    stamped = _txs(spark, d).withColumn("block_timestamp", F.col("seen_at"))
    oldest = latest_wins(
        stamped.withColumn("__age", -F.unix_seconds("seen_at")), V.TX_KEY,
        ("__age", *[c for c in V.TX_ORDER if c != "seen_at"]),
    )
    store.append(oldest, "transactions", 1)
    store.append(latest_wins(stamped, V.TX_KEY, V.TX_ORDER), "transactions", 2)
    return store.latest("transactions").select(*TX_COLUMNS, "block_timestamp", "insert_version")


def _event_store(spark, d, name):
    store = _store(spark, name, "day")
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS)
    store.append(blocks, "blocks", 1)
    store.append(
        enrich.explode_withdrawals(V.spark_view(spark, d, V.WITHDRAWALS)), "withdrawals", 1
    )
    return store, _head(blocks)


def delete_range(spark, d):
    """The middle half goes, with its withdrawals; whole days and parts of days."""
    store, head = _event_store(spark, d, "delete")
    store.delete_range("blocks", head // 4, 3 * (head // 4))
    return _table_rows(store)


def _table_rows(store):
    return reduce(
        DataFrame.unionByName,
        [
            store.read(name)
            .groupBy("block_number", "block_hash", "block_timestamp", "part_day", "insert_version")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("table_name", F.lit(name))
            for name in ("blocks", "withdrawals")
        ],
    )


def replace_ranges(spark, d):
    """Ranges that hold a purchase are loaded again under a new version and other hashes."""
    store, _ = _event_store(spark, d, "replace")
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS)
    purchases = V.table(spark, d, "events").filter(F.col("event_type") == "purchase")
    start = F.col("event_id") - F.col("event_id") % 5
    ranges = purchases.select(start.alias("start_block"), (start + 5).alias("end_block")).distinct()
    fresh = rows_in_ranges(blocks, ranges).withColumn("block_hash", F.lit("again"))
    store.replace_ranges("blocks", ranges, fresh, 2)
    return store.read("blocks").select(
        "block_number", "block_hash", "block_timestamp", "insert_version"
    )


def expire_live(spark, d):
    store, _ = _event_store(spark, d, "expire")
    for name in ("blocks", "withdrawals"):
        store.expire(name, datetime(2024, 1, 30, 12), 2)
    return _table_rows(store)


def compact_table(spark, d):
    """Three loads of overlapping rows, then the rewrite that keeps the latest versions."""
    store = _store(spark, "compact", "day")
    blocks = V.spark_view(spark, d, V.EVENT_BLOCKS)
    store.append(blocks, "blocks", 1)
    store.append(blocks.filter(F.col("gas_used") >= 100), "blocks", 2)
    store.append(blocks.filter(F.col("gas_used") >= 200), "blocks", 3)
    store.compact("blocks")
    return store.read("blocks").select("block_number", "insert_version")


def table_ddl(spark, d):
    """A stored table, declared by its own DDL in a database of its own and read through the catalog."""
    store, _ = _event_store(spark, d, "ddl")
    name = f"declared_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{store.path('_' + name)}'")
    try:
        spark.sql(store.ddl("blocks", f"{name}.blocks"))
        spark.sql(f"MSCK REPAIR TABLE {name}.blocks")
        found = spark.table(f"{name}.blocks")
        return store.put_work(
            found.select("block_number", "block_hash", "block_timestamp", "part_day", "insert_version"), "declared"
        )
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def delete_counts(spark, d):
    """How many rows of which table a deletion reports."""
    store, head = _event_store(spark, d, "delete-count")
    both = store.delete_range("blocks", head // 4, head // 2)
    own = store.delete_range("blocks", 3 * head // 4, head + 1, related=False)
    return spark.sql(f"SELECT {both}L AS with_withdrawals, {own}L AS blocks_only")


# -- whole operations ---------------------------------------------------------------------
def _raw(spark, d, blocks=V.BLOCKS_WITH_DEFECTS) -> ops.RawZone:
    return ops.RawZone(
        frames={
            "blocks": V.spark_view(spark, d, blocks),
            "transactions": _newest_txs(spark, d),
        }
    )


def _historical_store(spark, d):
    store, raw = _store(spark, "historical"), _raw(spark, d)
    end = _head(raw.frames["blocks"]) + 1
    ops.historical(
        store, raw, 0, end, ["blocks", "transactions"], as_of=V.AS_OF, version=VERSION
    )
    return store


def historical_state(spark, d):
    return _no_null_count(latest_state(_historical_store(spark, d).state())).drop("insert_version")


def historical_rows(spark, d):
    return _historical_store(spark, d).latest("transactions").select(*TX_COLUMNS, "block_timestamp")


def maintain_state(spark, d):
    """A load from defective blocks, then a repair from complete ones."""
    store = _historical_store(spark, d)
    ops.maintain(
        store, _raw(spark, d, V.BLOCKS), ["blocks", "transactions"],
        as_of="2001-08-03 00:00:00", version=VERSION + 10,
    )
    return latest_state(store.state()).select(*STATE_KEY, "status", "rows_indexed")


def auto_maintain_state(spark, d):
    """As `maintain_state`, by the repair that may run beside a loader."""
    store = _historical_store(spark, d)
    ops.auto_maintain(
        store, _raw(spark, d, V.BLOCKS), ["blocks", "transactions"], lookback_hours=10_000_000,
        as_of="2001-08-03 00:00:00", version=VERSION + 10,
    )
    return latest_state(store.state()).select(*STATE_KEY, "status", "rows_indexed")


def _extracted(spark, name, frames) -> str:
    """A folder with the files of each (dataset, frame), named as an extraction names them."""
    jvm = spark._jvm
    folder = work_folder(spark, name)
    for i, (dataset, frame) in enumerate(frames):
        frame.write.parquet(f"{folder}-{i}")
        source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{folder}-{i}", folder))
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        for k, found in enumerate(fs.globStatus(jvm.org.apache.hadoop.fs.Path(source, "part-*.parquet"))):
            fs.rename(found.getPath(), jvm.org.apache.hadoop.fs.Path(target, f"net__{dataset}__{i}-{k}.parquet"))
        fs.delete(source, True)
    return folder


def historical_files(spark, d):
    """Files of one dataset with different columns in different order: all columns are loaded."""
    blocks = V.spark_view(spark, d, V.BLOCKS)
    poor = blocks.filter("block_number % 2 = 0").select("timestamp", "block_hash", "block_number")
    rich = blocks.filter("block_number % 2 = 1").select("withdrawals", "block_number", "gas_used", "timestamp", "block_hash")
    store = _store(spark, "files")
    raw = ops.RawZone(_extracted(spark, "zone", [("blocks", poor), ("blocks", rich)]))
    ops.historical(store, raw, 0, _head(blocks) + 1, ["blocks"], as_of=V.AS_OF, version=VERSION)
    withdrawn = store.latest("withdrawals").groupBy("block_number").agg(F.count(F.lit(1)).alias("n"))
    return store.latest("blocks").join(withdrawn, "block_number", "left").select(
        "block_number", "block_hash", "timestamp", F.coalesce("gas_used", F.lit(-1)).alias("gas_used"),
        F.coalesce("n", F.lit(0)).alias("n_withdrawals"),
    )


def _ranged_files(spark, name, dataset, frame, width) -> str:
    """A folder with one file per `width` blocks, named by its first and last block."""
    jvm, folder = spark._jvm, work_folder(spark, name)
    start = (F.col("block_number") - F.col("block_number") % width).alias("__start")
    frame.withColumn("__start", start).repartition("__start").write.partitionBy("__start").parquet(f"{folder}-parts")
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for found in fs.globStatus(path(f"{folder}-parts", "__start=*/part-*.parquet")):
        first = int(found.getPath().getParent().getName().partition("=")[2])
        fs.rename(found.getPath(), path(folder, f"net__{dataset}__{first:08d}_to_{first + width - 1:08d}.parquet"))
    fs.delete(path(f"{folder}-parts"), True)
    return folder


def range_files(spark, d):
    """Rows per opened file for ranges of 300 blocks in every 5000; one file has no range in its name."""
    blocks = V.spark_view(spark, d, V.BLOCKS)
    folder = _ranged_files(spark, "ranged", "blocks", blocks.filter("gas_used % 50 > 0"), 1000)
    rest = _extracted(spark, "unranged", [("blocks", blocks.filter("gas_used % 50 = 0").coalesce(1))])
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(f"{rest}/net__blocks__0-0.parquet"), path(f"{folder}/net__blocks__rest.parquet"))
    ranges = spark.range(900, _head(blocks) + 1, 5000).select(
        F.col("id").alias("start_block"), (F.col("id") + 300).alias("end_block")
    )
    opened = extracts.read_dataset(spark, folder, "blocks", ranges=ranges)
    found = opened.select("block_number", F.col("_metadata.file_name").alias("file_name"))
    inside = rows_in_ranges(found, ranges).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return found.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_read")).join(inside, "file_name", "left").select(
        "file_name", "n_read", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


def _raw_with_bad_rows(spark, d) -> ops.RawZone:
    blocks, txs = V.spark_view(spark, d, V.BLOCKS), _newest_txs(spark, d)
    gas = F.when(F.col("block_number") % 977 == 3, "many").otherwise(F.col("gas_used").cast("string"))
    limit = F.when(F.col("block_number") % 883 == 5, "lots").otherwise(F.col("gas_limit").cast("string"))
    return ops.RawZone(
        frames={"blocks": blocks.withColumn("gas_used", gas), "transactions": txs.withColumn("gas_limit", limit)}
    )


def historical_bad_rows(spark, d):
    """Values that don't fit their column: only the ranges that hold one fail."""
    store, raw = _store(spark, "bad"), _raw_with_bad_rows(spark, d)
    ops.historical(
        store, raw, 0, _head(raw.frames["blocks"]) + 1, ["blocks", "transactions"], as_of=V.AS_OF, version=VERSION
    )
    return _no_null_count(latest_state(store.state())).select(
        *STATE_KEY, "status", "attempt_count", "rows_indexed", "error_message"
    )


# -- streams ------------------------------------------------------------------------------
def _file_stream(spark, d, name):
    schema = V.table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _ingested(spark, d):
    store = _store(spark, "stream")
    blocks = _file_stream(spark, d, "orders").select(F.col("o_orderkey").alias("block_number"))
    stream_ingest(
        store, _raw(spark, d), blocks, ["blocks", "transactions"], store.path("_checkpoint"),
    ).awaitTermination()
    return store


def stream_ingest_state(spark, d):
    return _no_null_count(latest_state(_ingested(spark, d).state())).select(
        *STATE_KEY, "status", "rows_indexed", "error_message"
    )


def stream_ingest_rows(spark, d):
    return _ingested(spark, d).latest("transactions").select(*TX_COLUMNS, "block_timestamp")


def stream_bad_ranges(spark, d):
    """Four micro-batches; ranges with a bad row are tried again in later ones, given up after three attempts, and don't hold up others."""
    raw = _raw_with_bad_rows(spark, d)
    blocks = V.spark_view(spark, d, V.BLOCKS).select("block_number")
    head = _head(blocks)
    parts = [
        ("blocks", blocks.filter((F.col("block_number") >= (head + 1) * k // 4) & (F.col("block_number") < (head + 1) * (k + 1) // 4)).coalesce(1))
        for k in range(4)
    ]
    folder = _extracted(spark, "heads", parts)
    store = _store(spark, "stream-bad")
    stream = block_stream(spark, folder, blocks.schema, files_per_batch=1)
    stream_ingest(store, raw, stream, ["blocks", "transactions"], store.path("_checkpoint")).awaitTermination()
    return _no_null_count(latest_state(store.state())).select(*STATE_KEY, "status", "attempt_count", "rows_indexed")


def _snapshotted(spark, d):
    """A state in four appends, with a snapshot after the first and the third and one that was not finished."""
    store, state = _store(spark, "snapshot"), _state(spark, d)
    view = StateView(store)
    for k in range(4):
        store.append_state(state.filter(F.col("insert_version") % 4 == k))
        if k in (0, 2):
            view.take()
    view._read("rows", view.versions()[0]).limit(1).write.parquet(view._path("rows", 2**62))
    return view


def snapshot_state(spark, d):
    return _no_null_count(_snapshotted(spark, d).latest())


def snapshot_progress(spark, d):
    return coverage.progress(_snapshotted(spark, d).latest())


def snapshot_gaps(spark, d):
    return coverage.find_gaps(_snapshotted(spark, d).history(), V.DATASETS)


def snapshot_history(spark, d):
    return fold.history_summary_of(_snapshotted(spark, d).folded())


def _empty_folder(spark, name) -> str:
    folder = work_folder(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def _in_steps(found, name, steps):
    """Rows of a stream that is started again on its checkpoint after each step of (folder, frame) is written; all files of a step
    are one micro-batch, however many tasks write them."""
    out = work_folder(found.sparkSession, name)
    for step in steps:
        for folder, frame in step:
            frame.write.mode("append").parquet(folder)
        found.writeStream.option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).format("parquet").start(
            f"{out}/rows"
        ).awaitTermination()
    return found.sparkSession.read.schema(found.schema).parquet(f"{out}/rows")


def stream_stuck(spark, d):
    """Events of the state in four micro-batches by time; claims that ran out after 36 hours."""
    state = _state(spark, d)
    bounds = state.agg(F.min("created_at").alias("lo"), F.max("created_at").alias("hi")).first()
    step = (bounds["hi"] - bounds["lo"]) / 4
    cuts = [bounds["lo"] + step * k for k in range(5)]
    folder, parts = _empty_folder(spark, "claims"), []
    for k in range(4):
        after = F.col("created_at") > cuts[k] if k else F.lit(True)
        parts.append(state.filter(after & (F.col("created_at") <= cuts[k + 1])) if k < 3 else state.filter(after))
    found = stuck_claims(spark.readStream.schema(state.schema).parquet(folder), 36)
    return _in_steps(found, "stuck", [[(folder, part)] for part in parts])


def stream_enrich(spark, d):
    """Children and blocks in four steps each, in the order of the chain; a fifth step far ahead moves the watermark past the head."""
    blocks, txs = V.spark_view(spark, d, V.BLOCKS_WITH_DEFECTS), _txs(spark, d)
    head, depth = _head(txs), 1000
    cuts = [(head + 1) * k // 4 for k in range(5)]
    far = F.lit(head + 10 * depth).cast("bigint").alias("block_number")
    streams, written = [], []
    for name, rows in (("children", txs), ("parents", blocks)):
        folder = _empty_folder(spark, name)
        parts = [rows.filter((F.col("block_number") >= lo) & (F.col("block_number") < hi)) for lo, hi in zip(cuts, cuts[1:])]
        ahead = rows.limit(1).withColumn("block_number", far)
        if name == "parents":
            ahead = ahead.withColumn("timestamp", F.lit(10**9).cast("bigint"))
        written.append([(folder, part) for part in [*parts, ahead]])
        streams.append(spark.readStream.schema(rows.schema).parquet(folder))
    found = enrich_stream(*streams, depth).select(*TX_COLUMNS, "l_quantity", "block_timestamp", "reason")
    return _in_steps(found, "enriched", zip(*written)).filter(F.col("block_number") <= head)


def confirmed_windows(spark, d):
    """Days of the event stream that are complete at a depth of 12 blocks of an hour."""
    events = _file_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = work_folder(spark, "confirmed")
    days = confirmed_by_time(events, 12, 3600, "ts").groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n_events"))
    days.select(F.col("window.start").alias("day"), "n_events").writeStream.option(
        "checkpointLocation", f"{out}/_checkpoint"
    ).trigger(availableNow=True).format("parquet").start(f"{out}/rows").awaitTermination()
    return spark.read.schema("day TIMESTAMP, n_events BIGINT").parquet(f"{out}/rows")


def live_stream(spark, d):
    """Rows of the event stream that the live tier still takes."""
    events = _file_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = work_folder(spark, "live")
    unexpired_stream(events, 2, "ts", as_of="2024-01-31 00:00:00").select("event_id", "event_type").writeStream.option(
        "checkpointLocation", f"{out}/_checkpoint"
    ).trigger(availableNow=True).format("parquet").start(f"{out}/rows").awaitTermination()
    return spark.read.schema("event_id BIGINT, event_type STRING").parquet(f"{out}/rows")


def stream_dedup_query(spark, d):
    """Two replays of the event stream leave each event once."""
    once = _file_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = work_folder(spark, "dedup")
    stream = (
        stream_dedup(once.unionByName(once), ["event_id"], "ts", "40 days")
        .select("event_id", "user_id", "event_type")
        .writeStream.option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{out}/rows")
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


QUERIES = {
    "read_dataset": read_dataset,
    "route_by_filename": route_by_filename,
    "slice_range": slice_range,
    "project_dataset": project_dataset,
    "head_block": head_block,
    "clean_documents": clean_documents,
    "hex_pages": hex_pages,
    "clean_blocks": clean_blocks,
    "conform_schema": conform_schema,
    "schema_contract": schema_contract,
    "usable_timestamps": usable_timestamps,
    "latest_txs": latest_txs,
    "latest_state": latest_range_state,
    "range_status": point_status,
    "enrich_strict": enrich_strict,
    "missing_parents": missing_parents,
    "rejected_rows": rejected_rows,
    "validate_rows": validate_rows,
    "explode_withdrawals": explode_withdrawals,
    "load_blocks": load_blocks,
    "progress": progress,
    "history_summary": history_summary,
    "highest_attempted": highest_attempted,
    "last_synced": last_synced,
    "non_completed_ranges": non_completed_ranges,
    "continuous_ranges": continuous_ranges,
    "coverage_segments": coverage_segments,
    "range_summary": range_summary,
    "find_gaps": find_gaps,
    "find_gaps_window": find_gaps_window,
    "find_gaps_latest": find_gaps_latest,
    "block_islands": block_islands,
    "validate_timestamps": validate_timestamps,
    "validate_uneven_ranges": validate_uneven_ranges,
    "presence_gate": presence_gate,
    "presence_recheck": presence_recheck,
    "presence_islands": presence_islands,
    "sample_bad_blocks": sample_bad_blocks,
    "zero_row_ranges": zero_row_ranges,
    "validate_report": validate_report,
    "validate_report_window": validate_report_window,
    "stuck_ranges": stuck_ranges,
    "recover_stuck": recover_stuck,
    "claim_ranges": claim_ranges,
    "complete_ranges": complete_ranges,
    "fail_ranges": fail_ranges,
    "fail_dependents": fail_dependents,
    "mark_reprocess": mark_reprocess,
    "split_ranges": split_ranges_query,
    "align_start": align_starts,
    "safe_ranges": safe_ranges_query,
    "confirmed_blocks": confirmed_blocks,
    "repair_plan_maintain": repair_plan_maintain,
    "repair_plan_auto": repair_plan_auto,
    "detect_reorg": detect_reorg,
    "ingest_metrics": ingest_metrics,
    "duration_histogram": duration_histogram,
    "rows_per_batch": rows_per_batch,
    "rows_per_range": rows_per_range,
    "partition_keys": partition_keys,
    "retention": retention,
    "append_versioned": append_versioned,
    "delete_range": delete_range,
    "replace_ranges": replace_ranges,
    "expire_live": expire_live,
    "compact_table": compact_table,
    "table_ddl": table_ddl,
    "delete_counts": delete_counts,
    "historical_files": historical_files,
    "range_files": range_files,
    "snapshot_state": snapshot_state,
    "snapshot_progress": snapshot_progress,
    "snapshot_gaps": snapshot_gaps,
    "snapshot_history": snapshot_history,
    "stream_stuck": stream_stuck,
    "stream_enrich": stream_enrich,
    "historical_bad_rows": historical_bad_rows,
    "historical_state": historical_state,
    "historical_rows": historical_rows,
    "maintain_state": maintain_state,
    "auto_maintain_state": auto_maintain_state,
    "stream_ingest_state": stream_ingest_state,
    "stream_ingest_rows": stream_ingest_rows,
    "stream_bad_ranges": stream_bad_ranges,
    "confirmed_windows": confirmed_windows,
    "live_stream": live_stream,
    "stream_dedup": stream_dedup_query,
}


def configured(query):
    """The query with the session settings its results rely on (UTC above all)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run
