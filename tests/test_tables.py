"""Stored tables, whole loads, repairs and streams on temporary folders."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanledger.operators.latest import latest_state
from spanledger.plans import operations as ops
from spanledger.schemas import STATE_TABLE
from spanledger.session import work_folder
from spanledger.sources.tables import TableStore, with_partition
from spanledger.streaming.dedup import stream_dedup
from spanledger.streaming.ingest import JOURNAL, block_stream, ingest_batch, stream_ingest
from tests.conftest import rows

DAY = 86_400
START = 1_704_067_200  # 2024-01-01 00:00:00 UTC
AT = "2024-03-01 00:00:00"


@pytest.fixture
def store(spark):
    return TableStore(spark, work_folder(spark, "test"), "day")


def raw_blocks(spark, n, step=DAY // 4, bad=(), missing=(), withdrawals=None):
    """n blocks, four a day; `bad` ones have no timestamp, `missing` ones are left out."""
    bad, missing = list(bad) or [-1], list(missing) or [-1]
    return (
        spark.range(n)
        .filter(~F.col("id").isin(missing))
        .select(
            F.col("id").alias("block_number"),
            F.concat(F.lit("h"), "id").alias("block_hash"),
            F.when(~F.col("id").isin(bad), START + F.col("id") * step).alias("timestamp"),
            F.lit(withdrawals or '[{"index":"1","amount":"5"}]').alias("withdrawals"),
        )
    )


def raw_children(spark, n, per_block=2):
    return spark.range(n * per_block).select(
        F.expr(f"id div {per_block}").alias("block_number"),
        (F.col("id") % per_block).alias("transaction_index"),
        F.concat(F.lit("t"), "id").alias("transaction_hash"),
    )


def stamped(df):
    return df.withColumn("block_timestamp", F.timestamp_seconds("timestamp"))


def test_append_counts_and_reads_latest(spark, store):
    blocks = stamped(raw_blocks(spark, 20))
    assert store.append(blocks, "blocks", 1) == 20
    assert store.append(blocks.filter("block_number < 5").withColumn("block_hash", F.lit("new")), "blocks", 2) == 5
    assert store.append(blocks, "blocks", 1) == 20  # a replay
    assert store.read("blocks").count() == 45
    assert rows(store.latest("blocks").groupBy("insert_version").count()) == [(1, 15), (2, 5)]
    latest = rows(store.latest("blocks"))
    store.compact("blocks", [20240101])
    assert rows(store.read("blocks").groupBy("part_day").count())[:2] == [(20240101, 4), (20240102, 9)]
    store.compact("blocks")
    assert store.read("blocks").count() == 20
    assert rows(store.latest("blocks")) == latest


def test_latest_of_a_large_table_is_dealt_to_more_tasks(spark, store, monkeypatch):
    blocks = stamped(raw_blocks(spark, 40)).withColumn("block_number", F.when(F.col("block_number") != 7, F.col("block_number")))
    store.append(blocks, "blocks", 1)
    store.append(blocks.filter("block_number < 5").withColumn("block_hash", F.lit("new")), "blocks", 2)
    expected = rows(store.latest("blocks"))
    monkeypatch.setattr("spanledger.sources.tables.LATEST_BYTES", 1000)
    found = store.latest("blocks")
    assert found.rdd.getNumPartitions() == -(-store._stored_bytes("blocks") // 1000) > 10
    assert rows(found) == expected and len(expected) == 40


def test_rewrites_leave_rows_alone_that_are_added_meanwhile(spark, store, monkeypatch):
    store.append(stamped(raw_blocks(spark, 20)), "blocks", 1)
    real = TableStore._replace_files

    def late(self, kept, table, files):
        self.append(stamped(raw_blocks(spark, 3)), table, 7)  # another loader, same days
        real(self, kept, table, files)

    monkeypatch.setattr(TableStore, "_replace_files", late)
    store.delete_range("blocks", 0, 10)
    assert rows(store.read("blocks"), "block_number", "insert_version") == sorted(
        [(n, 1) for n in range(10, 20)] + [(n, 7) for n in range(3)], key=repr
    )
    store.compact("blocks", [20240101])
    assert store.read("blocks").filter("insert_version = 7").count() == 6


def test_reading_a_table_nobody_wrote(store):
    assert store.read("logs").count() == 0
    assert store.delete_range("logs", 0, 10) == 0
    assert store.state().columns == [c for c in store.read(STATE_TABLE).columns if c != "part_day"]


def test_scan_prunes_partitions_and_pushes_the_range(spark, store):
    store.append(stamped(raw_blocks(spark, 20)), "blocks", 1)
    scan = store.read("blocks").filter("part_day = 20240102 AND block_number >= 3").select("block_number")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "part_day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(block_number,3)" in plan
    assert "ReadSchema: struct<block_number:bigint>" in plan


def test_delete_rewrites_touched_days_only(spark, store):
    blocks = stamped(raw_blocks(spark, 20, bad=[19]))
    store.append(blocks, "blocks", 1)
    store.append(
        blocks.select("block_number", F.lit("1").alias("withdrawal_index"), "block_timestamp"),
        "withdrawals", 1,
    )
    files = {f for f in store.read("blocks").inputFiles() if "20240101" in f or "20240105" in f}
    assert store.delete_range("blocks", 6, 14) == 16  # 8 blocks and their withdrawals
    kept = [n for n in range(20) if not 6 <= n < 14]
    for name in ("blocks", "withdrawals"):
        assert rows(store.read(name), "block_number") == sorted([(n,) for n in kept], key=repr)
    assert files <= set(store.read("blocks").inputFiles())
    assert not any("20240103" in f for f in store.read("blocks").inputFiles())
    assert store.delete_range("blocks", 18, 20, related=False) == 2  # one without a day
    assert store.read("withdrawals").filter("block_number >= 18").count() == 2
    assert store.delete_range("blocks", 100, 200) == 0


def test_replace_ranges(spark, store):
    blocks = stamped(raw_blocks(spark, 20))
    store.append(blocks, "blocks", 1)
    ranges = spark.createDataFrame([(0, 4), (10, 12)], "start_block BIGINT, end_block BIGINT")
    fresh = store.read("blocks").filter("block_number IN (0, 1, 10)").withColumn("block_hash", F.lit("again"))
    assert store.replace_ranges("blocks", ranges, fresh, 2) == 3
    again = [(0,), (1,), (10,)]
    assert rows(store.read("blocks").filter("block_hash = 'again'"), "block_number") == again
    assert store.read("blocks").count() == 20 - 6 + 3


@pytest.mark.parametrize("unit, first", [("day", 3), ("month", 3)])
def test_expire(spark, unit, first):
    store = TableStore(spark, work_folder(spark, "expire"), unit)
    store.append(stamped(raw_blocks(spark, 20, step=DAY // 2)), "blocks", 1)
    as_of = datetime(2024, 1, 4, 6)  # two days before: 2024-01-02 06:00
    store.expire("blocks", as_of, 2)
    assert rows(store.read("blocks"), "block_number") == sorted([(n,) for n in range(first, 20)], key=repr)


def test_partition_values(spark):
    df = spark.sql("SELECT timestamp'2024-02-29 23:59:59' AS block_timestamp")
    assert str(with_partition(df, "month").first().part_month) == "2024-02-01"
    assert with_partition(df, "day").first().part_day == 20240229


def zone(spark, n, **how):
    return ops.RawZone(frames={"blocks": raw_blocks(spark, n, **how), "transactions": raw_children(spark, n)})


NAMES = ["blocks", "transactions"]


def outcome(store):
    return rows(latest_state(store.state()), "dataset", "start_block", "end_block", "status", "rows_indexed")


def test_historical_load_and_replay(spark, store):
    raw = zone(spark, 40, bad=[13], missing=[25])
    for _ in range(2):  # the second call is a replay of the same version
        ops.historical(store, raw, 0, 35, NAMES, 10, as_of=AT, version=100)
        assert outcome(store) == [
            ("blocks", 0, 10, "completed", 20), ("blocks", 10, 20, "failed", None),
            ("blocks", 20, 30, "failed", None), ("blocks", 30, 35, "completed", 10),
            ("transactions", 0, 10, "completed", 20), ("transactions", 10, 20, "failed", None),
            ("transactions", 20, 30, "failed", None), ("transactions", 30, 35, "completed", 10),
        ]
        txs = store.latest("transactions")
        assert txs.count() == 30
        assert txs.filter(
            F.unix_seconds("block_timestamp") != START + F.col("block_number") * (DAY // 4)
        ).count() == 0
    messages = {r.start_block: r.error_message for r in latest_state(store.state()).filter(
        "dataset = 'transactions' AND status = 'failed'").collect()}
    assert messages[10] == "Skipped: Block timestamps unusable (invalid): 9/10 valid, 10 present"
    assert messages[20] == "Skipped: Block timestamps unusable (not_visible): 9/10 valid, 9 present"


def test_a_crash_between_rows_and_state_is_replayed_without_double_counts(spark, store, monkeypatch):
    raw = zone(spark, 20)
    real, calls = TableStore.append_state, []

    def dying(self, rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, rows)

    monkeypatch.setattr(TableStore, "append_state", dying)
    with pytest.raises(RuntimeError):
        ops.historical(store, raw, 0, 20, NAMES, 10, as_of=AT, version=100)
    monkeypatch.setattr(TableStore, "append_state", real)
    ops.historical(store, raw, 0, 20, NAMES, 10, as_of=AT, version=100)
    assert {r[3:] for r in outcome(store)} == {("completed", 20)}
    assert store.latest("blocks").count() == 20 and store.latest("withdrawals").count() == 20


def test_an_error_in_one_dataset_does_not_stop_the_others(spark, store):
    raw = zone(spark, 10)
    raw.frames["logs"] = raw_children(spark, 10).withColumn("address", F.raise_error(F.lit("broken file")).cast("string"))
    raw.frames["code_diffs"] = raw_children(spark, 10).withColumn("address", F.lit("a"))
    ops.historical(store, raw, 0, 10, [*NAMES, "logs", "code_diffs"], 10, as_of=AT, version=100)
    by_name = {r[0]: r[1:] for r in outcome(store)}
    assert by_name["transactions"] == (0, 10, "completed", 20)
    assert by_name["code_diffs"] == (1, 10, "completed", 18)
    assert by_name["logs"] == (0, 10, "failed", None)
    message = latest_state(store.state()).filter("dataset = 'logs'").first().error_message
    assert "broken file" in message and len(message) <= 500


def test_maintain_fixes_what_failed(spark, store):
    ops.historical(store, zone(spark, 40, bad=[13], missing=[25]), 0, 40, NAMES, 10, as_of=AT, version=100)
    before = {f for f in store.read("transactions").inputFiles() if "20240101" in f}
    ops.maintain(store, zone(spark, 40), NAMES, batch=10, min_gap=10, as_of=AT, version=200)
    assert {r[3] for r in outcome(store)} == {"completed"}
    assert store.read("blocks").count() == 40 and store.latest("withdrawals").count() == 40
    assert store.read("transactions").count() == 80
    assert before and before <= set(store.read("transactions").inputFiles())
    ops.maintain(store, zone(spark, 40), NAMES, batch=10, min_gap=10, as_of=AT, version=300)  # nothing to do
    assert store.state().filter("insert_version >= 300").count() == 0


def test_auto_maintain_recovers_stuck_and_empty_ranges(spark, store):
    empty = zone(spark, 40)
    empty.frames["transactions"] = raw_children(spark, 40).filter("block_number >= 10")
    ops.historical(store, empty, 0, 30, NAMES, 10, as_of=AT, version=100)
    assert ("transactions", 0, 10, "completed", 0) in outcome(store)
    from spanledger.operators.state import claim_ranges

    def claim(start, as_of, version):
        one = spark.createDataFrame([("transactions", start, start + 10)], "dataset STRING, start_block BIGINT, end_block BIGINT")
        store.append_state(claim_ranges(store.state(), one, "other", as_of, version))

    claim(30, "2024-03-01 00:00:00", 110)  # long dead
    claim(40, "2024-03-01 09:30:00", 111)  # at work
    ops.historical(store, zone(spark, 40), 30, 40, ["blocks"], 10, as_of=AT, version=120)
    ops.auto_maintain(
        store, zone(spark, 40), NAMES, batch=10, stuck_hours=2, min_gap=10,
        as_of="2024-03-01 10:00:00", version=200,
    )
    done = {r[:3]: r[3:] for r in outcome(store)}
    assert done.pop(("transactions", 40, 50)) == ("processing", None)
    assert set(done.values()) == {("completed", 20)} and len(done) == 8


def test_stream_equals_batch(spark, store, tmp_path):
    import pyarrow.parquet as pq

    raw = raw_blocks(spark, 47).toPandas()
    for i, (lo, hi) in enumerate([(0, 13), (13, 31), (31, 47)]):
        part = raw[(raw.block_number >= lo) & (raw.block_number < hi)]
        import pyarrow as pa

        pq.write_table(pa.Table.from_pandas(part, preserve_index=False), tmp_path / f"net__blocks__{i}.parquet")
    zone_ = ops.RawZone(str(tmp_path), frames={"transactions": raw_children(spark, 47)})
    stream = block_stream(spark, str(tmp_path), raw_blocks(spark, 1).schema, files_per_batch=1)
    for _ in range(2):  # a restart on the same checkpoint finds nothing new
        stream_ingest(
            store, zone_, stream, NAMES, store.path("_checkpoint"), batch_size=10, confirmations=6
        ).awaitTermination()
        assert outcome(store) == [
            (name, s, s + 10, "completed", 20) for name in NAMES for s in (0, 10, 20, 30)
        ]
    assert store.latest("transactions").count() == 80
    journal = spark.read.parquet(store.path(JOURNAL))
    assert rows(journal, "batch_id", "head_block") == [(0, 12), (1, 30), (2, 46)]


def test_stream_retries_gives_up_and_replays_a_batch(spark, store):
    raw = zone(spark, 40, bad=[13])
    head = spark.createDataFrame([(30,)], "block_number BIGINT")
    for batch_id in (0, 0, 1, 2):  # the second call is a replay
        ingest_batch(store, raw, head, batch_id, NAMES, batch_size=10, confirmations=0, max_retries=2)
    state = latest_state(store.state())
    assert rows(state.filter("status = 'failed'"), "dataset", "start_block", "attempt_count") == [
        ("blocks", 10, 2), ("transactions", 10, 2),
    ]
    assert rows(state.filter("dataset = 'blocks' AND status = 'completed'"), "start_block") == [(0,), (20,)]
    again = zone(spark, 40)
    ingest_batch(store, again, head, 3, NAMES, batch_size=10, confirmations=0, max_retries=3)
    assert {r[3:] for r in outcome(store)} == {("completed", 20)}
    assert store.latest("blocks").filter("timestamp IS NULL").count() == 0


def test_stream_dedup_keeps_the_first_of_a_replay(spark, tmp_path):
    source = str(tmp_path / "in")
    stamped(raw_blocks(spark, 30)).write.parquet(source)
    stamped(raw_blocks(spark, 30)).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    out = stream_dedup(spark.readStream.schema(schema).parquet(source), ["block_number"], lateness="40 days")
    out.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format(
        "parquet"
    ).start(str(tmp_path / "out")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "block_number") == sorted(
        [(n,) for n in range(30)], key=repr
    )


def test_late_and_expired_rows_do_not_enter_the_live_tier(spark, tmp_path):
    from spanledger.streaming.dedup import unexpired_stream

    source = tmp_path / "in"
    columns = "block_number BIGINT, block_timestamp TIMESTAMP"

    def add(number, age):
        spark.sql(
            f"SELECT {number}L AS block_number, current_timestamp() - INTERVAL {age} HOURS AS block_timestamp"
        ).coalesce(1).write.mode("append").parquet(str(source))

    add(1, 1)
    add(2, 47)
    add(3, 49)
    live = unexpired_stream(spark.readStream.schema(columns).parquet(str(source)), 2)
    live.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format(
        "parquet"
    ).start(str(tmp_path / "out")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "block_number") == [(1,), (2,)]


def test_sql_names_and_catalog_table(spark, store):
    store.append(stamped(raw_blocks(spark, 20)), "blocks", 1)
    ops.historical(store, zone(spark, 20), 0, 20, ["blocks"], 10, as_of=AT, version=100)
    from spanledger.sources.views import register_views

    names = register_views(store, "v_")
    assert "v_blocks" in names and "v_logs" not in names
    assert spark.sql("SELECT count(*) FROM v_blocks WHERE insert_version = 100").first()[0] == 20
    assert spark.sql("SELECT overall_status FROM v_indexing_progress").first()[0] == "complete"
    assert spark.sql("SELECT continuity_description FROM v_indexing_summary").first()[0] == "fully_continuous"
    spark.sql(store.ddl("blocks"))
    spark.sql("MSCK REPAIR TABLE blocks")
    try:
        assert spark.table("blocks").filter("part_day = 20240101").count() == 8
    finally:
        spark.sql("DROP TABLE blocks")
    assert store.exists("blocks")


def test_command_line(spark, tmp_path):
    import pyarrow.parquet as pq

    from spanledger.__main__ import main

    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    for name, df in (("blocks", raw_blocks(spark, 30)), ("transactions", raw_children(spark, 30))):
        pq.write_table(df.toArrow(), raw / f"net__{name}__0_to_29.parquet")
    base = ["--root", root, "--raw", str(raw), "--datasets", "blocks,transactions", "--live"]
    assert main(["historical", *base, "--start", "0", "--end", "10"]) == 0
    assert main(["continuous", *base, "--once"]) == 0
    live = TableStore(spark, root, "day")
    assert [r[1:] for r in outcome(live) if r[0] == "blocks"] == [
        (0, 10, "completed", 20), (10, 20, "completed", 20),
    ]
    assert main(["validate", *base]) == 0
    assert main(["historical", *base, "--start", "20", "--end", "40"]) == 1
    assert main(["validate", *base]) == 1
    live.expire_live(datetime(2024, 1, 6, 6))
    assert rows(live.read("transactions").select(F.min("block_number"))) == [(14,)]


def test_failing_blocks_leave_the_old_rows(spark, store, monkeypatch):
    """Whatever breaks while new rows are made, a repair takes nothing away before they stand."""
    ops.historical(store, zone(spark, 20, bad=[3]), 0, 20, NAMES, batch=10, as_of=AT, version=100)
    before = rows(store.read("blocks"))
    broken = zone(spark, 20)
    broken.frames["blocks"] = broken.frames["blocks"].withColumn(
        "block_hash", F.when(F.col("block_number") == 4, F.raise_error(F.lit("no such block"))).otherwise(F.col("block_hash"))
    )
    ops.maintain(store, broken, NAMES, batch=10, min_gap=1, as_of="2024-03-02 00:00:00", version=200)
    assert rows(store.read("blocks")) == before
    state = latest_state(store.state())
    assert rows(state.filter("start_block = 0"), "dataset", "status") == [("blocks", "failed"), ("transactions", "failed")]
    assert state.filter("status = 'processing'").count() == 0


def test_a_poorer_file_first_or_last(spark, tmp_path):
    rich = raw_blocks(spark, 4).withColumn("gas_used", F.lit(7))
    poor = raw_blocks(spark, 8).filter("block_number >= 4").drop("withdrawals").select("timestamp", "block_number", "block_hash")
    for names in (("a", "b"), ("b", "a")):
        folder = tmp_path / "".join(names)
        for name, frame in zip(names, (poor, rich)):
            frame.coalesce(1).write.parquet(str(folder / f"blocks-{name}"))
        for i, part in enumerate(sorted(folder.glob("*/part-*.parquet"))):
            part.rename(folder / f"net__blocks__{i}.parquet")
        store = TableStore(spark, work_folder(spark, "files"), "day")
        ops.historical(store, ops.RawZone(str(folder)), 0, 8, ["blocks"], batch=4, as_of=AT, version=1)
        assert rows(store.latest("blocks").filter("gas_used = 7"), "block_number") == [(0,), (1,), (2,), (3,)]
        assert store.latest("withdrawals").count() == 4


def test_children_alone_need_only_their_own_blocks(spark, store):
    ops.historical(store, zone(spark, 20, missing=[5, 12]), 0, 20, ["blocks"], batch=10, as_of=AT, version=100)
    raw = zone(spark, 20)
    raw.frames["transactions"] = raw.frames["transactions"].filter("block_number <> 5")
    ops.historical(store, raw, 0, 20, ["transactions"], batch=10, as_of=AT, version=200)
    state = latest_state(store.state()).filter("dataset = 'transactions'")
    assert rows(state, "start_block", "status", "error_message") == [
        (0, "completed", None), (10, "failed", "2 rows rejected, such as: null_timestamp"),
    ]


def test_equal_versions_read_alike(spark, store):
    twice = stamped(raw_blocks(spark, 4)).unionByName(stamped(raw_blocks(spark, 4)).withColumn("block_hash", F.lit("z")))
    store.append(twice, "blocks", 1)
    assert {r.block_hash for r in store.latest("blocks").collect()} == {"z"}


def test_deletes_push_their_bounds(spark, store, monkeypatch):
    store.append(stamped(raw_blocks(spark, 20)), "blocks", 1)
    plans = []
    real = TableStore.put_work
    monkeypatch.setattr(
        TableStore, "put_work",
        lambda self, df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(self, df, name),
    )
    assert store.delete_range("blocks", 6, 14, related=False) == 8
    assert "GreaterThanOrEqual(block_number,6)" in plans[0] and "LessThan(block_number,14)" in plans[0]


def test_a_restart_after_a_bad_row_goes_on(spark, store, tmp_path):
    raw = zone(spark, 47)
    gas = F.when(F.col("block_number") == 13, "many").otherwise("1")
    raw.frames["blocks"] = raw.frames["blocks"].withColumn("gas_used", gas)
    raw_blocks(spark, 47).coalesce(1).write.parquet(str(tmp_path / "blocks"))
    part = next((tmp_path / "blocks").glob("part-*.parquet"))
    part.rename(tmp_path / "net__blocks__1.parquet")
    stream = block_stream(spark, str(tmp_path), raw_blocks(spark, 1).schema)
    for _ in range(2):
        stream_ingest(
            store, raw, stream, NAMES, store.path("_checkpoint"), batch_size=10, confirmations=6
        ).awaitTermination()
    state = latest_state(store.state())
    assert rows(state.filter("status = 'failed'"), "dataset", "start_block", "attempt_count") == [
        ("blocks", 10, 1), ("transactions", 10, 1),
    ]
    assert state.filter("status = 'completed'").count() == 6


def test_failed_ranges_of_the_stream_are_tried_again(spark, tmp_path):
    """2800 blocks in four micro-batches; bad rows in the ranges at 0, 800, 900, 1700, 1900 and 2600."""
    import duckdb

    from checks.compare import compare
    from checks.queries import QUERIES

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    tables = {
        "orders": """SELECT i AS o_orderkey, i % 70 AS o_custkey, ['F', 'O', 'P'][i % 3 + 1] AS o_orderstatus, i * 1.5::DOUBLE AS o_totalprice,
            TIMESTAMP '1995-01-01' + to_days((i % 900)::INTEGER) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(2800) t(i)""",
        "lineitem": """SELECT i // 2 AS l_orderkey, i % 9 AS l_partkey, i % 7 AS l_suppkey, (i % 2)::INTEGER AS l_linenumber,
            i * 1.0::DOUBLE AS l_quantity, i * 2.0::DOUBLE AS l_extendedprice, 0.1::DOUBLE AS l_discount, 'A' AS l_returnflag,
            TIMESTAMP '1995-02-01' AS l_shipdate FROM range(5600) t(i)""",
    }
    for name, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    found = []

    def query(spark, d):
        found.append(QUERIES["stream_bad_ranges"](spark, d).localCheckpoint())
        return found[0]

    assert compare(spark, con, str(tmp_path), "stream_bad_ranges", {"stream_bad_ranges": query}) == ""
    failed = rows(found[0].filter("status = 'failed'"), "dataset", "start_block", "attempt_count")
    assert failed == sorted([
        ("blocks", 0, 3), ("blocks", 900, 3), ("blocks", 1900, 2), ("transactions", 0, 3), ("transactions", 800, 3),
        ("transactions", 900, 3), ("transactions", 1700, 2), ("transactions", 1900, 2), ("transactions", 2600, 1),
    ], key=repr)
