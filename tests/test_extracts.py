"""Extracted files picked by the range in their name."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from spanledger.plans import operations as ops
from spanledger.session import work_folder
from spanledger.sources import extracts
from spanledger.sources.tables import TableStore
from tests.conftest import rows

RANGES = "start_block BIGINT, end_block BIGINT"


def put(folder, name, numbers, **columns):
    table = {"block_number": pa.array(numbers, pa.int64())} | {k: pa.array([v] * len(numbers)) for k, v in columns.items()}
    (folder / name).parent.mkdir(exist_ok=True)
    pq.write_table(pa.table(table), folder / name)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """A thousand files of ten blocks, some in a subfolder, and one without a range in its name."""
    base = tmp_path_factory.mktemp("zone")
    for k in range(1000):
        name = f"net__logs__{10 * k:08d}_to_{10 * k + 9:08d}.parquet"
        put(base, f"deep/{name}" if k % 2 else name, range(10 * k, 10 * k + 10), **({"topic0": "t"} if k == 500 else {}))
    put(base, "net__logs__late.parquet", [5003, 77_777])
    put(base, "net__blocks__00000000_to_00099999.parquet", [1])
    return base


def opened(df):
    return sorted(f.rsplit("/", 1)[1] for f in df.inputFiles())


def test_three_of_a_thousand_files_are_opened(spark, folder):
    ranges = spark.createDataFrame([(5005, 5006), (5006, 5011), (9999, 20_000), (300, 300)], RANGES)
    got = extracts.read_dataset(spark, str(folder), "logs", ranges=ranges)
    assert opened(got) == [
        "net__logs__00005000_to_00005009.parquet", "net__logs__00005010_to_00005019.parquet",
        "net__logs__00009990_to_00009999.parquet", "net__logs__late.parquet",
    ]
    assert got.columns == ["block_number", "topic0"] and got.count() == 32
    whole = extracts.read_dataset(spark, str(folder), "logs")
    assert len(whole.inputFiles()) == 1001 and whole.count() == 10_002


@pytest.mark.parametrize(("ranges", "starts"), [
    ([(0, 10)], [0]), ([(9, 11)], [0, 10]), ([(10, 11), (15, 20)], [10]), ([(0, 10_000)], range(0, 10_000, 10)),
    ([(25, 31), (0, 45)], [0, 10, 20, 30, 40]), ([(-5, 1)], [0]), ([(10_000, 10**15)], []),
])
def test_edges_of_ranges(spark, folder, ranges, starts):
    files = extracts.list_files(spark, str(folder), "logs")
    hit = extracts.overlapping_files(files, spark.createDataFrame(ranges, RANGES))
    assert [r[0] for r in rows(hit.filter("start_block IS NOT NULL").orderBy("start_block"), "start_block")] == sorted(starts, key=lambda s: repr((s,)))
    assert hit.filter("start_block IS NULL").count() == 1


def test_names_without_a_usable_range(spark, tmp_path):
    for name in ("a__logs__9_to_5.parquet", f"a__logs__1_to_{10**30}.parquet", "a__logs__12.parquet", "a__logs__3_to_4.parquet"):
        put(tmp_path, name, [1])
    listed = extracts.list_files(spark, str(tmp_path), "logs").select("start_block", "end_block")
    assert rows(listed) == [(3, 5), (None, None), (None, None), (None, None)]


def test_a_plan_beyond_all_files_reads_nothing_and_keeps_the_columns(spark, folder):
    far = spark.createDataFrame([(500, 600)], RANGES)
    put(folder, "net__traces__0_to_9.parquet", [1], error="x")
    got = extracts.read_dataset(spark, str(folder), "traces", ranges=far)
    assert got.columns == ["block_number", "error"] and got.count() == 0


def test_a_load_opens_the_files_of_its_plan(spark, tmp_path):
    day = 86_400 * 20_000
    for k in range(6):
        numbers = list(range(10 * k, 10 * k + 10))
        pq.write_table(
            pa.table({"block_number": numbers, "timestamp": [day + n for n in numbers]}), tmp_path / f"n__blocks__{10 * k}_to_{10 * k + 9}.parquet"
        )
    (tmp_path / "n__blocks__20_to_29.parquet").write_bytes(b"no parquet")
    store = TableStore(spark, work_folder(spark, "picked"), "day")
    raw = ops.RawZone(str(tmp_path))
    ops.historical(store, raw, 30, 50, ["blocks"], 10, version=1)  # the broken file is not part of it
    assert rows(store.state().filter("status = 'completed'"), "start_block") == [(30,), (40,)]
    ops.historical(store, raw, 0, 30, ["blocks"], 10, version=3)
    assert store.state().filter("status = 'failed' AND insert_version = 4").count() == 3
