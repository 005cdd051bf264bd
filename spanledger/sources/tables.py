"""Versioned Parquet tables below one root: append, delete, replace, expire.

Layout: <root>/<table>/<partition column>=<value>/. Plain Parquet has no merge, so readers
take `latest_wins`, and deletes rewrite only the files that hold deleted rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.functions.columns import timestamp_at
from spanledger.operators.ranges import rows_in_ranges
from spanledger.operators.latest import latest_wins
from spanledger.plans.ranges import plan_ranges
from spanledger.schemas import (
    LIVE_DATA_DAYS,
    LIVE_STATE_DAYS,
    STATE_KEY,
    STATE_SCHEMA,
    STATE_TABLE,
    TABLES,
)
from spanledger.session import work_folder
from spanledger.sources.extracts import slice_range

# Time partition per tier: column, type, and the value of a timestamp.
PARTITIONS = {
    "month": ("part_month", T.DateType()),
    "day": ("part_day", T.IntegerType()),
}


def partition_value(unit: str, stamp: Column | str) -> Column:
    c = F.col(stamp) if isinstance(stamp, str) else stamp
    if unit == "month":
        return F.trunc(c.cast("date"), "month")
    if unit == "day":
        return F.date_format(c, "yyyyMMdd").cast("int")
    raise ValueError(f"unknown partition unit {unit}")


def with_partition(df: DataFrame, unit: str = "month", stamp: str = "block_timestamp") -> DataFrame:
    return df.withColumn(PARTITIONS[unit][0], partition_value(unit, stamp))


# Files that one rewrite job of a delete takes on; their names pass through the driver.
FILES_PER_REWRITE = 10_000
# Stored bytes whose rows one task compares when the latest versions are read: some 200 MB in memory.
LATEST_BYTES = 16 << 20


class TableStore:
    """Tables of one tier: "month" partitions are the permanent tier, "day" the live one."""

    def __init__(self, spark: SparkSession, root: str, unit: str = "month"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.unit = unit
        self.column, self.column_type = PARTITIONS[unit]

    # -- layout ---------------------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _schema(self, table: str) -> T.StructType:
        if table == STATE_TABLE:
            return STATE_SCHEMA
        return TABLES[table].stored_schema

    def _stamp(self, table: str) -> str:
        return "created_at" if table == STATE_TABLE else "block_timestamp"

    def _key(self, table: str) -> tuple[str, ...]:
        return STATE_KEY if table == STATE_TABLE else TABLES[table].key

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, table: str) -> bool:
        fs, p = self._fs(self.path(table))
        return fs.exists(p)

    def ddl(self, table: str, name: str | None = None) -> str:
        """CREATE TABLE statement over the files, as `name` (the table's own by default); MSCK
        REPAIR TABLE then finds the partitions."""
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in self._schema(table).fields]
        columns.append(f"{self.column} {self.column_type.simpleString()}")
        return (
            f"CREATE TABLE IF NOT EXISTS {name or table} ({', '.join(columns)}) USING parquet "
            f"PARTITIONED BY ({self.column}) LOCATION '{self.path(table)}'"
        )

    # -- read -----------------------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """Every stored version, with the partition column."""
        schema = T.StructType(self._schema(table).fields + [T.StructField(self.column, self.column_type)])
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def latest(self, table: str) -> DataFrame:
        """The latest version of every key; of equal versions the one with the largest values.

        A table that would give each shuffle partition more than LATEST_BYTES is dealt by its key to more of them, so that
        what a task sorts does not grow with the table. Rows are then sorted behind the shuffle only.
        """
        rows, key = self.read(table).drop(self.column), self._key(table)
        others = [c for c in rows.columns if c not in key and c != "insert_version"]
        parts = -(-self._stored_bytes(table) // LATEST_BYTES)
        if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            rows = rows.repartition(parts, *key)
        return latest_wins(rows, key, ["insert_version", *others])

    def _stored_bytes(self, table: str) -> int:
        fs, p = self._fs(self.path(table))
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def state(self) -> DataFrame:
        return self.read(STATE_TABLE).drop(self.column)

    # -- write ----------------------------------------------------------------------------
    def _laid_out(self, df: DataFrame, table: str) -> DataFrame:
        """Rows gathered per time partition and sorted by key for row-group skipping.

        A rebalance lets AQE split a partition that holds a large share of the rows. Columns that
        `df` doesn't have become NULL behind the shuffle and the sort, which so don't carry them.
        """
        fields, have = self._schema(table).fields, set(df.columns)
        laid_out = (
            with_partition(df, self.unit, self._stamp(table))
            .select(*[f.name for f in fields if f.name in have], self.column)
            .hint("rebalance", self.column)
            .sortWithinPartitions(self.column, *[k for k in self._key(table) if k in have])
        )
        return laid_out.select(
            *[f.name if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields], self.column
        )

    def append(self, df: DataFrame, table: str, version: int | None = None) -> int:
        """Append rows under one insert_version (a nanosecond clock by default); returns how
        many. Replaying an append is harmless, since readers take the latest version."""
        if table != STATE_TABLE:
            version = time.time_ns() if version is None else version
            stamp = self._stamp(table)
            if stamp not in df.columns:
                df = df.withColumn(stamp, F.lit(None))
            df = df.withColumn("insert_version", F.lit(version).cast("bigint"))
            have = set(df.columns)
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema(table).fields if f.name in have])
        seen = Observation()
        out = self._laid_out(df, table).observe(seen, F.count(F.lit(1)).alias("rows"))
        out.write.mode("append").partitionBy(self.column).parquet(self.path(table))
        return int(seen.get["rows"])

    def append_state(self, rows: DataFrame) -> int:
        return self.append(rows, STATE_TABLE)

    def delete_ranges(self, table: str, ranges: DataFrame, related: bool = True) -> int:
        """Delete all versions of the rows inside any of the ranges; returns how many.

        Deleting blocks also deletes their withdrawals, unless `related` is off.
        """
        deleted = self._rewrite_without(table, ranges)
        if related and table == "blocks":
            deleted += self._rewrite_without("withdrawals", ranges)
        return deleted

    def delete_range(self, table: str, start: int, end: int, related: bool = True) -> int:
        return self.delete_ranges(table, plan_ranges(self.spark, start, end, max(end - start, 1)), related)

    def replace_ranges(
        self, table: str, ranges: DataFrame, rows: DataFrame, version: int | None = None, staged: bool = False
    ) -> int:
        """Delete the ranges, then append the rows that were extracted again.

        The new rows are written to the work folder first, so they never read from files
        that are being replaced, and a failure while computing them deletes nothing. Rows
        that already come from a work table are taken as they are with `staged`.
        """
        if staged:
            self.delete_ranges(table, ranges, related=False)
            return self.append(rows, table, version)
        folder = work_folder(self.spark, f"replace-{table}")
        rows.write.parquet(folder)
        appended = self.replace_ranges(
            table, ranges, self.spark.read.schema(rows.schema).parquet(folder), version, staged=True
        )
        self._remove(folder)
        return appended

    # -- work tables ----------------------------------------------------------------------
    def put_work(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate result, so that later steps read it instead of its plan."""
        path = self.path(f"_work/{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_work(self, name: str) -> None:
        self._remove(self.path(f"_work/{name}"))

    def _remove(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    # -- rewriting files ------------------------------------------------------------------
    # A rewrite writes the rows to keep as new files and then removes the old files it read.
    # Files that others add meanwhile are not touched, so a loader may run beside it. Until
    # the old files are gone a reader sees rows twice under one version, as after a replay.
    def _rewrite_without(self, table: str, ranges: DataFrame) -> int:
        span = ranges.agg(F.min("start_block").alias("lo"), F.max("end_block").alias("hi")).first()
        if not self.exists(table) or span["lo"] is None:
            return 0
        # The outer bounds reach the scan, which skips row groups by them.
        near = slice_range(self.read(table), span["lo"], span["hi"])
        located = near.select("block_number", F.col("_metadata.file_path").alias("file"))
        work = f"delete-{uuid.uuid4().hex}"
        hits = self.put_work(
            rows_in_ranges(located, ranges).groupBy("file").agg(F.count(F.lit(1)).alias("rows")), work
        )
        found = hits.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
        for files in self._file_lists(hits, found["files"]):
            kept = rows_in_ranges(self._read_files(table, files), ranges, inside=False)
            self._replace_files(kept, table, files)
        self.drop_work(work)
        return found["rows"] or 0

    def _file_lists(self, located: DataFrame, n: int) -> Iterator[list[str]]:
        """The file names in lists of about FILES_PER_REWRITE, whatever partitions they are in."""
        parts = -(-n // FILES_PER_REWRITE)
        for k in range(parts):
            mine = located.filter(F.pmod(F.xxhash64("file"), F.lit(parts)) == k)
            files = [r["file"] for r in mine.select("file").collect()]
            if files:
                yield files

    def _partitions(self, table: str) -> list:
        """Values of the time partitions there are, from the folders' names."""
        fs, p = self._fs(self.path(table))
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        texts = [n.partition("=")[2] for n in names if n.startswith(f"{self.column}=")]
        whole = {"month": date.fromisoformat, "day": int}[self.unit]
        return [None if x == "__HIVE_DEFAULT_PARTITION__" else whole(x) for x in texts]

    def _files_of(self, table: str, partitions: Sequence) -> DataFrame:
        """One row per file of the partitions: a listing, without a look at the rows."""
        paths = [self._partition_path(table, v) for v in partitions]
        paths = [p for p in paths if (lambda fs, q: fs.exists(q))(*self._fs(p))]
        if not paths:
            return self.spark.createDataFrame([], "file STRING")
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
        return listed.select(F.col("_metadata.file_path").alias("file"))

    def _read_files(self, table: str, files: list[str]) -> DataFrame:
        jvm = self.spark._jvm
        paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in files]
        schema = self.read(table).schema
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def _replace_files(self, kept: DataFrame, table: str, files: list[str]) -> None:
        self._laid_out(kept, table).write.mode("append").partitionBy(self.column).parquet(self.path(table))
        jvm = self.spark._jvm
        for file in files:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)

    def _partition_path(self, table: str, value) -> str:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        return f"{self.path(table)}/{self.column}={name}"

    def _drop_partition(self, table: str, value) -> None:
        self._remove(self._partition_path(table, value))

    def compact(self, table: str, partitions: Sequence | None = None) -> None:
        """Rewrite time partitions (all by default) with only the latest versions found there."""
        if not self.exists(table):
            return
        wanted = self._partitions(table) if partitions is None else list(partitions)
        for value in wanted:  # the versions of a row may be in any file of its partition
            files = [r.file for r in self._files_of(table, [value]).collect()]
            if files:
                kept = latest_wins(self._read_files(table, files), self._key(table))
                self._replace_files(kept, table, files)

    # -- retention ------------------------------------------------------------------------
    def expire(self, table: str, as_of: datetime, keep_days: int) -> None:
        """Drop whole partitions past the retention and rewrite only the one at its edge (of state:
        leave it as it is)."""
        if not self.exists(table):
            return
        stamp = self._stamp(table)
        cutoff = as_of - timedelta(days=keep_days)
        edge = int(cutoff.strftime("%Y%m%d")) if self.unit == "day" else cutoff.date().replace(day=1)
        for value in self._partitions(table):
            if value is not None and value < edge:
                self._drop_partition(table, value)
        if table == STATE_TABLE:
            return  # events are counted, so no reader may see one twice: they go by whole partitions
        located = self._files_of(table, [edge])
        for files in self._file_lists(located, located.count()):
            kept = unexpired(self._read_files(table, files), stamp, as_of, keep_days)
            self._replace_files(kept, table, files)

    def expire_live(self, as_of: datetime) -> None:
        """Retention of the live tier; state outlives the data it describes."""
        for table in TABLES:
            self.expire(table, as_of, LIVE_DATA_DAYS)
        self.expire(STATE_TABLE, as_of, LIVE_STATE_DAYS)


def unexpired(df: DataFrame, stamp: str, as_of, keep_days: int) -> DataFrame:
    """Rows whose time plus the retention is still ahead of `as_of`."""
    return df.filter(
        F.col(stamp) + F.make_dt_interval(days=F.lit(keep_days)) > timestamp_at(as_of)
    )
