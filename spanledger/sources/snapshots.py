"""Snapshots of the state table: folded rows plus the events of files that came later.

Layout below <root>/_state_snapshot/: rows/v=<version>/settled=<0 or 1>/, heads/v=<version>/ and files/v=<version>/. Files lists the
state files that were folded and is written last: a version without it does not count, so a crash between the writes leaves
the version before in force. State files are only ever added, or dropped with their partition by the retention; a snapshot that
knows a file that is gone is no longer used.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.operators import fold
from spanledger.schemas import COMPLETED, STATE_KEY, STATE_SCHEMA, STATE_TABLE
from spanledger.sources.extracts import slice_range
from spanledger.sources.tables import TableStore

FOLDER = "_state_snapshot"
PARTS = ("rows", "heads", "files")
KEPT = 2  # versions that stay for readers that have begun


class StateView:
    """The state of a store as a snapshot and what came after it. Every call looks for new files."""

    def __init__(self, store: TableStore):
        self.store = store
        self.spark = store.spark

    # -- versions -------------------------------------------------------------------------
    def _path(self, part: str, version: int | None = None) -> str:
        return self.store.path(f"{FOLDER}/{part}") + ("" if version is None else f"/v={version}")

    def versions(self) -> list[int]:
        """Committed versions, the newest first."""
        fs, p = self.store._fs(self._path("files"))
        if not fs.exists(p):
            return []
        jvm = self.spark._jvm
        done = [s.getPath() for s in fs.listStatus(p) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted((int(x.getName().partition("=")[2]) for x in done), reverse=True)

    def _read(self, part: str, version: int) -> DataFrame:
        return self.spark.read.parquet(self._path(part, version))

    def _state_files(self) -> DataFrame:
        listed = self.spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
        if not self.store.exists(STATE_TABLE):
            return self.spark.createDataFrame([], "path STRING")
        return listed.load(self.store.path(STATE_TABLE)).select("path")

    def _now(self) -> tuple[int | None, list[str]]:
        """The version in force and the state files that came after it.

        The names of new files pass through the driver, as those of any table that Spark reads.
        """
        files = self._state_files()
        for version in self.versions()[:1]:
            folded = self._read("files", version)
            sides = files.withColumn("here", F.lit(True)).join(folded.withColumn("there", F.lit(True)), "path", "full")
            changed = sides.filter(F.col("here").isNull() | F.col("there").isNull())
            found = changed.select("path", F.col("here").isNotNull().alias("new")).collect()
            if all(r["new"] for r in found):
                return version, sorted(r["path"] for r in found)
        return None, sorted(r["path"] for r in files.collect())

    # -- reading --------------------------------------------------------------------------
    def _events(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(*files)

    def _folded(self, version: int | None, files: Sequence[str]) -> DataFrame:
        late = fold.fold(self._events(files))
        return late if version is None else fold.merge(self._read("rows", version).drop("settled").unionByName(late))

    def folded(self) -> DataFrame:
        """One folded row per range, over all events."""
        return self._folded(*self._now())

    def latest(self) -> DataFrame:
        return fold.latest_of(self.folded())

    def history(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """`history_of` the ranges that start in [start, end); the bounds reach the scans."""
        version, files = self._now()
        late = self._events(files)
        if start is not None:
            late = slice_range(late, start, end, "start_block")
        late = fold.fold(late)
        if version is None:
            return fold.history_of(late)
        rows = self._read("rows", version).drop("settled")
        if start is not None:
            rows = slice_range(rows, start, end, "start_block")
        return fold.history_of(fold.merge(rows.unionByName(late)))

    def unsettled(self) -> DataFrame:
        """Latest rows of all ranges whose last event is not completed.

        Of the snapshot only its unsettled ranges are read, and those that have later events.
        """
        version, files = self._now()
        late = fold.fold(self._events(files))
        if version is not None:
            rows = self._read("rows", version)
            open_rows = rows.filter("settled = 0")
            touched = rows.filter("settled = 1").join(late.select(*STATE_KEY), list(STATE_KEY), "left_semi")
            late = fold.merge(open_rows.unionByName(touched).drop("settled").unionByName(late))
        return fold.latest_of(late).filter(F.col("status") != COMPLETED)

    def last_synced(self, datasets: Sequence[str]) -> int:
        """As `coverage.last_synced`, from one row per dataset and the later events."""
        version, files = self._now()
        heads = _heads(self._events(files).filter(F.col("status") == COMPLETED))
        if version is not None:
            heads = heads.unionByName(self._read("heads", version))
        ends = heads.filter(F.col("dataset").isin(list(datasets))).groupBy("dataset").agg(F.max("last_block").alias("b"))
        return ends.agg(F.coalesce(F.min("b"), F.lit(0))).first()[0]

    # -- writing --------------------------------------------------------------------------
    def take(self, version: int | None = None) -> int | None:
        """Folds the later events into a new version; None when there are none."""
        base, files = self._now()
        if not files:
            return None
        version = time.time_ns() if version is None else version
        rows = self._folded(base, files).withColumn("settled", (F.col("last.status") == COMPLETED).cast("int"))
        rows.repartitionByRange("settled", "dataset", "start_block").sortWithinPartitions("settled", "dataset", "start_block").write.mode(
            "overwrite"
        ).partitionBy("settled").parquet(self._path("rows", version))
        written = self._read("rows", version)
        _heads(written.filter(F.col(f"n_{COMPLETED}") > 0)).write.mode("overwrite").parquet(self._path("heads", version))
        known = self.spark.createDataFrame([(f,) for f in files], "path STRING")
        if base is not None:
            known = known.unionByName(self._read("files", base))
        known.write.mode("overwrite").parquet(self._path("files", version))
        for old in self.versions()[KEPT:]:
            for part in reversed(PARTS):  # no longer committed first
                self.store._remove(self._path(part, old))
        return version

    def take_if(self, files: int) -> int | None:
        """A new version once so many files came after the last one."""
        return self.take() if len(self._now()[1]) >= files else None


def _heads(completed: DataFrame) -> DataFrame:
    return completed.groupBy("dataset").agg(F.max("end_block").alias("last_block"))
