"""Words of presence, stored per load.

Layout below <root>/_presence/: words/version=<insert_version>/, one folder per load or delete, and folds/upto=<version>/ with the
folded words of all folders up to that version, and in folded_versions/upto=<version>/ which ones these were, written last. A fold
is used only if the folders up to its version are those it knows, so a load that comes late under an old version is not lost.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.operators import presence as P
from spanledger.operators.ranges import rows_in_ranges
from spanledger.sources.tables import TableStore

FOLDER = "_presence"
_FOLDED = "word BIGINT, covered BIGINT, present BIGINT, usable BIGINT"


class PresenceIndex:
    """Which blocks of a store are there and usable, without a look at its block rows.

    Versions order the events, as they do for readers of the tables: a later load decides the blocks it holds, and a
    delete clears what has no later version. Replaying a load overwrites its folder.
    """

    def __init__(self, store: TableStore):
        self.store = store
        self.spark = store.spark

    def _path(self, part: str, key: str = "", value: int | None = None) -> str:
        return self.store.path(f"{FOLDER}/{part}") + ("" if value is None else f"/{key}={value}")

    def _listed(self, part: str) -> list[int]:
        """Versions of finished folders, the oldest first."""
        fs, p = self.store._fs(self._path(part))
        if not fs.exists(p):
            return []
        jvm = self.spark._jvm
        done = [s.getPath() for s in fs.listStatus(p) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(x.getName().partition("=")[2]) for x in done)

    def versions(self) -> list[int]:
        return self._listed("words")

    # -- writing --------------------------------------------------------------------------
    def add(self, blocks: DataFrame, version: int, replaced: DataFrame | None = None) -> int:
        """Record the rows of a load (block_number, timestamp), all of one version; the ranges that it `replaced` are cleared first."""
        words = P.words_of(blocks, version)
        if replaced is not None:
            words = words.unionByName(P.gone_words(replaced, version))
        words.write.mode("overwrite").parquet(self._path("words", "version", version))
        return version

    def remove(self, ranges: DataFrame, version: int | None = None) -> int:
        """Record that the ranges were deleted; a version of its own, the clock by default."""
        version = time.time_ns() if version is None else version
        P.gone_words(ranges, version).write.mode("overwrite").parquet(self._path("words", "version", version))
        return version

    def fold(self) -> int | None:
        """Fold all folders there are; None when the newest fold holds them already."""
        versions = self.versions()
        base, rest = self._base(versions)
        if not rest:
            return None
        upto = versions[-1]
        self._folded(base, rest).repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(
            self._path("folds", "upto", upto)
        )
        known = self.spark.createDataFrame([(v,) for v in versions], "version BIGINT")
        known.write.mode("overwrite").parquet(self._path("folded_versions", "upto", upto))
        return upto

    # -- reading --------------------------------------------------------------------------
    def _base(self, versions: list[int]) -> tuple[int | None, list[int]]:
        """The newest fold that still holds, and the versions it doesn't know."""
        for upto in reversed(self._listed("folded_versions")):
            known = {r["version"] for r in self.spark.read.parquet(self._path("folded_versions", "upto", upto)).collect()}
            if known == {v for v in versions if v <= upto}:
                return upto, [v for v in versions if v > upto]
        return None, versions

    def events(self, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], P.WORD_ROW)
        return self.spark.read.schema(P.WORD_ROW).parquet(*[self._path("words", "version", v) for v in versions])

    def _folded(self, base: int | None, versions: list[int], near: DataFrame | None = None) -> DataFrame:
        events = self.events(versions)
        if base is not None:
            folded = self.spark.read.schema(_FOLDED).parquet(self._path("folds", "upto", base))
            events = events.unionByName(folded.withColumns({"insert_version": F.lit(base), "step": F.lit(P.LOADED)}))
        return P.fold_words(events if near is None else rows_in_ranges(events, near, "word"))

    def words(self) -> DataFrame:
        """Folded words of all loads and deletes."""
        return self._folded(*self._base(self.versions()))

    def gate(self, ranges: DataFrame, n_ranges: int | None = None) -> DataFrame:
        """`validate_timestamps` of the ranges."""
        return P.word_gate(self.words(), ranges, n_ranges)

    def islands(self, mask: str = "present") -> DataFrame:
        """`block_islands` of what is there, or with "usable" of what has a usable time."""
        return P.word_islands(self.words(), mask)

    def touched(self, ranges: DataFrame, since: int) -> DataFrame:
        """The ranges in which a load or delete after version `since` decided a block; only those folders are read."""
        changed = P.fold_words(self.events([v for v in self.versions() if v > since]))
        changes = P.word_gate(changed.select("word", F.col("covered").alias("present"), "usable"), ranges)
        return changes.filter("present > 0").select("start_block", "end_block")

    def recheck(self, known: DataFrame, since: int) -> DataFrame:
        """An earlier `gate`, taken when `since` was the newest version, brought up to date.

        Ranges that nothing touched keep their rows; of the stored words only those of touched ranges are folded.
        """
        again = self.touched(known, since)
        keys = ["start_block", "end_block"]
        return known.join(again, keys, "left_anti").unionByName(self._gate_near(again))

    def _gate_near(self, ranges: DataFrame) -> DataFrame:
        base, rest = self._base(self.versions())
        near = ranges.select(
            F.call_function("div", F.col("start_block"), F.lit(P.BITS)).alias("start_block"),
            (F.call_function("div", F.col("end_block"), F.lit(P.BITS)) + 1).alias("end_block"),
        )
        return P.word_gate(self._folded(base, rest, near), ranges)
