"""Line dedup by levelled sorted runs: lines that many documents share stay in one of them only.

Texts are split at \\n (null or empty: one empty line). A line's key is the line without blanks ([\\x20\\x09-\\x0D]) at both ends,
A-Z in lower case. A key of at least `least` code points that is in at least `holders` documents loses all its lines except those
of the largest doc_id that holds it. A document is a row, so rows repeated count each; all rows of the largest doc_id keep the line; null
is the smallest doc_id.

1. Every document gives its long keys' 128-bit digests with their places; one of the places of a key in a document is marked.
2. Documents are added in batches, the largest doc_ids first. Each batch is cut to one row per digest, with the number of holders
   and the largest doc_id. It is merge-anti-joined with the runs: what no run holds is new, and its doc_id is the keeper; of
   the rest only the number is added. The batch's rows are a new run, sorted by digest in buckets of digests, so that a run is
   never shuffled again. `fan` runs of one level are compacted into one run of the next level.
3. Runs' rows of one digest add up to its number of holders. Digests of at least `holders` meet the places of step 1; the
   places that go are put together per text and the text is joined again without them.

Batches are cut by quantiles of doc_id; one doc_id is never in two batches. A line that a third of all documents hold is one row per
task before it is shuffled, and its places are split by adaptive execution in the join. Very long texts are one row's work. An
empty table gives an empty result. Further columns pass through `dedup_lines`, whatever their names.
Runs are tables of a database of their own, dropped when the digests that are held often enough are written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm.common import free_name, let, partitions_for, table, written
from spanledger.session import work_folder

LEAST = 40  # code points of a key
HOLDERS = 5  # documents
BATCHES = 4
FAN = 2
RUN_ROWS = 2_000_000  # rows of a bucket of a run
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _SMALL))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(c.cast("binary")))


def text_key() -> Column:
    return _digest(F.coalesce(F.col("text"), F.lit("")))


def places(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """digest, doc_id, text_key, place (from 0) and first (one place of a key in a document) of all lines with a long key."""

    def keyed(line: Column, place: Column) -> Column:
        return F.struct(let(F.btrim(line, F.lit(_BLANKS)), lambda b: F.when(F.char_length(b) >= least, lower_ascii(b))).alias("key"), place.alias("place"))

    long = F.filter(F.transform(_lines(F.col("text")), keyed), lambda s: s["key"].isNotNull())
    marked = let(
        F.sort_array(long),
        lambda a: F.transform(
            a, lambda s, i: F.struct(s["key"].alias("key"), s["place"].alias("place"), (~F.get(a, i - 1)["key"].eqNullSafe(s["key"])).alias("first"))
        ),
    )
    # The digest of the text is taken before the explosion, else once per line.
    found = docs.filter(F.octet_length("text") >= least).select("doc_id", text_key().alias("text_key"), marked.alias("marked"))
    found = found.select("doc_id", "text_key", F.explode("marked").alias("s"))
    return found.select(_digest(F.col("s.key")).alias("digest"), "doc_id", "text_key", "s.place", "s.first")


# ------------------------------------------------------------------ runs

class Runs:
    """Sorted runs of line digests in levels. A row: digest, n (holders it adds), keeper, fresh (the digest was new then)."""

    def __init__(self, spark: SparkSession, buckets: int, fan: int = FAN) -> None:
        self.spark, self.buckets, self.fan = spark, buckets, fan
        self.levels: list[list[str]] = []
        self.name, self.made = f"line_runs_{uuid.uuid4().hex}", 0
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{work_folder(spark, self.name)}'")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}.run_{self.made}"
        rows.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> None:
        """A batch of digest, n and doc_id, one row per digest, none of them above the doc_ids of batches before."""
        batch = batch.repartition(self.buckets, "digest")
        fresh, known = batch, []
        for run in self.tables():
            held = run.filter("fresh").select("digest").hint("merge")
            known.append(batch.join(held, "digest", "left_semi"))
            fresh = fresh.join(held, "digest", "left_anti")
        rows = fresh.select("digest", "n", F.col("doc_id").alias("keeper"), F.lit(True).alias("fresh"))
        for again in known:  # a digest is new in one run only, so it is found once
            rows = rows.unionByName(again.select("digest", "n", F.lit(None).cast(rows.schema["keeper"].dataType).alias("keeper"), F.lit(False).alias("fresh")))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(rows.repartition(self.buckets, "digest")))
        self.compact()

    def compact(self) -> None:
        """Full levels become one run of the next level."""
        for depth, level in enumerate(self.levels):
            if len(level) >= self.fan:
                whole = self._write(merged([self.spark.table(name) for name in level]).repartition(self.buckets, "digest"))
                for name in level:
                    self.spark.sql(f"DROP TABLE {name}")
                self.levels[depth] = []
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(whole)
                return self.compact()


def merged(runs: list[DataFrame]) -> DataFrame:
    """One row per digest of several runs: their buckets are merge-joined as they lie.

    Not a union and an aggregate: Spark 4.1 takes a union of bucketed tables for bucketed, and aggregates it without a shuffle into several
    rows per digest.
    """

    def both(one: DataFrame, other: DataFrame) -> DataFrame:
        other = other.select("digest", F.col("n").alias("n2"), F.col("keeper").alias("keeper2"), F.col("fresh").alias("fresh2"))
        return one.join(other.hint("merge"), "digest", "full").select(
            "digest", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
            F.when(F.col("fresh"), F.col("keeper")).when(F.col("fresh2"), F.col("keeper2")).alias("keeper"),
            (F.coalesce("fresh", F.lit(False)) | F.coalesce("fresh2", F.lit(False))).alias("fresh"),
        )

    return reduce(both, runs)


# ------------------------------------------------------------------ documents

def _drops(docs: DataFrame, least: int, holders: int, batches: int, fan: int) -> DataFrame:
    """doc_id, text_key and places of the lines that go."""
    spark = docs.sparkSession
    shares = [1 - (j + 1) / batches for j in range(batches - 1)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    batch = sum((F.when(F.col("doc_id") > c, 0).otherwise(1) for c in sorted(set(cuts or []), reverse=True)), F.lit(0))
    path = work_folder(spark, "lines")
    lines = places(docs, least).withColumn("batch", batch)
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    buckets = partitions_for(lines.count(), RUN_ROWS, spark.sparkContext.defaultParallelism)
    runs = Runs(spark, buckets, fan)
    try:
        for number in range(len(set(cuts or [])) + 1):
            own = lines.filter((F.col("batch") == number) & F.col("first"))
            runs.add(own.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id")))
        often = written(merged(runs.tables()).filter(F.col("n") >= holders).select("digest", "keeper"), "often")
    finally:
        runs.drop()
    gone = lines.join(often, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))


def _with_kept(docs: DataFrame, least: int, holders: int, batches: int, fan: int) -> tuple[DataFrame, str, str, str]:
    """The documents with the lines that stay, how many lines there were, and how many go."""
    key, gone, kept, lines = (free_name(docs, n) for n in ("_text_key", "_gone", "_kept", "_lines"))
    drops = _drops(docs.select("doc_id", "text"), least, holders, batches, fan)
    drops = drops.select(F.col("doc_id").alias("_of"), F.col("text_key").alias("_key"), F.col("places").alias("_places"))
    own = docs.withColumn(key, text_key())
    found = own.alias("d").join(drops.alias("g"), F.col(f"d.{key}").eqNullSafe(F.col("g._key")) & F.col("d.doc_id").eqNullSafe(F.col("g._of")), "left")
    found = found.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.col("g._places").alias(gone))
    rest = let(
        _lines(F.col("text")),
        lambda a: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(a) - 1), F.col(gone)), lambda i: F.get(a, i)), "\n"
        ),
    )
    found = found.withColumn(kept, F.when(F.col(gone).isNull(), F.coalesce("text", F.lit(""))).otherwise(rest))
    return found.withColumn(lines, F.size(_lines(F.col("text")))), kept, lines, gone


def dedup_lines(docs: DataFrame, least: int = LEAST, holders: int = HOLDERS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """The documents without the lines that others keep; a text that loses none stays as it is, null too."""
    found, kept, _, gone = _with_kept(docs, least, holders, batches, fan)
    return found.select(*(F.when(F.col(gone).isNull(), F.col(c)).otherwise(F.col(kept)).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, least: int = LEAST, holders: int = HOLDERS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document."""
    found, kept, lines, gone = _with_kept(docs.select("doc_id", "text"), least, holders, batches, fan)
    return found.select(
        "doc_id", F.col(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias("n_dropped"), F.sha2(F.col(kept).cast("binary"), 256).alias("kept_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


_KEY = r"translate(regexp_replace(regexp_replace(line, '^[ \x09-\x0D]+', ''), '[ \x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, r, i, a[i] AS line, {_KEY.replace("line", "a[i]")} AS key FROM d, unnest(range(1, len(a) + 1)) AS t(i)),
often AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {LEAST} GROUP BY key HAVING count(DISTINCT r) >= {HOLDERS}
),
m AS (SELECT l.*, often.key IS NOT NULL AND l.doc_id IS DISTINCT FROM keeper AS gone FROM l LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
