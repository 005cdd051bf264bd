"""Reading extracted Parquet files: `network__dataset__range.parquet` below one folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.operators.running import at_marks
from spanledger.schemas import DATASETS, TABLES

# First and last block in a file name.
NAMED_RANGE = r"(\d+)_to_(\d+)(?:\.|_|$)"


def read_dataset(
    spark: SparkSession, folder: str, dataset: str, schema: T.StructType | None = None,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """All Parquet files below `folder` with the dataset's name in their file name.

    Without a schema the columns of all files are taken together, since a chain gains some in
    the course of time; a column of two types that don't go together is an error. With `ranges`
    only the files whose named range overlaps one of them are opened, and only their columns
    count; where none does, the result is empty and has the columns of one of the others.
    """
    if ranges is not None:
        files = list_files(spark, folder, dataset)
        wanted = [r["path"] for r in overlapping_files(files, ranges).select("path").collect()]
        some = wanted or [r["path"] for r in files.limit(1).collect()]
        if some:
            found = _reader(spark, schema).parquet(*sorted(some))
            return found if wanted else found.limit(0)
    reader = _reader(spark, schema).options(recursiveFileLookup="true", pathGlobFilter=f"*{dataset}*.parquet")
    return reader.parquet(folder)


def _reader(spark: SparkSession, schema: T.StructType | None):
    reader = spark.read.option("mergeSchema", "true")
    return reader if schema is None else reader.schema(schema)


def list_files(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """path, start_block and end_block (exclusive; both NULL without a range in the name) of a
    dataset's files. A listing: no file is opened."""
    listed = spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter=f"*{dataset}*.parquet"
    ).load(folder)
    name = F.regexp_extract(F.col("path"), r"[^/]*$", 0)
    ends = [F.regexp_extract(name, NAMED_RANGE, k).try_cast("bigint") for k in (1, 2)]
    ordered = ends[0] <= ends[1]
    return listed.select(
        "path", F.when(ordered, ends[0]).alias("start_block"), F.when(ordered, ends[1] + 1).alias("end_block")
    )


def overlapping_files(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """The files that share a block with any of the ranges, and those whose range is not known.

    A range that starts before the file's end and reaches beyond its start overlaps it: the furthest
    end of all ranges that start before, a running maximum, is compared with the start. No pair
    of a file and a range is formed.
    """
    known = files.filter(F.col("end_block").isNotNull())
    marks = known.select(F.col("end_block").alias("__at"), F.lit(1).alias("__mark"))
    starts = ranges.filter(F.col("end_block") > F.col("start_block")).select(
        F.col("start_block").alias("__at"), F.lit(0).alias("__mark"), F.col("end_block").alias("__end")
    )
    places = starts.unionByName(marks, allowMissingColumns=True).groupBy("__at").agg(
        F.max("__end").alias("__end"), F.max("__mark").alias("__mark")
    )
    reach = at_marks(places, [], "__at", {"__reach": ("__end", "max")}).select("__at", "__reach")
    hit = known.join(reach, known["end_block"] == reach["__at"]).filter(F.col("__reach") > F.col("start_block"))
    return hit.select(*files.columns).unionByName(files.filter(F.col("end_block").isNull()))


def dataset_of(file_name: Column, known: Sequence[str] = DATASETS) -> Column:
    """Dataset named in a file name: the middle part of a `__` form, else a known name that
    stands between separators (longest first), else "unknown"."""
    middle = F.regexp_extract(file_name, r"^.+?__(.+?)__[^/]*$", 1)
    names = "|".join(sorted(known, key=lambda n: (-len(n), n)))
    named = F.regexp_extract(file_name, rf"(?:^|_)({names})(?:_|\.|$)", 1)
    return F.when(middle != "", middle).when(named != "", named).otherwise("unknown")


def route_by_filename(df: DataFrame, known: Sequence[str] = DATASETS) -> DataFrame:
    """Rows of a file scan with the dataset they belong to."""
    return df.withColumn("dataset", dataset_of(F.col("_metadata.file_name"), known))


def slice_range(
    df: DataFrame, start: int, end: int, position: str = "block_number"
) -> DataFrame:
    """Rows of the half-open range; a plain filter, so it reaches the Parquet scan."""
    return df.filter((F.col(position) >= start) & (F.col(position) < end))


def project_dataset(df: DataFrame, datasets: str | Sequence[str]) -> DataFrame:
    """Only the extracted columns of a dataset that declares them; all columns otherwise,
    and also for several datasets that declare different ones."""
    names = [datasets] if isinstance(datasets, str) else list(datasets)
    declared = {TABLES[n].input_columns if TABLES[n].declared_input else None for n in names}
    if len(declared) != 1 or None in declared:
        return df
    have = set(df.columns)
    return df.select(*[c for c in declared.pop() if c in have])


def head_block(df: DataFrame, position: str = "block_number") -> DataFrame:
    """One row with the highest block number."""
    return df.agg(F.max(position).alias("head_block"))
