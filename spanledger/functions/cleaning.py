"""Cleaning of extracted rows: unwanted columns, NaN, blank text, binary to hex."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.schemas import TABLES, UNWANTED_BLOCK_COLUMNS

# Nothing but white space, in Unicode's sense and with the four ASCII separators.
BLANK = r"(?U)^[\s\x1c-\x1f]*+$"


def clean(df: DataFrame, table: str | None = None) -> DataFrame:
    """One projection: NaN and blank text become NULL, binary becomes lower-case hex.

    The rule per column follows its declared type, so no row has to be looked at first.
    An incoming insert_version is dropped; the sink assigns it.
    """
    unwanted = {"insert_version"}
    if table == "blocks":
        unwanted.update(UNWANTED_BLOCK_COLUMNS)
    out = []
    for field in df.schema.fields:
        if field.name in unwanted:
            continue
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(field.dataType, T.BinaryType):
            c = F.when(F.length(c) > 0, F.lower(F.hex(c)))
        elif isinstance(field.dataType, T.StringType):
            c = F.when(~c.rlike(BLANK), c)
        out.append(c.alias(field.name))
    return df.select(*out)


def conform_checked(df: DataFrame, table: str, keep: Sequence[str] = (), error: str = "error") -> DataFrame:
    """As `conform`, with a column that names the first value of the row that doesn't fit its
    type (NULL: all fit), where `conform` would stop the job."""
    have = set(df.columns)
    columns, wrong = [], []
    for f in TABLES[table].schema.fields:
        raw = F.col(f.name) if f.name in have else F.lit(None)
        fitted = raw.try_cast(f.dataType)
        columns.append(fitted.alias(f.name))
        if f.name in have and df.schema[f.name].dataType != f.dataType:
            message = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), raw.cast("string"))
            wrong.append(F.when(raw.isNotNull() & fitted.isNull(), message))
    found = F.coalesce(*wrong) if wrong else F.lit(None).cast("string")
    return df.select(*columns, *keep, found.alias(error))


def conform(df: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns in declared order and type; missing ones NULL, others dropped unless
    named in `keep`."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].schema.fields
        ],
        *keep,
    )
