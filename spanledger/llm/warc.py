"""WARC archives: records written as text files by Spark, and read back by verified chains of record boundaries.

Writing: one record per page, in as many files as the frame has partitions, without compression so that large files can be
split. Equal payloads of at least revisit_bytes are stored once: the record with the largest page_id is a response, the others
are revisits of it, with the HTTP header (and so the length) and the digest of the payload. Only digests are shuffled to find
equal payloads; those that are there twice or more are broadcast if they are few, else the pages are shuffled by digest too.

Reading: files are cut at every version line, also inside payloads, by as many tasks as there are splits. Every cut is a
candidate record; its header names its successor's offset. Inside a split the successors are followed to where they leave it;
across splits pointer jumping from each file's start (log2 of the splits per file rounds, on one row per split entry) tells
which entries are reachable, and the chains from these are the records. Candidates off the chains are payload.
A record whose payload holds version lines is put together from its pieces.

A very long record is one row and one task's work. Columns beside page_id, url and html are not read. A null html is an empty payload, a null url an empty target, a null page_id an id of its own that is smaller than all
others. Repeated pages get a record each; if they hold the largest page_id of their payload, all of them are responses. An empty
table gives no records. A file that doesn't start with a record, or a chain that breaks, gives the records before the break.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanledger.llm.common import written
from spanledger.session import work_folder

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
REVISIT_BYTES = 1000
BROADCAST_ROWS = 200_000  # payloads with copies, at about 150 bytes each; with more of them the pages are shuffled
DATE = "2024-01-01T00:00:00Z"
_CHUNKS = (
    "file string, block bigint, rel bigint, size bigint, total bigint, header int, record_type string, record_id string, "
    "refers_to string, digest string, http_bytes bigint, own_bytes bigint, own_digest string, data binary"
)


# ------------------------------------------------------------------ writing

def with_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, url, payload (string), payload_bytes, digest, and refers_to (null for responses) with is_revisit.

    Payloads with copies are counted here; up to broadcast_rows of them are broadcast, so that no payload moves.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    key = rows.select("page_id", "payload_bytes", "digest").filter(F.col("payload_bytes") >= revisit_bytes)
    last = key.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1")
    last = written(last, "copies")
    last = F.broadcast(last) if last.count() <= broadcast_rows else last.hint("merge")
    revisit = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(last, ["digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "digest", revisit.alias("is_revisit"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def record(rows: DataFrame) -> DataFrame:
    """Each record as text, without the blank lines that end it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"),
    )
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = F.when(F.col("is_revisit"), http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(F.col("is_revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")), line("WARC-Target-URI", target), line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            F.col("is_revisit"),
            F.concat(
                line("WARC-Refers-To", urn("refers_to")),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
    )
    return rows.select(F.concat(head, line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body).alias("value"))


def write(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    record(with_revisits(pages, revisit_bytes)).write.option("lineSep", END.decode()).text(path)


# ------------------------------------------------------------------ reading

def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for x in head.split(b"\r\n"):
        name, colon, value = x.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


def payload_of(block: bytes) -> tuple[bytes, int | None]:
    """Payload of an HTTP response, and the length that its header names."""
    head, blank, payload = block.partition(END)
    if not blank or not head.startswith(b"HTTP/"):
        return block, None
    named = _fields(head).get("content-length", "")
    return payload, int(named) if named.isdigit() else None


def _number(text: str) -> int | None:
    return int(text) if text.isdigit() and len(text) < 19 else None


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _CHUNKS: what stands between two version lines, where in its split, and the record that may begin there.

    total: bytes from the version line to the successor's; null if this is no record header. own_*: of payloads that end
    where the piece ends, as they do unless they hold version lines.
    """
    at = (None, None)
    rel = 0
    for batch in batches:
        files, blocks, values = (batch.column(i).to_pylist() for i in range(3))
        out: list[tuple] = []
        for file, block, value in zip(files, blocks, values):
            if (file, block) != at:
                at, rel = (file, block), 0
            cut = value.find(END)
            fields = _fields(value[:cut]) if cut >= 0 else {}
            length = _number(fields.get("content-length", ""))
            total = header = own = own_digest = http = None
            if length is not None and "warc-type" in fields:
                header = cut + len(END)
                total = len(MAGIC) + header + length + len(END)
                payload, http = payload_of(value[header : header + length])
                if len(value) == header + length + len(END):
                    own, own_digest = len(payload), hashlib.sha1(payload).hexdigest()
            out.append((
                file, block, rel, len(value), total, header, fields.get("warc-type"), fields.get("warc-record-id"),
                fields.get("warc-refers-to"), fields.get("warc-payload-digest"), http, own, own_digest, value,
            ))
            rel += len(value) + len(MAGIC)
        kinds = (
            pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 4, pa.int64(),
            pa.int64(), pa.string(), pa.binary(),
        )
        if out:
            names = [x.split()[0] for x in _CHUNKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _follow(group: pd.DataFrame) -> pd.DataFrame:
    """Where the successors of each candidate leave the split."""
    group = group.sort_values("off")
    off, nxt = group["off"].to_numpy(), group["next"].to_numpy()
    known = dict(zip(off.tolist(), range(len(off))))
    exits = nxt.copy()
    for i in range(len(off) - 1, -1, -1):
        j = known.get(int(nxt[i]))
        if j is not None:
            exits[i] = exits[j]
    return group[["file", "block", "off", "next"]].assign(exit=exits)


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """The candidates on the chain from the split's entry."""
    nxt = dict(zip(group["off"].tolist(), group["next"].tolist()))
    at, kept = int(group["entry"].iloc[0]), set()
    while at in nxt:
        kept.add(at)
        at = int(nxt[at])
    return group[group["off"].isin(kept)][["file", "block", "off", "next"]]


def boundaries(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, block, off, next) of the records, and (file, block, base): where in the file a split's first piece starts."""
    sizes = chunks.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(sizes.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")), "bases")
    found = chunks.filter(F.col("total").isNotNull()).select("file", "block", "rel", "total").join(bases, ["file", "block"])
    off = F.col("base") + F.col("rel") - len(MAGIC)
    candidates = found.select("file", "block", off.alias("off"), (off + F.col("total")).alias("next")).filter("off >= 0")
    exits = "file string, block bigint, off bigint, next bigint, exit bigint"
    followed = written(candidates.groupBy("file", "block").applyInPandas(_follow, exits), "exits")

    starts = followed.filter("off = 0").select("file", "off")
    entries = followed.select("file", F.col("exit").alias("off")).distinct()
    jump = followed.select("file", "off", "exit").join(entries.unionByName(starts), ["file", "off"], "left_semi")
    jump, reached = written(jump, "jump"), written(starts, "reached")
    while True:  # reached: entries less than 2^k jumps from the start; jump: 2^k jumps at once
        ahead = reached.join(jump, ["file", "off"]).select("file", F.col("exit").alias("off"))
        further = ahead.join(followed.select("file", "off"), ["file", "off"], "left_semi")
        reached = written(reached.unionByName(further), "reached")
        second = jump.select("file", F.col("off").alias("exit"), F.col("exit").alias("to"))
        jump = written(jump.join(second, ["file", "exit"]).select("file", "off", F.col("to").alias("exit")), "jump")
        if jump.isEmpty():
            break
    owners = reached.distinct().join(followed.select("file", "off", "block"), ["file", "off"])
    entry = owners.groupBy("file", "block").agg(F.min("off").alias("entry"))
    kept = followed.select("file", "block", "off", "next").join(entry, ["file", "block"])
    return written(kept.groupBy("file", "block").applyInPandas(_chain, "file string, block bigint, off bigint, next bigint"), "chain"), bases


def _assemble(group: pd.DataFrame) -> pd.DataFrame:
    """The payload of one record whose pieces are the rows."""
    group = group.drop_duplicates("at").sort_values("at")
    first = group.iloc[0]
    whole = MAGIC.join(bytes(x) for x in group["data"])[: int(first["next"] - first["off"]) - len(MAGIC)]
    payload, _ = payload_of(whole[int(group["header"].iloc[0]) : -len(END)])
    return pd.DataFrame({
        "file": [first["file"]], "off": [first["off"]], "payload": [payload], "n": [len(payload)],
        "sha1": [hashlib.sha1(payload).hexdigest()],
    })


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, off, record_type, record_id, refers_to, digest (as the header has them), payload_bytes, payload_digest, payload.

    payload_bytes and payload_digest are of the full payload: measured on responses, on revisits as their headers name them. The
    payload of a revisit is null.
    """
    raw = spark.read.option("lineSep", MAGIC.decode()).text(path)
    raw = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    chunks = written(raw.mapInArrow(_chunks, _CHUNKS), "chunks", "zstd")  # as large as the archives
    chain, bases = boundaries(chunks)
    placed = chunks.join(bases, ["file", "block"]).withColumn("at", F.col("base") + F.col("rel") - len(MAGIC)).drop("base")
    records = placed.join(chain.select("file", F.col("off").alias("at"), "next"), ["file", "at"]).withColumnRenamed("at", "off")

    revisit = F.col("record_type") == "revisit"
    broken = written(records.filter(F.col("own_digest").isNull()).select("file", "block", "off", "next"), "broken")
    ends = Window.partitionBy("file").orderBy("base")
    spans = bases.select("file", "block", "base", F.lead("base", 1, 1 << 62).over(ends).alias("stop"))
    covered = broken.drop("block").join(spans, "file").filter((F.col("base") <= F.col("next")) & (F.col("stop") >= F.col("off")))
    covered = written(covered.select("file", "block", "off", "next"), "covered")  # known to be small, where it is
    pieces = (
        covered.join(placed.select("file", "block", "at", "header", "data"), ["file", "block"])
        .filter((F.col("at") >= F.col("off")) & (F.col("at") < F.col("next")))
    )
    joined = pieces.groupBy("file", "off").applyInPandas(
        _assemble, "file string, off bigint, payload binary, n bigint, sha1 string"
    )
    own = F.substring("data", F.col("header") + 1, F.col("size")).cast("binary")
    rows = records.join(joined, ["file", "off"], "left")
    return rows.select(
        "file", "off", "record_type", "record_id", "refers_to", "digest",
        F.when(revisit, F.col("http_bytes")).otherwise(F.coalesce("own_bytes", "n")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(F.coalesce("own_digest", "sha1")).alias("payload_digest"),
        F.when(~revisit, F.coalesce(F.col("payload"), _http_payload(own))).alias("payload"),
    )


def _http_payload(data):
    """Payload of a block as binary: after the HTTP header, without the blank lines that end the record."""
    text = F.decode(data, "ISO-8859-1")
    start = F.instr(text, "\r\n\r\n")
    return F.encode(F.substr(text, start + 4, F.length(text) - start - 7), "ISO-8859-1")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages into a new folder and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = work_folder(spark, "warc")
    write(pages, path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1) AS BIGINT)")
    return read(spark, path).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
