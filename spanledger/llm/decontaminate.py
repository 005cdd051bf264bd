"""Benchmark decontamination: a broadcast set of benchmark n-grams, looked up by every document window.

Words are [0-9a-z and all beyond ASCII]+ after lower-casing A-Z. A benchmark window is n consecutive words of an
item; an item of fewer words, but not none, is one window. Documents are scanned where they lie, without a shuffle:
window hashes are looked up in the set and each find is verified word by word.

The set is broadcast in blocks of at most block_grams windows, so its size is bounded; a larger benchmark takes
several passes, each written to the shared folder before the next, and every window is still looked up.

Very long texts are scanned whole, each by one task. Null and empty texts, and an empty table of documents, have no words and no hits. Repeated documents are each judged alone, item ids may repeat and may be
null (such items count, under the id "null"). An empty benchmark leaves all documents clean. Further columns pass through;
names of further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.llm.common import Words, fold, free_name, in_batches, partitions_for, text_blocks, text_column, written

WINDOW = 10
BLOCK_GRAMS = 200_000
REPORT = "doc_id {0}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


class GramSet:
    """Verified lookup of windows: size -> sorted hashes, and the texts and items behind each hash."""

    def __init__(self, grams: list[tuple[int, bytes, list[str]]]) -> None:
        self.sizes = {}
        for n in sorted({g[0] for g in grams}):
            own = [g for g in grams if g[0] == n]
            joined = b"\n".join(g[1] for g in own)
            words = Words(np.array([0, len(joined)]), np.frombuffer(joined, np.uint8)).hash.reshape(-1, n)
            hashes = fold([words[:, j] for j in range(n)])
            entries: dict[int, list] = {}
            for h, (_, text, items) in zip(hashes.tolist(), own):
                entries.setdefault(h, []).append((text, items))
            ordered = np.unique(hashes)
            mask = np.zeros(1 << 22, bool)
            mask[ordered >> np.uint64(42)] = True
            self.sizes[n] = ordered, mask, entries

    def finds(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each occurrence."""
        for n, (ordered, mask, entries) in self.sizes.items():
            at, hashes = words.grams(n)
            near = mask[hashes >> np.uint64(42)]
            at, hashes = at[near], hashes[near]
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
            for w in np.flatnonzero(ordered[place] == hashes):
                first = int(at[w])
                for text, items in entries[int(hashes[w])]:
                    if words.text(first, n) == text:
                        yield first, n, items


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: size, gram (words joined by blanks), item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, offsets, data in text_blocks(text_column(batch, "text")):
                words = Words(offsets, data, hashes=False)
                out: list[tuple[int, bytes, str]] = []
                for i in range(len(offsets) - 1):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    size = min(n, b - a)
                    out += {(size, words.text(w, size), str(ids[row + i])) for w in range(a, b - size + 1) if size}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.string()))]
                    if out else [pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.string())],
                    names=["size", "gram", "item"],
                )

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return items.mapInArrow(cut, "size int, gram binary, item string").distinct()


def _hit_pass(grams: list, schema: T.StructType, hits: str, items: str, text: str) -> Callable:
    """Adds the hit words (int32, packed) and the items of one block of windows to the two columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = GramSet(grams.value)
        for batch in batches:
            old_hits = batch.column(batch.schema.get_field_index(hits)).to_pylist()
            old_items = batch.column(batch.schema.get_field_index(items)).to_pylist()
            for row, offsets, data in text_blocks(text_column(batch, text)):
                words = Words(offsets, data)
                marks = np.zeros(len(words.start) + 1, np.int32)
                owners: dict[int, set[str]] = {}
                for first, n, own in found.finds(words):
                    marks[first] += 1
                    marks[first + n] -= 1
                    owners.setdefault(int(np.searchsorted(words.first, first, "right")) - 1, set()).update(own)
                hit = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                for i, own in owners.items():
                    a, b = words.first[i], words.first[i + 1]
                    mine = (hit[np.searchsorted(hit, a) : np.searchsorted(hit, b)] - a).astype(np.int32)
                    before = np.frombuffer(old_hits[row + i] or b"", np.int32)
                    old_hits[row + i] = np.union1d(before, mine).astype(np.int32).tobytes()
                    old_items[row + i] = sorted({*(old_items[row + i] or []), *own})
            columns = {hits: pa.array(old_hits, pa.binary()), items: pa.array(old_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [columns.get(f, batch.column(i)) for i, f in enumerate(batch.schema.names)], names=batch.schema.names
            )

    return run


def hit_words(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_grams: int = BLOCK_GRAMS
) -> tuple[DataFrame, str, str]:
    """The documents with two more columns, whose names are returned too: hit words, and items."""
    spark = docs.sparkSession
    hits = free_name(docs, "_hit_words")
    items = free_name(docs, "_hit_items")
    grams = windows(benchmark, n).groupBy("size", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
    grams = written(grams, "grams")
    blocks = partitions_for(grams.count(), block_grams)
    grams = grams.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
    out = docs.withColumn(hits, F.lit(None).cast("binary")).withColumn(items, F.lit(None).cast("array<string>"))
    for block in range(blocks):
        own = [(r[0], bytes(r[1]), r[2]) for r in grams.filter(F.col("block") == block).drop("block").collect()]
        if own:
            sent = spark.sparkContext.broadcast(own)
            out = in_batches(out, _hit_pass(sent, out.schema, hits, items, "text"), out.schema)
            if block + 1 < blocks:
                out = written(out, "hits")
                sent.unpersist()
    return out, hits, items


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, and whether any was found."""
    out, hits, items = hit_words(docs.select("doc_id", "text"), benchmark, n, block_grams)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.concatenate(
                [np.diff(Words(o, d, hashes=False).first) for _, o, d in text_blocks(text_column(batch, "text"))] or [[]]
            )
            hit = [len(x or b"") // 4 for x in batch.column(2).to_pylist()]
            found = [x or [] for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(words, pa.int64()), pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in found]),
                    pa.array([x > 0 for x in hit]),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return in_batches(out, count, REPORT.format(kind))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, whole: bool = False, block_grams: int = BLOCK_GRAMS
) -> DataFrame:
    """The documents without the spans of hit words, or (whole) without the documents that have any.

    A span goes from the first byte of a run of hit words to the last byte of that run. Texts without hits stay as
    they are, byte for byte.
    """
    out, hits, items = hit_words(docs, benchmark, n, block_grams)
    if whole:
        return out.filter(F.col(hits).isNull()).drop(hits, items)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            marked = batch.column(batch.schema.get_field_index(hits)).to_pylist()
            texts = None
            for i, hit in enumerate(marked):
                if not hit:
                    continue
                texts = texts or batch.column(place).to_pylist()
                raw = texts[i].encode()
                words = Words(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8), hashes=False)
                hit = np.frombuffer(hit, np.int32)
                breaks = np.flatnonzero(np.diff(hit) > 1)
                firsts, lasts = hit[np.r_[0, breaks + 1]], hit[np.r_[breaks, len(hit) - 1]]
                kept, at = [], 0
                for a, b in zip(words.start[firsts], words.end[lasts]):
                    kept.append(raw[at:a])
                    at = b
                texts[i] = b"".join([*kept, raw[at:]]).decode()
            columns = [batch.column(i) for i in range(batch.num_columns)]
            if texts:
                columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return in_batches(out, cut, out.schema).drop(hits, items)
