"""Language-model scores by stupid backoff, from n-gram counts of all documents.

Words are those of the decontamination: [0-9a-z and all beyond ASCII]+ after lower-casing A-Z. The count of an n-gram is that in
all documents together, for n up to ORDER. A word's score is count(n-gram) / count(its first n - 1 words) for the longest
n-gram of at least MIN_COUNT occurrences that ends in it, times BACKOFF for each shorter step taken; in the end it is the share
of the word among all words. A document's score is the sum of the logarithms.

The tables are relations of blocks: documents are dealt over batches by hash; each batch sends its distinct n-gram
hashes with their counts, sorted, one row per hash range (bucket); a bucket adds up what all batches sent, which is its part of
the count table, and answers each batch with the corpus counts of what it asked for; the batch joins them to the
n-grams of its documents and sums per document. A frequent n-gram is one entry per batch, so no key is hot. Repeats of one row
(same doc_id and text), which all go to one batch, are one document with a number of copies before they are shuffled and
again inside the batch; the result has a row for each. N-grams are compared by 64-bit hashes.

A very long text is one task's work. Null and empty texts, and texts without words, have no score (n_words 0, log_score 0, mean_log null). Repeated documents are
counted and scored each. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import Words, fold, in_batches, partitions_for, text_blocks, text_column, written

ORDER = 3
MIN_COUNT = 2
BACKOFF = 0.4
BATCH_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
REPEAT_ROWS = 10_000


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second, and so on, packed: what differs little gets small."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = zstandard.ZstdDecompressor().decompress(planes)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _pack_counts(counts: np.ndarray) -> bytes:
    small = len(counts) == 0 or int(counts.max()) < 1 << 32
    return (b"4" if small else b"8") + _planes(counts.astype(np.uint32 if small else np.uint64))


def _unpack_counts(raw: bytes) -> np.ndarray:
    return _numbers(raw[1:], np.uint32 if raw[:1] == b"4" else np.uint64).astype(np.int64)


def _pack_sorted(hashes: np.ndarray) -> bytes:
    return _planes(np.diff(hashes, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_numbers(raw, np.uint64), dtype=np.uint64)


class Grams:
    """N-grams of a batch of texts. words: per text; hash[n - 1]: of the n-gram that ends in each word (0 where there is none)."""

    def __init__(self, texts: pa.Array, order: int) -> None:
        self.words, parts = [], [[] for _ in range(order)]
        for _, offsets, data in text_blocks(texts):
            words = Words(offsets, data)
            self.words.append(np.diff(words.first))
            within = np.arange(len(words.start)) - np.repeat(words.first[:-1], np.diff(words.first))  # place in the text
            for n in range(1, order + 1):
                m = max(0, len(words.hash) - n + 1)
                full = np.zeros(len(words.hash), np.uint64)
                full[n - 1 :] = fold([words.hash[j : m + j] for j in range(n)]) | np.uint64(1)  # 0 is for none
                full[within < n - 1] = 0
                parts[n - 1].append(full)
        self.words = np.concatenate(self.words) if self.words else np.zeros(0, np.int64)
        self.hash = [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]

    def distinct(self, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes of all n-grams, their counts with so many copies of each text, and for each n-gram of all
        orders its place among them (the n-grams that are none have place -1)."""
        every = np.concatenate(self.hash)
        order = np.argsort(every)
        ordered = every[order]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        none = int(len(ordered) > 0 and ordered[0] == 0)
        place = np.empty(len(every), np.int64)
        place[order] = np.cumsum(new) - 1 - none
        first = np.flatnonzero(new)
        if (copies > 1).any():
            times = np.tile(np.repeat(copies, self.words), len(self.hash))[order]
            counts = np.add.reduceat(times, first) if len(first) else times
        else:
            counts = np.diff(np.append(first, len(ordered)))
        return ordered[first][none:], counts[none:], place


def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of hashes begins, and the end. buckets: a power of two."""
    bits = buckets.bit_length() - 1
    borders = np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, borders), [len(hashes)]))


def score(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF,
    batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_backed (words not scored by their longest n-gram), log_score and mean_log of every document."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    batches = partitions_for(total, batch_bytes)
    buckets = 1 << (partitions_for(total, bucket_bytes) - 1).bit_length()
    dealt = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch"))
    dealt = in_batches(dealt, _deal, "batch bigint, part binary", most=64 << 20)  # the larger, the better packed

    def ask(group: pa.Table) -> pa.Table:
        _, texts, copies = _documents(group)
        hashes, counts, _ = Grams(texts, order).distinct(copies)
        cuts = _cuts(hashes, buckets).tolist()
        used = [(b, x, y) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        return pa.table({
            "bucket": pa.array([b for b, _, _ in used], pa.int64()),
            "batch": pa.array([group.column("batch")[0].as_py()] * len(used), pa.int64()),
            "hashes": pa.array([_pack_sorted(hashes[x:y]) for _, x, y in used], pa.binary()),
            "counts": pa.array([_pack_counts(counts[x:y]) for _, x, y in used], pa.binary()),
        })

    def add(group: pa.Table) -> pa.Table:
        asked = [_unpack_sorted(x) for x in group.column("hashes").to_pylist()]
        counts = np.concatenate([_unpack_counts(x) for x in group.column("counts").to_pylist()])
        every = np.concatenate(asked)
        by = np.argsort(every)
        ordered = every[by]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        sums = np.add.reduceat(counts[by], first)
        answer = np.empty(len(every), np.int64)
        answer[by] = np.repeat(sums, np.diff(np.append(first, len(ordered))))
        stops = np.cumsum([0, *map(len, asked)]).tolist()
        return pa.table({
            "batch": group.column("batch"), "bucket": group.column("bucket"),
            "counts": pa.array([_pack_counts(answer[x:y]) for x, y in zip(stops, stops[1:])], pa.binary()),
        })

    def judge(group: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts, copies = _documents(group)
        grams = Grams(texts, order)
        _, _, place = grams.distinct(copies)
        parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist()))
        known = np.concatenate([np.zeros(0, np.int64), *(_unpack_counts(x) for _, x in parts), [0]])  # place -1 is 0
        n_words = len(grams.hash[0])
        counts = known[place].reshape(order, n_words)
        logs = np.log(np.maximum(counts[0], 1).astype(float))  # less the logarithm of all words, in the end
        level = np.ones(n_words, np.int64)
        for n in range(2, order + 1):
            enough = counts[n - 1] >= min_count
            before = np.maximum(np.concatenate(([0], counts[n - 2][:-1])), 1)  # the first n - 1 words end one word earlier
            logs = np.where(enough, np.log(np.maximum(counts[n - 1], 1) / before), logs)
            level = np.where(enough, n, level)
        reach = sum((h != 0).astype(np.int64) for h in grams.hash)  # the longest n-gram that could be
        logs = logs + (reach - level) * np.log(backoff)
        ends = np.cumsum(grams.words)
        per = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))])
        sums = [float(logs[a:b].sum()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return pa.table({
            "doc_id": ids, "copies": pa.array(copies, pa.int64()), "n_words": pa.array(grams.words, pa.int64()),
            "n_backed": pa.array(per(level < reach), pa.int64()), "n_alone": pa.array(per(level == 1), pa.int64()),
            "log_score": pa.array(sums, pa.float64()),
        })

    asked = dealt.groupBy("batch").applyInArrow(ask, "bucket bigint, batch bigint, hashes binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(add, "batch bigint, bucket bigint, counts binary")
    judged = dealt.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(
        judge, f"doc_id {kind}, copies bigint, n_words bigint, n_backed bigint, n_alone bigint, log_score double"
    )
    judged = written(judged, "lm-scores")
    words = judged.agg(F.sum(F.col("n_words") * F.col("copies"))).first()[0] or 1
    log_score = F.col("log_score") - F.col("n_alone") * float(np.log(words))
    scored = judged.select("doc_id", "n_words", "n_backed", log_score.alias("log_score"), "copies")
    scored = _repeated(scored, "copies")
    return scored.withColumn("mean_log", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def _repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column copies says, in runs so that no array is long."""
    run = F.lit(REPEAT_ROWS)
    df = df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / run))).alias("_run"))
    left = F.least(run, F.col(copies) - F.col("_run") * run).cast("int")
    return df.select("*", F.explode(F.array_repeat(F.lit(0), left)).alias("_copy")).drop(copies, "_run", "_copy")


def _distinct(ids: pa.ChunkedArray | pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first places of the distinct rows, and for each row the place of its own among these."""
    seen: dict[tuple, int] = {}
    own = np.empty(len(texts), np.int64)
    first = []
    for k, (i, t) in enumerate(zip(ids, texts)):
        own[k] = at = seen.setdefault((repr(i.as_py()), t.as_py()), len(first))
        if at == len(first):
            first.append(k)
    return np.array(first, np.int64), own


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one batch together in one packed row, which is smaller than row by row; repeats once, with their number."""
    for rows in batches:
        batch = rows.column(2).to_numpy()
        order = np.argsort(batch, kind="stable")
        cuts = np.flatnonzero(np.diff(batch[order], prepend=-1, append=-1)).tolist()
        parts = []
        for a, b in zip(cuts, cuts[1:]):
            docs = rows.select(["doc_id", "text"]).take(pa.array(order[a:b]))
            first, own = _distinct(docs.column(0), text_column(docs, "text"))
            docs = docs.take(pa.array(first)).append_column("copies", pa.array(np.bincount(own), pa.int64()))
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
            with pa.ipc.new_stream(sink, docs.schema, options=options) as stream:
                stream.write_batch(docs)
            parts.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch[order][cuts[:-1]], pa.int64()), pa.array(parts, pa.binary())], names=["batch", "part"]
        )


def _documents(group: pa.Table) -> tuple[pa.ChunkedArray, pa.Array, np.ndarray]:
    """doc_id, text and copies of all distinct documents of a group of packed rows. Texts may be over 2 GB together."""
    known: dict[tuple, int] = {}
    copies, ids, texts = [], [], []
    for raw in group.column("part"):  # one by one, so that repeats in many parts are in memory once
        for docs in pa.ipc.open_stream(raw.as_buffer()):
            column, new = text_column(docs, "text"), []
            for k, (i, t, n) in enumerate(zip(docs.column(0), column, docs.column(2).to_pylist())):
                at = known.setdefault((repr(i.as_py()), t.as_py()), len(copies))
                if at == len(copies):
                    copies.append(n)
                    new.append(k)
                else:
                    copies[at] += n
            new = pa.array(new, pa.int64())
            ids.append(docs.column(0).take(new))
            texts.append(column.take(new))
    return pa.chunked_array(ids), pa.concat_arrays(texts), np.array(copies, np.int64)
