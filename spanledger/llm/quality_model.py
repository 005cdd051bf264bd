"""Quality classifier by compression: a text is like the dictionary that makes it smaller.

Two zstandard dictionaries hold labelled text, one good, one bad. A text is cut into pieces of PIECE bytes, each compressed
with either dictionary. The difference of the summed sizes is normalised twice, by the size of the text and by the compressed
size; with the compressed share itself (what neither dictionary explains) these are the features. A logistic curve over them,
fitted on labelled documents that are in neither dictionary, turns them into a probability.

Labelled documents come from a bounded sample: at most sample documents of each class (those with the smallest hash of
doc_id), of which half make the dictionary and half the curve. The texts that reach the driver, for the dictionaries, are pieces of
at most sample_bytes together, cut from a place in the whole text that its hash says. Dictionaries leave
out a piece's first OPENING bytes, which are often a line that many documents share. The curve and scoring read every text
whole, in the task that read it.

Null and empty texts have features of 0. Labels of unknown documents are ignored, as are null labels; a repeated label is
one. A document with labels of both classes is in both. However many rows it has, a document has one place in its class: in
the dictionary with one of its texts (that of the smallest hash), in the curve with the compressed sizes of all of them, summed in the tasks
that read them. Without labels of both classes every score is the share of good labels (0.5 without
any). An empty table gives an empty result. Further columns pass through `filter_quality` and are not read by `score`.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import free_name, in_batches, text_blocks, text_column

PIECE = 1024
SAMPLE = 800
SAMPLE_BYTES = 4 << 20
DICT_BYTES = 192 << 10
OPENING = 200
LEVEL = 3
THRESHOLD = 0.3


class Model(NamedTuple):
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the features, and the bias


def bucket(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; of a null id that of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.packers = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=_prepared(d), write_checksum=False, write_content_size=False, write_dict_id=False
            )
            for d in (model.good, model.bad)
        ] if model.good and model.bad else []

    def sizes(self, text: memoryview | bytes) -> tuple[int, int, int]:
        """Bytes of the text, and compressed with either dictionary."""
        good, bad = (p.compress for p in self.packers)
        with_good = with_bad = 0
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE]
            with_good += len(good(piece))
            with_bad += len(bad(piece))
        return len(text), with_good, with_bad

    def features(self, text: memoryview | bytes) -> tuple[float, float, float]:
        return _features(*self.sizes(text)) if len(text) and self.packers else (0.0, 0.0, 0.0)

    def score(self, features: tuple[float, ...]) -> float:
        *weights, bias = self.model.weights
        z = sum(w * x for w, x in zip(weights, features)) + bias
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _features(size: int, with_good: int, with_bad: int) -> tuple[float, float, float]:
    """Bytes that the good dictionary saves over the bad one, per byte and per compressed byte; compressed bytes per byte."""
    both, saved = with_good + with_bad, with_bad - with_good
    return saved / size, saved / both, both / size


def _prepared(raw: bytes) -> zstandard.ZstdCompressionDict:
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return d


def _dictionary(texts: list[bytes]) -> bytes:
    """An equal share of each text, from anywhere behind its opening, up to DICT_BYTES."""
    share = max(256, DICT_BYTES // max(1, len(texts)))

    def part(t: bytes) -> bytes:
        if len(t) <= OPENING + 256:
            return t[:256]
        at = OPENING + zlib.crc32(t) % max(1, len(t) - OPENING - share + 1)
        return t[at : at + share]

    return b"\n".join(map(part, texts))[-DICT_BYTES:]


def _curve(points: list[tuple[float, ...]], marks: list[int]) -> tuple[float, ...]:
    """Weights and bias of the logistic curve, by Newton steps with a small penalty on standardised features."""
    x, y = np.array(points), np.array(marks, float)
    mean, dev = x.mean(0), x.std(0)
    dev[dev == 0] = 1.0
    z = np.c_[(x - mean) / dev, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = 1e-3 * len(x) * np.eye(len(w)) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + penalty + 1e-9 * np.eye(len(w)), z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).sum() < 1e-6:
            break
    weights = w[:-1] / dev
    return (*weights.tolist(), float(w[-1] - weights @ mean))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """The model from at most sample labelled documents per class whose bucket isn't 0."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    known = known.filter(F.col("quality").isin(0, 1) & (bucket(F.col("doc_id")) != 0))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.filter("quality = 1").orderBy(*order).limit(sample).unionByName(
        known.filter("quality = 0").orderBy(*order).limit(sample)
    )  # bounded: 2 * sample ids
    texts = docs.select("doc_id", F.encode(F.col("text"), "UTF-8").alias("text")).filter(F.length("text") > 0)
    size = sample_bytes // (2 * sample)
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - size + 1, F.lit(1))).cast("int") + 1
    piece = F.substring(F.col("text"), at, F.lit(size)).alias("text")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), piece))["text"].alias("text")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(one).orderBy(*order).collect()
    )  # bounded: a row per chosen id and class
    by = {q: [r for r in rows if r.quality == q] for q in (0, 1)}
    if not by[0] or not by[1]:
        n = len(by[0]) + len(by[1])
        share = (len(by[1]) + 0.5) / (n + 1)
        return Model(b"", b"", (0.0, 0.0, 0.0, math.log(share / (1 - share))))
    model = Model(*(_dictionary([bytes(r.text) for r in by[q][::2]]) for q in (1, 0)), ())
    rest = [(r.doc_id, q) for q in (0, 1) for r in (by[q][1::2] or by[q])]
    kind = docs.schema["doc_id"].dataType.simpleString()
    points = _sizes(texts.join(F.broadcast(docs.sparkSession.createDataFrame(rest, f"doc_id {kind}, quality int")), "doc_id"), model)
    sums = points.groupBy("doc_id", "quality").agg(*(F.sum(c).alias(c) for c in ("size", "with_good", "with_bad")))
    sums = sums.orderBy(*order, "quality").collect()  # bounded: a row per id of the curve
    return model._replace(weights=_curve([_features(r.size, r.with_good, r.with_bad) for r in sums], [r.quality for r in sums]))


def _sizes(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, quality, size, with_good and with_bad of each row with a text that is bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*sent.value))
        for batch in batches:
            sizes = [scorer.sizes(t.as_buffer()) for t in text_column(batch, "text")]
            columns = [pa.array([s[k] for s in sizes], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["doc_id", "quality", "size", "with_good", "with_bad"])

    rows = docs.select("doc_id", "quality", "text")
    return in_batches(rows, run, f"doc_id {kind}, quality int, size bigint, with_good bigint, with_bad bigint")


def _scored(docs: DataFrame, model: Model, column: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*sent.value))
        for batch in batches:
            scores = []
            for _, offsets, data in text_blocks(text_column(batch, "text")):
                view = memoryview(data)
                ends = offsets.tolist()
                scores += [scorer.score(scorer.features(view[a:b])) for a, b in zip(ends, ends[1:])]
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, column])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return in_batches(docs, run, f"{kinds}, `{column}` double")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, sample)
    scored = _scored(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id", (bucket(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def filter_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that score THRESHOLD or more, all columns as they were."""
    name = free_name(docs, "_score")
    return _scored(docs, fit(docs, labels, sample), name).filter(F.col(name) >= THRESHOLD).drop(name)
