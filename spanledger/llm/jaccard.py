"""N-gram Jaccard join: all documents whose sets of 5-word shingles have a Jaccard similarity of at least 0.8.

Words are [0-9a-z and all beyond ASCII]+ after lower-casing A-Z; a text of fewer than 5 words, but not none, has one shingle.
Documents with equal sets are one class from the start (similarity 1) and go on as one text with a number of copies.

1. Each distinct set gets a MinHash signature of 128 values. Equal values in one of 32 bands of 4 make two sets candidates; a pair at
   0.8 meets with a probability of 1 - 5e-8, others more surely.
2. Candidates meet in groups, one per band value; groups with the same members are kept once. A pair is looked at in the first band in
   which it agrees, so once. Groups of more than BLOCK members are split, and pairs of blocks are what a task compares.
3. The pairs of a group are compared 16 values at a time, all pairs at once; after each step those are dropped whose posterior
   probability of reaching the threshold (uniform prior) is below TOLERANCE.
4. What is left is verified exactly with the shingle sets, read again from the texts that are needed. Sets travel once per
   group, pairs as one packed row per group: rows grow with members, not with pairs.
5. Verified links are counted per document, with copies, and join documents into classes (connected components, by
   smallest labels and pointer jumping over written tables).

A very long text is one row's work; its set is as long as the text. Null and empty texts, and texts without words, are similar to nothing and are a class each, as is a null doc_id with such a text.
doc_id may repeat or be null; a class's id is its smallest doc_id. An empty table gives an empty result. Further columns
aren't read by `classes` and pass through `keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import Words, fold, free_name, in_batches, mix, partitions_for, text_blocks, text_column, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_VALUES = 32, 4
VALUES = BANDS * BAND_VALUES
STEP = 16
TOLERANCE = 1e-7
BLOCK = 512
_FACTORS = np.random.default_rng(20240101).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts of a block one after another, and how many each text has (with repetitions)."""
    sizes = np.diff(words.first)
    at, hashes = words.grams(SHINGLE)
    counts = np.maximum(sizes - SHINGLE + 1, 0)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        own = [fold([words.hash[k : k + 1] for k in range(int(words.first[i]), int(words.first[i + 1]))])[0] for i in short]
        hashes = np.insert(hashes, np.cumsum(counts)[short], np.array(own, np.uint64))
        counts[short] = 1
    return hashes, counts


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values (texts x VALUES, 16 bits) of texts with at least one shingle each."""
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), VALUES), np.uint16)
    for j, factor in enumerate(_FACTORS):
        out[:, j] = mix(np.minimum.reduceat(hashes * factor, starts)) >> np.uint64(48)
    return out


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After k values, the matches below which the posterior probability of threshold is below tolerance."""
    out = {}
    for k in range(STEP, VALUES + 1, STEP):
        total = 0.0
        for m in range(k + 1):  # P(J >= t | m of k) = P(Bin(k + 1, t) <= m) for a uniform prior
            total += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                out[k] = m
                break
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, offsets, data in text_blocks(text_column(batch, "text")):
            hashes, counts = shingle_sets(Words(offsets, data))
            full = np.flatnonzero(counts)
            stops = np.cumsum(counts).tolist()
            digests, sizes = [None] * len(counts), [0] * len(counts)
            for i in full.tolist():
                own = np.unique(hashes[stops[i] - int(counts[i]) : stops[i]])
                digests[i], sizes[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest(), len(own)
            values = [None] * len(counts)
            if len(full):
                for i, v in zip(full.tolist(), signatures(hashes, counts[full])):
                    values[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(row, len(counts)) for c in (0, 1)), pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int32()), pa.array(values, pa.binary()),
                ],
                names=["doc_id", "text_key", "digest", "n", "values"],
            )


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, digest of the shingle set (null: none), its size n, and the MinHash values."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_key().alias("text_key"), "text")
    return in_batches(rows, _sketch, f"doc_id {kind}, text_key binary, digest binary, n int, values binary")


def _candidates(sets: DataFrame) -> DataFrame:
    """digest, band, bucket, side, x and y: members of the groups to compare; x and y are blocks of a group."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    posted = sets.select("digest", "values", F.explode(bands).alias("band"))
    width = 2 * BAND_VALUES
    key = F.xxhash64("band", F.substring(F.col("values"), F.col("band") * width + 1, F.lit(width)))
    posted = posted.select("digest", "band", key.alias("bucket"))
    groups = posted.groupBy("band", "bucket").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("digest")).alias("f"),
        F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("g"),
    ).filter("members > 1")
    groups = groups.groupBy("members", "f", "g").agg(F.min(F.struct("band", "bucket")).alias("one"))
    groups = groups.select("one.*", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(7), "digest"), F.col("blocks")).cast("int")
    member = posted.join(groups, ["band", "bucket"]).withColumn("own", own)
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return member.select(
        "digest", "band", "bucket", (F.col("own") > F.col("other")).cast("int").alias("side"),
        F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
    )


def prune(values: np.ndarray, sizes: np.ndarray, side: np.ndarray, band: int, one_block: bool, threshold: float,
          least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members that are first met in this band and may reach the threshold."""
    keys = values.view(np.uint64)  # one number per band
    left, right = [], []
    rows = np.arange(len(values)) if one_block else np.flatnonzero(side == 0)
    others = rows if one_block else np.flatnonzero(side == 1)
    for a in range(0, len(rows), 256):
        i, j = (x.reshape(-1) for x in np.meshgrid(rows[a : a + 256], others, indexing="ij"))
        if one_block:
            i, j = i[i < j], j[i < j]
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        good = (keys[i, band] == keys[j, band]) & (small >= threshold * large - 1e-9)
        i, j = i[good], j[good]
        for b in range(band):
            fresh = keys[i, b] != keys[j, b]
            i, j = i[fresh], j[fresh]
        matches = np.zeros(len(i), np.int32)
        for k in range(0, VALUES, STEP):
            matches += (values[i, k : k + STEP] == values[j, k : k + STEP]).sum(1, dtype=np.int32)
            alive = matches >= least[k + STEP]
            i, j, matches = i[alive], j[alive], matches[alive]
        left.append(i)
        right.append(j)
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def _pruner(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def run(group: pa.Table) -> pa.Table:
        names = ("band", "bucket", "x", "y")
        keys = [group.column(c).to_numpy() for c in names]
        digests = np.array(group.column("digest").to_pylist(), object)
        values = np.frombuffer(b"".join(group.column("values").to_pylist()), np.uint16).reshape(-1, VALUES)
        sizes, copies, side = (group.column(c).to_numpy() for c in ("n", "copies", "side"))
        order = np.lexsort((digests.astype("S16"), *keys[::-1]))
        same = np.all([k[order][1:] == k[order][:-1] for k in keys], axis=0)
        cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(order)]
        out: list[tuple] = []
        for a, b in zip(cuts, cuts[1:]):
            own = order[a:b]
            band, bucket, x, y = (int(k[own[0]]) for k in keys)
            i, j = prune(values[own], sizes[own], side[own], band, x == y, threshold, least)
            if len(i):
                used = np.unique(np.concatenate((i, j)))
                pairs = np.stack((np.searchsorted(used, i), np.searchsorted(used, j))).astype(np.int16)
                members = [{"digest": digests[k], "n": int(sizes[k]), "copies": int(copies[k])} for k in own[used].tolist()]
                out.append((f"{band}.{bucket}.{x}.{y}", members, pairs.tobytes()))
        member = pa.struct([("digest", pa.binary()), ("n", pa.int32()), ("copies", pa.int64())])
        kinds = (pa.string(), pa.list_(member), pa.binary())
        return pa.table([pa.array([o[c] for o in out], k) for c, k in enumerate(kinds)], names=["grp", "members", "pairs"])

    return run


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None
    for batch in batches:
        wanted = batch.column(batch.schema.get_field_index("digest")).to_pylist()
        first = [k for k, d in enumerate(wanted) if d != (wanted[k - 1] if k else last)]  # rows of one text come after one another
        last = wanted[-1] if wanted else last
        wanted = [wanted[k] for k in first]
        for row, offsets, data in text_blocks(text_column(batch.take(pa.array(first, pa.int64())), "text")):
            hashes, counts = shingle_sets(Words(offsets, data))
            stops, digests, blobs = np.cumsum(counts).tolist(), [], []
            for i, (stop, count) in enumerate(zip(stops, counts.tolist())):
                blob = np.unique(hashes[stop - count : stop]).tobytes()
                if count and hashlib.blake2b(blob, digest_size=16).digest() == wanted[row + i]:
                    digests.append(wanted[row + i])
                    blobs.append(blob)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(blobs, pa.binary())], names=["digest", "shingles"])


def shared_sizes(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(left) <= 2 * len(sets):
        out = np.empty(len(left), np.int64)
        for p, (i, j) in enumerate(zip(left.tolist(), right.tolist())):
            a, b = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            out[p] = (b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()
        return out
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, seen = np.unique(every, return_inverse=True, return_counts=True)
    width = len(seen)
    total = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, width, 8192):  # all pairs at once, a stretch of shingles at a time; sums stay exact below 2^24
        here = (column >= a) & (column < a + 8192)
        some = np.zeros((len(sets), min(8192, width - a)), np.float32)
        some[owner[here], column[here] - a] = 1
        total += some @ some.T
    return total[left, right].astype(np.int64)


def _verifier(threshold: float):
    def run(groups: pa.Table, sets: pa.Table) -> pa.Table:
        blobs = dict(zip(sets.column("digest").to_pylist(), sets.column("shingles").to_pylist()))
        out: list[tuple] = []
        for members, pairs in zip(groups.column("members").to_pylist(), groups.column("pairs").to_pylist()):
            own = [np.frombuffer(blobs[m["digest"]], np.uint64) for m in members]
            sizes = np.array([len(s) for s in own])
            left, right = np.frombuffer(pairs, np.int16).reshape(2, -1).astype(np.int64)
            common = shared_sizes(own, left, right)
            good = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
            left, right = left[good], right[good]
            copies = np.array([m["copies"] for m in members])
            links = np.bincount(left, copies[right], len(own)) + np.bincount(right, copies[left], len(own))
            root = np.arange(len(own))
            while True:  # smallest member reachable, by labels along the links
                before = root.copy()
                low = np.minimum(root[left], root[right])
                np.minimum.at(root, left, low)
                np.minimum.at(root, right, low)
                root = root[root]
                if np.array_equal(before, root):
                    break
            out += [
                (members[k]["digest"], int(links[k]), members[int(root[k])]["digest"]) for k in np.flatnonzero(links).tolist()
            ]
        kinds = (pa.binary(), pa.int64(), pa.binary())
        return pa.table([pa.array([o[c] for o in out], k) for c, k in enumerate(kinds)], names=["digest", "links", "root"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node) of the components of edges (node, other)."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct()
    both = written(both, "edges")
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    labels = written(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        lower = written(lower, "lower")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        step = lower.join(jump, "low", "left").select("node", F.coalesce("lowest", "low").alias("label"), "old")
        step = written(step, "labels")
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels


def classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, text_key, n_shingles, n_links (documents of similarity threshold or more), class_id, class_size, and one: true
    for one (doc_id, text) of each class."""
    rows = written(sketch(docs), "sketch")
    sets = rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.first("n").alias("n"), F.first("values").alias("values"), F.count("*").alias("copies"),
        F.min(F.struct("doc_id", "text_key")).alias("one"),
    )
    sets = written(sets, "sets")
    members = written(_candidates(sets), "members")
    tasks = partitions_for(members.count(), 20_000)
    dealt = members.join(sets.select("digest", "n", "values", "copies"), "digest").withColumn(
        "task", F.pmod(F.xxhash64("band", "bucket", "x", "y"), F.lit(tasks))
    )
    member = "array<struct<digest:binary,n:int,copies:bigint>>"
    groups = dealt.groupBy("task").applyInArrow(_pruner(threshold, tolerance), f"grp string, members {member}, pairs binary")
    groups = written(groups, "groups")
    each = groups.select("grp", F.explode("members").alias("m")).select("grp", "m.digest", "m.n")
    tasks = partitions_for(each.agg(F.sum(8 * F.col("n").cast("long"))).first()[0], 8 << 20)
    needed = each.select("digest").distinct().join(sets.select("digest", "one.*"), "digest").alias("w")
    texts = docs.select("doc_id", "text", text_key().alias("text_key")).alias("t").join(
        needed, F.expr("t.text_key = w.text_key AND t.doc_id <=> w.doc_id")
    ).select("w.digest", "t.text")
    full = in_batches(texts, _full_sets, "digest binary, shingles binary")
    task = F.pmod(F.xxhash64("grp"), F.lit(tasks)).alias("task")
    sent = each.select("digest", task).distinct().join(full, "digest").select("task", "digest", "shingles")
    verified = groups.select(task, "members", "pairs").groupBy("task").cogroup(sent.groupBy("task")).applyInArrow(
        _verifier(threshold), "digest binary, links bigint, root binary"
    )
    verified = written(verified, "verified")
    links = verified.groupBy("digest").agg(F.sum("links").alias("links"))
    edges = verified.select(F.col("digest").alias("node"), F.col("root").alias("other")).filter("node <> other")
    labels = components(edges).withColumnRenamed("node", "digest")
    known = sets.select("digest", "copies").join(links, "digest", "left").join(labels, "digest", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "digest").alias("label")
    )
    placed = rows.select("doc_id", "text_key", "n", "digest").join(known, "digest", "left")
    placed = written(placed, "placed")
    per = placed.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"), F.count("*").alias("class_size")
    )
    alone = F.col("label").isNull()
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return placed.join(per, "label", "left").select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), (alone | chosen).alias("one"),
    )


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id, class_size, n_links and n_shingles of every document."""
    return classes(docs, threshold, tolerance).select("doc_id", "class_id", "class_size", "n_links", "n_shingles")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the one with the smallest doc_id. Texts without words all stay."""
    placed = written(classes(docs, threshold), "classes")
    key, doc = free_name(docs, "_text_key"), free_name(docs, "_doc")
    kept = placed.filter("one").groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(
        F.count("*").alias(free_name(docs, "_rows")), F.max(F.col("n_shingles") > 0).alias(free_name(docs, "_words"))
    )
    rows, words = kept.columns[2:]
    found = docs.withColumn(key, text_key()).alias("t").join(
        kept.withColumnRenamed(key, "_w_key").alias("w"), F.expr(f"t.`doc_id` <=> w.`{doc}` AND t.`{key}` = w.`_w_key`")
    )
    twice = F.col(words) & (F.col(rows) > 1)
    once = found.filter(~twice).select(*[F.col(f"t.`{c}`") for c in docs.columns])
    if placed.filter("one AND n_shingles > 0").groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():
        return once
    more = found.filter(twice).dropDuplicates([doc, "_w_key"]).select(*[F.col(f"t.`{c}`") for c in docs.columns])
    return once.unionByName(more)
