"""Suffix-array dedup: removes every byte covered by a string of `length` bytes that starts anywhere else too.

Texts are UTF-8 bytes; matches don't cross documents. Suffix arrays over all bytes of a corpus would sort everything to find the
little that repeats, so texts are first cut by content:

1. Every window of length bytes has an anchor, its `anchor`-byte string with the smallest hash (the first of equal ones). Equal
   windows have equal anchors at equal places. Neighbouring windows with one anchor form a segment; segments partition all windows.
   A segment travels as its anchor's hash and its own digest.
2. Anchors that occur once are dropped: none of their windows repeats. Equal segments repeat with all their windows.
3. Only the segments that share their anchor with other, different segments are compared byte by byte. They are dealt over
   shards by anchor. Of these, a shard drops those that share with no other what is beside the anchor, to either side. It builds the suffix array of the others by Larsson-Sadakane refinement (ranks of doubled or
   tripled prefixes, sorting again only what is still tied), and Kasai's common prefixes; a window whose common prefix with a neighbour
   has the full length repeats.
4. An anchor with many different segments is split over several shards. Their windows that were not found in the own
   shard are merged across shards: sorted window digests are cut into ranges, and in each range every shard's run is looked up
   by binary search in the merged run.

`report` judges passages of `passage` bytes first, and windows of length bytes in what those cover: a repeated window lies in
passages that repeat as well, so nothing else can hold one.

Digests are 128 bits of XXH3. Null and empty texts have no windows and stay as they are; texts shorter than length can't
repeat. Copies of a text are judged alike, so rows are found again by the digest of their text, and doc_id may repeat or
be null. A very long text is cut in pieces of PIECE windows, which overlap, so memory does not grow with it beyond its bytes. An
empty table gives an empty result. Further columns pass through `remove_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from spanledger.llm.common import discard, free_name, in_batches, mix, partitions_for, powers, prefix_sums, raw_bytes, text_blocks, text_column, written

LENGTH = 400
ANCHOR = 96
PASSAGE, PASSAGE_ANCHOR = 240, 64
PASSAGE_WORDS = 50  # a passage of more words counts as one
PIECE = 256 << 10  # windows that are cut at once
SHARD_BYTES = 1 << 20
HOT_SEGMENTS = 2048  # different segments of one anchor in a shard
_BASE = 0x8D58AC26AFE12E47 | 1


# ------------------------------------------------------------------ segments

def cut(data: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows of the segments, how many windows each has, and the anchors' hashes.

    data: texts one after another; ends: for each text where it ends.
    """
    n, span = len(data), length - anchor + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix_sums(data, _BASE)
    _, down = powers(_BASE, n)
    codes = mix((sums[anchor:] - sums[: n - anchor + 1]) * down[: n - anchor + 1])
    del sums
    bits = np.uint64(max(1, n.bit_length()))
    keys = ((codes >> bits) << bits) | np.arange(len(codes), dtype=np.uint64)  # ties go to the first
    rows = -(-len(keys) // span)
    padded = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(rows, span)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - length + 1
    least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    begin = np.arange(windows)
    text = np.searchsorted(ends, begin, "right")
    inside = begin + length <= ends[np.minimum(text, len(ends) - 1)]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, stop - start, codes[at[start]]


def segments(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """key, base, anchor, digest, lo and run of all segments of the texts (columns key, base, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in text_blocks(text_column(batch, "text"), PIECE):
                for low in range(0, max(1, len(data) - length + 1), PIECE):
                    piece = data[low : low + PIECE + length - 1]
                    ends = np.minimum(offsets[1:] - low, len(piece))
                    start, runs, codes = cut(piece, ends, length, anchor)
                    whole, at = piece.tobytes(), start + low
                    text = np.searchsorted(offsets, at, "right") - 1
                    digests = [
                        xxh3_128_digest(whole[a:b]) for a, b in zip(start.tolist(), (start + runs + length - 1).tolist())
                    ]
                    rows = pa.array(text + row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows), batch.column(1).take(rows), pa.array(codes.view(np.int64)),
                            pa.array(digests, pa.binary()), pa.array(at - offsets[text]), pa.array(runs, pa.int32()),
                        ],
                        names=["key", "base", "anchor", "digest", "lo", "run"],
                    )

    return in_batches(texts.select("key", "base", "text"), run, "key binary, base bigint, anchor bigint, digest binary, lo bigint, run int")


# ------------------------------------------------------------------ suffix arrays

def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, which end with their segment; of equal ones the first comes first."""
    n = len(data)
    left = (np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)).astype(np.int32)  # bytes to the segment's end
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key <<= np.uint64(9)
        own = np.flatnonzero(left[: n - j] > j)
        key[own] |= data[own + j].astype(np.uint64) + np.uint64(1)
    order = np.argsort(key).astype(np.int32)
    ordered = key[order]
    del key
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    del ordered
    places = np.arange(n, dtype=np.int32)
    rank = np.zeros(n + 1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0)) + 1  # a group is named by its first place
    h, deepest = 7, int(np.diff(ends, prepend=0).max())
    bits = n.bit_length()
    steps = 3 if 3 * bits <= 63 else 2  # ranks of h bytes that are looked at together
    tied = places[~(new & np.append(new[1:], True))]  # places of groups of two and more
    while True:
        own = order[tied]
        if not len(tied) or h >= deepest:
            order[tied] = own[np.argsort(rank[own].astype(np.int64) << 32 | own)]
            return order
        both = rank[own].astype(np.int64)
        for k in range(1, steps):
            ahead = np.where(left[own] > k * h, rank[np.minimum(own.astype(np.int64) + k * h, n)], 0)
            both = both << bits | ahead
        by = np.argsort(both)
        own, both = own[by], both[by]
        order[tied] = own
        parts = np.ones(len(tied), bool)
        parts[1:] = both[1:] != both[:-1]
        rank[own] = np.maximum.accumulate(np.where(parts, tied, 0)) + 1
        tied = tied[~(parts & np.append(parts[1:], True))]
        h *= steps


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each position, how many bytes its suffix shares with the one before it in order, up to depth.

    Kasai: the next position shares at most one byte less. All segments are gone through side by side, eight bytes at a time.
    This needs the whole order, ties too: of one cut off at some depth it would not hold.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n, 8), (1, 1)).copy().view("<u8").reshape(-1)
    sizes = np.diff(ends, prepend=0)
    stop = np.repeat(ends, sizes).astype(np.int32)
    out = np.zeros(n, np.int32)
    longest = np.argsort(-sizes, kind="stable")
    starts, sizes = (ends - np.diff(ends, prepend=0))[longest], sizes[longest]
    shared = np.zeros(len(starts), np.int64)
    lives = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0))  # segments longer than step
    for step, live in enumerate(lives.tolist()):
        at = starts[:live] + step
        other = before[at].astype(np.int64)
        has = shared[:live]
        np.maximum(has - 1, 0, out=has)
        alone = other < 0
        has[alone] = 0
        limit = np.minimum(np.minimum(stop[at] - at, stop[other] - other), depth)
        limit[alone] = 0
        going = np.flatnonzero(has < limit)
        while len(going):
            m = has[going]
            differ = eight[at[going] + m] ^ eight[other[going] + m]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)  # a power of two, or 0 where all eight agree
            same = np.where(differ == 0, 8, (np.frexp(lowest)[1] - 1) >> 3)
            has[going] = np.minimum(m + same, limit[going])
            going = going[(same == 8) & (m + 8 < limit[going])]
        out[at] = has
    return out


def repeated(data: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Positions whose window of length bytes is also at another position."""
    order = suffix_array(data, ends)
    shared = common_prefixes(data, ends, order, length)
    found = np.zeros(len(data), bool)
    same = np.flatnonzero(shared[order] >= length)  # places equal to the place before
    found[order[same]] = True
    found[order[same - 1]] = True
    return found


def may_repeat(data: np.ndarray, ends: np.ndarray, anchors: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """Segments that can have a repeated window, for segments that share no anchor with segments elsewhere.

    Equal windows have their anchor at equal places, and half of what is beside it, or more, on one side of it. So of a segment
    with a repeated window the bytes before the anchor or those after it, that many, are those of another segment too.
    """
    n, sizes = len(data), np.diff(ends, prepend=0)
    sums = prefix_sums(data, _BASE)
    _, down = powers(_BASE, n)
    codes = mix((sums[anchor:] - sums[: n - anchor + 1]) * down[: n - anchor + 1])
    hits = np.flatnonzero(codes == np.repeat(anchors, sizes)[: len(codes)])
    starts = ends - sizes
    at = hits[np.minimum(np.searchsorted(hits, starts), len(hits) - 1)]  # the first in each segment
    beside = (length - anchor + 1) // 2
    found = np.zeros(len(ends), bool)
    for first in (at - beside, at + anchor):
        whole = np.flatnonzero((first >= starts) & (first + beside <= ends))
        first = first[whole]
        own = mix((sums[first + beside] - sums[first]) * down[first]) ^ mix(anchors[whole].copy())
        _, back, count = np.unique(own, return_inverse=True, return_counts=True)
        found[whole[count[back] > 1]] = True
    return found


# ------------------------------------------------------------------ Spark

_MARK = "anchor bigint, digest binary, first int, stop int"
_LOOSE = "anchor bigint, part int, digests binary, owners binary, firsts binary"


def _shard(length: int, anchor: int, ranges: int):
    """Repeated windows of a shard's segments; of anchors that have several shards also the digests for the merge."""

    def run(group: pa.Table) -> pa.Table:
        group = group.select(["anchor", "digest", "settled", "parts", "bytes"]).sort_by([("anchor", "ascending"), ("digest", "ascending")]).combine_chunks()
        anchors, digests, settleds, split = (group.column(c).to_pylist() for c in ("anchor", "digest", "settled", "parts"))
        offsets, data = raw_bytes(group.column("bytes").combine_chunks().cast(pa.large_binary()))
        data, ends = data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
        fresh = np.ones(len(ends), bool)  # a row that came twice counts once
        fresh[1:] = [x != y for x, y in zip(zip(anchors[1:], digests[1:]), zip(anchors, digests))]
        if not fresh.all():
            keep = np.repeat(fresh, np.diff(ends, prepend=0))
            data, ends = data[keep], np.cumsum(np.diff(ends, prepend=0)[fresh])
            anchors, digests, settleds, split = ([x for x, f in zip(v, fresh) if f] for v in (anchors, digests, settleds, split))
        found = np.zeros(len(data), bool)
        some = may_repeat(data, ends, np.array(anchors, np.int64).view(np.uint64), length, anchor)
        if some.any():
            inside = np.repeat(some, np.diff(ends, prepend=0))
            found[inside] = repeated(data[inside], np.cumsum(np.diff(ends, prepend=0)[some]), length)
        starts = ends - np.diff(ends, prepend=0)
        out: list[tuple] = []
        edges = np.flatnonzero(np.diff(np.concatenate(([0], found.astype(np.int8), [0]))))  # no run goes beyond its segment
        own = np.searchsorted(starts, edges[::2], "right") - 1
        for k, x, y in zip(own.tolist(), (edges[::2] - starts[own]).tolist(), (edges[1::2] - starts[own]).tolist()):
            if not settleds[k]:
                out.append((anchors[k], digests[k], x, y, None, None))
        loose: dict[int, list[tuple[bytes, bytes, int]]] = {}
        for k in np.flatnonzero(np.array(split) > 1).tolist():
            own, raw, d, settled = loose.setdefault(anchors[k], []), data[starts[k] : ends[k]].tobytes(), digests[k], settleds[k]
            flags = found[starts[k] : ends[k]]
            for w in range(len(raw) - length + 1):
                own.append((xxh3_128_digest(raw[w : w + length]), d, -1 if settled or flags[w] else w))
        for a, own in loose.items():
            own = sorted({x[0]: x for x in sorted(own, key=lambda x: -x[2])}.values())  # one row per window, found ones first
            first = np.frombuffer(b"".join(x[0] for x in own), ">u8")[::2]
            borders = np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges)
            stops = [0, *np.searchsorted(first, borders).tolist(), len(own)]
            out += [
                (a, None, None, None, r, own[x:y]) for r, (x, y) in enumerate(zip(stops, stops[1:])) if y > x
            ]
        return pa.table({
            "anchor": pa.array([x[0] for x in out], pa.int64()), "digest": pa.array([x[1] for x in out], pa.binary()),
            "first": pa.array([x[2] for x in out], pa.int32()), "stop": pa.array([x[3] for x in out], pa.int32()),
            "part": pa.array([x[4] for x in out], pa.int32()),
            "digests": pa.array([x[5] and b"".join(y[0] for y in x[5]) for x in out], pa.binary()),
            "owners": pa.array([x[5] and b"".join(y[1] for y in x[5]) for x in out], pa.binary()),
            "firsts": pa.array([x[5] and np.array([y[2] for y in x[5]], np.int32).tobytes() for x in out], pa.binary()),
        })

    return run


def _merge(group: pa.Table) -> pa.Table:
    """Windows that several shards of an anchor have, by binary search of each shard's run in the merged one."""
    runs = [np.frombuffer(x, "S16") for x in group.column("digests").to_pylist()]
    merged = np.sort(np.concatenate(runs))
    anchor, out = group.column("anchor")[0].as_py(), []
    for run, owners, firsts in zip(runs, group.column("owners").to_pylist(), group.column("firsts").to_pylist()):
        twice = np.searchsorted(merged, run, "right") - np.searchsorted(merged, run, "left") > 1
        firsts = np.frombuffer(firsts, np.int32)
        for i in np.flatnonzero(twice & (firsts >= 0)).tolist():
            out.append((anchor, owners[16 * i : 16 * i + 16], int(firsts[i]), int(firsts[i]) + 1))
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
    return pa.table([pa.array([x[j] for x in out], k) for j, k in enumerate(kinds)], names=["anchor", "digest", "first", "stop"])


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def whole_texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_key().alias("key"), F.lit(0).cast("bigint").alias("base"), "doc_id", "text")


def repeats(
    texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = HOT_SEGMENTS
) -> DataFrame:
    """key and spans: sorted ranges of bytes that repeated windows cover, not yet merged.

    texts: key of a text, base (where in it a part starts), text (of the part) and doc_id; rows of one key and base have one text.
    """
    found = written(segments(texts, length, anchor), "segments")
    # Written, so that joins stand on plain exchanges, in which adaptive execution splits a hot anchor.
    often = written(found.groupBy("anchor").count().filter("count > 1").select("anchor"), "often")
    shared = written(found.join(often, "anchor", "left_semi"), "shared")
    discard(found, often)
    kinds = shared.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("key", "base", "lo", "run")).alias("one"))
    kinds = written(kinds, "kinds")
    per = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed = (
        kinds.join(per.filter("kinds > 1 AND least = 1"), "anchor")
        .select("anchor", "digest", "n", "kinds", "one.key", "one.base", "one.lo", "one.run")
    )
    mixed = written(mixed, "mixed")
    total = mixed.agg(F.sum(F.col("run") + (length - 1)).alias("b"), F.max("kinds").alias("k")).first()
    shards, ranges = partitions_for(total.b, shard_bytes), partitions_for(total.k, hot)
    parts = F.ceil(F.col("kinds") / hot)
    shard = F.pmod(F.xxhash64("anchor", F.pmod(F.xxhash64("digest"), parts)), F.lit(shards))
    wanted = mixed.withColumn("parts", parts.cast("int")).withColumn("shard", shard)
    wanted = wanted.groupBy("key", "base").agg(
        F.collect_list(F.struct("anchor", "digest", (F.col("n") > 1).alias("settled"), "parts", "shard", "lo", "run")).alias("cuts")
    )
    one_text = texts.groupBy("key", "base").agg(F.min("doc_id").alias("doc_id"))
    wanted = wanted.join(one_text, ["key", "base"])
    holders = texts.alias("t").join(
        wanted.alias("w"),
        (F.col("t.key") == F.col("w.key")) & (F.col("t.base") == F.col("w.base")) & F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")),
    ).select("t.text", "w.cuts", "t.key", "t.base")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last = ["anchor", "digest", "settled", "parts", "shard"], None
        for batch in batches:
            offsets, data = raw_bytes(text_column(batch, "text"))
            for i, own in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if own == last:  # rows of one text and doc_id come after one another; the first has given all
                    continue
                last, cuts = own, batch.column(1)[i].values
                at = (np.asarray(cuts.field("lo")) + offsets[i]).tolist()
                runs = np.asarray(cuts.field("run")).tolist()
                pieces = [data[a : a + r + length - 1].tobytes() for a, r in zip(at, runs)]
                yield pa.RecordBatch.from_arrays(
                    [*(cuts.field(n) for n in names), pa.array(pieces, pa.binary())], names=[*names, "bytes"]
                )

    pieces = in_batches(holders, take, "anchor bigint, digest binary, settled boolean, parts int, shard bigint, bytes binary")
    compared = pieces.groupBy("shard").applyInArrow(
        _shard(length, anchor, ranges), f"{_MARK}, part int, digests binary, owners binary, firsts binary"
    )
    compared = written(compared, "compared")
    marks = compared.filter(F.col("part").isNull()).select("anchor", "digest", "first", "stop")
    if ranges > 1:
        across = compared.filter(F.col("part").isNotNull()).select("anchor", "part", "digests", "owners", "firsts")
        marks = marks.unionByName(across.groupBy("anchor", "part").applyInArrow(_merge, _MARK))
    whole = kinds.filter("n > 1").select("anchor", "digest", F.lit(0).alias("first"), F.col("one.run").alias("stop"))
    spans = shared.join(whole.unionByName(marks), ["anchor", "digest"]).select(
        "key", (F.col("base") + F.col("lo") + F.col("first")).alias("a"), (F.col("base") + F.col("lo") + F.col("stop") + (length - 1)).alias("b")
    )
    out = written(spans.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans")), "spans")
    discard(shared, kinds, mixed, compared)
    return out


def merged(spans: pa.ListScalar) -> list[tuple[int, int]]:
    """Maximal ranges out of sorted ones."""
    if not spans.is_valid or not len(spans.values):
        return []
    first, stop = (np.asarray(spans.values.field(c)) for c in ("a", "b"))
    reach = np.maximum.accumulate(stop)
    apart = first[1:] > reach[:-1]
    return list(zip(first[np.concatenate(([True], apart))].tolist(), reach[np.concatenate((apart, [True]))].tolist()))


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def _judged(docs: DataFrame, length: int, passage: int, passage_anchor: int) -> DataFrame:
    """One row per document with its passages; where one of them has length bytes or more, also the text and these."""
    spans = repeats(whole_texts(docs), passage, passage_anchor)
    marked = docs.select("doc_id", "text", text_key().alias("key")).join(spans, "key", "left").select("doc_id", "text", "key", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(text_column(batch, "text"), batch.column(3)):
                raw, own = text.as_py(), merged(own)
                words = [w for w in (len(raw[a:b].split()) for a, b in own) if w > PASSAGE_WORDS]
                long = [s for s in own if s[1] - s[0] >= length]
                sha = None if long else hashlib.sha256(raw).hexdigest()
                out.append((len(raw), sum(b - a for a, b in own), len(words), sum(words), sha, raw if long else None, [{"a": a, "b": b} for a, b in long]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), _SPANS)
            columns = [pa.array([x[j] for x in out], k) for j, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=_JUDGED)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, key binary, n_bytes bigint, n_passage_bytes bigint, n_passages bigint, n_passage_words bigint, "
        "kept_sha256 string, text binary, long array<struct<a: bigint, b: bigint>>"
    )
    out = written(in_batches(marked, run, schema), "judged")
    discard(spans)
    return out


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_JUDGED = ["doc_id", "key", "n_bytes", "n_passage_bytes", "n_passages", "n_passage_words", "kept_sha256", "text", "long"]


def report(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, passage: int = PASSAGE, passage_anchor: int = PASSAGE_ANCHOR
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of every document.

    Of passages, which repeat from `passage` bytes on (at most length), also: n_passage_bytes (covered by any of them), n_passages (maximal runs
    of more than PASSAGE_WORDS words) and n_passage_words (the words in those).
    """
    judged = _judged(docs.select("doc_id", "text"), length, passage, passage_anchor)
    counts = ["n_passage_bytes", "n_passages", "n_passage_words"]
    zero = F.lit(0).cast("bigint")
    short = judged.filter(F.col("kept_sha256").isNotNull()).select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256", *counts)
    long = judged.filter(F.col("kept_sha256").isNull()).select("doc_id", "key", "n_bytes", "text", "long", *counts)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                raw, long = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                n = len(long)
                columns = [batch.column(j).take(pa.array([i] * n, pa.int32())) for j in range(2)]
                columns += [pa.array([s["a"] for s in long], pa.int64()), pa.array([raw[s["a"] : s["b"]] for s in long], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "base", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = in_batches(long.select("doc_id", "key", "text", "long"), part, f"doc_id {kind}, key binary, base bigint, text binary")
    names = short.columns
    found = long.join(repeats(parts, length, anchor), "key", "left").select("doc_id", "n_bytes", "text", "spans", *counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(text_column(batch, "text"), batch.column(3)):
                raw, own = text.as_py(), merged(own)
                kept = _kept(raw, own)
                out.append((len(raw) - len(kept), len(own), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([x[j] for x in out], k) for j, k in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, *batch.columns[4:]], names=names)

    return short.unionByName(in_batches(found, run, short.schema))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """The documents without the repeated bytes; a character that loses a byte goes as a whole."""
    key, spans = free_name(docs, "_text_key"), free_name(docs, "_spans")
    found = repeats(whole_texts(docs), length, anchor).select(F.col("key").alias(key), F.col("spans").alias(spans))
    marked = docs.withColumn(key, text_key()).join(found, key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            found = [merged(own) for own in batch.column(batch.schema.get_field_index(spans))]
            columns = list(batch.columns)
            if any(found):
                texts = batch.column(place).to_pylist()
                for i, own in enumerate(found):
                    if own:
                        texts[i] = _kept(texts[i].encode(), own).decode("utf-8", "ignore")
                columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return in_batches(marked, run, marked.schema).drop(key, spans).select(*docs.columns)
