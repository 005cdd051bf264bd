"""Centroid clustering in integers, filtered by a PCA-rotated lower bound.

Vectors with exactly `size` components, none of them null or not finite, take part; component x becomes floor(64 * x). Centroids start as the
`centroids` vectors with the smallest SHA-256 of `1:<vec_id>` (no digits for null; equal ids by their components). In each round every vector goes
to the nearest centroid (squared Euclidean distance, ties to the smaller number), and every centroid with vectors becomes their
exact componentwise floor(sum / count). Then vectors are assigned once more.

1. One pass turns vectors into integers; sums and products of components, added up over all of them, give mean and covariance.
2. The covariance's eigenvectors rotate every vector. Its `leading` coordinates and the norm of the rest are stored beside
   the integers.
3. The squared distance of two vectors is at least that of their leading coordinates plus the squared difference of the norms of
   their rests. A vector is compared in integers with the centroid of the least bound, and then with those whose bound, less an allowance for
   rounding, is not above the distance found. The rest can't be nearer, so the result is that of comparing all.

A round reads the stored table and sends one row per task and centroid; only centroids and the rotation (both of fixed size) reach the driver.

Fewer vectors than centroids give fewer centroids, none an empty result. Repeated rows are assigned each. Components beyond 2^26
in size (|x| of 2^20 and more) count as 2^26, so that distances fit into a long; an inertia beyond that counts as the largest long. Columns beside vec_id
and embedding are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm.common import in_batches, table, written

SIZE = 64
CENTROIDS = 16
ROUNDS = 3
LEADING = 16
SCALE = 64
LIMIT = 1 << 26
MOST = (1 << 63) - 1


def integers(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their components as integers."""
    lists = column.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), size), False).to_numpy(zero_copy_only=False))
    values = lists.take(pa.array(rows)).flatten()
    flat = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).reshape(len(rows), size)
    good = np.isfinite(flat).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat[good] * SCALE)
    return rows[good], np.clip(scaled, -LIMIT, LIMIT).astype(np.int32)


def packed(matrix: np.ndarray) -> pa.Array:
    """A binary value per row."""
    raw = np.ascontiguousarray(matrix)
    width = raw.shape[1] * raw.itemsize
    offsets = pa.py_buffer((np.arange(len(raw) + 1, dtype=np.int64) * width).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(raw), [None, offsets, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty((0, width), kind)
    first = np.frombuffer(offsets, np.int64)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(first)).reshape(len(column), width)


def vectors(embeddings: DataFrame, size: int = SIZE) -> DataFrame:
    """vec_id, ints (int32 each) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ints = integers(batch.column(1), size)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), packed(ints)], names=["vec_id", "ints"])

    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return in_batches(embeddings.select("vec_id", "embedding"), run, f"vec_id {kind}, ints binary")


# ------------------------------------------------------------------ rotation

def rotation(stored: DataFrame, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the covariance's eigenvectors as columns, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = unpacked(batch.column(0), np.int32, size).astype(np.float64)
            n, total, products = n + len(x), total + x.sum(axis=0), products + x.T @ x
        if n:
            both = np.concatenate(([float(n)], total, products.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(both)), pa.int32()), pa.array(both)], names=["place", "value"])

    sums = in_batches(stored.select("ints"), run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    values = {r.place: r.value for r in sums.collect()}  # 1 + size + size^2 rows
    if not values:
        return np.zeros(size), np.eye(size)
    flat = np.array([values[i] for i in range(1 + size + size * size)])
    n, mean = flat[0], flat[1 : 1 + size] / flat[0]
    spread = flat[1 + size :].reshape(size, size) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return mean, np.ascontiguousarray(axes[:, ::-1])


def turned(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of the others."""
    y = (x - mean) @ axes
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def rotated(stored: DataFrame, mean: np.ndarray, axes: np.ndarray, leading: int = LEADING, size: int = SIZE) -> DataFrame:
    """vec_id, ints, lead (leading coordinates, float32 each) and rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = turned(unpacked(batch.column(1), np.int32, size).astype(np.float64), mean, axes, leading)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), packed(lead.astype(np.float32)), pa.array(rest)], names=["vec_id", "ints", "lead", "rest"]
            )

    kind = stored.schema["vec_id"].dataType.simpleString()
    return in_batches(stored, run, f"vec_id {kind}, ints binary, lead binary, rest double")


# ------------------------------------------------------------------ assignment

class Centres:
    """Centroids in integers and as the bound needs them."""

    def __init__(self, ints: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> None:
        self.ints = ints.astype(np.int64)
        self.lead, self.rest = turned(self.ints.astype(np.float64), mean, axes, leading)

    def nearest(self, ints: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid, and how many centroids were compared in integers."""
        ints, lead = ints.astype(np.int64), lead.astype(np.float64)
        own, centre = (lead**2).sum(axis=1), (self.lead**2).sum(axis=1)
        bound = own[:, None] - 2.0 * (lead @ self.lead.T) + centre + (rest[:, None] - self.rest) ** 2
        # float32 coordinates are off by 2^-24 of their size; products and sums of doubles by far less
        bound -= 1e-6 * (np.sqrt(own + rest**2)[:, None] + np.sqrt(centre + self.rest**2)) ** 2
        best = np.argmin(bound, axis=1)
        distance = ((ints - self.ints[best]) ** 2).sum(axis=1)
        compared = np.ones(len(ints), np.int32)
        first = best.copy()
        for c in range(len(self.ints)):
            rows = np.flatnonzero((bound[:, c] <= distance) & (first != c))
            if not len(rows):
                continue
            compared[rows] += 1
            found = ((ints[rows] - self.ints[c]) ** 2).sum(axis=1)
            nearer = (found < distance[rows]) | ((found == distance[rows]) & (c < best[rows]))
            best[rows[nearer]], distance[rows[nearer]] = c, found[nearer]
        return best, distance, compared


def start(stored: DataFrame, centroids: int = CENTROIDS, size: int = SIZE) -> np.ndarray:
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = stored.orderBy(F.sha2(name.cast("binary"), 256), F.hex("ints")).limit(centroids).collect()
    return np.array([np.frombuffer(bytes(r.ints), np.int32) for r in rows], np.int64).reshape(len(rows), size)


def moved(stored: DataFrame, centres: Centres, size: int = SIZE, leading: int = LEADING) -> np.ndarray:
    """The centroids after one round."""
    count = len(centres.ints)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(count, np.int64), np.zeros((count, size), np.int64)
        for batch in batches:
            ints = unpacked(batch.column(0), np.int32, size)
            own, _, _ = centres.nearest(ints, unpacked(batch.column(1), np.float32, leading), batch.column(2).to_numpy())
            n += np.bincount(own, minlength=count)
            by = np.argsort(own, kind="stable")
            held, first = np.unique(own[by], return_index=True)
            sums[held] += np.add.reduceat(ints[by].astype(np.int64), first, axis=0) if len(held) else 0
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(n[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = in_batches(stored.select("ints", "lead", "rest"), run, "cluster int, n bigint, sums array<bigint>")
    flat = parts.select("cluster", "n", F.posexplode("sums").alias("place", "value"))
    total = flat.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = centres.ints.copy()
    for r in total.collect():  # centroids x size rows
        out[r.cluster, r.place] = int(r.value) // r.n
    return out


def cluster(
    embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, leading: int = LEADING, size: int = SIZE
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, and compared: centroids that were compared in integers."""
    ints = written(vectors(embeddings, size), "vectors", "zstd")
    mean, axes = rotation(ints, size)
    stored = written(rotated(ints, mean, axes, leading, size), "rotated", "zstd")
    centres = Centres(start(ints, centroids, size), mean, axes, leading)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if not len(centres.ints):
        empty = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, compared int"
        return embeddings.sparkSession.createDataFrame([], empty)
    for _ in range(rounds):
        centres = Centres(moved(stored, centres, size, leading), mean, axes, leading)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance, compared = centres.nearest(
                unpacked(batch.column(1), np.int32, size), unpacked(batch.column(2), np.float32, leading), batch.column(3).to_numpy()
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.int32()), pa.array(distance), pa.array(compared)], names=["vec_id", "cluster", "distance", "compared"]
            )

    assigned = written(in_batches(stored, run, f"vec_id {kind}, cluster int, distance bigint, compared int"), "assigned")
    sums = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.ints.tolist()]
    rows = [(c, min(d, MOST), min(sum(sums.values()), MOST), names[c]) for c, d in sorted(sums.items())]  # one per centroid
    facts = embeddings.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).drop("compared")


def _oracle() -> str:
    out = [
        "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER () AS r "
        f"FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE})",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS c, x AS m FROM "
        f"(SELECT * FROM v ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) LIMIT {CENTROIDS}))",
    ]
    for k in range(ROUNDS + 1):
        out.append(
            f"p{k} AS (SELECT r, c, list_sum(list_transform(list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{k})"
        )
        out.append(f"a{k} AS (SELECT r, c, d FROM p{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if k < ROUNDS:
            out.append(
                f"n{k} AS (SELECT c, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM a{k} JOIN v USING (r), "
                f"unnest(range(1, {SIZE} + 1)) AS t(i) GROUP BY c, i)"
            )
            out.append(
                f"c{k + 1} AS (SELECT c, coalesce(g.m, c{k}.m) AS m FROM c{k} LEFT JOIN (SELECT c, list(m ORDER BY i) AS m FROM n{k} GROUP BY c) g USING (c))"
            )
    return ",\n".join(out) + (
        f"\nSELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 "
        f"FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} USING (c)"
    )


ORACLE = _oracle()
