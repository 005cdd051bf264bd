import hashlib
import math
import random

import numpy as np
import pytest
from llm.conftest import SMALL, shown

from spanledger.llm import centroids as op

KIND = "vec_id bigint, embedding array<double>"


def expected(rows, centroids=16, rounds=3, size=64):
    kept = [
        (i, [max(-op.LIMIT, min(op.LIMIT, math.floor(64 * x))) for x in v]) for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    raw = lambda v: np.array(v, np.int32).tobytes().hex()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r), raw(r[1])))[:centroids]]

    def assign():
        for _, v in kept:
            yield min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(centres))

    for _ in range(rounds):
        own = [c for _, c in assign()]
        for c in set(own):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = list(assign())
    inertia = {c: sum(d for d, o in last if o == c) for _, c in last}
    most = (1 << 63) - 1
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centres]
    total = min(sum(inertia.values()), most)
    return sorted(((i, c, d, min(inertia[c], most), total, names[c]) for (i, _), (d, c) in zip(kept, last)), key=repr)


def got(frame, **how):
    return shown(op.cluster(frame, **how).drop("compared"))


def test_clusters_equal_brute_force_with_odd_rows(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    first = rows[0][1]
    rows += [
        (None, first), (None, first), (9001, first), (9001, first[::-1]), (9002, None), (9003, []), (9004, first[:63]), (9005, [*first, 0.0]),
        (9006, [None, *first[1:]]), (9007, [math.nan, *first[1:]]), (9008, [math.inf, *first[1:]]), (9009, [1e300, -1e300, *first[2:]]),
        (9010, [0.0] * 64), (9011, [-0.001] * 64), *((9100 + i, [0.25] * 64) for i in range(40)),
    ]
    frame = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS cluster", "2 AS rest", "3 AS ints").repartition(3)
    assert got(frame) == expected(rows)


@pytest.mark.parametrize("count", [0, 1, 5, 16])
def test_fewer_vectors_than_centroids_and_ties(spark, count):
    rows = [(i, [float(i % 2)] * 64) for i in range(count)]
    assert got(spark.createDataFrame(rows, KIND)) == expected(rows)


def test_bound_drops_centroids_and_loses_none(spark):
    random.seed(4)
    rows = [(i, [random.gauss(10 * (i % 20 == j) + 5 * (i % 7 == j), 1) for j in range(64)]) for i in range(400)]
    frame = spark.createDataFrame(rows, KIND)
    assert got(frame, leading=4) == expected(rows)
    compared = [r.compared for r in op.cluster(frame, leading=16).collect()]
    assert min(compared) >= 1 and sum(compared) < 8 * len(rows)


def test_bound_never_exceeds_the_distance():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-90, 90, (200, 64)), rng.integers(-op.LIMIT, op.LIMIT, (50, 64))]).astype(np.int32)
    mean, axes = x.mean(axis=0), np.linalg.qr(rng.normal(size=(64, 64)))[0]
    centres = op.Centres(x[::16], mean, axes, 8)
    lead, rest = op.turned(x.astype(np.float64), mean, axes, 8)
    own, distance, _ = centres.nearest(x, lead.astype(np.float32), rest)
    every = ((x.astype(object)[:, None, :] - x[::16].astype(object)[None]) ** 2).sum(axis=2)
    want = [min((d, c) for c, d in enumerate(row)) for row in every.tolist()]
    assert list(zip(distance.tolist(), own.tolist())) == want
