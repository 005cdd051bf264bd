import random

import pytest
from llm.conftest import shown, words_of

from spanledger.llm import jaccard as op


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, group = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    out = []
    for i in range(n):
        own = [k for k in range(n) if group[k] == group[i]]
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        out.append((rows[i][0], min(ids, default=None), len(own), links[i], len(sets[i])))
    return sorted(out, key=repr), len(set(group))


@pytest.mark.parametrize("block", [512, 16])
def test_join_equals_brute_force(spark, documents, block, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", block)
    random.seed(1)
    base = documents[5][1].split()[:130]
    rows = list(documents)
    for i in range(60):
        w = list(base)
        for _ in range(random.randint(0, 6)):
            w[random.randrange(len(w))] = random.choice(["foo", "bar", f"baz{i}"])
        rows.append((3_000_000 + i, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want, n_classes = expected(rows)
    assert shown(op.join(frame)) == want
    if block == 16:
        kept = op.keep_one(frame.selectExpr("*", "1 AS _text_key", "2 AS _rows"))
        assert kept.columns == ["doc_id", "text", "_text_key", "_rows"] and kept.count() == n_classes


def test_pairs_are_dropped_only_below_the_tolerance():
    least = op.least_matches(0.8, 1e-7)
    assert least[16] >= 1 and least[128] < 0.8 * 128 and sorted(least) == list(range(16, 129, 16))
    assert all(least[k] <= 0.8 * k for k in least)


def test_empty_table(no_docs):
    assert op.join(no_docs).count() == 0 and op.keep_one(no_docs).columns == no_docs.columns


def test_rows_without_an_id_ship_their_text_once(spark, monkeypatch):
    random.seed(2)
    base = [f"w{random.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(i % 3):
            w[random.randrange(len(w))] = f"x{i}"
        rows += [(None if i < 60 else 7, " ".join(w))] * (1 + i % 2)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    seen, real = [], op.in_batches

    def counting(df, run, schema, **how):
        if run is op._full_sets:
            seen.append((df.count(), df.select("digest").distinct().count()))
        return real(df, run, schema, **how)

    monkeypatch.setattr(op, "in_batches", counting)
    assert shown(op.join(frame)) == expected(rows)[0]
    (shipped, sets), = seen
    assert sets <= shipped <= len(rows)
