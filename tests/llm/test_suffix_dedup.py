import hashlib
import random

import numpy as np
import pytest
from llm.conftest import shown

from spanledger.llm import suffix_dedup as op


def covered(raws, length):
    seen = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    for raw in raws:
        marks = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        yield np.cumsum(marks)[: len(raw)] > 0


def runs_of(raw, gone):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
    return [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]


def expected(rows, length, passage=op.PASSAGE):
    raws = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), raw, gone, shared in zip(rows, raws, covered(raws, length), covered(raws, passage)):
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        words = [w for w in (len(x.split()) for x in runs_of(raw, shared)) if w > 50]
        out.append((
            doc_id, len(raw), int(gone.sum()), len(runs_of(raw, gone)), hashlib.sha256(kept).hexdigest(),
            int(shared.sum()), len(words), sum(words),
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("hot", "shard"), [(2048, 2 << 20), (5, 200_000)])
def test_report_equals_brute_force_in_one_shard_and_across_shards(spark, documents, hot, shard, monkeypatch):
    monkeypatch.setattr(op.repeats, "__defaults__", (op.LENGTH, op.ANCHOR, shard, hot))
    random.seed(3)
    noise = lambda: "".join(random.choice("abcdé \n") for _ in range(300))
    passage = documents[5][1][:700]
    rows = [*documents[:60], *documents[-12:], *((10**6 + i, noise() + passage + noise()) for i in range(40))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert shown(op.report(frame)) == expected(rows, op.LENGTH)


def test_suffix_array_and_common_prefixes():
    random.seed(5)
    parts = ["".join(random.choice("ab") for _ in range(random.randint(1, 40))) for _ in range(30)] + ["a" * 50, "a" * 50]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    whole, stop = data.tobytes(), np.repeat(ends, [len(p) for p in parts])
    suffix = [whole[i : stop[i]] for i in range(len(whole))]
    order = op.suffix_array(data, ends)
    assert order.tolist() == sorted(range(len(whole)), key=lambda i: (suffix[i], i))
    shared = op.common_prefixes(data, ends, order, 1000)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while n < min(len(suffix[a]), len(suffix[b])) and suffix[a][n] == suffix[b][n]:
            n += 1
        assert shared[b] == n


def test_pieces_of_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 500)
    random.seed(7)
    passage = "".join(random.choice("abcdefgh ") for _ in range(900))
    rows = [(1, "x y " * 100 + passage + "1 2 3 " * 90), (2, passage[:650] + "".join(random.choice("klm") for _ in range(800)))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    texts = [r.asDict() for r in op.segments(op.whole_texts(frame), 400, 96).collect()]
    assert sum(t["run"] for t in texts) == sum(len(t) - 399 for _, t in rows)


def test_removal_keeps_columns_and_whole_characters(spark, docs, no_docs):
    left = op.remove_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert op.remove_repeats(no_docs).count() == 0 and op.report(no_docs).count() == 0


def test_two_thousand_equal_rows_are_one_holder(spark, monkeypatch):
    random.seed(9)
    noise = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = noise(500)
    rows = [(5, noise(300) + passage + noise(200))] * 2000 + [(None, noise(100) + passage)] + [(7, noise(90) + passage[:450] + noise(50))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    seen, real = [], op.in_batches

    def counting(df, run, schema, **how):
        out = real(df, run, schema, **how)
        if "settled boolean" in schema:
            seen.append(out.groupBy("anchor", "digest").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(op, "in_batches", counting)
    assert shown(op.report(frame)) == expected(rows, op.LENGTH)
    assert seen and set(seen) <= {None, 1}


def test_a_text_of_more_than_a_megabyte(spark):
    random.seed(11)
    noise = lambda n: "".join(random.choices("abcdefghijklmnop qrstuvwxyz", k=n))
    passage = noise(1000)
    text = noise(700_000) + passage + noise(900_000) + "é" + passage[:500]
    rows = [(1, text), (2, noise(50) + passage[200:700]), (3, noise(5000))]
    got = {r.doc_id: r for r in op.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(got[i].n_removed, got[i].n_spans) for i in (1, 2, 3)] == [(700 + 500, 2), (500, 1), (0, 0)]


def test_a_shorter_limit_finds_passages_that_the_windows_do_not(spark):
    random.seed(13)
    words = lambda n: " ".join("".join(random.choices("abcdefghij", k=5)) for _ in range(n))
    passage = words(55)
    rows = [(1, words(40) + " " + passage + " " + words(9)), (2, passage + "\n" + words(70)), (3, words(200)), (4, words(10) + passage[:235])]
    got = {r.doc_id: r for r in op.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].n_passages for i in (1, 2, 3, 4)] == [1, 1, 0, 0] and all(got[i].n_removed == 0 for i in got)
    assert [got[i].n_passage_words for i in (1, 2, 3, 4)] == [55, 55, 0, 0]
