import math
from collections import Counter

import pyarrow as pa
import pytest
from llm.conftest import words_of
from pyspark.sql import functions as F

from spanledger.llm import lm_score as op


def expected(rows):
    docs = [(i, words_of(t)) for i, t in rows]
    count, total = Counter(), 0
    for _, w in docs:
        total += len(w)
        count.update(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    out = []
    for i, w in docs:
        score, backed = 0.0, 0
        for j in range(len(w)):
            for steps, n in enumerate(range(min(3, j + 1), 0, -1)):
                gram = tuple(w[j - n + 1 : j + 1])
                if n == 1 or count[gram] >= 2:
                    score += math.log(count[gram] / (count[gram[:-1]] if n > 1 else total)) + steps * math.log(0.4)
                    backed += steps > 0
                    break
        out.append((i, len(w), backed, score))
    return sorted(out, key=lambda x: (repr(x[0]), *x[1:]))


@pytest.mark.parametrize("sizes", [(6 << 20, 8 << 20), (50_000, 30_000)])
def test_scores_equal_brute_force(docs, documents, sizes):
    rows = op.score(docs, batch_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_backed, r.log_score) for r in rows), key=lambda x: (repr(x[0]), *x[1:]))
    want = expected(documents)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-9, abs=1e-9)
    assert all((r.mean_log is None) == (r.n_words == 0) for r in rows)


def test_empty_table(no_docs):
    assert op.score(no_docs).count() == 0


def test_repeats_of_a_row_are_one_document_in_their_batch(spark):
    rows = [(5, "a b c a b")] * 3000 + [(None, "a b c a b")] * 2 + [(6, "a b c a b"), (5, "b c"), (7, None), (7, "")]
    kinds = [("doc_id", pa.int64()), ("text", pa.string()), ("batch", pa.int64())]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t, "batch": 0} for i, t in rows], pa.schema(kinds))
    packed = pa.Table.from_batches(list(op._deal(iter([batch, batch]))))
    ids, texts, copies = op._documents(packed)
    assert list(zip(ids.to_pylist(), texts.to_pylist(), copies.tolist())) == [
        (5, b"a b c a b", 6000), (None, b"a b c a b", 4), (6, b"a b c a b", 2), (5, b"b c", 2), (7, b"", 4)
    ]


def test_scores_of_many_repeats_equal_brute_force(spark):
    few, often = [(6, "x b c a b"), (5, "b c"), (None, ""), (None, "")], 2 * op.REPEAT_ROWS + 7
    hot = spark.range(often).selectExpr("5L AS doc_id", "'a b c a b' AS text")
    got = op.score(hot.unionByName(spark.createDataFrame(few, "doc_id bigint, text string")), batch_bytes=50_000, bucket_bytes=200)
    want = {}
    for i, n, backed, score in expected([(5, "a b c a b")] * often + few):
        want.setdefault((i, n, backed), []).append(score)
    rows = got.groupBy("doc_id", "n_words", "n_backed").agg(F.count("*").alias("n"), F.min("log_score").alias("a"), F.max("log_score").alias("b"))
    found = {(r.doc_id, r.n_words, r.n_backed): (r.n, r.a, r.b) for r in rows.collect()}
    assert {k: len(v) for k, v in want.items()} == {k: v[0] for k, v in found.items()}
    assert all(found[k][1:] == pytest.approx((min(v), max(v)), rel=1e-9, abs=1e-9) for k, v in want.items())
