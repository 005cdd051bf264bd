import hashlib

import pytest
from llm.conftest import SMALL, shown, words_of

from spanledger.llm import decontaminate as op


def expected(rows, items, n=10):
    grams = {}
    for item, text in items:
        w = words_of(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else []:
            grams.setdefault(tuple(w[i : i + k]), set()).add(str(item) if item is not None else "null")
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        hit, found = set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    found |= grams[tuple(w[i : i + k])]
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), names, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark, documents):
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    return [*rows, (None, "One two"), (rows[0][0], rows[1][1]), (900, None), (901, ""), (902, " ".join(documents[3][1].split()[:14]))]


@pytest.mark.parametrize("block", [200_000, 300])
def test_report_equals_brute_force_in_one_and_in_several_blocks(spark, docs, documents, items, block):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = shown(op.report(docs, benchmark, block_grams=block))
    assert got == expected(documents, items)
    assert sum(r[5] for r in got) > 3


def test_spans_go_and_the_rest_stays(spark):
    docs = spark.createDataFrame(
        [(1, "Before. A b c d e f g h i j, after"), (2, "clean  text."), (3, None), (4, "a b c")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, "a B c d e f g h i j")], "item_id long, text string")
    assert shown(op.decontaminate(docs, items)) == [(1, "Before. , after"), (2, "clean  text."), (3, None), (4, "a b c")]
    assert shown(op.decontaminate(docs, items, whole=True), "doc_id") == [(2,), (3,), (4,)]


def test_empty_tables(spark, docs, no_docs, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r[5] for r in shown(op.report(docs, none))} == {False}
    assert op.report(no_docs, none).count() == 0
    assert op.decontaminate(docs, none).columns == docs.columns


def test_blocks_of_one_long_text(monkeypatch):
    import numpy as np

    from spanledger.llm import common

    text = ("word " * 3000 + "x" * 9000 + " end").encode()
    whole = common.Words(np.array([0, len(text)]), np.frombuffer(text, np.uint8)).hash
    monkeypatch.setattr(common, "BLOCK_BYTES", 1000)
    assert (common.Words(np.array([0, len(text)]), np.frombuffer(text, np.uint8)).hash == whole).all()
    assert len(whole) == 3002 and len(set(whole.tolist())) == 3
