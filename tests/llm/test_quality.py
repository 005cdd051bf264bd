import random
import re

import pytest
from llm.conftest import SMALL, shown
from pyspark.sql import functions as F

from spanledger.llm import quality_model as model
from spanledger.llm import quality_rules as rules
from spanledger.llm.common import table

BLANK = re.compile("[ \t-\r]+")


def measured(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice),
        len(words) < 10 or 100 * len(twice) > 20 * len(words),
    )


def test_measures_equal_brute_force(spark, docs, documents):
    rows = [(i, t) for i, t in documents if len(t or "") < 6000] + [(7, "a b c d e a b c d e\x0bx\u00a0y\nl\nl \nl"), (8, "w " * 40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = rules.judge(frame).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert shown(got) == sorted(((i, *measured(t)) for i, t in rows), key=repr)


def test_rules_keep_clean_documents_and_drop_junk(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = rules.judge(docs).join(labels, "doc_id").select("quality", "kept").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.1


def test_rules_without_python_and_on_an_empty_table(no_docs, docs):
    assert rules.judge(no_docs).count() == 0
    assert "Python" not in rules.judge(docs)._jdf.queryExecution().executedPlan().toString()


def test_maximisation_finds_a_useless_rule():
    votes = {(-1, -1, 0): 200, (0, 0, 0): 700, (-1, -1, 1): 30, (0, 0, 1): 40, (0, 0, -1): 100}
    _, weights = rules.fit(list(votes.items()))
    assert weights[0] > 2 and weights[1] > 2 and weights[2] < 1


def test_classifier_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = model.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = ([r.predicted for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def test_held_out_labels_are_never_read(spark, docs):
    labels = table(spark, SMALL, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) AS quality")
    assert shown(model.score(docs, labels)) == shown(model.score(docs, turned))


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (2, 0)]])
def test_classifier_without_both_classes(spark, docs, no_docs, labels):
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = model.score(docs, frame).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows}) == 1
    assert model.filter_quality(no_docs, frame).count() == 0
    assert model.filter_quality(docs, frame).columns == docs.columns


def labelled(spark, sample):
    """Documents, labels, and the rows of good ids of the sample in its order."""
    docs, labels = table(spark, SMALL, "documents").select("doc_id", "text"), table(spark, SMALL, "labels")
    good = labels.filter("quality = 1").filter(model.bucket(labels.doc_id) != 0).join(docs, "doc_id")
    return docs, labels, good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()


def test_repeated_labels_and_rows_do_not_push_others_out_of_the_sample(spark):
    docs, labels, good = labelled(spark, 20)
    plain = model.fit(docs, labels, 20)
    hot = labels.filter(labels.doc_id == good[3].doc_id).crossJoin(spark.range(50)).drop("id")
    assert model.fit(docs, labels.unionByName(hot), 20) == plain
    for k in (2, 3):  # one makes the dictionary, one the curve
        hot = docs.filter(docs.doc_id == good[k].doc_id).crossJoin(spark.range(100)).drop("id")
        assert model.fit(docs.unionByName(hot), labels, 20) == plain


def test_all_texts_of_a_document_count_in_the_curve(spark):
    docs, labels, good = labelled(spark, 20)
    more = [(good[3].doc_id, f"{i} " + good[(i * 7) % 20].text[:400]) for i in range(150)]
    got = model.fit(docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string")), labels, 20)
    plain = model.fit(docs, labels, 20)
    assert got[:2] == plain[:2]
    texts, quality = {}, {r.doc_id: r.quality for r in labels.collect()}
    for i, t in [tuple(r) for r in docs.collect()] + more:
        texts.setdefault(i, []).append((t or "").encode())
    order = [r.doc_id for r in labels.filter(model.bucket(labels.doc_id) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    scorer, points = model.Scorer(plain), []
    curve = {i for q in (0, 1) for i in [i for i in order if quality[i] == q and any(texts.get(i, []))][:20][1::2]}
    for i in (i for i in order if i in curve):
        size, a, b = (sum(x) for x in zip(*(scorer.sizes(t) for t in texts[i])))
        points.append(((b - a) / size, (b - a) / (a + b), (a + b) / size))
    assert got.weights == pytest.approx(model._curve(points, [quality[i] for i in order if i in curve]), rel=1e-9)


def test_junk_below_a_clean_beginning_is_learnt(spark):
    rng = random.Random(2)
    clean = [f"{rng.choice('bdfglmnprst')}{rng.choice('aeiou')}{rng.choice('bdfglmnprst')}{rng.choice('aeiou')}" for _ in range(400)]
    junk = ["BUY", "NOW!!", "$$$", "click", "here>>", "WIN", "www.", "free%%"]
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, i % 2, text(clean, 900) + " " + text(clean if i % 2 else junk, 900)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, quality int, text string")
    scored = model.score(frame.select("doc_id", "text"), frame.select("doc_id", "quality")).filter("held_out").collect()
    assert len(scored) > 20 and all(r.predicted == r.doc_id % 2 for r in scored)
