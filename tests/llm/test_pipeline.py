import random

import pytest
from llm.conftest import LOWER, SMALL, WORD, shown, words_of
from llm.test_jaccard import shingles
from llm.test_suffix_dedup import covered

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, duck_connection
from spanledger.llm import pieces, quality_model
from spanledger.llm.common import table, written
from spanledger.llm.queries import ORACLES, QUERIES


def test_all_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck_connection(SMALL), SMALL, name, QUERIES, ORACLES) == ""


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        if name != "tokens":
            assert after.columns == first.columns
            ids = {r.doc_id for r in after.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and len(ids) > 0.5 * docs.count()
        docs = after
    assert all(r.round_trip for r in docs.collect())


def test_a_passage_is_repeated_from_its_bytes_on_not_from_its_words(spark):
    rng = random.Random(1)
    noise = lambda: "".join(rng.choice("abcdefghij ") for _ in range(300))
    short = " ".join(rng.choice("xyz") + rng.choice("xyzuvw") for _ in range(79))  # 79 words, 236 bytes
    texts = [noise() + "A" + short + "1" + noise(), noise() + "B" + short + "2" + noise()]
    texts += [noise() + "C" + short + "long" + "3" + noise(), noise() + "D" + short + "long" + "4" + noise()]
    want = [texts[0], texts[1], *(t.replace(short + "long", "") for t in texts[2:])]
    for some, left in ((texts[:2], want[:2]), (texts[2:], want[2:])):
        docs = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string")
        assert shown(corpus_pipeline.repeated_passages(spark, docs, "")) == list(enumerate(left))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of small tables with cases for each stage."""
    where = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect() if r.text)
    good = [t for i, t in rows if known.get(i) == 1 and 1500 < len(t) < 4000 and t.isascii()][:8]
    item = next(r.text for r in bench.orderBy("item_id").collect() if len(words_of(r.text)) >= 10)
    rows = [r for r in rows if known.get(r[0]) == 0][:30] + [r for r in rows if known.get(r[0]) != 0][:120]
    rows += [(10**6 + 1, good[0] + " tail"), (10**6 + 2, good[0] + " other tail"), (10**6 + 3, good[1] + " " + good[2][300:700])]
    rows += [(10**6 + 4, good[3] + " " + good[2][300:700] + "é"), (10**6 + 5, f"{good[4]} {item} {good[5]}"), (10**6 + 6, None), (10**6 + 7, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{where}/documents.parquet")
    labels.write.parquet(f"{where}/labels.parquet")
    bench.write.parquet(f"{where}/benchmark.parquet")
    return where, rows


def clean(spark, where, rows):
    model = quality_model.fit(table(spark, where, "documents"), table(spark, where, "labels"))
    scorer = quality_model.Scorer(model)
    return [(i, t) for i, t in rows if scorer.score(scorer.features((t or "").encode())) >= 0.3]


def one_of_each(spark, where, rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min(i, least.get(g, i))
    return [r for g, r in zip(group, rows) if least[g] == r[0]]


def without_repeats(spark, where, rows):
    raws = [(t or "").encode() for _, t in rows]
    left = [bytes(b for b, gone in zip(raw, marks) if not gone) for raw, marks in zip(raws, covered(raws, 240))]
    return [(i, t and raw.decode("utf-8", "ignore")) for (i, t), raw in zip(rows, left)]


def without_leaks(spark, where, rows):
    grams = set()
    for r in table(spark, where, "benchmark").collect():
        w = words_of(r.text)
        grams |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    out = []
    for i, text in rows:
        found = list(WORD.finditer((text or "").translate(LOWER)))
        w = [m.group() for m in found]
        hit = set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
        at, parts = 0, []
        for k in sorted(hit):  # with what is between two hit words
            parts.append(text[at : found[k].start()] if k - 1 not in hit else "")
            at = found[k].end()
        out.append((i, text and "".join(parts) + text[at:]))
    return out


def test_stages_and_run_equal_brute_force(spark, corpus):
    where, rows = corpus
    docs = table(spark, where, "documents")
    plain = [clean, one_of_each, without_repeats, without_leaks]
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain):
        after = want(spark, where, rows)
        assert after != rows, name
        docs = written(stage(spark, docs, where), f"test-{name}")
        assert shown(docs) == sorted(after, key=repr), name
        rows = after
    tokens = corpus_pipeline.run(spark, where)
    back = pieces.decode(tokens.select("doc_id", "ids"), pieces.read_model(pieces.default_model()))
    assert shown(back) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert all(r.round_trip for r in tokens.collect())


def test_stages_take_empty_tables_and_clashing_columns(spark, documents):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, "en", None, None) for i, t in [*documents[:25], *documents[-12:]]]
    extra = ("key", "_text_key", "spans", "digest", "score", "_rows", "n_words", "label", "base")
    for docs in (spark.createDataFrame([], kind), spark.createDataFrame(rows, kind)):
        docs = docs.selectExpr("*", *(f"'x' AS {c}" for c in extra))
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SMALL)
            if name != "tokens":
                assert after.columns == docs.columns, name
                assert after.filter(" OR ".join(f"{c} <> 'x'" for c in extra)).isEmpty(), name
            assert after.isEmpty() == docs.isEmpty(), name
