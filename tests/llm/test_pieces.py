import itertools

import numpy as np
import pytest
import sentencepiece
from llm.conftest import shown

from spanledger.llm import pieces as op


@pytest.fixture(scope="module")
def model():
    return op.read_model(op.default_model())


@pytest.fixture(scope="module")
def encoder(model):
    return op.Encoder(op.Vocabulary(model))


def brute(vocabulary, text):
    def rest(i):
        if i == len(text):
            yield 0.0, ()
        for b in range(i + 1, min(len(text), i + vocabulary.longest) + 1):
            found = vocabulary.pieces.get(text[i:b])
            if found or b == i + 1:
                own, ids = (found[1], (found[0],)) if found else (vocabulary.unknown, vocabulary.unknown_ids(text[i]))
                for score, more in rest(b):
                    yield own + score, ids + more

    return sorted(rest(0), reverse=True)


@pytest.mark.parametrize("text", ["the of and", "thnterble, 漢!", "a  b", "x\ny", " q ", "été!!", "\n\n", "ab ▁c", "🎉"])
def test_nbest_equals_all_segmentations(encoder, text):
    want = brute(encoder.vocabulary, op.MARK + text.replace(" ", op.MARK))
    lattice = op.Lattice(encoder.vocabulary, op.MARK + text.replace(" ", op.MARK)).nbest(8)
    got = encoder.nbest(text, 8)
    for some in (lattice, got):
        assert [s.score for s in some] == pytest.approx([s for s, _ in want[:8]], rel=1e-12)
        assert len({s.ids for s in some}) == len(some)
    assert {(s.score, s.ids) for s in lattice} <= set(want)


def test_the_library_decodes_every_segmentation(model, encoder):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in ["the thing", "thnterble onthsh", " quelle  maison", "漢字 🎉\n", "abcabcabc"]:
        assert {library.decode(list(s.ids)) for s in encoder.nbest(text, 4)} == {text}


def test_frames(spark, docs, documents, no_docs, model, encoder):
    encoded = op.encode(docs, model).cache()
    rows = encoded.collect()
    assert len(rows) == len(documents) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    assert shown(op.decode(encoded, model)) == sorted(((i, t or "") for i, t in documents), key=repr)
    for doc_id, text in documents[-12:]:
        want = encoder.nbest(text or "", op.NBEST)
        match = [r for r in rows if r.doc_id == doc_id and r.ids == encoder.encode(text or "")]
        assert match and match[0].nbest_scores == pytest.approx([s.score for s in want])
        assert match[0].nbest_pieces[0] == len(want[0].ids) and match[0].score <= match[0].nbest_scores[0] + 1e-6
    assert op.encode(no_docs, model).count() == 0


def test_ids_equal_the_library(spark, model, encoder):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["", " ", "  a", "a\n\n b\t", "x" * 3000, "ab" * 200 + " " * 90 + "é" * 70, "漢字🎉" * 40, "the\x00 of", "====" * 50]
    for text, want in zip(texts, library.encode(texts, num_threads=1)):
        assert encoder.encode(text) == want


def test_merges_of_many_units_at_once(encoder):
    vocabulary = encoder.vocabulary
    units = ["▁the", "x", "▁▁▁▁▁ab", "nterble", "====", "▁quelle", "aaaaaaaaaaaaaaaa", "▁", "▁été", "0123456789", "lllillil"]
    ids, sizes, scores = op.merge_batch(vocabulary, units)
    want = [op.merged(vocabulary, u) for u in units]
    assert [tuple(x) for x in np.split(ids, np.cumsum(sizes)[:-1])] == [w.ids for w in want]
    assert scores.tolist() == [w.score for w in want]


def test_other_models_take_the_best_segmentation(model, monkeypatch):
    vocabulary = op.Vocabulary(model)
    monkeypatch.setattr(vocabulary, "merges", False)
    other = op.Encoder(vocabulary)
    for text in ("the thing", "quelle maison 漢"):
        assert tuple(other.encode(text)) == other.nbest(text, 1)[0].ids


def test_a_full_cache_changes_nothing(model, encoder, documents):
    small = op.Encoder(encoder.vocabulary, 50)
    for _, text in itertools.islice(documents, 20):
        assert small.nbest(text, 3)[0] == encoder.nbest(text, 3)[0] and small.encode(text) == encoder.encode(text)


def test_little_memory_gives_the_same_rows(docs, model):
    assert sorted(map(repr, op.encode(docs, model, small=True).collect())) == sorted(map(repr, op.encode(docs, model).collect()))
