import hashlib
import zlib
from collections import defaultdict

import pytest
from llm.conftest import LOWER, SMALL, shown

from spanledger.llm import merkle as op


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def item(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(hashes, fan):
    """Top hash, and for every leaf its siblings before and after it, level by level."""
    paths, nodes, at = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            low = i - i % fan
            path.append(("".join(nodes[low:i]), "".join(nodes[i + 1 : low + fan])))
        nodes, at = [H(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)], [i // fan for i in at]
    return (nodes or [None])[0], paths


def expected(rows, fan=16):
    by_source = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = H(*map(item, (doc_id, source, lang, n_chars, text)))
        changed = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            changed = H(*map(item, (doc_id, source, lang, n_chars, text.translate(LOWER))))
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, changed, doc_id))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])], fan) for s in sources}
    root, upper = tree([trees[s][0] for s in sources], fan)
    out = []
    for s, above in zip(sources, upper):
        subroot, paths = trees[s]
        for (_, _, leaf, changed, doc_id), path in zip(sorted(by_source[s]), paths):
            node = changed
            for before, after in path + above:
                node = H(before, node, after)
            out.append((doc_id, leaf, subroot, root, H(*(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def rows_of(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    odd = [
        (None, None, None, None, None), (None, None, None, None, None), (7, None, "de", 3, "ÄB c"), (7, "", "de", None, ""), (-5, "one", "", 0, "X"),
        (8, "é", "en", 1, None), (9, "z" * 300, "en", 1, "A" * 200_000), (9, "z" * 300, "en", 1, "A" * 200_000),
    ]
    return rows + odd + [(10_000 + i, "hot", "en", i, f"Text {i}") for i in range(530)]


@pytest.mark.parametrize("fan", [16, 3])
def test_report_equals_brute_force(spark, monkeypatch, fan):
    monkeypatch.setattr(op, "FANOUT", fan)
    rows = rows_of(spark)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS grp", "'x' AS leaf", "2 AS at", "3 AS salt").repartition(5)
    got = op.report(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = expected(rows, fan)
    assert shown(got) == want and {r[-1] for r in want} == {True, False}


def test_a_lone_document_a_lone_source_and_none(spark):
    for rows in ([(1, "s", "en", 1, "Ab")], [(i, None, "en", 1, "b") for i in range(17)], [(i, f"s{i}", "en", 1, "Q") for i in range(18)]):
        assert shown(op.report(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    assert op.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(4, "s", "en", 1, "same")] * 300 + [(5, "s", "en", 1, "other")]
    assert shown(op.report(spark.createDataFrame(rows, SCHEMA).repartition(6))) == expected(rows)


def test_manifest_holds_every_node_above_the_leaves(spark):
    rows = rows_of(spark)
    manifest = op.Manifest(spark.createDataFrame(rows, SCHEMA))
    nodes = manifest.table().collect()
    hot = sorted((n.level, n.idx) for n in nodes if n.source == "hot")
    assert hot == [*((1, i) for i in range(34)), *((2, i) for i in range(3)), (3, 0)]
    top = max((n for n in nodes if n.tier == "top"), key=lambda n: n.level)
    assert top.hash == expected(rows)[0][3]
