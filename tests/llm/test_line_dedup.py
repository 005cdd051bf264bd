import hashlib
from collections import defaultdict

import pytest
from llm.conftest import LOWER, shown

from spanledger.llm import line_dedup as op

BLANKS = " \t\n\x0b\x0c\r"


def kept_lines(rows, least, holders):
    """For every row its lines and which of them stay."""
    split = [(doc_id, (text or "").split("\n")) for doc_id, text in rows]
    held, keeper = defaultdict(set), {}
    for r, (doc_id, lines) in enumerate(split):
        for line in lines:
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= least:
                held[key].add(r)
                ids = [x for x in (keeper.get(key), doc_id) if x is not None]
                keeper[key] = max(ids, default=None)
    gone = {k for k, v in held.items() if len(v) >= holders}
    for doc_id, lines in split:
        yield doc_id, lines, [k not in gone or keeper[k] == doc_id for k in (x.strip(BLANKS).translate(LOWER) for x in lines)]


def expected(rows, least=op.LEAST, holders=op.HOLDERS):
    out = []
    for doc_id, lines, stays in kept_lines(rows, least, holders):
        text = "\n".join(x for x, s in zip(lines, stays) if s)
        out.append((doc_id, len(lines), stays.count(False), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COMMON = "Subscribe to our newsletter to read this and more, é"
ODD = [
    *((3_000_000 + i, f"own {i}\n {COMMON.upper() if i % 2 else COMMON}\t\n\n{COMMON}\r\nend") for i in range(9)),
    (None, COMMON), (None, f"{COMMON}\n"), (3_000_008, COMMON), (3_000_008, COMMON), (3_100_000, "\n\n"),
    (3_100_001, "\n".join(f"line {i % 700} of a text that repeats its own lines" for i in range(3000))),
    *((None, "held by rows without an id only, and by enough of them") for _ in range(6)),
]


@pytest.mark.parametrize(("least", "holders", "batches", "fan"), [(40, 5, 4, 2), (12, 2, 7, 3), (1, 1, 1, 2)])
def test_report_equals_brute_force(spark, documents, least, holders, batches, fan):
    rows = documents + ODD
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert shown(op.report(frame, least, holders, batches, fan)) == expected(rows, least, holders)


def test_lines_go_from_texts_and_columns_pass(spark, docs, documents, no_docs):
    got = op.dedup_lines(docs, 12, 2)
    assert got.columns == docs.columns
    want = []
    for (doc_id, text), (_, lines, stays) in zip(documents, kept_lines(documents, 12, 2)):
        want.append((doc_id, text if all(stays) else "\n".join(x for x, s in zip(lines, stays) if s)))
    assert shown(got, "doc_id", "text") == sorted(want, key=repr)
    assert op.report(no_docs).count() == 0 and op.dedup_lines(no_docs).columns == no_docs.columns


def test_runs_are_compacted_by_level_and_leave_nothing_behind(spark):
    before = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    runs = op.Runs(spark, 3, 2)
    try:
        for first in range(0, 50, 10):
            batch = spark.range(first, first + 15).selectExpr("unhex(md5(cast(id AS string))) AS digest", "1L AS n", f"{100 - first}L AS doc_id")
            runs.add(batch)
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        whole = op.merged(runs.tables())
        assert whole.count() == 55 and whole.filter("fresh").count() == 55 and whole.agg({"n": "sum"}).first()[0] == 75
        assert whole.filter("digest = unhex(md5('12'))").first().keeper == 100  # the batch that had it first
    finally:
        runs.drop()
    assert {r.namespace for r in spark.sql("SHOW DATABASES").collect()} == before


def test_a_run_is_joined_without_moving_it(spark):
    runs = op.Runs(spark, 3)
    try:
        digests = spark.range(100).selectExpr("unhex(md5(cast(id AS string))) AS digest", "1L AS n", "id AS doc_id")
        runs.add(digests)
        fresh = digests.repartition(3, "digest").join(runs.tables()[0].filter("fresh").hint("merge"), "digest", "left_anti")
        assert fresh._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        runs.drop()


def test_a_very_long_text(spark):
    text = "\n".join(f"row {i % 9000} of a very long table, wider than the least width" for i in range(40_000))
    rows = [(i, text if i < 2 else f"x{i}\nrow 7 of a very long table, wider than the least width") for i in range(7)]
    assert shown(op.report(spark.createDataFrame(rows, "doc_id bigint, text string"))) == expected(rows)
