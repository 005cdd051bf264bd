import hashlib

from llm.conftest import SMALL, shown

from spanledger.llm import warc as op

INSIDE = (
    "x" * 500 + "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    "WARC/1.1\r\nfoo WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5000\r\n\r\nabc"
)


def expected(rows):
    last = {}
    for page_id, _, html in rows:
        key = html or ""
        last[key] = max((x for x in (last.get(key), page_id) if x is not None), default=None)
    out = []
    for page_id, _, html in rows:
        raw, to = (html or "").encode(), last[html or ""]
        revisit = len(raw) >= 1000 and page_id != to
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_with_records_inside_payloads_over_many_splits(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    rows = pages + [
        (10**6, "http://a\r\nb", INSIDE), (10**6 + 1, None, None), (10**6 + 2, "u", INSIDE * 300), (10**6 + 3, "u", INSIDE * 300),
        (10**6 + 4, "u", ""), (None, "u", "n" * 2000), (5_000_001, "u", "n" * 2000), (5_000_001, "u", "é" * 700),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert shown(op.round_trip(frame)) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_payloads_come_back_and_revisits_have_none(spark, tmp_path):
    rows = [(1, "u", INSIDE), (2, "u", "b" * 1200), (3, "u", "b" * 1200), (4, "u", "ü")]
    op.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"), str(tmp_path / "w"))
    got = {r.record_id: r.payload and bytes(r.payload).decode() for r in op.read(spark, str(tmp_path / "w")).collect()}
    assert got == {"<urn:page:1>": INSIDE, "<urn:page:2>": None, "<urn:page:3>": "b" * 1200, "<urn:page:4>": "ü"}


def test_no_pages(spark):
    assert op.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_copies_are_found_by_broadcast_and_by_shuffle(spark):
    rows = [(i, "u", "c" * 1500 if i % 3 else f"{i}" * 1200) for i in range(60)] + [(None, "u", "c" * 1500), (60, "u", None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    key = lambda r: (r.page_id is None, r.page_id)
    few, many = (sorted(op.with_revisits(frame, broadcast_rows=n).collect(), key=key) for n in (1, 0))
    assert few == many and [r.refers_to for r in few if r.is_revisit] == [59] * 40
