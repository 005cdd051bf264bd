from llm.conftest import shown

from spanledger.llm import url_filter as op

URLS = {
    "http://a.example.com/en/1?x=1#y": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "https://WWW.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
    "https://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
    "http://x.com": ("x.com", "", None, "allow"),
    "http://x.net/fr/1": ("x.net", "/fr/1", "net/fr/", "block"),
    "http://x.net/fr": ("x.net", "/fr", None, "allow"),
    "http://spam-farm.example.org/": ("spam-farm.example.org", "/", None, "block"),
    "http://spam-farm.example.com/": ("spam-farm.example.com", "/", "com/", "allow"),
    "http://my-spam-farm.org/": ("my-spam-farm.org", "/", None, "allow"),
    "http://ads.x.org/": ("ads.x.org", "/", None, "block"),
    "http://x.org/wp-login.php": ("x.org", "/wp-login.php", None, "block"),
    "http://x.org?a://b": ("x.org", "", None, "allow"),
    "x.com/en/": ("", "", None, "block"),
    "": ("", "", None, "block"),
    None: ("", "", None, "block"),
    "://": ("", "", None, "block"),
    "http://x.com:80/": ("x.com:80", "/", None, "allow"),
}


def test_verdicts(spark):
    rows = [(i % 7 or None, u) for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS rule", "2 AS token")
    assert shown(op.judge(pages)) == sorted(((i, *URLS[u]) for i, u in rows), key=repr)


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.sql("SELECT array('', 'example', 'com', 'en') AS tokens UNION ALL SELECT array('', 'com', 'en')")
    rules = op.rule_table(spark, [op.HostRule("block", "example.com/en/"), op.HostRule("allow", "com/")], [op.Pattern("x", ())])
    filed = {r.rule: r.token for r in op.file_rules(urls, rules).collect()}
    assert filed == {"example.com/en/": "example", "com/": "com", None: ""}


def test_plan_is_native_and_small_rules_are_optional(spark):
    pages = spark.createDataFrame([(1, "http://x.net/fr/1")], "page_id bigint, url string")
    assert shown(op.judge(pages, (), ())) == [(1, "x.net", "/fr/1", None, "allow")]
    assert "Python" not in op.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert op.judge(pages.limit(0)).count() == 0
