"""Verdicts against a direct search over the rules."""

from tapewire.llm.url_filter import judge_urls, rule_table

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.org", "/x", "block"), ("a.org", "/x", "allow"), ("b.org", "", "block"), ("", "", "allow"), (None, "/", "block"),
]
URLS = [
    None, "", "no scheme/net/", "http://NET", "http://net/", "https://A.Example.NET/en/x?y#z", "x://example.net/en", "http://notnet/",
    "http://a.org/xyz", "http://b.org", "http://c.b.org?q", "http://org/fr/#", "http://org./fr/", "http:///path", "http://..net/",
    "a://b://net/", "http://user@net:80/", "http://example.com/de/" + "p" * 50_000, "http://exämple.net/en/\nline", "://net/",
]


def expected(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = tail[: min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]
    fit = [
        (len(h + p), len(h), a == "block", h + p, a)
        for h, p, a in rules
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_equals_direct_search(spark):
    rows = [(i, u, "clash", "extra") for i, u in enumerate(URLS)] + [(5, URLS[5], None, None), (None, URLS[4], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, _row string")
    for rules in (RULES, RULES[:4]):
        got = judge_urls(pages, rule_table(spark, rules)).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected(r["url"], rules), r["url"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    none = rule_table(spark, [("x", "/", "block")]).limit(0)
    assert [r["verdict"] for r in judge_urls(pages, none).collect()] == ["allow"]
    assert judge_urls(pages.limit(0), rule_table(spark, RULES)).count() == 0
