"""Feed rows beside page records: every page is parsed once."""

from tapewire.operators import extract as ex

DATED = '<html><head><title>T</title><meta name="date" content="2024-02-02"></head><body><p>Body</p></body></html>'
BARE = "<html><head><title>U</title></head><body><p>Body</p></body></html>"


def test_enrich_parses_a_page_once_and_keeps_every_feed_row(spark):
    pages = spark.createDataFrame([(1, "u1", DATED), (2, "u2", BARE), (3, "u3", None)], "page_id long, url string, html string")
    rows = [(10, 1, "s", "own", "p"), (11, 2, "s", "own", ""), (12, 3, "s", "own", None), (13, 9, "s", "own", "p"), (14, 1, "s", "two", "p"), (15, None, "s", "own", "p")]
    feed = spark.createDataFrame(rows, "pos long, page_id long, source string, title string, published string")
    out = ex.enrich(feed, ex.page_records(pages), "now")
    # The filter on the status used to hold a second parse of the page with every field.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("fallbacks(") <= 1 and "regexp_extract" not in plan.split("Filter", 1)[-1].split("\n", 1)[0]
    got = {r["pos"]: (r["title"], r["published_at"], r["time_tier"]) for r in out.collect()}
    assert got == {
        10: ("T", "2024-02-01 07:00:00 PM EST", "tier1_http"),
        11: ("own", "now", "fast_fallback"),
        12: ("own", "now", "fast_fallback"),
        13: ("own", "p", "fast_fallback"),
        14: ("T", "2024-02-01 07:00:00 PM EST", "tier1_http"),
        15: ("own", "p", "fast_fallback"),
    }
