"""Operators against plain Python on small inputs, edge rows and plans."""

import collections
import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapewire.functions import pages as pg
from tapewire.functions import text as tx
from tapewire.functions import times as tm
from tapewire.functions import urls as ur
from tapewire.operators import backtest as bt
from tapewire.operators import cluster as cl
from tapewire.operators import dedup as dd
from tapewire.operators import evaluate as ev
from tapewire.operators import joins as jn
from tapewire.operators import learn as ln
from tapewire.operators import ordering as od
from tapewire.operators import portfolio as pf
from tapewire.operators import quality as ql
from tapewire.operators import risk as rk
from tapewire.operators import timeseries as ts
from tapewire.operators import vectorize as vz


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


def greedy(rows):
    kept, a_seen, b_seen = [], set(), set()
    for a, b, pos in rows:
        if a not in a_seen and b not in b_seen:
            kept.append(pos)
            a_seen.add(a)
            b_seen.add(b)
    return kept


def test_greedy_keeps_rows_one_and_three(spark):
    rows = [("u1", "t1", 1), ("u2", "t1", 2), ("u2", "t2", 3)]
    out = dd.greedy_two_key(spark.createDataFrame(rows, "u string, t string, pos bigint"), "u", "t", "pos")
    assert sorted(r.pos for r in out.collect()) == [1, 3]


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_equals_a_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(12)}", f"t{rng.randrange(12)}", i) for i in range(60)]
    rows += [("hot", "hot", 100 + i) for i in range(60)]
    out = dd.greedy_two_key(spark.createDataFrame(rows, "u string, t string, pos bigint"), "u", "t", "pos")
    assert sorted(r.pos for r in out.collect()) == greedy(rows)


def test_mark_repeats_and_group_limit(spark):
    rows = [("a", i) for i in range(5)] + [("b", 9)]
    df = spark.createDataFrame(rows, "k string, pos bigint")
    assert {r.pos for r in dd.mark_repeats(df, "k", "pos").where("repeat").collect()} == {1, 2, 3, 4}
    plan = dd.keep_first(df, ["k"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lookup_join_is_the_same_broadcast_or_salted(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"))
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        small = jn.lookup_join(facts, lookup, ["k"], ["id"], how)
        salted = jn.lookup_join(facts, lookup, ["k"], ["id"], how, max_rows=1, salts=4)
        key = lambda r: (r.id, r.k, r.v)
        assert sorted(map(key, small.collect()), key=repr) == sorted(map(key, salted.collect()), key=repr)


def test_quantiles_and_ids_with_one_value_filling_a_third(spark):
    values = [5.0] * 40 + [float(i) for i in range(80)]
    df = spark.createDataFrame([("x", v) for v in values] + [("y", 1.0)], "g string, v double")
    got = {r.g: r for r in od.exact_quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}).collect()}
    for name, p in (("q1", 25), ("q2", 50), ("q9", 90)):
        assert math.isclose(got["x"][name], np.percentile(values, p))
        assert got["y"][name] == 1.0
    ids = od.sequential_id(spark.range(500).select((500 - F.col("id")).alias("o")), ["o"]).collect()
    assert all(r.id == r.o for r in ids)


def test_stratified_shares(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("y"))
    parts = ev.stratified_parts(df, "y", "id", {"train": 0.8, "test": 1.0}).groupBy("y", "part").count().collect()
    got = {(r.y, r.part): r["count"] for r in parts}
    assert abs(got[(True, "train")] - 0.8 * 334) <= 1 and abs(got[(False, "train")] - 0.8 * 666) <= 1


def test_capped_weights(spark):
    rng = random.Random(3)
    scores = [(f"n{i:02d}", rng.random() ** 4) for i in range(30)] + [("zero", 0.0), ("minus", -1.0)]
    out = pf.capped_weights(spark.createDataFrame(scores, "ticker string, score double")).collect()
    weights = {r.ticker: r.weight for r in out}
    assert math.isclose(sum(weights.values()), 1.0) and max(weights.values()) <= 0.05 + 1e-12
    assert weights["zero"] == weights["minus"] == 0.0
    free = [n for n, s in scores if 0 < weights[n] < 0.05 - 1e-12]
    ratios = {round(weights[n] / dict(scores)[n], 9) for n in free}
    assert len(ratios) == 1


def test_shrinkage_against_numpy(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    day = datetime.date(2020, 1, 1)
    rows = [(f"t{j}", day + datetime.timedelta(days=i), float(data[i, j])) for i in range(300) for j in range(4)]
    fit = rk.ledoit_wolf(spark.createDataFrame(rows, "ticker string, dt date, ret double")).first()
    x = data - data.mean(axis=0)
    n, p = x.shape
    s = x.T @ x / n
    mu = np.trace(s) / p
    delta = ((s - mu * np.eye(p)) ** 2).sum() / p
    beta = sum(((np.outer(r, r) - s) ** 2).sum() for r in x) / (n * n * p)
    assert math.isclose(fit["shrinkage"], min(beta, delta) / delta, rel_tol=1e-9)


def bars_frame(spark, closes):
    day = datetime.date(2020, 1, 1)
    rows = [
        (t, day + datetime.timedelta(days=i), c, c, c, c, 10.0) for t, values in closes.items() for i, c in enumerate(values)
    ]
    return spark.createDataFrame(rows, "ticker string, dt date, open double, high double, low double, close double, volume double")


def test_edge_tickers(spark):
    bars = bars_frame(spark, {"one": [1.0], "flat": [2.0] * 30, "zero": [0.0, 1.0, 1.0]})
    assert ts.next_day_label(bars).where("ticker = 'one'").count() == 0
    flat = ts.price_features(bars, complete_only=False).where("ticker = 'flat'").collect()
    assert all(r.volume_z_20d is None and r.rsi_14 is None for r in flat)
    assert ts.returns(bars, (1,)).where("ticker = 'zero'").orderBy("dt").collect()[1].return_1d is None


def test_features_use_one_exchange(spark):
    bars = bars_frame(spark, {"a": [1.0, 2.0], "b": [3.0, 4.0]})
    plan = ts.price_features(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_drawdown_and_summary(spark):
    day = datetime.date(2020, 1, 1)
    moves = [0.1, -0.5, 0.2, 0.3]
    daily = spark.createDataFrame([("s", day + datetime.timedelta(days=i), r) for i, r in enumerate(moves)], "strategy string, dt date, ret double")
    out = bt.summary(daily).first()
    assert math.isclose(out.max_drawdown, -0.5) and math.isclose(out.total_growth, 1.1 * 0.5 * 1.2 * 1.3)


def test_tfidf_against_python(spark):
    texts = ["Red red blue", "blue sky x", "", "été sky"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    got = {(r.id, r.feature): r.tfidf for r in vz.tfidf(docs, "id", "t", vz.Settings()).collect()}
    df = {"red": 1, "blue": 2, "sky": 2, "été": 1}
    idf = {t: math.log(5 / (1 + n)) + 1 for t, n in df.items()}
    norm = math.hypot(2 * idf["red"], idf["blue"])
    assert math.isclose(got[(0, "red")], 2 * idf["red"] / norm)
    assert set(got) == {(0, "red"), (0, "blue"), (1, "blue"), (1, "sky"), (3, "été"), (3, "sky")}
    pairs = vz.term_counts(docs, "id", "t", vz.Settings(bigrams=True)).where("id = 0").collect()
    assert {(r.feature, r.tf) for r in pairs} == {("red", 2), ("blue", 1), ("red red", 1), ("red blue", 1)}


def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    points = [(i, i % 3, (rng.normal(size=3) + i % 3).tolist()) for i in range(40)]
    got = {r.id: r.silhouette for r in cl.silhouette(spark.createDataFrame(points, "id int, cluster int, v array<double>"), "id").collect()}
    v, c = np.array([p[2] for p in points]), np.array([p[1] for p in points])
    d = ((v[:, None] - v[None]) ** 2).sum(axis=2)
    for i in range(40):
        a = d[i][(c == c[i]) & (np.arange(40) != i)].mean()
        b = min(d[i][c == k].mean() for k in range(3) if k != c[i])
        assert math.isclose(got[i], (b - a) / max(a, b), rel_tol=1e-9)


def test_svd_reproduces_the_leading_values(spark):
    rng = np.random.default_rng(2)
    m = rng.random((30, 6))
    rows = [(i, f"f{j}", float(m[i, j])) for i in range(30) for j in range(6)]
    embedded, values = ln.truncated_svd(spark.createDataFrame(rows, "id int, feature string, tfidf double"), "id", 3)
    assert np.allclose(values, np.linalg.svd(m, compute_uv=False)[:3])
    assert np.allclose(np.linalg.norm([r.embedding for r in embedded.collect()], axis=0), values)


def test_kmeans_beats_one_cluster_and_search_ranks(spark):
    points = [(i, [float(i % 2) * 10 + i * 0.01, 1.0]) for i in range(40)]
    df = cl.with_features(spark.createDataFrame(points, "id int, v array<double>"), "v")
    sweep = cl.kmeans_sweep(df, [2, 3], restarts=2).collect()
    assert sweep[0].silhouette > 0.9 and sweep[1].inertia <= sweep[0].inertia
    folded = df.select("id", "features", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 5).alias("fold"))
    ranked = ln.search(ln.forest(5, 3), ln.grid({"maxDepth": [1, 2]}), folded, "macro_f1").collect()
    assert {r["rank"] for r in ranked} == {1, 2} and ranked[0].mean_test == 1.0
    assert ln.out_of_fold(ln.boosted(2), folded, "id").count() == 40
    assert len(ln.grid(ln.GBT_GRID)) == 81 and len(ln.draws(ln.FOREST_SPACE)) == 25


def test_confusion_has_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    assert {(r.actual, r.predicted, r.n) for r in ev.confusion(df).collect()} == {(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0)}
    assert ev.class_report(df).where("class = 1").first().f1 == 0.0


@pytest.mark.parametrize(
    "value, want",
    [("Ã©tÃ©", "été"), ("plain", "plain"), ("a – b", "a – b"), ("é", "é"), ("", "")],
)
def test_mojibake(spark, value, want):
    assert one(spark, value, tx.fix_mojibake) == want


@pytest.mark.parametrize(
    "url, valid, canonical",
    [
        ("", False, ""), ("ftp://x", False, "ftp://x"), ("http://", False, "http:"),
        ("HTTPS://A.com/B/?q=1#f", True, "https://a.com/B"), (" https://wsj.com/x ", True, "https://wsj.com/x"),
    ],
)
def test_urls(spark, url, valid, canonical):
    assert one(spark, url, ur.is_valid) is valid
    assert one(spark, url, ur.canonical) == canonical
    assert one(spark, "https://www.wsj.com/x", ur.domain) == "wsj.com"


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-02T03:04:05Z", "2024-01-01 10:04:05 PM EST"), ("2024-07-01T12:00:00+0200", "2024-07-01 06:00:00 AM EDT"),
        ("Jan 5, 2024 at 3:04 PM", "2024-01-05 03:04:00 PM EST"), ("January 5, 2024", "2024-01-05 12:00:00 PM EST"),
        ("2024-01-02T03:04:05.1234567Z", "2024-01-01 10:04:05 PM EST"), ("junk", None), (None, None),
    ],
)
def test_dates(spark, text, want):
    assert one(spark, text, lambda c: tm.eastern(tm.any_timestamp(c))) == want


def test_headline_and_author(spark):
    assert one(spark, "Big  news - Reuters", tx.headline) == "Big news"
    assert one(spark, "Rates &amp; bonds | Daily Post", tx.headline) == "Rates & bonds"
    assert one(spark, "By  Jane Doe", lambda c: tx.author_name(c, F.lit("CNN"))) == "Jane Doe"
    assert one(spark, "admin", lambda c: tx.author_name(c, F.lit("CNN"))) == "CNN Staff"
    assert one(spark, None, lambda c: tx.author_name(c, F.lit(""))) == "Unknown"


def test_page_edges(spark):
    html = '<body><p class="a">One<p>Two <b>x</b></p><script>var p="<p>no</p>"</script></body>'
    assert one(spark, html, pg.body_text) == "One Two x"
    walked = one(spark, '<a rel="author">Ann <i>B</i></a><time>today</time>', pg.fallbacks)
    assert walked.byline == "AnnB" and walked.times == ["today"]
    assert one(spark, "", pg.is_blocked) is True
    assert one(spark, '<script type="application/ld+json">{bad</script>', lambda c: F.size(pg.ld_items(c))) == 0


def test_reports(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, "b"), (None, "a"), (4.0, "a"), (3.0, "b")], "x double, s string")
    filled = ql.imputed(df, ["x"], ["s"]).collect()
    assert filled[2].x == 2.5 and filled[0].s == "a"
    assert ql.duplicate_profile(df, {"s": ["s"]}).first().n_duplicates == 2
    with pytest.raises(ValueError):
        ql.require_columns(df, ["absent"])


def test_iso_stamps_with_fraction_and_offset(spark):
    from tapewire.functions.times import iso_timestamp

    stamps = {
        "2024-01-05T10:00:00.123+02:00": "08:00:00.123000", "2024-01-05T10:00:00.123456+0200": "08:00:00.123456", "2024-01-05T10:00": "10:00:00.000000",
        "2024-01-05T10:00:00.123456789Z": "10:00:00.123456", "2024-01-05 10:00:00.5": "10:00:00.500000", "2024-01-05T10:00-05:00": "15:00:00.000000",
        "2024-01-05": "00:00:00.000000", "2024-13-05T10:00": None, "soon": None,
    }
    df = spark.createDataFrame(list(stamps.items()), "s string, want string")
    rows = df.select("s", "want", F.date_format(iso_timestamp(F.col("s")), "HH:mm:ss.SSSSSS").alias("got")).collect()
    assert {r["s"]: r["got"] for r in rows} == stamps


def test_links_with_dot_segments(spark):
    from urllib.parse import urljoin

    from tapewire.functions.urls import resolve

    bases, links = ["https://a.com/x/y/z", "https://a.com/"], ["../b/c", "./d", "..", "../../../e?q=../r", "/f/./g/../h", "i/..", "https://b.org/k/../l", "plain"]
    df = spark.createDataFrame([(b, x) for b in bases for x in links], "base string, link string")
    for r in df.select("*", resolve(F.col("link"), F.col("base")).alias("got")).collect():
        assert r["got"] == urljoin(r["base"], r["link"]), r


def test_null_groups_are_kept(spark):
    from tapewire.operators.dedup import mark_repeats
    from tapewire.operators.ordering import exact_quantiles, hashed_rank, running_total

    df = spark.createDataFrame([(i, None if i % 3 == 0 else "g", float(i)) for i in range(30)], "k long, g string, v double")
    assert running_total(df, ["g"], ["k"], F.lit(1)).count() == 30
    assert hashed_rank(df, ["g"], "k").where("group_size = 10 AND g IS NULL").count() == 10
    assert {r["g"]: r["q"] for r in exact_quantiles(df, ["g"], "v", {"q": 0.5}).collect()} == {None: 13.5, "g": 15.0}
    assert mark_repeats(df, "g", "k").where("repeat").count() == 19


def test_weights_fall_back_to_reach_one(spark):
    from tapewire.operators.portfolio import capped_weights

    rows = [(g, f"t{i}", 1.0 if i < (10 if g == "few" else 22) else -1.0, 1.0 + i) for g in ("few", "many") for i in range(25)]
    df = spark.createDataFrame(rows, "g string, ticker string, score double, calm double")
    total = capped_weights(df, 0.05, ["g"], fallback="calm").groupBy("g").agg(F.sum("weight").alias("w"), F.max("weight").alias("m"))
    assert all(abs(r["w"] - 1) < 1e-9 and r["m"] <= 0.05 + 1e-12 for r in total.collect())


def test_attributes_in_every_quoting(spark):
    html = """<meta name='author' content='Al "B" Cox'><meta name=date content=2024-01-02><META content="x" NAME = "byl"><meta name="bare">"""
    tags = one(spark, html, pg.meta_tags)
    assert [(t.key, t.content) for t in tags] == [("author", 'Al "B" Cox'), ("date", "2024-01-02"), ("byl", "x"), ("bare", "")]


@pytest.mark.parametrize(
    "html, byline",
    [
        ('<p class="byline">Hal Ives<p>Body one<p>two', "Hal Ives"),
        ('<div><p class="byline">Hal Ives</div>Body', "Hal Ives"),
        ('<ul><li class=author>Jo <b>Fry</b><li>next</ul>', "JoFry"),
        ('<span class="byline">Ann</b> Lee</span>Body', "AnnLee"),
        ('<div class="byline"><p>Ann<p>Lee</div>Body', "AnnLee"),
    ],
)
def test_byline_ends_with_its_element(spark, html, byline):
    assert one(spark, html, pg.fallbacks).byline == byline


def test_listed_authors(spark):
    row = spark.createDataFrame([([" By Ann Lee ", None, "", "Bo Ray"],), ([],), (None,)], "a array<string>")
    names = [r[0] for r in row.select(tx.author_name(tx.listed_authors(F.col("a")), F.lit("BBC"))).collect()]
    assert names[:2] == ["Ann Lee, Bo Ray", "BBC Staff"]


def test_cleaning_report_counts_texts_once(spark):
    text = "word " * 20
    rows = [(1, "u1", "t", text), (2, "u1", "t", text), (3, "u2", "t ", text), (4, "u3", "o", text), (5, "u4", "o", "short"), (6, None, None, None)]
    report = ql.cleaning_report(spark.createDataFrame(rows, "pos long, url string, title string, content string"))
    assert [(r.stage, r.rows_after) for r in report.collect()] == [("unique_url", 5), ("filled", 4), ("long_enough", 3), ("unique_text", 2)]


def test_best_labels_finds_the_number_of_blobs(spark):
    rng = random.Random(1)
    rows = [(i, [float(10 * (i % 3)) + rng.random(), rng.random()]) for i in range(60)]
    points = cl.with_features(spark.createDataFrame(rows, "id int, v array<double>"), "v")
    for label in (cl.kmeans_labels, cl.hierarchical_labels):
        labels, k, score = cl.best_labels(points, label, [2, 3, 4])
        assert k == 3 and score > 0.9
        assert labels.groupBy("cluster").count().count() == 3


def test_tfidf_weighs_rows_in_place_and_joins_large_vocabularies_without_copies(spark, monkeypatch):
    texts = ["red red blue the", "blue sky x the", "", None, "été sky the red blue", "red sky red sky red", "blue the sky"]
    settings = vz.Settings(bigrams=True, min_df=2, max_df=0.9, sublinear=True, stop_words=("the",))
    for ids in (list(range(7)), [0, 1, 2, 3, 1, 5, None]):  # ids once each, or repeated and null
        docs = spark.createDataFrame(list(zip(ids, texts)), "id bigint, t string")
        words = [[w for w in (t or "").split() if len(w) > 1 and w != "the"] for t in texts]
        terms = [collections.Counter(w + [" ".join(p) for p in zip(w, w[1:])]) for w in words]
        df = collections.Counter(t for c in terms for t in c)
        weight = [{t: (1 + math.log(n)) * (math.log(8 / (1 + df[t])) + 1) for t, n in c.items() if 2 <= df[t] <= 6.3} for c in terms]
        norm = collections.Counter()
        for i, w in zip(ids, weight):
            norm[i] += sum(x * x for x in w.values())
        want = sorted((str(i), t, round(x / math.sqrt(norm[i]), 9)) for i, w in zip(ids, weight) for t, x in w.items())
        plans = []
        for limit in (vz.BROADCAST_ROWS, 3):
            monkeypatch.setattr(vz, "BROADCAST_ROWS", limit)
            out = vz.tfidf(docs, "id", "t", settings)
            assert sorted((str(r.id), r.feature, round(r.tfidf, 9)) for r in out.collect()) == want
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            monkeypatch.undo()
        assert "Generate" not in plans[1] and "_salt" not in plans[1]
        if None not in ids:
            assert "Exchange" not in plans[0]
