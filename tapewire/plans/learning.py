"""Queries that fit models: no SQL twin, checked by the tests.

Fits have the operators' defaults and searches the method's spaces; all of them run
over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.functions import lexicon as lx
from tapewire.functions.numeric import rounded
from tapewire.operators import backtest as bt
from tapewire.operators import boosting as bo
from tapewire.operators import cluster as cl
from tapewire.operators import evaluate as ev
from tapewire.operators import forests as fr
from tapewire.operators import gradient_trees as gt
from tapewire.operators import learn as ln
from tapewire.operators import neighbours as nb
from tapewire.operators import panel as pn
from tapewire.operators import quality as ql
from tapewire.operators import timeseries as ts
from tapewire.operators import vectorize as vz
from tapewire.operators import window_models as wm
from tapewire.plans.news import training_rows
from tapewire.plans.portfolios import CUTOFF, PLAN, filled_prices
from tapewire.plans.registry import query
from tapewire.plans.tabular import ipo
from tapewire.plans.vectors import CLUSTER, STOPPED, split_docs
from tapewire.session import cut_lineage
from tapewire.sources import news as nw
from tapewire.sources.tables import bars, table


def text_sets(spark, sf):
    """Train and test TF-IDF vectors of the documents, vocabulary fitted on the train part."""
    rows = cut_lineage(split_docs(spark, sf))
    train = rows.where("part = 'train'")
    packed, vocabulary = vz.tfidf_rows(rows, "doc_id", "text", STOPPED, train, ["part", "lang"])
    points, _ = ln.indexed(vz.rows_to_vectors(cut_lineage(packed), len(vocabulary)), "lang")
    points = cut_lineage(points.select("doc_id", "part", "label", "features"))
    return points.where("part = 'train'"), points.where("part = 'test'")


@query("clf_logreg")
def clf_logreg(spark, sf):
    train, test = text_sets(spark, sf)
    return ln.fit_predict(ln.logistic(train.count()), train, test, "doc_id")


@query("clf_tree")
def clf_tree(spark, sf):
    train, test = text_sets(spark, sf)
    return ln.fit_predict(ln.tree(), train, test, "doc_id")


@query("clf_forest")
def clf_forest(spark, sf):
    train, test = text_sets(spark, sf)
    return ln.fit_predict(ln.forest(), train, test, "doc_id")


IPO_COLUMNS = ["issue_size", "qib", "hni", "rii", "total", "offer_price", "avg_subscription"]


def ipo_points(spark, sf):
    """Imputed issue features with target and fold."""
    rows = ql.with_target(ipo(spark, sf))
    filled = ql.imputed(rows, ["hni"], []).withColumnRenamed("issue_size(crores)", "issue_size")
    filled = ql.imputed(filled, ["issue_size"], []).withColumn("avg_subscription", F.expr("(qib + hni + rii) / 3"))
    folded = ev.stratified_folds(filled.withColumn("label", F.col("target").cast("double")), "label", "ipo_name")
    return cut_lineage(ln.assembled(ln.balanced(folded), IPO_COLUMNS))


@query("clf_gbt")
def clf_gbt(spark, sf):
    points = ipo_points(spark, sf)
    model = ln.boosted().setWeightCol("weight")
    return ln.fit_predict(model, points.where("fold > 0"), points.where("fold = 0"), "ipo_name")


def embedding_points(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return cut_lineage(cl.with_features(rows, "embedding"))


@query("clf_mlp")
def clf_mlp(spark, sf):
    points = ev.tail_holdout(embedding_points(spark, sf), ["vec_id"]).withColumn("label", F.col("label").cast("double"))
    points = cut_lineage(points)
    network = ln.dense_network([64, *ln.DENSE_HIDDEN, 10])
    return ln.fit_predict(network, points.where("part = 'train'"), points.where("part = 'validation'"), "vec_id")


@query("tune_grid")
def tune_grid(spark, sf):
    """All 81 settings over five folds; settings that differ in their rounds alone share a fit."""
    return bo.staged_search(ipo_points(spark, sf), ln.GBT_GRID, "ipo_name", IPO_COLUMNS, "label", "weight")


@query("tune_random")
def tune_random(spark, sf):
    return ln.search(ln.forest(), ln.draws(ln.FOREST_SPACE), ipo_points(spark, sf), "weighted_f1", with_train=True)


@query("oof_probs")
def oof_probs(spark, sf):
    return rounded(ln.out_of_fold(ln.boosted().setWeightCol("weight"), ipo_points(spark, sf), "ipo_name"), "prob")


@query("feature_importance")
def feature_importance(spark, sf):
    model = gt.GrownBoost(ln.boosted().setWeightCol("weight"), ipo_points(spark, sf))
    return ln.importances(model, IPO_COLUMNS, spark)


@query("gbt_scores")
def gbt_scores(spark, sf):
    panel = cut_lineage(pn.build_panel(ts.price_features(bars(spark, sf)), CUTOFF))
    scores, ic, n_rows = ln.panel_scores(panel, CUTOFF)
    return scores.withColumns({"validation_ic": F.lit(ic), "n_train_rows": F.lit(n_rows)})



@query("walk_forward_model")
def walk_forward_model(spark, sf):
    """The walk-forward on scores of a model fitted per window."""
    prices = filled_prices(spark, sf)
    features = cut_lineage(ts.price_features(prices))
    span = prices.agg(F.min("dt").alias("a"), F.max("dt").alias("z")).first()
    cutoffs = cut_lineage(bt.rebalance_cutoffs(spark, span["a"], span["z"], PLAN))
    scores = cut_lineage(wm.window_scores(features, cutoffs))
    return rounded(bt.walk_forward(prices, features, PLAN, model=scores)["daily"].select("strategy", "window_id", "dt", "ret", "ic"), "ret", "ic")


@query("score_headlines")
def score_headlines(spark, sf):
    rows = cut_lineage(training_rows(spark, sf))
    names = rows.select("ticker").distinct()
    brands = {s: r[0] for s, r in zip(lx.SYMBOLS, names.orderBy("ticker").limit(len(lx.SYMBOLS)).collect())}
    columns = [*ts.MARKET_FEATURES, "news_sentiment_mean", "news_count"]
    points, classes = ln.indexed(ln.assembled(rows, columns), "label")
    model = fr.GrownForest(ln.forest().setWeightCol("weight"), ln.balanced(points))
    symbol = lx.link_company(F.col("headline"))
    ticker = F.coalesce(*[F.when(F.col("symbol") == s, b) for s, b in brands.items()])
    titles = nw.docs(spark, sf).select("doc_id", "headline", symbol.alias("symbol")).withColumn("ticker", ticker)
    return ln.score_headlines(titles, rows, model, classes, columns)


# ---- reduction and clustering ---------------------------------------------


def text_embedding(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")
    packed, vocabulary = vz.tfidf_rows(rows, "doc_id", "text", CLUSTER)
    return ln.svd_of_rows(packed, len(vocabulary), 100)[0]


@query("svd_embed")
def svd_embed(spark, sf):
    return text_embedding(spark, sf)


def pca_fit(spark, sf, k=64):
    points = cut_lineage(ev.tail_holdout(embedding_points(spark, sf), ["vec_id"]))
    return cl.pca(points, k, points.where("part = 'train'"))


@query("pca_embed")
def pca_embed(spark, sf):
    return pca_fit(spark, sf)[1].select("vec_id", "part", "pca")


@query("pca_cumvar")
def pca_cumvar(spark, sf):
    return cl.explained(pca_fit(spark, sf)[0], spark)


@query("pca_plane")
def pca_plane(spark, sf):
    """The first two components, as a scatter plot takes them."""
    first = pca_fit(spark, sf, 2)[1]
    return first.select("vec_id", F.col("pca")[0].alias("x"), F.col("pca")[1].alias("y"))


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return cl.kmeans_sweep(embedding_points(spark, sf), cl.KS)


@query("hier_cluster")
def hier_cluster(spark, sf):
    return cl.best_labels(embedding_points(spark, sf), cl.hierarchical_labels)[0].select("vec_id", "cluster")


@query("dbscan")
def dbscan(spark, sf):
    """Density clusters of the vectors for the best of 40 settings around the knee of the k-distance curve; noise is -1."""
    labels, best = nb.density_clusters(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return labels.withColumns({"eps": F.round(F.lit(best.eps), 6), "min_samples": F.lit(best.min_samples)})


def text_points(spark, sf):
    embedded = text_embedding(spark, sf)
    return cut_lineage(cl.with_features(embedded, "embedding").select("doc_id", "features"))


@query("clustered_titles")
def clustered_titles(spark, sf):
    points = text_points(spark, sf)
    flat, nested = (
        cl.best_labels(points, label)[0].select("doc_id", F.col("cluster").alias(name))
        for name, label in (("kmeans", cl.kmeans_labels), ("hierarchical", cl.hierarchical_labels))
    )
    titles = nw.docs(spark, sf).select("doc_id", "title")
    return titles.join(flat, "doc_id").join(nested, "doc_id")


@query("cluster_summary")
def cluster_summary(spark, sf):
    points = embedding_points(spark, sf)
    rows = []
    for name, label in (("kmeans", cl.kmeans_labels), ("hierarchical", cl.hierarchical_labels)):
        labels, k, score = cl.best_labels(points, label)
        rows.append((name, f"k={k}", labels.select("cluster").distinct().count(), score))
    return spark.createDataFrame(rows, "algorithm string, parameters string, n_clusters bigint, silhouette double")
