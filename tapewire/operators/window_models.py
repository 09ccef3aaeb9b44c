"""A fitted model inside the walk-forward: one boosted model per window, all windows side by side.

Each window knows the rows whose target ended by its cutoff. A model of its early dates
gives the rank correlation on its late ones; a model of all its rows scores the last row
of every ticker. Z-scores and percentiles of a date are the same for all windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapewire.operators.backtest import first_known_days
from tapewire.operators.boosting import Boost, fit_models, score_rows
from tapewire.operators.panel import average_rank, build_panel
from tapewire.operators.timeseries import PRICE_FEATURES
from tapewire.session import cut_lineage

# The method's model and the smallest panels it trusts.
MODEL = Boost(rounds=300, step=0.05, depth=5, leaf_rows=20, l2=1.0)
LEAST_ROWS = 2000
LEAST_JUDGED = 200
TRAIN_SHARE = 0.8
WINDOW_ROWS = 20_000  # most rows one window's model is fitted on


def known_rows(panel: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Labelled rows once per window that knows their target, marked `early` up to the window's split date.

    Dates are numbered per window over the calendar; the split is the date with index
    int(share * dates). Windows with too few rows, early or late, are left out.
    """
    whole = panel.dropna(subset=["target_end_date", "forward_return", "target_percentile"])
    first = first_known_days(cutoffs, F.lit("1900-01-01").cast("date")).select(F.col("dt").alias("target_end_date"), F.col("window_id").alias("_first"))
    windows = cutoffs.agg(F.max("window_id")).first()[0] or 0
    since = cut_lineage(whole.join(first, "target_end_date"))
    later = F.explode(F.sequence("_first", F.lit(windows).cast("bigint")))  # window numbers are dense from 1
    dates = since.groupBy("dt").agg(F.min("_first").alias("_first")).select("dt", later.alias("window_id"))
    of_window = Window.partitionBy("window_id")
    numbered = dates.select(
        "window_id", "dt", (F.row_number().over(of_window.orderBy("dt")) - 1).alias("_at"), F.count("*").over(of_window).alias("_n")
    )
    split = numbered.where(F.col("_at") == F.floor(F.col("_n") * TRAIN_SHARE)).select("window_id", F.col("dt").alias("split"))
    rows = since.withColumn("window_id", later).join(F.broadcast(split), "window_id").withColumn("early", F.col("dt") <= F.col("split"))
    counts = rows.groupBy("window_id").agg(
        F.count("*").alias("n_rows"), F.count_if("early").alias("_early"), F.count_if(~F.col("early")).alias("_late")
    )
    enough = (F.col("n_rows") >= LEAST_ROWS) & (F.col("_late") >= LEAST_JUDGED) & (F.col("_early") >= LEAST_ROWS * 0.5)
    fit = cut_lineage(counts.where(enough).select("window_id", "n_rows"))
    return rows.join(F.broadcast(fit), "window_id")


def window_ic(judged: DataFrame, least_names: int = 5) -> DataFrame:
    """(window_id, ic): mean over the late dates of the rank correlation of score and return; 0 without one."""
    day = ["window_id", "dt"]
    ranked = judged.select(*day, average_rank("score", *day).alias("a"), average_rank("forward_return", *day).alias("b"))
    usable = (F.count("*") >= least_names) & (F.min("a") < F.max("a")) & (F.min("b") < F.max("b"))
    daily = ranked.groupBy(*day).agg(F.when(usable, F.corr("a", "b")).alias("ic"))
    return daily.groupBy("window_id").agg(F.coalesce(F.avg("ic"), F.lit(0.0)).alias("ic"))


def latest_rows(panel: DataFrame, cutoffs: DataFrame, columns: list[str]) -> DataFrame:
    """(window_id, ticker, columns) of every ticker's last row up to each cutoff."""
    known = first_known_days(cutoffs, F.lit("1900-01-01").cast("date"))
    packed = F.struct(*columns)
    newest = panel.join(known, "dt").groupBy("ticker", "window_id").agg(F.max_by(packed, "dt").alias("_row"))
    windows = cutoffs.agg(F.max("window_id")).first()[0] or 0
    every = F.sequence(F.lit(1).cast("bigint"), F.lit(windows).cast("bigint")) if windows else F.array().cast("array<bigint>")
    cells = panel.select("ticker").distinct().select("ticker", F.explode(every).alias("window_id"))
    upto = Window.partitionBy("ticker").orderBy("window_id")
    filled = cells.join(newest, ["ticker", "window_id"], "left").withColumn("_row", F.last("_row", ignorenulls=True).over(upto))
    return filled.where("_row IS NOT NULL").select("window_id", "ticker", "_row.*")


def window_scores(features: DataFrame, cutoffs: DataFrame, model: Boost = MODEL, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(window_id, ticker, score, ic, n_rows) for every window with enough rows; the others have no row.

    Models are fitted on at most `window_rows` rows of a window, chosen by md5 of ticker
    and date; all rows are counted, ranked and judged.
    """
    columns = list(PRICE_FEATURES)
    panel = cut_lineage(build_panel(features))
    rows = known_rows(panel, cutoffs).withColumn("key", F.concat_ws(" ", "ticker", "dt"))
    rows = cut_lineage(rows.select("window_id", "ticker", "dt", "key", "early", "n_rows", "target_percentile", "forward_return", *columns))
    group = F.col("window_id") * 2
    train = rows.where("early").withColumn("group", group).unionByName(rows.withColumn("group", group + 1))
    models = fit_models(train, [model], "group", "key", columns, "target_percentile", fit_rows=window_rows)
    stages = {0: [model.rounds]}
    late = rows.where("NOT early").withColumn("group", group)
    judged = score_rows(late, models, "group", columns, stages, ["window_id", "dt", "forward_return"])
    latest = latest_rows(panel, cutoffs, columns).withColumn("group", group + 1)
    scored = score_rows(latest, models, "group", columns, stages, ["window_id", "ticker"])
    sizes = rows.groupBy("window_id").agg(F.max("n_rows").alias("n_rows"))
    return scored.select("window_id", "ticker", "score").join(window_ic(judged), "window_id").join(sizes, "window_id")
