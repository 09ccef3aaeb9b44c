"""Rolling features and labels over daily bars (ticker, dt, open, high, low, close, volume).

Bars hold one row per ticker and day, so a window over one ticker is bounded by
the trading calendar however many trades the ticker has. All functions share the
window spec, which Spark plans as one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tapewire.functions.numeric import finite, safe_div

# Feature set, label thresholds and horizon of the method.
PRICE_FEATURES = [
    "daily_return", "return_5d", "return_20d", "return_60d", "volatility_20d", "volatility_60d",
    "ma_10_gap", "ma_50_gap", "ma_200_gap", "rsi_14", "volume_change_20d", "volume_z_20d",
]
MARKET_FEATURES = [
    "return_1d", "return_3d", "return_5d", "return_10d", "volatility_10d",
    "hl_range", "volume_avg_10d", "volume_ratio", "gap_pct",
]
SPIKE, CRASH = 0.015, -0.015
HORIZON = 20


def by_ticker() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("dt")


def pct_change(value: Column, rows: int = 1) -> Column:
    return safe_div(value, F.lag(value, rows).over(by_ticker())) - 1


def rolling(aggregate: Column, value: Column, rows: int) -> Column:
    """An aggregate over the last `rows` rows, null until all of them are non-null."""
    frame = by_ticker().rowsBetween(1 - rows, 0)
    return F.when(F.count(value).over(frame) == rows, aggregate.over(frame))


def rolling_mean(value: Column, rows: int) -> Column:
    return rolling(F.avg(value), value, rows)


def rolling_std(value: Column, rows: int) -> Column:
    return rolling(F.stddev_samp(value), value, rows)


def spread_by_ticker(bars: DataFrame) -> DataFrame:
    """Hash by ticker over all shuffle partitions.

    Rolling frames cost CPU rather than bytes, so the byte-driven merging of small
    partitions would leave them to one task. The windows reuse this exchange.
    """
    partitions = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bars.repartition(partitions, "ticker")


def returns(bars: DataFrame, spans=(1, 3, 5, 10, 20, 60)) -> DataFrame:
    return bars.select("ticker", "dt", *[pct_change(F.col("close"), k).alias(f"return_{k}d") for k in spans])


def rsi(bars: DataFrame, rows: int = 14) -> DataFrame:
    """Relative strength from simple rolling means; a window without losses gives null."""
    moved = bars.select("ticker", "dt", "close", (F.col("close") - F.lag("close").over(by_ticker())).alias("move"))
    gain = F.when(F.col("move").isNotNull(), F.greatest(F.col("move"), F.lit(0.0)))
    loss = F.when(F.col("move").isNotNull(), F.greatest(-F.col("move"), F.lit(0.0)))
    strength = safe_div(rolling_mean(gain, rows), rolling_mean(loss, rows))
    return moved.select("ticker", "dt", (100 - 100 / (1 + strength)).alias("rsi"))


def forward_return(bars: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return bars.select(
        "ticker",
        "dt",
        (safe_div(F.lead("close", horizon).over(by_ticker()), F.col("close")) - 1).alias("forward_return"),
        F.lead("dt", horizon).over(by_ticker()).alias("target_end_date"),
    )


def price_features(bars: DataFrame, complete_only: bool = True) -> DataFrame:
    """The twelve price features, the forward return and its end date.

    With `complete_only` warm-up rows and rows without a target are dropped.
    """
    close, volume, ret, move = (F.col(c) for c in ("close", "volume", "daily_return", "move"))
    upto = by_ticker().rowsBetween(Window.unboundedPreceding, 0)
    based = spread_by_ticker(bars).select(
        "ticker", "dt", "close", "volume",
        pct_change(close).alias("daily_return"),
        (close - F.lag("close").over(by_ticker())).alias("move"),
        F.sum("close").over(upto).alias("close_sum"),
        F.count("close").over(upto).alias("close_count"),
    )

    def long_mean(rows: int) -> Column:
        """Rolling mean of close as a difference of running sums: constant work per row."""
        seen = F.col("close_count") - F.coalesce(F.lag("close_count", rows).over(by_ticker()), F.lit(0))
        total = F.col("close_sum") - F.coalesce(F.lag("close_sum", rows).over(by_ticker()), F.lit(0.0))
        return F.when(seen == rows, total / rows)

    gain = F.when(move.isNotNull(), F.greatest(move, F.lit(0.0)))
    loss = F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0)))
    strength = safe_div(rolling_mean(gain, 14), rolling_mean(loss, 14))
    columns = {
        "daily_return": ret,
        "return_5d": pct_change(close, 5),
        "return_20d": pct_change(close, 20),
        "return_60d": pct_change(close, 60),
        "volatility_20d": rolling_std(ret, 20),
        "volatility_60d": rolling_std(ret, 60),
        "ma_10_gap": safe_div(close, long_mean(10)) - 1,
        "ma_50_gap": safe_div(close, long_mean(50)) - 1,
        "ma_200_gap": safe_div(close, long_mean(200)) - 1,
        "rsi_14": (100 - 100 / (1 + strength)) / 100,
        "volume_change_20d": pct_change(volume, 20),
        "volume_z_20d": safe_div(volume - rolling_mean(volume, 20), rolling_std(volume, 20)),
        "forward_return": safe_div(F.lead("close", HORIZON).over(by_ticker()), close) - 1,
    }
    out = based.select(
        "ticker",
        "dt",
        *[c.alias(n) for n, c in columns.items()],
        F.lead("dt", HORIZON).over(by_ticker()).alias("target_end_date"),
    ).withColumns({n: finite(F.col(n)) for n in columns})
    return out.dropna() if complete_only else out


def market_features(bars: DataFrame) -> DataFrame:
    """The nine market features; rows are kept and missing values stay null."""
    close, volume = F.col("close"), F.col("volume")
    based = bars.withColumn("return_1d", pct_change(close))
    before = F.lag("close").over(by_ticker())
    columns = {
        "return_1d": F.col("return_1d"),
        "return_3d": pct_change(close, 3),
        "return_5d": pct_change(close, 5),
        "return_10d": pct_change(close, 10),
        "volatility_10d": rolling_std(F.col("return_1d"), 10),
        "hl_range": safe_div(F.col("high") - F.col("low"), close),
        "volume_avg_10d": rolling_mean(volume, 10),
        "volume_ratio": safe_div(volume, rolling_mean(volume, 10)),
        "gap_pct": safe_div(F.col("open") - before, before),
    }
    out = based.select("ticker", "dt", *[c.alias(n) for n, c in columns.items()])
    return out.withColumns({n: finite(F.col(n)) for n in columns})


def next_day_label(bars: DataFrame, spike: float = SPIKE, crash: float = CRASH) -> DataFrame:
    """Label each day by the return of the ticker's next row; the last row is dropped."""
    ahead = F.col("next_return")
    return (
        bars.select("ticker", "dt", (safe_div(F.lead("close").over(by_ticker()), F.col("close")) - 1).alias("next_return"))
        .where(ahead.isNotNull())
        .withColumn("label", F.when(ahead > spike, "spike").when(ahead < crash, "crash").otherwise("neutral"))
    )


def calendar_grid(bars: DataFrame) -> DataFrame:
    """Every ticker on every trading date of the union calendar.

    Each ticker row unfolds the calendar span and a semi join keeps the dates on
    which anything traded: an equi-join, where a product of dates and tickers
    would be a cross join.
    """
    span = bars.agg(F.min("dt").alias("first"), F.max("dt").alias("last")).first()
    days = F.explode(F.sequence(F.lit(span["first"]), F.lit(span["last"]), F.expr("interval 1 day")))
    dates = bars.select("dt").distinct()
    return bars.select("ticker").distinct().select("ticker", days.alias("dt")).join(dates, "dt", "left_semi")


def forward_filled(bars: DataFrame, columns=("open", "high", "low", "close", "volume")) -> DataFrame:
    """Bars on the union calendar, gaps filled from the last row, leading gaps dropped."""
    upto = by_ticker().rowsBetween(Window.unboundedPreceding, 0)
    filled = calendar_grid(bars).join(bars, ["ticker", "dt"], "left")
    return filled.select(
        "ticker", "dt", *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in columns]
    ).dropna()


def latest_row(rows: DataFrame, cutoff: str | None = None) -> DataFrame:
    """The last row of every ticker at or before the cutoff."""
    if cutoff:
        rows = rows.where(F.col("dt") <= F.lit(cutoff).cast("date"))
    newest = Window.partitionBy("ticker").orderBy(F.desc("dt"))
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def complete_history(bars: DataFrame) -> DataFrame:
    """Bars of the tickers that trade on every date of the union calendar."""
    n_dates = bars.agg(F.countDistinct("dt")).first()[0]
    whole = bars.groupBy("ticker").agg(F.count("close").alias("_n")).where(F.col("_n") == n_dates)
    return bars.join(whole.select("ticker"), "ticker", "left_semi")


def min_history(bars: DataFrame, cutoff: str, min_rows: int = 300) -> DataFrame:
    """Row count per ticker up to the cutoff and whether it reaches the minimum."""
    formation = bars.where(F.col("dt") <= F.lit(cutoff).cast("date"))
    counted = formation.groupBy("ticker").agg(F.count("close").alias("n_rows"))
    return (
        bars.select("ticker").distinct().join(counted, "ticker", "left")
        .select("ticker", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
        .withColumn("kept", F.col("n_rows") >= min_rows)
    )


def fallback_rows(old: DataFrame, new: DataFrame, key: str = "ticker") -> DataFrame:
    """The new rows, plus the old rows of keys that the new fetch lacks."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def coverage(bars: DataFrame) -> DataFrame:
    """Row count, distinct dates, first and last date per ticker."""
    return bars.groupBy("ticker").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("dt").alias("n_dates"),
        F.min("dt").alias("first_date"),
        F.max("dt").alias("last_date"),
    )
