"""Covariance with Ledoit-Wolf shrinkage, from blocks of trading days."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tapewire.functions.numeric import safe_div
from tapewire.operators.timeseries import pct_change
from tapewire.session import cut_lineage

TRADING_DAYS = 252
DAYS_PER_BLOCK = 256


def formation_returns(prices: DataFrame) -> DataFrame:
    """Daily returns on the dates where every ticker has a price."""
    n_tickers = prices.agg(F.countDistinct("ticker")).first()[0]
    whole = prices.groupBy("dt").agg(F.count("close").alias("_n")).where(F.col("_n") == n_tickers)
    kept = prices.join(whole.select("dt"), "dt", "left_semi")
    return kept.select("ticker", "dt", pct_change(F.col("close")).alias("ret")).where("ret IS NOT NULL")


def centred(returns: DataFrame) -> DataFrame:
    """Returns minus the ticker's mean; the means are one row per ticker."""
    means = returns.groupBy("ticker").agg(F.avg("ret").alias("_mean"))
    return returns.join(means, "ticker").select("ticker", "dt", (F.col("ret") - F.col("_mean")).alias("x"))


def _block_products(rows: pd.DataFrame) -> pd.DataFrame:
    wide = rows.pivot(index="dt", columns="ticker", values="x").fillna(0.0)
    matrix = wide.to_numpy()
    left, right = np.triu_indices(matrix.shape[1])
    names = wide.columns.to_numpy()
    return pd.DataFrame(
        {"ticker_i": names[left], "ticker_j": names[right], "s": (matrix.T @ matrix)[left, right]}
    )


def product_sums(x: DataFrame, days_per_block: int = DAYS_PER_BLOCK) -> DataFrame:
    """Sum over dates of x_i * x_j for i <= j.

    A block holds at most `days_per_block` dates, multiplies once, and hands on
    one row per pair of tickers; pairs of single dates are never shuffled.
    """
    block = F.floor(F.datediff("dt", F.lit("1970-01-01").cast("date")) / days_per_block)
    parts = (
        x.withColumn("block", block)
        .groupBy("block")
        .applyInPandas(_block_products, "ticker_i string, ticker_j string, s double")
    )
    return parts.groupBy("ticker_i", "ticker_j").agg(F.sum("s").alias("s"))


def _sample(returns: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Centred returns and their sample covariance, each written once, with both sizes."""
    x = cut_lineage(centred(returns))
    sizes = x.agg(F.countDistinct("dt").alias("n"), F.countDistinct("ticker").alias("p")).first()
    sums = product_sums(x)
    sample = cut_lineage(sums.select("ticker_i", "ticker_j", (F.col("s") / float(sizes["n"])).alias("s")))
    return x, sample, sizes["n"], sizes["p"]


def _shrinkage(x: DataFrame, sample: DataFrame, n: int, p: int) -> DataFrame:
    same = F.col("ticker_i") == F.col("ticker_j")
    square = F.col("s") * F.col("s")
    norms = sample.agg(
        F.sum(F.when(same, F.col("s"))).alias("trace"),
        F.sum(F.when(same, square).otherwise(2 * square)).alias("frobenius"),
        F.lit(1).alias("_k"),
    )
    squares = x.groupBy("dt").agg(F.sum(F.col("x") * F.col("x")).alias("q"))
    quartic = squares.agg(F.sum(F.col("q") * F.col("q")).alias("quartic"), F.lit(1).alias("_k"))
    mu = F.col("trace") / p
    out = norms.join(quartic, "_k").select(
        F.lit(n).cast("bigint").alias("n"),
        F.lit(p).cast("bigint").alias("p"),
        mu.alias("mu"),
        ((F.col("frobenius") - 2 * mu * F.col("trace") + p * mu * mu) / p).alias("delta"),
        ((F.col("quartic") / n - F.col("frobenius")) / (p * n)).alias("beta"),
    )
    strength = safe_div(F.least("beta", "delta"), F.col("delta"))
    return out.withColumn("shrinkage", F.coalesce(strength, F.lit(0.0)))


def ledoit_wolf(returns: DataFrame) -> DataFrame:
    """One row: sizes, mean variance, delta, beta and the shrinkage intensity."""
    return _shrinkage(*_sample(returns))


def covariance(returns: DataFrame, days: int = TRADING_DAYS) -> DataFrame:
    """Annualised shrunk covariance for i <= j."""
    x, sample, n, p = _sample(returns)
    fit = _shrinkage(x, sample, n, p).first()
    keep, pull = 1.0 - fit["shrinkage"], fit["shrinkage"] * fit["mu"]
    on_diagonal = F.when(F.col("ticker_i") == F.col("ticker_j"), pull).otherwise(0.0)
    return sample.select("ticker_i", "ticker_j", ((F.col("s") * keep + on_diagonal) * days).alias("cov"))


def ridged(cov: DataFrame, strength: float = 1e-4) -> DataFrame:
    """Add `strength` times the mean variance to the diagonal."""
    same = F.col("ticker_i") == F.col("ticker_j")
    level = cov.where(same).agg(F.avg("cov").alias("v")).first()["v"]
    return cov.withColumn("cov", F.col("cov") + F.when(same, F.lit(strength * level)).otherwise(0.0))
