"""Headline sentiment and company lookup from fixed word lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Word lists, aliases, symbols and blend weight of the method.
POSITIVE = [
    "jump", "jumps", "surge", "surges", "soar", "soars", "rally", "rallies", "record", "high", "highs", "beat",
    "beats", "strong", "growth", "gain", "gains", "profit", "profits", "upgrade", "upgraded", "breakthrough",
    "boost", "boosts", "win", "wins", "expand", "expands", "expansion", "deal", "partnership", "outperform",
    "bullish", "recovery", "recovers", "exceeds", "optimistic", "success", "successful", "innovative",
    "milestone", "positive", "rise", "rises", "rising", "climbs", "climb",
]
NEGATIVE = [
    "drop", "drops", "fall", "falls", "falling", "crash", "crashes", "plunge", "plunges", "recall", "recalls",
    "lawsuit", "lawsuits", "weak", "miss", "misses", "decline", "declines", "layoffs", "cut", "cuts", "loss",
    "losses", "downgrade", "downgraded", "bug", "bugs", "fraud", "investigation", "probe", "sues", "sued",
    "bearish", "slump", "slumps", "warns", "warning", "concern", "concerns", "worried", "worry", "risk", "risks",
    "shutdown", "delay", "delays", "delayed", "scandal", "fine", "fined", "penalty", "resign", "resigns",
    "resignation", "strike", "fired", "bankruptcy", "default", "crisis",
]
ALIASES = {
    "apple": "AAPL", "apple inc": "AAPL", "tesla": "TSLA", "tesla inc": "TSLA", "microsoft": "MSFT",
    "microsoft corp": "MSFT", "google": "GOOGL", "alphabet": "GOOGL", "amazon": "AMZN", "amazon.com": "AMZN",
    "nvidia": "NVDA",
}
SYMBOLS = ["AAPL", "TSLA", "MSFT", "GOOGL", "AMZN", "NVDA"]
LABELS = ["crash", "neutral", "spike"]
SENTIMENT_WEIGHT = 0.35


def sentiment(text: Column) -> Column:
    """(positive - negative) / (positive + negative) word hits; 0 without any."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit("[a-z']+"), F.lit(0))
    good = F.size(F.filter(tokens, lambda w: w.isin(POSITIVE)))
    bad = F.size(F.filter(tokens, lambda w: w.isin(NEGATIVE)))
    return F.coalesce((good - bad) / F.nullif(good + bad, F.lit(0)), F.lit(0.0))


def sentiment_parts(score: Column) -> dict[str, Column]:
    """A score in [-1, 1] as shares of crash, neutral and spike."""
    zero = F.lit(0.0)
    return {"crash": F.greatest(-score, zero), "neutral": 1 - F.abs(score), "spike": F.greatest(score, zero)}


def link_company(title: Column) -> Column:
    """Ticker of the first alias found as a whole word, else of the first known symbol.

    The lists are short and fixed, so the match is a chain of conditions on the
    row instead of a join of every title with every alias. The plain substring
    test comes first: most titles fail it and never reach the pattern.
    """
    text = F.lower(title)
    edge = r"[^\p{L}\p{N}_]"
    by_alias = [
        F.when(F.contains(text, F.lit(alias)) & text.rlike(f"(^|{edge}){alias.replace('.', '[.]')}($|{edge})"), ticker)
        for alias, ticker in ALIASES.items()
    ]
    tokens = F.regexp_extract_all(title, F.lit(r"\$?[A-Z]{2,5}"), F.lit(0))
    symbols = F.filter(F.transform(tokens, lambda t: F.ltrim(t, F.lit("$"))), lambda t: t.isin(SYMBOLS))
    return F.coalesce(*by_alias, F.get(symbols, F.lit(0)))


def blend(model: dict[str, Column], mood: dict[str, Column], weight: float = SENTIMENT_WEIGHT) -> dict[str, Column]:
    """Weighted mix of two label distributions, renormalised, to three digits."""
    mixed = {n: (1 - weight) * F.coalesce(model[n], F.lit(0.0)) + weight * mood[n] for n in LABELS}
    total = sum(mixed.values(), F.lit(0.0))
    return {n: F.round(v / F.when(total == 0, 1.0).otherwise(total), 3) for n, v in mixed.items()}


def top_label(shares: dict[str, Column]) -> Column:
    """Label of the largest share, the first in label order on ties."""
    best = F.greatest(*shares.values())
    return F.coalesce(*[F.when(v == best, n) for n, v in shares.items()])
