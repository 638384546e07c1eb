"""Numeric expressions: decay, boosts, tiers, bins and page scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from foghorn import vocab
from foghorn.functions import text as tx


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Null-preserving clip (``least``/``greatest`` alone would skip nulls)."""
    out = c
    if low is not None:
        out = F.when(c < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > high, F.lit(high)).otherwise(out)
    return out


def round_scaled(c: Column, digits: int) -> Column:
    """Round as array libraries do: scale, round to a whole number, scale back."""
    scale = F.lit(float(10**digits))
    return F.round(c * scale) / scale


def decay(age: Column, scale_days: float, mode: str = "exponential") -> Column:
    """``exp(-age/scale)``; ``mode='half_life'`` halves every ``scale`` days instead.

    Negative ages (future events) give values above one.
    """
    scale = max(scale_days, 1e-6)
    if mode == "half_life":
        return F.pow(F.lit(0.5), age / F.lit(scale))
    return F.exp(-age / F.lit(scale))


def volume_boost(n: Column) -> Column:
    return F.least(F.lit(1.0) + F.lit(0.15) * F.log1p(n), F.lit(1.8))


def weighted_strength(strength: Column, climate: Column) -> Column:
    """Unreadable strength counts as 0, unreadable relevance as 1."""
    return F.coalesce(strength.try_cast("double"), F.lit(0.0)) * F.coalesce(
        climate.try_cast("double"), F.lit(1.0)
    )


def recency_factor(age: Column) -> Column:
    """0.6..1.3 from the age clipped at zero, 365 when unknown; three decimals."""
    days = F.coalesce(clip(age, low=0.0), F.lit(365.0))
    raw = F.lit(0.6) + F.lit(0.6) * F.exp(-days / F.lit(180.0))
    return F.round(F.greatest(F.lit(0.6), F.least(raw, F.lit(1.3))), 3)


SENTIMENT_THRESHOLD = 0.2


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= SENTIMENT_THRESHOLD, "positive").when(score <= -SENTIMENT_THRESHOLD, "negative").otherwise("neutral")
    )


def half_away_int(c: Column) -> Column:
    return (F.signum(c) * F.floor(F.abs(c) + F.lit(0.5))).cast("bigint")


def price_strength(change: Column) -> Column:
    size = F.abs(change)
    return F.when(size >= 0.2, 1.0).when(size >= 0.1, 0.75).when(size >= 0.05, 0.6).otherwise(0.4)


def period_label(months: int) -> str:
    months = max(1, months)
    for floor, label in ((24, "2y"), (12, "1y"), (6, "6mo"), (3, "3mo")):
        if months >= floor:
            return label
    return "1mo"


def source_strength(country: Column, language: Column, hits: Column) -> Column:
    lang = F.upper(tx.text_or_blank(language)).isin(*vocab.SCORED_LANGUAGES)
    region = F.upper(tx.text_or_blank(country)).isin(*vocab.FOCUS_COUNTRIES)
    total = (
        F.lit(0.5)
        + F.when(lang, 0.2).otherwise(0.0)
        + F.when(region, 0.2).otherwise(0.0)
        + F.least(F.lit(0.1), F.lit(0.02) * hits)
    )
    return F.round(F.least(total, F.lit(1.0)), 3)


def term_density(text: Column, patterns: Sequence[str] = vocab.PAGE_TERMS) -> Column:
    hits = F.lit(0)
    for pattern in patterns:
        hits = hits + text.rlike("(?iu)" + pattern).cast("int")
    words = F.greatest(F.lit(250), tx.word_count(text))
    return F.least(F.lit(0.8), hits / words * F.lit(250.0))


def page_score(url: Column, density: Column, age: Column) -> Column:
    anchor = F.when(url.rlike("(?i)" + vocab.PAGE_ANCHOR_PATTERN), 0.2).otherwise(0.0)
    whole_days = F.greatest(F.floor(age), F.lit(0))
    recency = F.when(age.isNull(), 0.7).otherwise(F.exp(-whole_days / F.lit(365.0)))
    return F.round(F.least(F.lit(1.0), recency * (anchor + density)), 4)


def size_bin(employees: Column, revenue: Column, ticker: Column) -> Column:
    """Employees decide, then revenue, then a listing means large, else medium."""
    return (
        F.when(employees >= 1000, "l")
        .when(employees >= 250, "m")
        .when(employees >= 50, "s")
        .when(revenue >= 1e9, "l")
        .when(revenue >= 1e8, "m")
        .when(revenue >= 1e7, "s")
        .when(F.length(tx.text_or_blank(ticker)) > 0, "l")
        .otherwise("m")
    )


def banded_size(c: Column, table: Mapping[str, str]) -> Column:
    return tx.lookup(F.trim(tx.text_or_blank(c)), table, "")


def rule_confidence(best: Column) -> Column:
    return F.when(best > 0, F.least(best / 5.0 + 0.2, F.lit(0.75))).otherwise(0.35)


def adjusted_strength(base: Column, relevance: Column, label: Column, score: Column) -> Column:
    """Strength after relevance and sentiment, clipped to -1..1."""
    scaled = base * relevance
    moved = (
        F.when(label == "negative", -F.abs(scaled * (F.lit(1.0) + F.abs(score))))
        .when(label == "neutral", scaled * 0.5)
        .otherwise(scaled * (F.lit(1.0) + score * 0.5))
    )
    return F.greatest(F.least(moved, F.lit(1.0)), F.lit(-1.0))
