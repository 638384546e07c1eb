"""Interest score: weighted, decayed, capped per group, summed and clipped at 100."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, measures as mx
from foghorn.operators.quantiles import small_domain_quantiles
from foghorn.operators.rows import top_k
from foghorn.plans.events import complete_rows, positive_strength

Weights = Sequence[tuple[str, float, str, float]]
IDENTITY = ("company_id", "company_name", "country", "industry", "size_bin")


def _weight_of(signal_type: Column, weights: Weights) -> tuple[Column, Column]:
    """Group and weight of a signal type as CASE expressions (the table is configuration)."""
    group = F.lit(None).cast("string")
    weight = F.lit(None).cast("double")
    for name, _cap, kind, value in weights:
        group = F.when(signal_type == kind, name).otherwise(group)
        weight = F.when(signal_type == kind, value).otherwise(weight)
    return group, weight


def scored_events(
    events: DataFrame,
    as_of: dt.datetime | str,
    weights: Weights = vocab.SIGNAL_WEIGHTS,
    decay_days: float = vocab.DECAY_DAYS,
    months: int | None = 12,
    since: str | None = None,
    mode: str = "exponential",
) -> DataFrame:
    """Events in the window with ``group`` and ``event_score``; unmapped types dropped."""
    kept = positive_strength(complete_rows(events, dx.window_start(as_of, months, since)))
    kind = F.lower(F.trim("signal_type"))
    group, weight = _weight_of(kind, weights)
    age = dx.age_days(dx.as_of_lit(as_of), F.col("ts"))
    return (
        kept.withColumn("group", group)
        .filter(F.col("group").isNotNull())
        .withColumn(
            "event_score",
            weight * F.col("signal_strength") * mx.decay(age, decay_days, mode),
        )
    )


def dropped_types(events: DataFrame, weights: Weights = vocab.SIGNAL_WEIGHTS) -> DataFrame:
    """Counts of signal types that carry no weight and therefore do not score."""
    kind = F.lower(F.trim("signal_type"))
    known = [w[2] for w in weights]
    return (
        events.filter(F.col("signal_type").isNotNull() & ~kind.isin(*known))
        .groupBy(kind.alias("signal_type"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def company_scores(scored: DataFrame, weights: Weights = vocab.SIGNAL_WEIGHTS) -> DataFrame:
    """One row per company: capped ``group_*`` scores, event count and last time.

    The pivot is written as conditional sums, so grouping, pivoting and the
    event meta share one aggregation with map-side combine.
    """
    caps = {name: cap for name, cap, _kind, _w in weights}
    sums = [
        F.sum(F.when(F.col("group") == g, F.col("event_score"))).alias(f"_s_{g}") for g in caps
    ]
    grouped = scored.groupBy("company_id").agg(
        *sums, F.count(F.lit(1)).alias("signals_count"), F.max("ts").alias("_last")
    )
    capped = [
        F.least(F.coalesce(F.col(f"_s_{g}"), F.lit(0.0)), F.lit(cap)).alias(f"group_{g}")
        for g, cap in caps.items()
    ]
    return grouped.select(
        "company_id", *capped, "signals_count", dx.iso_z(F.col("_last")).alias("last_ts")
    )


def group_scores(scored: DataFrame, weights: Weights = vocab.SIGNAL_WEIGHTS) -> DataFrame:
    """Long form: one row per company and group with the capped score."""
    caps = {name: cap for name, cap, _kind, _w in weights}
    cap = F.lit(100.0)
    for name, value in caps.items():
        cap = F.when(F.col("group") == name, F.lit(value)).otherwise(cap)
    return (
        scored.groupBy("company_id", "group")
        .agg(F.sum("event_score").alias("event_score"))
        .withColumn("score", F.least(F.col("event_score"), cap))
    )


def interest_scores(
    events: DataFrame,
    universe: DataFrame,
    as_of: dt.datetime | str,
    weights: Weights = vocab.SIGNAL_WEIGHTS,
    **window,
) -> DataFrame:
    """Every universe company with its group scores and ``score_0_100``."""
    per_company = company_scores(scored_events(events, as_of, weights, **window), weights)
    groups = [f"group_{g}" for g in dict.fromkeys(w[0] for w in weights)]
    joined = universe.select(*IDENTITY).distinct().join(per_company, "company_id", "left")
    joined = joined.fillna(0.0, subset=groups).fillna(0, subset=["signals_count"])
    joined = joined.fillna("", subset=["last_ts"])
    total = sum((F.col(g) for g in groups), F.lit(0.0))
    return joined.withColumn("score_0_100", F.round(F.least(total, F.lit(100.0)), 2))


def ranked(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.col("score_0_100").desc(), F.col("company_id").asc())


def stratum_summary(scores: DataFrame) -> DataFrame:
    """Companies, mean, 90th percentile and share at 60 or more, per stratum.

    Scores have two decimals between 0 and 100: they are summed as whole
    hundredths, so the mean does not depend on the order of summation, and the
    percentile works on at most 10,001 counted values per stratum.
    """
    keys = ["country", "industry"]
    scores = scores.dropna(subset=keys)
    cents = F.sum(F.round(F.col("score_0_100") * 100).cast("bigint"))
    base = scores.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("companies"),
        mx.round_scaled(cents / 100.0 / F.count(F.lit(1)), 2).alias("avg_score"),
        mx.round_scaled(F.avg((F.col("score_0_100") >= 60).cast("double")), 3).alias("high_share"),
    )
    hundredths = scores.withColumn("_cents", F.round(F.col("score_0_100") * 100).cast("bigint"))
    p90 = small_domain_quantiles(hundredths, keys, "_cents", {"p90_score": 0.9})
    # tenths between whole hundredths: six decimals remove what the interpolation adds
    p90 = p90.withColumn("p90_score", F.round(F.round("p90_score", 6), 0) / 100.0)
    return base.join(p90, keys)


def top_by_stratum(scores: DataFrame, k: int = 10) -> DataFrame:
    return top_k(
        scores.dropna(subset=["country", "industry"]),
        ["country", "industry"],
        [F.col("score_0_100").desc(), F.col("company_id").asc()],
        k,
    )


def prospect_columns(scores: DataFrame) -> DataFrame:
    """The published columns in order; an error names the missing ones."""
    wanted = [*IDENTITY, "score_0_100", "signals_count", "last_ts"]
    missing = [c for c in wanted if c not in scores.columns]
    if missing:
        raise ValueError(f"score table lacks columns: {missing}")
    return scores.select(*wanted, *[c for c in scores.columns if c.startswith("group_")])


def targeted_view(
    scores: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    floor: float = 40.0,
    limit: int = 25,
) -> DataFrame:
    """Top companies of some countries and industries at or above a score."""
    return (
        prospect_columns(scores)
        .filter(
            F.col("country").isin(*countries)
            & F.col("industry").isin(*industries)
            & (F.col("score_0_100") >= floor)
        )
        .orderBy(F.col("score_0_100").desc(), F.col("company_id").asc())
        .limit(limit)
    )


def shipped_views(
    scores: DataFrame, views: Mapping[str, tuple[Sequence[str], Sequence[str]]] = vocab.TARGET_VIEWS
) -> dict[str, DataFrame]:
    """The standing targeted views by name."""
    return {name: targeted_view(scores, *scope) for name, scope in views.items()}


def median_heat(scores: DataFrame, value: str = "score_0_100") -> DataFrame:
    """Median score per stratum (bounded domain, as in :func:`stratum_summary`)."""
    return small_domain_quantiles(
        scores.dropna(subset=["country", "industry"]), ["country", "industry"], value, {value: 0.5}
    )


def top_prospects(scores: DataFrame, by: str = "score_0_100", limit: int = 200) -> DataFrame:
    return scores.orderBy(F.col(by).desc(), F.col("company_id").asc()).limit(limit)
