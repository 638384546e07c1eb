"""Company rollup and the published coverage, mix and ranking tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, measures as mx, text as tx
from foghorn.operators.quantiles import exact_quantiles, small_domain_quantiles
from foghorn.operators.rows import keep_one

ROLLUP_KEYS = ["company_key", "company_name", "country", "industry"]


def prepare_events(events: DataFrame) -> DataFrame:
    """Weighted strengths, cleaned keys and the fallback company key."""
    blank_to_null = lambda c: F.when(
        F.trim(F.col(c)).isin("", "nan", "None"), F.lit(None)
    ).otherwise(F.col(c).cast("string"))
    weighted = mx.weighted_strength(F.col("signal_strength"), F.col("climate_score"))
    name_key = F.regexp_replace(F.lower(F.col("company_name")), r"(?U)\s+", "_")
    return events.withColumns(
        {
            "weighted_strength": weighted,
            "abs_strength": F.abs(weighted),
            "sentiment_score": F.col("sentiment_score").try_cast("double"),
            "company_id": blank_to_null("company_id"),
            "company_numeric_id": F.col("company_id").cast("string").try_cast("double").try_cast("bigint"),
            "company_key": F.coalesce(
                blank_to_null("company_id"),
                blank_to_null("company_qid"),
                name_key,
                F.lit("unknown_company"),
            ),
            "country": F.upper(tx.text_or_blank("country")),
            "industry": tx.text_or_blank("industry"),
            "signal_type": F.coalesce("signal_type", F.lit("unknown")),
            "source": F.coalesce("source", F.lit("unknown")),
        }
    )


def prepare_universe(universe: DataFrame) -> DataFrame:
    return universe.withColumns(
        {
            "company_numeric_id": tx.numeric_id("company_id"),
            "industry": tx.text_or_blank("industry"),
            "country": tx.text_or_blank("country"),
        }
    )


def only_universe(events: DataFrame, universe: DataFrame) -> DataFrame:
    """Events of universe companies; an empty universe leaves nothing."""
    ids = universe.select("company_numeric_id").dropna().distinct()
    return events.join(ids, "company_numeric_id", "left_semi")


def recent_cutoff(as_of: dt.datetime | str, years: int = 5, floor: str = "2020-10-01") -> Column:
    moving = F.add_months(dx.as_of_lit(as_of).cast("timestamp"), -12 * years).cast("timestamp")
    exact = dx.as_of_lit(as_of) - F.make_ym_interval(F.lit(years), F.lit(0))
    return F.greatest(F.coalesce(exact, moving), F.lit(floor).cast("timestamp"))


def company_rollup(
    events: DataFrame, as_of: dt.datetime | str, recent_since: str | None = None
) -> DataFrame:
    """One row per company key, name, country and industry, from prepared events."""
    cutoff = F.lit(recent_since).cast("timestamp") if recent_since else recent_cutoff(as_of)
    recent = F.coalesce(F.col("ts") >= cutoff, F.lit(False))
    # First pass over the events: numeric buffers only, so it hashes without a
    # sort. Text attributes are grouped along and reduced on its small result.
    texts = ["company_id", "company_qid"]
    partial = (
        events.dropna(subset=ROLLUP_KEYS)
        .groupBy(*ROLLUP_KEYS, *texts)
        .agg(
            F.sum("weighted_strength").alias("_w"),
            F.sum("abs_strength").alias("_a"),
            F.count(F.lit(1)).alias("_n"),
            F.sum("sentiment_score").alias("_s"),
            F.count("sentiment_score").alias("_sn"),
            F.max("ts").alias("_last"),
            F.min("company_numeric_id").alias("_num"),
            F.count_if(recent).alias("_recent"),
        )
    )
    grouped = partial.groupBy(*ROLLUP_KEYS).agg(
        (F.sum("_w") / F.sum("_n")).alias("avg_strength"),
        (F.sum("_a") / F.sum("_n")).alias("avg_abs_strength"),
        F.sum("_n").alias("total_events"),
        F.max("_last").alias("last_ts"),
        F.try_divide(F.sum("_s"), F.sum("_sn")).alias("avg_sentiment"),
        F.min("company_id").alias("company_id"),
        F.min("_num").alias("company_numeric_id"),
        F.min("company_qid").alias("company_qid"),
        (F.sum("_recent") > 0).alias("recent_activity"),
        F.sum("_recent").alias("recent_events"),
    )
    boost = mx.volume_boost(F.col("total_events"))
    return grouped.withColumns(
        {
            "demand_score": F.col("avg_strength") * boost,
            "intensity_score": F.col("avg_abs_strength") * boost,
        }
    )


# --- ranking ------------------------------------------------------------------

def recency_ranking(
    companies: DataFrame,
    as_of: dt.datetime | str,
    limit: int = 25,
    country_order: Sequence[str] = vocab.RANKING_COUNTRY_ORDER,
    last_since: str | None = None,
) -> DataFrame:
    """Top companies by event count times recency, one row per company key.

    ``total_events`` of the winner is the sum over all rows of its key, while
    ``priority_score`` uses the winner's own count. ``last_since`` keeps only
    companies whose last event is at least that recent.
    """
    active = companies.filter("recent_activity")
    if last_since:
        active = active.filter(F.col("last_ts") >= F.lit(last_since).cast("timestamp"))
    age = dx.age_days(dx.as_of_lit(as_of), F.col("last_ts"))
    scored = active.withColumn("recency_factor", mx.recency_factor(age)).withColumn(
        "priority_score", F.greatest(F.col("total_events"), F.lit(1)) * F.col("recency_factor")
    )
    key = F.coalesce("company_key", "company_name")
    scored = scored.withColumn("_key", key)
    best_first = [
        F.col("priority_score").desc(),
        F.col("total_events").desc(),
        F.col("demand_score").desc(),
        F.col("_key").asc(),
        F.col("company_name").asc(),
        F.col("country").asc(),
        F.col("industry").asc(),
    ]
    winners = keep_one(scored, ["_key"], best_first).orderBy(*best_first).limit(limit)
    totals = scored.join(winners.select("_key"), "_key", "left_semi")
    totals = totals.groupBy("_key").agg(F.sum("total_events").alias("_sum"))
    result = winners.join(totals, "_key").withColumn("total_events", F.col("_sum"))
    rank = F.lit(len(country_order))
    for position, code in reversed(list(enumerate(country_order))):
        rank = F.when(F.col("country") == code, position).otherwise(rank)
    return (
        result.withColumn("last_ts_fmt", F.coalesce(F.date_format("last_ts", "yyyy-MM-dd"), F.lit("—")))
        .withColumn("country_rank", rank)
        .orderBy("country_rank", *best_first)
        .drop("_key", "_sum")
    )


def ranking_lines(ranking: DataFrame) -> DataFrame:
    """One text line per ranked company."""
    return ranking.select(
        F.format_string(
            "- %s (%s · %s): score %.2f (base %.2f · recencia %.2f), promedio %.2f, señales %d, última %s",
            F.col("company_name"),
            F.col("country"),
            tx.industry_label(F.col("industry")),
            F.col("priority_score"),
            F.col("demand_score"),
            F.col("recency_factor"),
            F.col("avg_strength"),
            F.col("total_events"),
            F.col("last_ts_fmt"),
        ).alias("value")
    )


# --- geography and time -------------------------------------------------------

def country_industry_heat(companies: DataFrame) -> DataFrame:
    """Demand and companies per stratum, with the country's own total for ordering."""
    cells = companies.groupBy("country", "industry").agg(
        F.sum("demand_score").alias("total_score"), F.count("company_id").alias("companies")
    )
    totals = companies.groupBy("country").agg(F.sum("demand_score").alias("country_total"))
    return cells.join(totals, "country")


def country_intensity(companies: DataFrame, iso3: Mapping[str, str] = vocab.ISO2_TO_ISO3) -> DataFrame:
    geo = companies.groupBy(F.upper("country").alias("country")).agg(
        F.sum("demand_score").alias("total_score"), F.count("company_id").alias("companies")
    )
    return geo.withColumn("iso3", tx.lookup(F.col("country"), iso3))


def fact_sheet(companies: DataFrame) -> DataFrame:
    return (
        companies.groupBy("country", "industry")
        .agg(
            F.sum("demand_score").alias("total_strength"),
            F.count("company_id").alias("companies_count"),
            F.sum("intensity_score").alias("intensity"),
        )
        .filter("intensity > 0")
        .orderBy("country", F.col("intensity").desc(), "industry")
    )


def signal_timeline(events: DataFrame) -> DataFrame:
    """Per month and type: companies, and the sum of their mean strengths."""
    per_company = (
        events.dropna(subset=["ts", "signal_type", "company_id"])
        .groupBy(dx.month_start(F.col("ts")).alias("month"), "signal_type", "company_id")
        .agg(F.avg("weighted_strength").alias("strength"))
    )
    return per_company.groupBy("month", "signal_type").agg(
        F.count("company_id").alias("companies"), F.sum("strength").alias("strength")
    )


def industry_timeline(events: DataFrame, months: int = 24, top: int = 8) -> DataFrame:
    """Monthly volume of the ``top`` industries over the trailing ``months``."""
    monthly = (
        events.filter(F.col("ts").isNotNull())
        .groupBy(dx.month_start(F.col("ts")).alias("month"), tx.clean_industry(F.col("industry")).alias("industry"))
        .agg(F.count("company_key").alias("total_signals"), F.sum("weighted_strength").alias("total_strength"))
    )
    latest = monthly.agg(F.max("month").alias("latest"))
    monthly = monthly.filter(F.col("month") >= F.add_months(latest.scalar(), -(months - 1)))
    leaders = (
        monthly.groupBy("industry")
        .agg(F.sum("total_signals").alias("_n"))
        .orderBy(F.col("_n").desc(), "industry")
        .limit(top)
    )
    return monthly.join(leaders.select("industry"), "industry", "left_semi")


# --- distributions ------------------------------------------------------------

def exact_sentiment(companies: DataFrame, events: DataFrame, order: Sequence[str], near: float = 1e-9) -> DataFrame:
    """``companies`` with the mean sentiment summed in ``order`` where it lies at a label's threshold.

    A sum of doubles depends on the order of its terms by its last bits, which decide there; elsewhere
    they don't. Those few companies' events are collected, sorted and added one by one.
    """
    at_threshold = F.abs(F.abs("avg_sentiment") - mx.SENTIMENT_THRESHOLD) < near
    few = companies.filter(at_threshold).select(*ROLLUP_KEYS)
    ordered = (
        events.join(few, ROLLUP_KEYS, "left_semi")
        .filter("sentiment_score IS NOT NULL")
        .groupBy(*ROLLUP_KEYS)
        .agg(F.array_sort(F.collect_list(F.struct(*order, "sentiment_score"))).alias("_scores"))
        .select(
            *ROLLUP_KEYS,
            (
                F.aggregate("_scores", F.lit(0.0), lambda total, e: total + e["sentiment_score"]) / F.size("_scores")
            ).alias("_mean"),
        )
    )
    joined = companies.join(ordered, ROLLUP_KEYS, "left")
    return joined.withColumn("avg_sentiment", F.coalesce("_mean", "avg_sentiment")).drop("_mean")


def sentiment_distribution(companies: DataFrame) -> DataFrame:
    return companies.groupBy(
        "industry", mx.sentiment_label(F.col("avg_sentiment")).alias("sentiment_label")
    ).agg(F.count("company_id").alias("companies"))


def industry_indicators(companies: DataFrame, top: int = 20) -> DataFrame:
    """Size, demand and median intensity of the ``top`` industries by demand."""
    base = companies.groupBy("industry").agg(
        F.count_distinct("company_key").alias("total_companies"),
        F.sum("total_events").alias("total_events"),
        F.sum("demand_score").alias("total_demand"),
    )
    base = (
        base.filter("total_companies > 0")
        .orderBy(F.col("total_demand").desc(), "industry")
        .limit(top)
    )
    medians = exact_quantiles(companies, ["industry"], "intensity_score", {"median_intensity": 0.5})
    return base.join(medians, "industry", "left").withColumns(
        {
            "avg_events_per_company": F.round(F.col("total_events") / F.col("total_companies"), 2),
            "total_demand_text": mx.half_away_int(F.col("total_demand")),
        }
    )


def coverage_cells(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("country", "industry")
        .agg(
            F.count("company_key").alias("total_events"),
            F.count_distinct("company_key").alias("companies"),
            F.sum("weighted_strength").alias("total_demand"),
        )
        .filter("total_events > 0")
    )


def coverage_matrix(cells: DataFrame, industries: Sequence[str], measure: str) -> DataFrame:
    """Dense country-by-industry matrix of one measure, zeros filled.

    ``country_demand`` is the country's total, by which the rows are ordered.
    """
    return (
        cells.groupBy("country")
        .agg(
            F.sum("total_demand").alias("country_demand"),
            *[
                F.coalesce(F.sum(F.when(F.col("industry") == i, F.col(measure))), F.lit(0)).alias(i)
                for i in industries
            ],
        )
        .orderBy(F.col("country_demand").desc(), "country")
    )


def signal_type_counts(
    events: DataFrame, universe: DataFrame | None = None, universe_label: str = "Wikidata"
) -> DataFrame:
    """Events per type, largest first, with the universe size as one more row."""
    counts = events.groupBy(F.coalesce("signal_type", F.lit("sin dato")).alias("signal_type")).agg(
        F.count(F.lit(1)).alias("total_signals")
    )
    if universe is not None:
        total = universe.select(
            F.lit(universe_label).alias("signal_type"), "company_numeric_id"
        ).groupBy("signal_type").agg(F.count_distinct("company_numeric_id").alias("total_signals"))
        counts = counts.unionByName(total.filter("total_signals > 0"))
    return counts.orderBy(F.col("total_signals").desc(), "signal_type")


def coverage_gaps(companies: DataFrame, universe: DataFrame) -> DataFrame:
    """Active against known companies per aligned industry; unknown industries drop out."""
    known = (
        universe.dropna(subset=["company_numeric_id"])
        .groupBy(tx.align_industry(F.col("industry")).alias("industry"))
        .agg(F.count_distinct("company_numeric_id").alias("universe_companies"))
    )
    aligned = companies.withColumn("industry", tx.align_industry(F.col("industry")))
    active = aligned.groupBy("industry").agg(
        F.count_distinct("company_key").alias("active_companies"),
        F.sum("total_events").alias("total_signals"),
        F.sum("demand_score").alias("total_demand"),
    )
    medians = exact_quantiles(aligned, ["industry"], "intensity_score", {"median_intensity": 0.5})
    return (
        active.join(known.filter("universe_companies > 0"), "industry")
        .join(medians, "industry", "left")
        .withColumns(
            {
                "coverage_pct": F.coalesce(
                    F.try_divide(F.col("active_companies") * 100.0, F.col("universe_companies")), F.lit(0.0)
                ),
                "avg_signals_per_company": F.coalesce(
                    F.try_divide(F.col("total_signals"), F.col("active_companies")), F.lit(0.0)
                ),
            }
        )
    )


def _summary_id() -> Column:
    return F.coalesce(
        F.col("company_numeric_id").cast("string"),
        F.nullif(tx.text_or_blank("company_key"), F.lit("")),
        F.lit("unknown_company"),
    )


def signal_distribution(companies: DataFrame) -> DataFrame:
    """One row: companies, signals, mean, median, population sd, quartiles, extremes.

    The percentile buffer holds one entry per distinct event count, and counts
    that differ from each other must add up to the events there are, so it grows
    with the square root of the events at most.
    """
    per_company = companies.groupBy(_summary_id().alias("_id")).agg(
        F.sum(F.coalesce("total_events", F.lit(0))).alias("n")
    )
    return per_company.agg(
        F.count(F.lit(1)).alias("companies"),
        F.sum("n").alias("total_signals"),
        F.avg("n").alias("mean"),
        F.percentile("n", 0.5).alias("median"),
        F.stddev_pop("n").alias("sd"),
        F.percentile("n", 0.25).alias("q1"),
        F.percentile("n", 0.75).alias("q3"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
    )


def coverage_summary(companies: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Formatted ``(position, metric, value)`` rows, universe rows first when given."""
    stats = signal_distribution(companies)
    rows = [
        ("Empresas únicas en la muestra", F.format_number("companies", 0)),
        ("Total de señales registradas", F.format_number("total_signals", 0)),
        ("Señales por empresa (media)", F.format_string("%.2f", F.col("mean"))),
        ("Señales por empresa (mediana)", F.format_string("%.2f", F.col("median"))),
        ("Señales por empresa (desvío estándar)", F.format_string("%.2f", F.col("sd"))),
        ("Señales por empresa (Q1)", F.format_string("%.2f", F.col("q1"))),
        ("Señales por empresa (Q3)", F.format_string("%.2f", F.col("q3"))),
        ("Señales por empresa (mínimo)", F.format_number("smallest", 0)),
        ("Señales por empresa (máximo)", F.format_number("largest", 0)),
    ]
    if universe is not None:
        cover = universe_coverage(companies, universe)
        stats = stats.withColumn("_k", F.lit(1)).join(cover.withColumn("_k", F.lit(1)), "_k")
        rows = [
            ("Empresas en el universo", F.format_number("universe_companies", 0)),
            ("Empresas del universo con señales", F.format_number("active", 0)),
            ("Empresas del universo sin señales", F.format_number("inactive", 0)),
            ("% universo cubierto", F.format_string("%.1f%%", F.col("coverage_pct"))),
        ] + rows
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric"), value.alias("value"))
            for i, (name, value) in enumerate(rows)
        ]
    )
    return stats.select(F.explode(cells).alias("c")).select("c.position", "c.metric", "c.value")


def universe_coverage(companies: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: universe size, active and inactive companies, share covered."""
    ids = universe.select("company_numeric_id").dropna().distinct()
    seen = companies.select("company_numeric_id").dropna().distinct().withColumn("_seen", F.lit(1))
    both = ids.join(seen, "company_numeric_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("universe_companies"),
        F.count("_seen").alias("active"),
        F.count_if(F.col("_seen").isNull()).alias("inactive"),
        (100.0 * F.count("_seen") / F.count(F.lit(1))).alias("coverage_pct"),
    )


def inactive_universe(companies: DataFrame, universe: DataFrame) -> DataFrame:
    seen = companies.select("company_numeric_id").dropna()
    return universe.select("company_numeric_id").dropna().distinct().join(
        seen, "company_numeric_id", "left_anti"
    )


# --- signal mix ---------------------------------------------------------------

def signal_mix(events: DataFrame, universe: DataFrame) -> DataFrame:
    """Companies per combination of signal types, types in alphabetical order.

    Distinct (company, type) pairs are formed first, so a busy company
    contributes one small set of types rather than its events.
    """
    ids = universe.select("company_numeric_id").dropna().distinct()
    kinds = (
        events.select("company_numeric_id", F.coalesce("signal_type", F.lit("unknown")).alias("signal_type"))
        .dropna()
        .distinct()
        .join(ids, "company_numeric_id", "left_semi")
    )
    combos = kinds.groupBy("company_numeric_id").agg(
        F.array_join(F.array_sort(F.collect_set("signal_type")), " + ").alias("combination")
    )
    return combos.groupBy("combination").agg(F.count(F.lit(1)).alias("companies"))


def signal_mix_flows(events: DataFrame, universe: DataFrame) -> DataFrame:
    """Flow edges: universe to active/inactive, active to each combination."""
    mix = signal_mix(events, universe)
    cover = universe_coverage(
        events.select("company_numeric_id").distinct(), universe
    )
    totals = cover.select(
        F.explode(
            F.array(
                F.struct(F.lit("Con señales").alias("target"), F.col("active").alias("value")),
                F.struct(F.lit("Sin señales").alias("target"), F.col("inactive").alias("value")),
            )
        ).alias("f")
    ).select(F.lit("Universo total").alias("source"), "f.target", "f.value")
    return totals.unionByName(
        mix.select(
            F.lit("Con señales").alias("source"),
            F.col("combination").alias("target"),
            F.col("companies").alias("value"),
        )
    )


# --- quality assurance --------------------------------------------------------

def qa_coverage(events: DataFrame, universe: DataFrame, types: Sequence[str]) -> DataFrame:
    """Companies, coverage and per-type counts and means for every stratum of either side."""
    keys = ["country", "industry"]
    total = universe.dropna(subset=keys).groupBy(*keys).agg(
        F.count_distinct("company_id").alias("companies_total")
    )
    strength = F.coalesce(F.col("signal_strength").try_cast("double"), F.lit(0.0))
    # one pass over (stratum, type, company) gives all distinct counts and means
    per_company = (
        events.dropna(subset=[*keys, "company_id"])
        .groupBy(*keys, "signal_type", "company_id")
        .agg(F.sum(strength).alias("s"), F.count(F.lit(1)).alias("n"))
    )
    flags = per_company.groupBy(*keys, "company_id").agg(
        *[F.max((F.col("signal_type") == t).cast("int")).alias(f"_has_{t}") for t in types],
        *[F.sum(F.when(F.col("signal_type") == t, F.col("s"))).alias(f"_s_{t}") for t in types],
        *[F.sum(F.when(F.col("signal_type") == t, F.col("n"))).alias(f"_n_{t}") for t in types],
    )
    seen = flags.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("companies_with_signal"),
        *[F.sum(f"_has_{t}").alias(t) for t in types],
        *[
            F.round(F.try_divide(F.sum(f"_s_{t}"), F.sum(f"_n_{t}")), 3).alias(f"avg_{t}")
            for t in types
        ],
    )
    joined = total.join(seen, keys, "full").fillna(0)
    return joined.withColumn(
        "coverage_pct",
        F.coalesce(
            F.round(F.try_divide(100.0 * F.col("companies_with_signal"), F.col("companies_total")), 1),
            F.lit(0.0),
        ),
    )


def strata_counts(universe: DataFrame) -> DataFrame:
    return universe.dropna(subset=["country", "industry"]).groupBy("country", "industry").agg(
        F.count(F.lit(1)).alias("count")
    )


def distribution_rollup(events: DataFrame) -> DataFrame:
    """Events per industry and source with an ``ALL`` row per industry."""
    return (
        events.rollup("industry", "source")
        .agg(F.count(F.lit(1)).alias("events"), F.grouping_id().alias("_g"))
        .filter("_g < 3")
        .withColumn("source", F.when(F.col("_g") == 0, F.col("source")).otherwise(F.lit("ALL")))
        .drop("_g")
    )


def count_by_country(df: DataFrame) -> DataFrame:
    """Rows per country and an ``ALL`` total."""
    return (
        df.rollup("country")
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
        .withColumn("country", F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("country")))
        .drop("_g")
    )
