"""Theme prospect lists from events of companies outside the universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import measures as mx, text as tx
from foghorn.operators.rows import keep_one


def theme_candidates(
    events: DataFrame, industries: Sequence[str], keywords: Sequence[str], regex: bool = True
) -> DataFrame:
    """Rows of a listed industry, or with a keyword in title, description or snippet.

    Keywords are patterns over the accent-free text; ``regex=False`` takes them
    literally.
    """
    text = F.concat_ws(
        " ", *[tx.text_or_blank(c) for c in ("title", "description", "text_snippet") if c in events.columns]
    )
    folded = tx.fold(F.lower(text))
    words = [tx.fold_literal(k) if k == k.strip() else tx.fold_literal(k) + " " for k in keywords if k]
    if not words:
        hit = F.lit(False)
    elif regex:
        hit = folded.rlike("|".join(words))
    else:
        hit = tx.contains_any(folded, words)
    return events.filter(F.col("industry").isin(*industries) | hit)


def summarise_prospects(
    events: DataFrame,
    limit: int = 25,
    order_id: str = "event_id",
    snippet_limit: int | None = None,
    justification_limit: int | None = None,
) -> DataFrame:
    """One row per company with modal attributes, signal types and a justification.

    Sorted by number of types, last time and name. Companies whose country is
    always null keep a null country. The snippet is the newest non-blank
    description, else the newest non-blank snippet, tags removed.

    One aggregation over one scan. Modes are kept as counts per value that merge
    before the shuffle, so a company's state grows with its distinct countries,
    industries and types, not its rows; the smallest value wins a tie.
    """
    e = events.dropna(subset=["company_name"]).withColumns(
        {"country": F.upper("country"), "_type": F.coalesce("signal_type", F.lit("unknown"))}
    )

    def newest(c: str) -> Column:
        if c not in e.columns:
            return F.lit(None).cast("string")
        time = F.col("ts").cast("timestamp")
        row = F.struct(time.isNull(), -F.unix_micros(time), F.col(order_id), F.col(c).alias("value"))
        return F.min(F.when(F.trim(F.col(c)) != "", row))["value"]

    joined = e.groupBy("company_name").agg(
        F.mode("country", True).alias("country"),
        F.mode("industry", True).alias("industry"),
        F.array_sort(F.collect_set("_type")).alias("_types"),
        F.size(F.collect_set("signal_type")).alias("type_count"),
        F.max("ts").alias("_last"),
        newest("description").alias("_description"),
        newest("text_snippet").alias("_text_snippet"),
    )
    snippet = F.trim(F.coalesce("_description", "_text_snippet", F.lit("")))
    snippet = F.regexp_replace(F.regexp_replace(snippet, "<[^>]+>", " "), "\n", " ")
    justification = F.concat_ws(
        " | ",
        F.concat(F.lit("signals: "), F.array_join("_types", ", ")),
        F.concat(F.lit("last_update: "), F.date_format("_last", "yyyy-MM-dd")),
        F.when(snippet != "", tx.cut(snippet, snippet_limit)),
    )
    ranked = joined.orderBy(F.col("type_count").desc(), F.col("_last").desc_nulls_last(), "company_name")
    return ranked.limit(limit).select(
        "company_name",
        "country",
        "industry",
        F.array_join("_types", "|").alias("source"),
        tx.cut(justification, justification_limit).alias("justification"),
    )


def theme_list(
    events: DataFrame, industries: Sequence[str], keywords: Sequence[str], limit: int = 25
) -> DataFrame:
    """Prospects of one theme among the companies outside the universe."""
    outside = events.filter(tx.is_external("company_id"))
    return summarise_prospects(theme_candidates(outside, industries, keywords), limit)


def shipped_themes(events: DataFrame, limit: int = 25) -> dict[str, DataFrame]:
    """The two standing theme lists."""
    return {
        "renewables": theme_list(events, vocab.RENEWABLE_INDUSTRIES, vocab.RENEWABLE_KEYWORDS, limit),
        "digital_assets": theme_list(events, vocab.DIGITAL_INDUSTRIES, vocab.DIGITAL_KEYWORDS, limit),
    }


def price_moves(
    prices: DataFrame, since: Column, period: str, order: Sequence[str] = ("ts",)
) -> DataFrame:
    """Change between the first and last price of the window, per ticker.

    First and last are combined minima and maxima, so a ticker with most of the
    rows is reduced in every task before the shuffle.
    """
    kept = prices.filter(F.col("close").isNotNull() & (F.col("ts") >= since))
    at = F.struct(*[F.col(c) for c in order], F.col("close").alias("price"))
    ends = kept.groupBy("ticker").agg(
        F.min(at).alias("_a"), F.max(at).alias("_b"), F.max("ts").alias("last_ts")
    )
    change = (F.col("_b.price") - F.col("_a.price")) / F.col("_a.price")
    return (
        ends.filter(F.col("_a.price") != 0)
        .select(
            "ticker",
            F.col("_a.price").alias("first_close"),
            F.col("_b.price").alias("last_close"),
            "last_ts",
            change.alias("change"),
        )
        .withColumns(
            {
                "signal_strength": mx.price_strength(F.col("change")),
                "title": F.concat("ticker", F.lit(" activity")),
                "text_snippet": F.format_string(f"Δp %.1f%% (period {period})", F.col("change") * 100),
            }
        )
    )


def finance_events(moves: DataFrame, universe: DataFrame) -> DataFrame:
    """One event per company listed under the ticker."""
    listed = universe.withColumn("ticker", F.trim(F.col("ticker"))).filter(F.length("ticker") > 0)
    return moves.join(listed, "ticker").withColumns(
        {"source": F.lit("finance"), "signal_type": F.lit("finance"), "ts": F.col("last_ts")}
    )


def job_events(
    postings: DataFrame, universe: DataFrame, keywords: Sequence[str], since: Column
) -> DataFrame:
    """Postings matched to companies by lower-case domain; the last company of a domain wins."""
    owners = keep_one(
        universe.filter(F.length(tx.text_or_blank("company_domain")) > 0).withColumn(
            "_domain", F.lower("company_domain")
        ),
        ["_domain"],
        [F.col("company_id").desc()],
    )
    text = F.lower(F.concat_ws(" ", tx.text_or_blank("title"), tx.text_or_blank("snippet")))
    strength = F.when(tx.contains_any(text, [k.lower() for k in keywords]), 1.0).otherwise(0.5)
    kept = postings.filter(F.col("ts") >= since).withColumn("_domain", F.lower("company_domain"))
    return kept.drop("company_domain").join(owners, "_domain").withColumns(
        {
            "signal_strength": strength,
            "source": F.lit("jobs"),
            "signal_type": F.lit("job_posting"),
            "text_snippet": F.col("snippet"),
        }
    ).drop("_domain", "snippet")
