"""Flattening of landed JSON and XML payloads into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.functions import dates as dx, text as tx
from foghorn.operators.rows import top_k


def _json(column: str, schema: str) -> Column:
    return F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})


def board_jobs(df: DataFrame, payload: str, as_of: str) -> DataFrame:
    """Postings of a board answer ``{"jobs": [...]}``; rows without url or title dropped."""
    schema = (
        "jobs array<struct<absolute_url: string, title: string, location: struct<name: string>, "
        "updated_at: string, created_at: string>>"
    )
    jobs = df.withColumn("_p", _json(payload, schema)).select(
        *[c for c in df.columns if c != payload], F.explode("_p.jobs").alias("j")
    )
    return jobs.select(
        *[c for c in jobs.columns if c != "j"],
        F.col("j.title").alias("title"),
        F.col("j.absolute_url").alias("url"),
        tx.text_or_blank("j.location.name").alias("snippet"),
        F.coalesce(dx.parse_ts(F.coalesce("j.updated_at", "j.created_at")), dx.as_of_lit(as_of)).alias("ts"),
    ).filter((tx.text_or_blank("url") != "") & (tx.text_or_blank("title") != ""))


def posting_jobs(df: DataFrame, payload: str, as_of: str) -> DataFrame:
    """Postings of a plain array answer; category values joined, epoch-millisecond times."""
    schema = (
        "array<struct<hostedUrl: string, text: string, name: string, "
        "categories: map<string, string>, createdAt: string>>"
    )
    jobs = df.withColumn("_p", _json(payload, schema)).select(
        *[c for c in df.columns if c != payload], F.explode("_p").alias("j")
    )
    values = F.filter(F.map_values("j.categories"), lambda v: tx.text_or_blank(v) != "")
    return jobs.select(
        *[c for c in jobs.columns if c != "j"],
        F.coalesce("j.text", "j.name").alias("title"),
        F.col("j.hostedUrl").alias("url"),
        F.coalesce(F.array_join(values, ", "), F.lit("")).alias("snippet"),
        F.coalesce(dx.epoch_millis(F.col("j.createdAt")), dx.as_of_lit(as_of)).alias("ts"),
    ).filter((tx.text_or_blank("url") != "") & (tx.text_or_blank("title") != ""))


def search_articles(df: DataFrame, payload: str, as_of: str, limit: int = 0) -> DataFrame:
    """Articles of a news-search answer ``{"articles": [...]}`` with compact times."""
    schema = (
        "articles array<struct<url: string, title: string, snippet: string, seendate: string, "
        "language: string, sourcecountry: string>>"
    )
    rows = df.withColumn("_p", _json(payload, schema)).select(
        *[c for c in df.columns if c != payload], F.posexplode("_p.articles").alias("position", "a")
    )
    if limit:
        rows = rows.filter(F.col("position") < limit)
    return rows.select(
        *[c for c in rows.columns if c != "a"],
        F.col("a.url").alias("url"),
        tx.collapse_ws("a.title").alias("title"),
        tx.collapse_ws("a.snippet").alias("text_snippet"),
        tx.text_or_blank("a.language").alias("language"),
        tx.text_or_blank("a.sourcecountry").alias("sourcecountry"),
        F.when(tx.text_or_blank("a.seendate") == "", dx.as_of_lit(as_of))
        .otherwise(dx.compact_ts(F.col("a.seendate")))
        .alias("ts"),
    ).filter((tx.text_or_blank("url") != "") & (F.col("title") != ""))


def archive_stories(df: DataFrame, payload: str) -> DataFrame:
    """Stories of an archive answer ``{"results": [...]}``."""
    schema = "results array<struct<url: string, title: string, language: string, publish_date: string>>"
    rows = df.withColumn("_p", _json(payload, schema)).select(
        *[c for c in df.columns if c != payload], F.posexplode("_p.results").alias("position", "r")
    )
    return rows.select(
        *[c for c in rows.columns if c != "r"],
        F.col("r.url").alias("url"),
        F.col("r.title").alias("title"),
        tx.text_or_blank("r.language").alias("language"),
        F.lit("").alias("sourcecountry"),
        dx.parse_ts(F.col("r.publish_date")).alias("ts"),
        F.lit("mediacloud").alias("source"),
    )


def company_bindings(df: DataFrame, payload: str) -> DataFrame:
    """Candidate rows of a graph-query answer (``results.bindings``)."""
    names = [
        "company", "companyLabel", "companyDescription", "industryLabel", "employees1128",
        "employees1081", "revenue", "website", "ticker", "exchangeLabel",
    ]
    inner = ", ".join(f"{n}: struct<value: string>" for n in names)
    schema = f"results struct<bindings: array<struct<{inner}>>>"
    rows = df.withColumn("_p", _json(payload, schema)).select(
        *[c for c in df.columns if c != payload],
        F.posexplode("_p.results.bindings").alias("position", "b"),
    )
    value = lambda n: F.col(f"b.{n}.value")
    exchange = F.trim(tx.text_or_blank(value("exchangeLabel")))
    ticker = F.when(exchange != "", F.concat(value("ticker"), F.lit("@"), exchange)).otherwise(value("ticker"))
    return rows.select(
        *[c for c in rows.columns if c not in ("b", "position")],
        F.col("position").cast("bigint").alias("scan"),
        F.element_at(F.split(value("company"), "/"), -1).alias("qid"),
        F.trim(tx.text_or_blank(value("companyLabel"))).alias("company_name"),
        F.trim(tx.text_or_blank(value("companyDescription"))).alias("description"),
        F.trim(value("industryLabel")).alias("industry_label"),
        F.greatest(tx.parse_number(value("employees1128")), tx.parse_number(value("employees1081"))).alias("employees"),
        tx.parse_number(value("revenue")).alias("revenue"),
        value("website").alias("website"),
        ticker.alias("ticker"),
    ).filter(tx.text_or_blank("qid") != "")


def feed_entries(df: DataFrame, feed: str, xml: str, as_of: str, limit: int = 0) -> DataFrame:
    """Entries of landed feeds: published else updated else ``as_of``; a limit per feed."""
    schema = (
        "channel struct<item: array<struct<title: string, link: string, description: string, "
        "pubDate: string, updated: string>>>"
    )
    rows = df.withColumn("_p", F.from_xml(F.col(xml), F.lit(schema), {"rowTag": "rss"})).select(
        feed, F.posexplode("_p.channel.item").alias("position", "i")
    )
    if limit:
        rows = rows.filter(F.col("position") < limit)
    when = F.coalesce(*[_feed_time(F.col(f"i.{c}")) for c in ("pubDate", "updated")], dx.as_of_lit(as_of))
    return rows.select(
        feed,
        "position",
        F.trim(tx.text_or_blank("i.link")).alias("url"),
        tx.collapse_ws("i.title").alias("title"),
        tx.collapse_ws("i.description").alias("text_snippet"),
        when.alias("ts"),
    ).filter("url <> '' AND title <> ''")


def _feed_time(c: Column) -> Column:
    """Feed dates with a weekday and zone, or ISO."""
    plain = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    utc = F.regexp_replace(plain, r"\s+(GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(F.try_to_timestamp(utc, F.lit("d MMM yyyy HH:mm:ss Z")), dx.parse_ts(c))


def article_strength(text: Column, include: list[str], hit: float = 1.0, miss: float = 0.5) -> Column:
    folded = tx.fold_match(text)
    return F.when(tx.contains_any(folded, tx.dedupe_terms(include, folded=True)), hit).otherwise(miss)


def keep_articles(
    df: DataFrame, text: Column, include: list[str], exclude: list[str], since: Column, miss: float = 0.5
) -> DataFrame:
    """Window, exclusion terms and keyword strength of collected articles."""
    folded = tx.fold_match(text)
    return (
        df.filter(F.col("ts") >= since)
        .filter(~tx.contains_any(folded, tx.dedupe_terms(exclude, folded=True)))
        .withColumn("signal_strength", article_strength(text, include, 1.0, miss))
    )


def limit_entries(df: DataFrame, source: str, limit: int) -> DataFrame:
    return top_k(df, [source], [F.col("position").asc()], limit)
