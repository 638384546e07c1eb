"""Article discovery: keyword scoring, company registry, country inference, event rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import measures as mx, text as tx
from foghorn.operators.registry_text import registry_mentions
from foghorn.operators.rows import keep_one, row_numbers, top_k


def distinct_articles(articles: DataFrame, order: str) -> DataFrame:
    """First article per non-blank url in arrival order."""
    kept = articles.filter(F.trim(tx.text_or_blank("url")) != "")
    return keep_one(kept, ["url"], [F.col(order).asc()])


def mark_full_text(articles: DataFrame, order: str, ratio: float) -> DataFrame:
    """Flag the first ``int(n * ratio)`` articles, which get their full text."""
    total = articles.agg(F.count(F.lit(1)).alias("n"))
    budget = F.floor(total.scalar() * F.lit(ratio))
    return row_numbers(articles, [F.col(order).asc()], out="_rn").withColumn(
        "full_text", F.col("_rn") <= budget
    ).drop("_rn")


def limit_per_source(df: DataFrame, source: str, order: Sequence[Column], limit: int) -> DataFrame:
    """Per-feed, per-company or per-query row limits."""
    return top_k(df, [source], order, limit)


def score_articles(
    articles: DataFrame, text: Column, include: Sequence[str], min_hits: int = 1
) -> DataFrame:
    """Keyword hits and coverage; articles below ``min_hits`` are dropped."""
    lowered = F.lower(tx.text_or_blank(text))
    return (
        articles.withColumn("hits", tx.term_hits(lowered, [t.lower() for t in include]))
        .filter(F.col("hits") >= min_hits)
        .withColumn("climate_score", tx.keyword_coverage(text, include))
    )


# --- registry -----------------------------------------------------------------

REGISTRY_COLUMNS = ["company_id", "company_qid", "company_name", "country", "industry", "size_bin"]


def known_companies(
    sources: Sequence[DataFrame],
    region: Sequence[str] = vocab.FOCUS_COUNTRIES,
    limit: int = 0,
) -> DataFrame:
    """Registry of named companies, earlier sources first, one row per folded name.

    Companies of a known country outside ``region`` stay out; an empty
    ``region`` keeps all. ``limit`` keeps the first companies by rank.
    """
    merged = None
    for rank, source in enumerate(sources):
        part = source.select(
            *[F.col(c) if c in source.columns else F.lit("").alias(c) for c in REGISTRY_COLUMNS],
            F.lit(rank).alias("source_rank"),
        )
        merged = part if merged is None else merged.unionByName(part)
    named = merged.withColumn("name_key", tx.fold_match("company_name")).filter("name_key <> ''")
    if region:
        country = F.upper(tx.text_or_blank("country"))
        named = named.filter((country == "") | country.isin(*region))
    first = keep_one(named, ["name_key"], [F.col("source_rank").asc(), F.col("company_id").asc()])
    if limit:
        first = first.orderBy("source_rank", "company_id").limit(limit)
    return first


def alias_registry(companies: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``(alias_key, company columns)``: every spelling variant, later companies win.

    ``aliases`` may add ``(company_name, alias)`` rows from configuration.
    """
    spellings = companies.withColumn("_names", tx.company_variants("company_name"))
    if aliases is not None:
        extra = companies.join(aliases, "company_name").withColumn("_names", tx.company_variants("alias"))
        spellings = spellings.unionByName(extra.drop("alias"))
    exploded = spellings.select(
        *REGISTRY_COLUMNS, "source_rank", F.explode("_names").alias("_name")
    ).withColumn("alias_key", tx.fold_match("_name")).filter("alias_key <> ''")
    # the last stored company owns an alias: highest source rank, then id
    return keep_one(
        exploded.drop("_name"), ["alias_key"], [F.col("source_rank").desc(), F.col("company_id").desc()]
    )


def known_company_mentions(articles: DataFrame, article_id: str, text: str, registry: DataFrame) -> DataFrame:
    """Companies of the registry that articles name, one row per mention with its place.

    ``registry`` is that of :func:`alias_registry`. No entity model runs: in known-company mode an
    organisation counts only if the registry has it, so its spellings are looked up in the text.
    """
    named = registry.drop(*{article_id, "first_word", "n_words"})
    return registry_mentions(articles, article_id, text, named, "alias_key")


def match_organisations(mentions: DataFrame, organisation: str, registry: DataFrame) -> DataFrame:
    """Organisations resolved through the registry; their variants are tried in order.

    Each distinct spelling is resolved once and joined back to its mentions.
    """
    spellings = mentions.select(organisation).distinct()
    exploded = spellings.select(
        organisation, F.posexplode(tx.company_variants(organisation)).alias("_pos", "_name")
    ).withColumn("alias_key", tx.fold_match("_name"))
    hits = exploded.join(registry, "alias_key").drop("_name", "source_rank")
    resolved = keep_one(hits, [organisation], [F.col("_pos").asc()]).drop("_pos")
    return mentions.join(resolved, organisation)


def infer_country(
    source_country: Column, domain: Column, matched: Column, text: Column, language: Column
) -> Column:
    """Source country, then domain, matched company, text markers, language."""
    declared = F.coalesce(
        F.nullif(tx.country_to_iso2(source_country), F.lit("")), F.upper(F.trim(source_country))
    )
    by_language = tx.lookup(F.lower(F.substring(tx.text_or_blank(language), 1, 2)), vocab.LANGUAGE_COUNTRY)
    return F.coalesce(
        F.when(declared.isin(*vocab.FOCUS_COUNTRIES), declared),
        tx.country_from_domain(domain),
        F.nullif(F.upper(tx.text_or_blank(matched)), F.lit("")),
        tx.country_from_text(text),
        by_language,
    )


def discovery_events(
    matched: DataFrame, source_label: str = "news_discovery"
) -> DataFrame:
    """Event rows of matched articles; rows without any country are dropped.

    Expects ``url, title, text_snippet, language, sourcecountry, hits,
    climate_score`` and the matched company columns.
    """
    text = F.concat_ws(" ", "title", "text_snippet")
    place = infer_country(
        F.col("sourcecountry"), tx.url_domain("url"), F.col("country"), text, F.col("language")
    )
    return (
        matched.withColumn("_place", place)
        .filter("_place IS NOT NULL")
        .withColumns(
            {
                "signal_strength": mx.source_strength(F.col("_place"), F.col("language"), F.col("hits")),
                "country": F.col("_place"),
                "industry": F.coalesce(F.nullif(F.col("industry"), F.lit("")), F.lit("unknown")),
                "source": F.lit(source_label),
                "signal_type": F.lit("news"),
            }
        )
        .drop("_place")
    )


# --- near-string lookup -------------------------------------------------------

def sorted_tokens(c: Column | str) -> Column:
    """Words in alphabetical order, as the token-sort ratio compares them."""
    return F.array_join(F.array_sort(F.split(tx.collapse_ws(c), " ")), " ")


def lcs_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair, by bit-parallel rows.

    A row of the dynamic programme is a number whose zero bits are its steps; one addition moves it over
    a character. Pairs of which a string has at most 64 characters are moved together, as arrays.
    """
    one = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    two = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(one), np.int64)
    sizes = np.fromiter(map(len, one), np.int64, len(one))
    lengths = np.fromiter(map(len, two), np.int64, len(two))
    for i in np.flatnonzero(sizes > 64).tolist():
        out[i] = _long_lcs(one[i], two[i])
    short = np.flatnonzero((sizes <= 64) & (sizes > 0))
    short = short[np.argsort(lengths[short], kind="stable")]
    for rows in np.array_split(short, max(1, len(short) // 512)):  # pairs of like length
        if not len(rows):
            continue
        wide, long = int(sizes[rows].max()), int(lengths[rows].max())
        x = np.array([one[i] for i in rows], f"U{wide}").view(np.uint32).reshape(len(rows), wide)
        y = np.array([two[i] for i in rows], f"U{long}").view(np.uint32).reshape(len(rows), long)
        bits = np.uint64(1) << np.arange(wide, dtype=np.uint64)
        own = np.arange(wide) < sizes[rows, None]
        row = np.full(len(rows), np.iinfo(np.uint64).max, np.uint64)
        for j in range(long):
            met = ((x == y[:, j : j + 1]) & own & (j < lengths[rows])[:, None]) @ bits
            step = row & met
            row = (row + step) | (row - step)
        used = np.where(own, bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        out[rows] = np.bitwise_count(~row & used)
    return out


def _long_lcs(a: str, b: str) -> int:
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        step = row & places.get(y, 0)
        row = ((row + step) | (row - step)) & full
    return (~row & full).bit_count()


def _ratio_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        a, b = batch["a"].tolist(), batch["b"].tolist()
        total = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
        yield batch.assign(ratio=np.where(total > 0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1), 100.0))


def near_string_match(
    queries: DataFrame, query: str, choices: DataFrame, choice: str, floor: float = 92.0
) -> DataFrame:
    """Best choice per query at or above ``floor`` by token-sort ratio.

    Both sides are reduced to distinct token-sorted strings. A pair at ratio
    ``r`` differs by at most ``(a + b)(1 - r/100)`` insertions and deletions, so
    if a query is cut into one more piece than the largest such budget, one piece
    stands unchanged in the choice. Pairs are found by an equi-join on (piece,
    position), positions shifted within the budget; no query meets every choice.
    """
    q = queries.select(F.col(query), sorted_tokens(query).alias("a"))
    c = choices.select(F.col(choice), sorted_tokens(choice).alias("b"))
    slack = 1.0 - floor / 100.0
    if not 0.0 <= slack < 1.0 / 3.0:
        raise ValueError("floor must be above 66.7: below it no unchanged piece is certain")
    qa = q.select("a").distinct().withColumn("_la", F.length("a")).filter("_la > 0")
    cb = c.select("b").distinct().withColumn("_lb", F.length("b")).filter("_lb > 0")

    # partner lengths: a + b deletions allow |a - b| <= (a + b) * slack
    longest = (1.0 + slack) / (1.0 - slack)
    edits = F.floor(F.col("_la") * (1.0 + longest) * slack + 1e-9).cast("int")
    width = F.greatest(F.floor(F.col("_la") / (edits + 1)), F.lit(1)).cast("int")
    pieces = (
        qa.withColumns({"_edits": edits, "_width": width})
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_edits"))))
        .withColumn("_at", F.col("_i") * F.col("_width") + 1)
        .filter(F.col("_at") + F.col("_width") - 1 <= F.col("_la"))
        .withColumn(
            "_pos",
            F.explode(
                F.sequence(F.greatest(F.lit(1), F.col("_at") - F.col("_edits")), F.col("_at") + F.col("_edits"))
            ),
        )
        .select("a", "_la", "_edits", "_pos", "_width", F.expr("substring(a, _at, _width)").alias("_piece"))
    )
    widths = pieces.agg(F.sort_array(F.collect_set("_width")).alias("w"))
    grams = (
        cb.withColumn("_width", F.explode(widths.scalar()))
        .filter(F.col("_width") <= F.col("_lb"))
        .withColumn("_pos", F.explode(F.sequence(F.lit(1), F.col("_lb") - F.col("_width") + 1)))
        .select("b", "_lb", "_width", "_pos", F.expr("substring(b, _pos, _width)").alias("_piece"))
    )
    near = F.abs(F.col("_la") - F.col("_lb")) <= F.col("_edits")
    pairs = pieces.join(grams, ["_width", "_pos", "_piece"]).filter(near).select("a", "b").distinct()
    scored = pairs.mapInPandas(_ratio_batches, "a string, b string, ratio double")
    ranked = scored.filter(F.col("ratio") >= floor).join(c.groupBy("b").agg(F.min(choice).alias("match")), "b")
    best = keep_one(ranked, ["a"], [F.col("ratio").desc(), F.col("match").asc()])
    return q.join(best.select("a", "match", "ratio"), "a").select(query, "match", "ratio")


def map_company_industry(names: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """Industry by direct name, then alias, then near string; else ``unknown``.

    ``table`` has ``company_name, industry`` and an ``aliases`` array.
    """
    direct = table.select(F.col("company_name").alias(name), F.col("industry").alias("_direct"))
    direct = keep_one(direct, [name], [F.col("_direct").asc()])
    alias = table.select(F.explode("aliases").alias(name), F.col("industry").alias("_alias"), "company_name")
    alias = keep_one(alias, [name], [F.col("company_name").asc()]).drop("company_name")
    staged = names.join(direct, name, "left").join(alias, name, "left")
    open_names = staged.filter("_direct IS NULL AND _alias IS NULL").select(name).distinct()
    near = near_string_match(open_names, name, table, "company_name").select(name, F.col("match").alias("_match"))
    by_near = near.join(direct.withColumnRenamed(name, "_match"), "_match").select(
        name, F.col("_direct").alias("_near")
    )
    joined = staged.join(by_near, name, "left")
    return joined.withColumn(
        "industry", F.coalesce("_direct", "_alias", "_near", F.lit("unknown"))
    ).drop("_direct", "_alias", "_near")
