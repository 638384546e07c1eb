"""Event schema plans: canonical projection, filters, append, union, member events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, measures as mx, text as tx
from foghorn.operators.rows import keep_one
from foghorn.schemas import EVENT, EVENT_COLUMNS

EVENT_KEY = ("company_id", "signal_type", "url", "ts")


def canonical_events(
    df: DataFrame, source: str = "", signal_type: str = "", strength: float = 1.0,
    default_climate: float | None = None,
) -> DataFrame:
    """Event columns in order, missing or null values filled with defaults.

    ``default_climate=None`` leaves an unknown relevance null, so that it counts
    as 1 in the rollup; pass 0.0 to zero such events instead.
    """
    defaults = {
        "source": source,
        "signal_type": signal_type,
        "signal_strength": strength,
        "climate_score": default_climate,
        "sentiment_score": 0.0,
    }
    out = []
    for field in EVENT.fields:
        default = defaults.get(field.name, "" if field.dataType.simpleString() == "string" else None)
        fallback = F.lit(default).cast(field.dataType)
        if field.name in df.columns:
            value = F.coalesce(F.col(field.name).cast(field.dataType), fallback)
        else:
            value = fallback
        out.append(value.alias(field.name))
    return df.select(*out)


def union_events(frames: Sequence[DataFrame], **defaults) -> DataFrame:
    """Union of event frames with differing columns, defaults filled once."""
    frames = [f for f in frames if f is not None]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return canonical_events(merged, **defaults)


def both_batches(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Current and incoming rows, told apart by ``_batch``."""
    return current.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )


def append_keep_last(
    current: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = EVENT_KEY,
    order: str | None = None,
) -> DataFrame:
    """Current rows overwritten by incoming rows with the same key.

    Within a batch the row with the largest ``order`` value wins (default: the
    row's own content, so the result never depends on file order).
    """
    both = both_batches(current, incoming)
    rest = [c for c in both.columns if c not in (*key, "_batch")]
    ranking = [F.col("_batch").desc()]
    if order:
        ranking.append(F.col(order).desc())
    ranking += [F.col(c).desc() for c in rest if c != order]
    return keep_one(both, list(key), ranking).drop("_batch")


def added_rows(merged: DataFrame, current: DataFrame) -> int:
    return max(0, merged.count() - current.count())


# --- filters ------------------------------------------------------------------

def complete_rows(events: DataFrame, since: Column) -> DataFrame:
    """Rows with a time, type, strength and company, not older than ``since``.

    The bound takes the type of the column, not the other way round, so that the
    comparison reaches the scan.
    """
    return events.dropna(
        subset=["ts", "signal_type", "signal_strength", "company_id"]
    ).filter(F.col("ts") >= since.cast(events.schema["ts"].dataType))


def positive_strength(events: DataFrame) -> DataFrame:
    """Unreadable strength counts as zero; only positive strengths stay."""
    value = F.coalesce(F.col("signal_strength").try_cast("double"), F.lit(0.0))
    return events.withColumn("signal_strength", value).filter(F.col("signal_strength") > 0)


def in_countries(df: DataFrame, countries: Sequence[str] = vocab.FOCUS_COUNTRIES) -> DataFrame:
    return df.filter(F.col("country").isin(*countries))


def filter_universe(
    universe: DataFrame,
    countries: Sequence[str] = (),
    industries: Sequence[str] = (),
    size_bins: Sequence[str] = (),
) -> DataFrame:
    if countries:
        universe = universe.filter(F.upper("country").isin(*[c.upper() for c in countries]))
    if industries:
        universe = universe.filter(F.col("industry").isin(*industries))
    if size_bins:
        universe = universe.filter(F.lower("size_bin").isin(*[s.lower() for s in size_bins]))
    return universe


def organisation_names(names: Column) -> Column:
    """Predicate for organisation-like names."""
    trimmed = F.trim(names)
    return (
        (F.length(trimmed) >= 3)
        & ~F.lower(trimmed).isin(*vocab.BANNED_ORGANISATIONS)
        & ~trimmed.contains(":")
        & trimmed.rlike(r"\p{Lu}")
    )


# --- members ------------------------------------------------------------------

def normalise_members(
    df: DataFrame, signal_type: str, source: str, as_of: dt.datetime | str
) -> DataFrame:
    """Member rows with every column present and blanks for nulls."""
    have = set(df.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    name = F.col("member_name") if "member_name" in have else col("company_name")
    return df.select(
        tx.text_or_blank(name).alias("member_name"),
        tx.text_or_blank(col("company_name")).alias("company_name"),
        tx.clean_id(col("company_id")).alias("company_id"),
        F.coalesce(col("signal_type"), F.lit(signal_type)).alias("signal_type"),
        F.coalesce(col("source"), F.lit(source)).alias("source"),
        dx.membership_ts(col("ts"), dx.as_of_lit(as_of)).alias("ts"),
        *[tx.text_or_blank(col(c)).alias(c) for c in ("url", "country", "industry", "size_bin")],
    )


def attach_company(matches: DataFrame, universe: DataFrame) -> DataFrame:
    """Company attributes of ``match_id``; a member's own values where unmatched.

    A repeated universe id contributes one row, the last by name.
    """
    attrs = keep_one(
        universe.select(
            tx.clean_id("company_id").alias("match_id"),
            F.col("company_qid").alias("u_qid"),
            F.col("company_name").alias("u_name"),
            F.col("country").alias("u_country"),
            F.col("industry").alias("u_industry"),
            F.col("size_bin").alias("u_size"),
        ).filter("match_id <> ''"),
        ["match_id"],
        [F.col("u_name").desc(), F.col("u_country").desc(), F.col("u_industry").desc()],
    )
    joined = matches.join(attrs, "match_id", "left")
    hit = F.col("u_name").isNotNull()
    own_name = F.coalesce(F.nullif(F.col("company_name"), F.lit("")), F.col("member_name"))

    def pick(u: str, own: Column) -> Column:
        return F.when(hit, tx.text_or_blank(u)).otherwise(own)

    return joined.select(
        *[c for c in matches.columns if c not in ("company_id", "company_name", "country", "industry", "size_bin", "match_id")],
        F.coalesce("match_id", "company_id").alias("company_id"),
        pick("u_qid", F.lit("")).alias("company_qid"),
        pick("u_name", own_name).alias("company_name"),
        pick("u_country", F.col("country")).alias("country"),
        pick("u_industry", F.col("industry")).alias("industry"),
        pick("u_size", F.col("size_bin")).alias("size_bin"),
    )


def member_events(matched: DataFrame) -> DataFrame:
    """Matched members as events with the membership constants."""
    return canonical_events(
        matched.withColumns(
            {
                "signal_strength": F.lit(1.0),
                "climate_score": F.lit(1.0),
                "sentiment_label": F.lit("positive"),
                "sentiment_score": F.lit(0.6),
                "title": F.concat(F.lit("Membership: "), F.col("signal_type")),
                "text_snippet": F.col("member_name"),
                "ts": dx.parse_ts(F.col("ts")),
            }
        )
    )


def external_id(signal_type: Column, name: Column, country: Column) -> Column:
    """Stable id of a member outside the universe: type, whole name key and country.

    A name without a Latin letter or digit has no slug; the digest of the name stands for it.
    """
    slug = tx.slug_dash(name)
    digest = F.concat(F.lit("unknown-"), F.sha1(F.lower(F.trim(tx.text_or_blank(name)))))
    key = F.when((slug == "unknown") & (F.lower(F.trim(tx.text_or_blank(name))) != "unknown"), digest).otherwise(slug)
    suffix = F.when(country != "", F.concat(F.lit("-"), F.lower(country))).otherwise("")
    return F.concat(F.lit("ext::"), signal_type, F.lit("::"), key, suffix)


def indexed_member_events(matches: DataFrame, universe: DataFrame) -> DataFrame:
    """Members after :func:`index_match` as events; misses become external companies."""
    u = keep_one(
        universe.select(
            tx.clean_id("company_id").alias("match_id"),
            *[F.col(c).alias(f"u_{c}") for c in ("company_qid", "company_name", "country", "industry", "size_bin")],
        ).filter("match_id <> ''"),
        ["match_id"],
        [F.col("u_company_name").asc(), F.col("u_country").asc(), F.col("u_industry").asc()],
    )
    j = matches.join(u, "match_id", "left")
    hit = F.col("match_id").isNotNull()

    def prefer(name: str) -> Column:
        return F.coalesce(F.nullif(F.col(f"u_{name}"), F.lit("")), tx.text_or_blank(name))

    titles = tx.lookup(
        F.col("signal_type"),
        vocab.MEMBERSHIP_TITLES,
        F.concat(F.lit("Membership: "), F.col("signal_type")),
    )
    snippet = F.coalesce(F.nullif(F.trim(tx.text_or_blank("text_snippet")), F.lit("")), F.col("member_name"))
    return canonical_events(
        j.withColumns(
            {
                "company_id": F.when(hit, F.col("match_id")).otherwise(
                    external_id(F.col("signal_type"), F.col("member_name"), F.col("country"))
                ),
                "company_qid": F.when(hit, tx.text_or_blank("u_company_qid")).otherwise(""),
                "company_name": F.when(hit, tx.text_or_blank("u_company_name")).otherwise(F.col("member_name")),
                "country": F.when(hit, prefer("country")).otherwise(F.col("country")),
                "industry": F.when(hit, prefer("industry")).otherwise(F.col("industry")),
                "size_bin": F.when(hit, prefer("size_bin")).otherwise(F.col("size_bin")),
                "source": F.lit("memberships"),
                "signal_strength": F.lit(1.0),
                "title": titles,
                "text_snippet": tx.collapse_ws(snippet),
                "climate_score": F.lit(1.0),
                "sentiment_label": F.lit("positive"),
                "sentiment_score": F.lit(0.6),
            }
        )
    )


def priority_description(
    source: Column, sector: Column, description: Column, status: Column, snippet: Column,
    limit: int | None = None,
) -> Column:
    """Description by source priority, repeated sentences dropped, cut to ``limit`` characters if given."""
    parts = F.filter(
        F.array(description, F.concat(F.lit("Sector: "), F.nullif(sector, F.lit(""))), status, snippet),
        lambda p: p.isNotNull() & (F.trim(p) != ""),
    )
    sentences = F.array_distinct(
        F.filter(
            F.transform(
                F.flatten(F.transform(parts, lambda p: F.split(p, r"(?<=[.!?])\s+"))),
                lambda s: tx.collapse_ws(s),
            ),
            lambda s: s != "",
        )
    )
    lead = F.concat(F.upper(source), F.lit(": "))
    return tx.cut(F.concat(lead, F.array_join(sentences, " | ")), limit)


def event_projection(extra: Sequence[str] = ()) -> list[str]:
    return [*EVENT_COLUMNS, *extra]


def enrich_strength(
    events: DataFrame,
    text: Column,
    include: Sequence[str],
    exclude: Sequence[str],
    valence: Mapping[str, float],
    base: Column,
) -> DataFrame:
    """Relevance, sentiment and adjusted strength; zero-strength events are dropped.

    ``include``/``exclude`` are matched as folded literals inside the folded
    text. The text is folded once, and the row is dropped or passed on by a
    generator, so the filter cannot be pushed below and evaluate it again.
    """
    include = tx.dedupe_terms(include, folded=True)
    exclude = tx.dedupe_terms(exclude, folded=True)

    def measured(plain: Column) -> Column:
        return F.struct(
            F.lower(tx.collapse_ws(plain)).alias("shape"),
            compound_of_words(tx.plain_words(plain), valence).alias("compound"),
        )

    def judged(m: Column) -> Column:
        return F.struct(
            tx.contains_any(m["shape"], exclude).alias("excluded"),
            tx.relevance_tier(tx.term_hits(m["shape"], include)).alias("relevance"),
            m["compound"].alias("compound"),
            mx.sentiment_label(m["compound"]).alias("label"),
            F.coalesce(base, F.lit(0.0)).alias("base"),
        )

    def enriched(j: Column) -> Column:
        dead = j["excluded"] | (j["relevance"] == 0)
        return F.struct(
            F.when(dead, 0.0)
            .otherwise(mx.adjusted_strength(j["base"], j["relevance"], j["label"], j["compound"]))
            .alias("signal_strength"),
            j["relevance"].alias("climate_score"),
            j["label"].alias("sentiment_label"),
            j["compound"].alias("sentiment_score"),
        )

    outcome = tx.let(
        F.lower(tx.fold(text)),
        lambda plain: tx.let(measured(plain), lambda m: tx.let(judged(m), enriched)),
    )
    out = ["signal_strength", "climate_score", "sentiment_label", "sentiment_score"]
    kept = F.filter(F.array(outcome), lambda e: e["signal_strength"] != 0.0)
    rest = [c for c in events.columns if c not in out]
    return events.withColumn("_e", F.explode(kept)).select(*rest, *[F.col(f"_e.{c}").alias(c) for c in out])


def compound_of_words(words: Column, valence: Mapping[str, float]) -> Column:
    """Sum of word valences squashed by ``s / sqrt(s^2 + 15)``, four decimals.

    ``words`` is folded text with single spaces. Only words of the lexicon, found
    by one set probe each, are looked at further.
    """
    levels: dict[float, list[str]] = {}
    for word, value in valence.items():
        levels.setdefault(value, []).append(word)

    def value_of(token: Column) -> Column:
        score = F.lit(0.0)
        for value, listed in levels.items():
            score = F.when(token.isin(*listed), F.lit(value)).otherwise(score)
        return score

    known = F.filter(F.split(words, " "), lambda t: t.isin(*valence))
    total = F.aggregate(known, F.lit(0.0), lambda acc, t: acc + value_of(t))
    return tx.let(total, lambda s: F.round(s / F.sqrt(s * s + 15.0), 4))


def lexicon_compound(text: Column, valence: Mapping[str, float]) -> Column:
    """Lexicon sentiment of any text."""
    return compound_of_words(tx.fold_words(text), valence)
