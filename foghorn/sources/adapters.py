"""Source adapters: member files with their own layouts to one member schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, measures as mx, text as tx
from foghorn.operators.rows import keep_one
from foghorn.schemas import MEMBER_CONTEXT


def _first_text(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-blank of several columns, blank when none is there."""
    options = [F.nullif(F.trim(tx.text_or_blank(n)), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*options, F.lit(""))


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _member_rows(
    df: DataFrame,
    signal_type: str,
    as_of: str,
    name: str,
    times: Sequence[str],
    sector: Column,
    size: Column,
    url: Column,
    snippet: Column,
    context: dict[str, Column],
    countries: Sequence[str],
) -> DataFrame:
    fixed = {c: tx.text_or_blank(context[c]) if c in context else F.lit("") for c in MEMBER_CONTEXT}
    midnight = F.date_trunc("DAY", dx.as_of_lit(as_of))
    return (
        df.select(
            F.trim(tx.text_or_blank(name)).alias("member_name"),
            dx.first_ts(*[_column(df, t) for t in times], default=midnight).alias("ts"),
            url.alias("url"),
            tx.country_to_iso2(_column(df, "country")).alias("country"),
            tx.sector_industry(sector).alias("industry"),
            size.alias("size_bin"),
            tx.collapse_ws(snippet).alias("text_snippet"),
            *[value.alias(c) for c, value in fixed.items()],
            F.lit(signal_type).alias("signal_type"),
        )
        .filter(F.col("country").isin(*countries) & (F.col("member_name") != ""))
    )


def bcorp_members(
    df: DataFrame, as_of: str, countries: Sequence[str] = vocab.REGION_COUNTRIES
) -> DataFrame:
    sector = F.coalesce(_column(df, "industry_category"), _column(df, "industry"))
    return _member_rows(
        df, "bcorp", as_of, "company_name",
        ["date_certified", "date_first_certified", "assessment_year"],
        sector,
        mx.banded_size(_column(df, "size"), vocab.BCORP_SIZE),
        _first_text(df, ["b_corp_profile", "website"]),
        _first_text(df, ["description", "products_and_services"]),
        {
            "context_sector": _column(df, "industry_category"),
            "context_description": _column(df, "description"),
            "context_extra": _column(df, "products_and_services"),
        },
        countries,
    )


def ungc_members(
    df: DataFrame, as_of: str, countries: Sequence[str] = vocab.REGION_COUNTRIES
) -> DataFrame:
    status = F.concat_ws(
        " | ",
        F.nullif(tx.text_or_blank(_column(df, "status")), F.lit("")),
        F.nullif(tx.text_or_blank(_column(df, "ownership")), F.lit("")),
    )
    return _member_rows(
        df, "ungc", as_of, "name", ["joined_on"],
        _column(df, "sector"),
        mx.banded_size(F.lower(_column(df, "type")), vocab.UNGC_SIZE),
        tx.text_or_blank(_column(df, "participant_url")),
        status,
        {
            "context_sector": _column(df, "sector"),
            "context_type": _column(df, "type"),
            "context_description": _column(df, "status"),
            "context_extra": _column(df, "ownership"),
        },
        countries,
    )


def sbti_members(
    df: DataFrame, as_of: str, countries: Sequence[str] = vocab.REGION_COUNTRIES
) -> DataFrame:
    return _member_rows(
        df, "sbti", as_of, "member_name", ["ts"],
        _column(df, "sector"),
        F.lit(""),
        tx.text_or_blank(_column(df, "url")),
        F.lit(vocab.SBTI_SNIPPET),
        {
            "context_sector": _column(df, "sector"),
            "context_type": _column(df, "type"),
            "context_description": _column(df, "target_type"),
            "context_extra": _column(df, "source"),
        },
        countries,
    )


def target_list_candidates(df: DataFrame, countries: Sequence[str]) -> DataFrame:
    """Candidate companies of a targets list: mapped sector, no small enterprises."""
    kind = F.lower(tx.text_or_blank("organization_type"))
    return (
        df.withColumns(
            {
                "country": tx.country_inside_text(F.col("location")),
                "industry": tx.sector_exact_industry("sector"),
                "company_name": F.trim(tx.text_or_blank("company_name")),
            }
        )
        .filter(F.col("country").isin(*countries) & (F.col("industry") != ""))
        .filter((kind != "sme") & (F.col("company_name") != ""))
        .select(
            tx.prefixed_hash_id("sbti", F.col("company_name"), F.col("country")).alias("qid"),
            "company_name",
            "country",
            F.col("sector").alias("industry_raw"),
            F.coalesce(_column(df, "full_target_language"), F.col("sector"), F.lit("")).alias("description"),
            F.lit(None).cast("double").alias("employees"),
            F.lit(None).cast("double").alias("revenue"),
            F.lit("").alias("company_domain"),
            F.lit("").alias("ticker"),
            F.when(kind == "corporate", "l").otherwise("m").alias("size_bin"),
            F.lit("sbti").alias("source"),
            F.lit(2).alias("source_rank"),
            "industry",
        )
    )


def list_page_candidates(rows: DataFrame) -> DataFrame:
    """Candidate companies from company-list table rows (``country, cells`` map).

    The name, industry and description columns are found by header substring;
    the first company of a name within a country wins.
    """
    def cell(*needles: str) -> Column:
        keys = F.filter(F.map_keys("cells"), lambda k: F.lower(k).rlike("|".join(needles)))
        return F.try_element_at("cells", F.try_element_at(keys, F.lit(1)))

    name = F.coalesce(cell("name"), cell("company"))
    raw = tx.text_or_blank(cell("industry", "sector", "type", "field", "products"))
    notes = F.coalesce(cell("notes", "description", "remarks", "activity"), raw)
    staged = rows.select(
        "country",
        "url",
        "table_no",
        "row_no",
        F.trim(tx.text_or_blank(name)).alias("company_name"),
        F.coalesce(F.nullif(raw, F.lit("")), notes).alias("industry_raw"),
        notes.alias("description"),
        tx.list_page_industry(F.concat_ws(" ", raw, notes)).alias("industry"),
    ).filter(
        (F.col("company_name") != "")
        & ~F.lower("company_name").isin("name", "company", "organisation")
        & (F.col("industry") != "")
    )
    first = keep_one(staged, ["country", "company_name"], [F.col("table_no").asc(), F.col("row_no").asc()])
    digest = tx.prefixed_hash_id("sbti", F.col("company_name"), F.col("country"))
    return first.select(
        F.concat(F.lit("wiki-"), F.regexp_replace(digest, "^sbti-", "")).alias("qid"),
        "company_name",
        "country",
        "industry_raw",
        "description",
        F.lit(None).cast("double").alias("employees"),
        F.lit(None).cast("double").alias("revenue"),
        F.lit("").alias("company_domain"),
        F.lit("").alias("ticker"),
        F.lit("m").alias("size_bin"),
        F.lit("wikipedia").alias("source"),
        F.lit(3).alias("source_rank"),
        "industry",
    )
