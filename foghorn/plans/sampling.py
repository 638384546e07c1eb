"""Universe building: candidate merge, industry mapping, stratified sampling, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from foghorn import vocab
from foghorn.functions import measures as mx, text as tx
from foghorn.operators.rows import keep_one


def merge_entities(rows: DataFrame) -> DataFrame:
    """One row per ``qid`` from repeated candidate rows.

    Largest employees and revenue, union of labels and tickers, name and country
    of the first scan, last non-blank domain. ``scan`` orders the input rows.
    """
    def first(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull(), F.struct("scan", c)))[c]

    blank = F.trim(tx.text_or_blank("website")) == ""
    domain = tx.url_domain("website")
    merged = rows.groupBy("qid").agg(
        first("company_name").alias("company_name"),
        first("country").alias("country"),
        first("description").alias("description"),
        F.max("employees").alias("employees"),
        F.max("revenue").alias("revenue"),
        F.max(F.when(~blank, F.struct("scan", domain.alias("domain"))))["domain"].alias("company_domain"),
        F.collect_set(F.nullif(F.trim(F.col("industry_label")), F.lit(""))).alias("_labels"),
        F.min(F.nullif(F.trim(F.col("ticker")), F.lit(""))).alias("ticker"),
    )
    return (
        merged.filter(F.trim(tx.text_or_blank("company_name")) != "")
        .withColumns(
            {
                "industry_raw": F.array_join(F.array_sort("_labels"), "; "),
                "company_domain": tx.text_or_blank("company_domain"),
                "ticker": tx.text_or_blank("ticker"),
            }
        )
        .withColumn("size_bin", mx.size_bin(F.col("employees"), F.col("revenue"), F.col("ticker")))
        .drop("_labels")
    )


def map_industries(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] | None = None,
    fields: Sequence[str] = ("industry_raw", "description", "company_name", "company_domain"),
) -> DataFrame:
    """First-match industry over the joined fields; unmapped rows are dropped."""
    if rules is None:
        rules = [(pattern, slug) for pattern, slug, _ in vocab.INDUSTRY_PATTERNS]
    text = F.concat_ws(" ", *[F.col(c) for c in fields if c in df.columns])
    mapped = tx.first_match(text, [("(?iu)" + p, s) for p, s in rules], "")
    return df.withColumn("industry", mapped).filter(F.col("industry") != "")


def link_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of candidate sources, one row per name and country, lowest ``source_rank`` first."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return keep_one(merged, ["company_name", "country"], [F.col("source_rank").asc(), F.col("qid").asc()])


def employees_mask(threshold: int) -> Column:
    """Large enough by employees, or by size bin and listing where those count."""
    if threshold <= 0:
        return F.lit(True)
    bins = F.coalesce(F.col("size_bin"), F.lit(""))
    mask = F.coalesce(F.col("employees"), F.lit(0.0)) >= threshold
    if threshold <= 100:
        return mask | bins.isin("m", "l") | (tx.text_or_blank("ticker") != "")
    if threshold <= 250:
        return mask | bins.isin("m", "l")
    return mask | (bins == "l")


def _position(column: str, order: Sequence[str]) -> Column:
    """Configured position of a value; values outside the list come out null."""
    position = F.lit(None).cast("int")
    for i, value in reversed(list(enumerate(order))):
        position = F.when(F.col(column) == value, i).otherwise(position)
    return position


def allocate(
    strata: DataFrame, total_target: int, min_per_stratum: int, within: Sequence[str] = ()
) -> DataFrame:
    """Rows to take per stratum: a quota, then the remainder to the largest leftovers.

    ``strata`` has one row per non-empty stratum with ``n`` and ``position``.
    The greedy remainder is a running sum over strata (a table as small as the
    configured countries times industries), not over rows. ``within`` names the
    columns whose values are allocated apart.
    """
    whole = W.partitionBy(*within)
    quota = F.greatest(F.lit(min_per_stratum), F.floor(F.lit(total_target) / F.col("n_strata")))
    quotas = (
        strata.withColumn("n_strata", F.count(F.lit(1)).over(whole))
        .withColumn("take", F.least(F.col("n"), quota))
        .withColumn("extra", F.col("n") - F.col("take"))
        .withColumn("need", F.greatest(F.lit(0), F.lit(total_target) - F.sum("take").over(whole)))
    )
    earlier = whole.orderBy(F.col("extra").desc(), "position").rowsBetween(W.unboundedPreceding, -1)
    prior = F.coalesce(F.sum("extra").over(earlier), F.lit(0))
    add = F.greatest(F.lit(0), F.least(F.col("extra"), F.col("need") - prior))
    return quotas.withColumn("allotted", (F.col("take") + add).cast("bigint"))


STRATUM = ["country", "industry"]
SALTS = 64  # parts that the candidates left of one stratum are ranked in first


def _picks(
    candidates: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    thresholds: Sequence[int],
) -> DataFrame:
    """For every threshold (``_attempt``) the best row of each ``qid`` that passes it.

    All thresholds come from one aggregation, whose rows combine before the shuffle.
    ``_bin`` is a coarse step of ``employees`` that keeps their order (null: unknown).
    """
    base = candidates.filter(F.col("size_bin").isin("s", "m", "l"))
    if countries:
        base = base.filter(F.col("country").isin(*countries))
    if industries:
        base = base.filter(F.col("industry").isin(*industries))
    size = F.col("employees").cast("double")
    plain = [f.name for f in base.schema if f.dataType.simpleString().split("<")[0] not in ("map", "variant")]
    best = F.struct(
        size.isNull(),
        F.when(F.isnan(size), float("-inf")).otherwise(-size),
        "company_name",
        *STRATUM,
        F.xxhash64(*plain),
    )
    row = F.struct(*base.columns)
    tried = base.groupBy(F.col("qid").alias("_qid")).agg(
        *[
            F.min_by(F.when(employees_mask(t), row), F.when(employees_mask(t), best)).alias(f"_{i}")
            for i, t in enumerate(thresholds)
        ]
    )
    each = F.array(*[F.struct(F.lit(i).alias("_attempt"), F.col(f"_{i}").alias("_row")) for i in range(len(thresholds))])
    rows = tried.select(F.inline(each)).filter(F.col("_row").isNotNull()).select("_attempt", "_row.*")
    step = F.signum(size) * F.rint(F.log1p(F.abs(size)) * 64)
    return rows.withColumn("_bin", step)


def _histogram(picks: DataFrame) -> DataFrame:
    return picks.groupBy("_attempt", *STRATUM, "_bin").agg(F.count(F.lit(1)).alias("_c"))


def _allotments(
    histogram: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    total_target: int,
    min_per_stratum: int,
) -> DataFrame:
    """Rows to take per threshold and stratum, with the ``rows`` that each threshold yields."""
    if countries and industries:
        # country-major configured order; only strata that have rows exist here
        position = _position("country", countries) * len(industries) + _position("industry", industries)
    else:
        position = F.xxhash64(*STRATUM)
    strata = histogram.groupBy("_attempt", *STRATUM).agg(F.sum("_c").alias("n"))
    plan = allocate(strata.withColumn("position", position), total_target, min_per_stratum, ["_attempt"])
    return plan.withColumn("rows", F.sum("allotted").over(W.partitionBy("_attempt"))).select(
        "_attempt", *STRATUM, "allotted", "n_strata", "rows"
    )


def fallback_sample(
    candidates: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    thresholds: Sequence[int] = tuple(vocab.SAMPLE_EMPLOYEE_THRESHOLDS),
    total_target: int = vocab.SAMPLE_TOTAL_TARGET,
    min_per_stratum: int = vocab.SAMPLE_MIN_PER_STRATUM,
) -> DataFrame:
    """Quota sample by country and industry of the first threshold that meets the target, or the last.

    Largest employers first. Adds ``weight_stratum``, ``company_qid`` and the dense ``company_id`` by ``qid``.

    One plan over one scan: counts per (threshold, stratum, step of employees) give the
    allotments, the threshold, and per stratum the step below which no row is taken.
    Only rows from that step up are ranked, in parts of a stratum first, so that a step
    that holds most candidates (say unknown sizes) is not sorted by one task. The sample
    itself is numbered in one task: its size is the configured one, whatever the input's.
    """
    thresholds = list(thresholds) or [0]
    picks = _picks(candidates, countries, industries, thresholds)
    histogram = _histogram(picks)
    plan = _allotments(histogram, countries, industries, total_target, min_per_stratum)
    if total_target <= 0:
        chosen = F.lit(0)
    else:
        met = F.min(F.when(F.col("rows") >= total_target, F.col("_attempt"))).over(W.partitionBy())
        chosen = F.coalesce(met, F.lit(len(thresholds) - 1))
    plan = plan.withColumn("_chosen", chosen).filter("_attempt = _chosen").drop("_chosen", "rows")
    above = W.partitionBy("_attempt", *STRATUM).orderBy(F.col("_bin").desc_nulls_last())
    steps = histogram.withColumn(
        "_above", F.coalesce(F.sum("_c").over(above.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    cuts = (
        steps.join(plan, ["_attempt", *STRATUM])
        .filter(F.col("_above") < F.col("allotted"))
        .groupBy("_attempt", *STRATUM)
        .agg(
            F.max_by("_bin", "_above").alias("_cut"),
            F.first("allotted").alias("allotted"),
            F.first("n_strata").alias("n_strata"),
        )
    )
    if countries and industries:
        cuts = F.broadcast(cuts)  # at most one row per configured country and industry
    left = picks.join(cuts, ["_attempt", *STRATUM]).filter(F.col("_cut").isNull() | (F.col("_bin") >= F.col("_cut")))
    order = [F.col("employees").desc_nulls_last(), F.col("qid").asc()]
    left = left.withColumn("_salt", F.pmod(F.xxhash64("qid"), F.lit(SALTS)))
    for within in ([*STRATUM, "_salt"], STRATUM):
        rank = F.row_number().over(W.partitionBy(*within).orderBy(*order))
        left = left.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("allotted"))
    return left.select(
        *candidates.columns,
        (F.lit(float(total_target)) / (F.col("n_strata") * F.col("allotted"))).alias("weight_stratum"),
        F.row_number().over(W.orderBy(F.col("qid").asc())).cast("bigint").alias("company_id"),
        F.col("qid").alias("company_qid"),
    )


def stratified_sample(
    candidates: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    total_target: int = vocab.SAMPLE_TOTAL_TARGET,
    min_per_stratum: int = vocab.SAMPLE_MIN_PER_STRATUM,
) -> DataFrame:
    """:func:`fallback_sample` of all candidates, whatever their employees."""
    return fallback_sample(candidates, countries, industries, [0], total_target, min_per_stratum)


def sample_attempts(
    candidates: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    thresholds: Sequence[int] = tuple(vocab.SAMPLE_EMPLOYEE_THRESHOLDS),
    total_target: int = vocab.SAMPLE_TOTAL_TARGET,
    min_per_stratum: int = vocab.SAMPLE_MIN_PER_STRATUM,
) -> DataFrame:
    """Rows that each threshold would yield (``attempt``, ``rows``); none for a threshold that nothing passes."""
    picks = _picks(candidates, countries, industries, list(thresholds) or [0])
    plan = _allotments(_histogram(picks), countries, industries, total_target, min_per_stratum)
    return plan.groupBy(F.col("_attempt").alias("attempt")).agg(F.sum("allotted").alias("rows"))


def sample_with_fallback(
    candidates: DataFrame,
    countries: Sequence[str],
    industries: Sequence[str],
    thresholds: Sequence[int] = tuple(vocab.SAMPLE_EMPLOYEE_THRESHOLDS),
    total_target: int = vocab.SAMPLE_TOTAL_TARGET,
    min_per_stratum: int = vocab.SAMPLE_MIN_PER_STRATUM,
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """:func:`fallback_sample` and ``(threshold, rows)`` of the attempts up to the one kept.

    The attempts cost a job of their own, which gives one row per threshold.
    """
    tried = list(thresholds) or [0]
    args = (candidates, countries, industries, tried, total_target, min_per_stratum)
    rows = {r.attempt: r.rows for r in sample_attempts(*args).collect()}
    attempts: list[tuple[int, int]] = []
    for i, threshold in enumerate(tried):
        attempts.append((threshold, rows.get(i, 0)))
        if attempts[-1][1] >= total_target:
            break
    return fallback_sample(*args), attempts
