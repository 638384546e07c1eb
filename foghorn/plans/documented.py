"""Documented index methods: z-scores, pillar index, prospect score, bootstrap, label rules."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import dates as dx, text as tx
from foghorn.operators.quantiles import _null_safe_left, exact_quantiles
from foghorn.operators.rows import row_numbers
from foghorn.session import materialise


def hot_signals(ts: Column, as_of: dt.datetime | str, days: int = vocab.HOT_DAYS) -> Column:
    return F.count_if(ts >= dx.as_of_lit(as_of) - F.expr(f"INTERVAL {days} DAYS"))


def stratum_zscores(df: DataFrame, strata: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Population z-scores within strata; a constant stratum scores zero.

    Moments come from one combined aggregation joined back, so a large stratum
    is never gathered in one window.
    """
    moments = df.groupBy(*strata).agg(
        *[F.avg(v).alias(f"_m_{v}") for v in values],
        *[F.stddev_pop(v).alias(f"_s_{v}") for v in values],
    )
    joined = _null_safe_left(df, moments, strata)
    z = {
        v: F.when(
            F.col(f"_s_{v}") > 0, (F.col(v) - F.col(f"_m_{v}")) / F.col(f"_s_{v}")
        ).otherwise(0.0)
        for v in values
    }
    return joined.withColumns(z).drop(*[f"_m_{v}" for v in values], *[f"_s_{v}" for v in values])


def rebase(df: DataFrame, values: Sequence[str], p: float = 0.95) -> DataFrame:
    """Winsorise each column at its upper quantile, then stretch to 0..100.

    All columns share one quantile pass over (column, value) rows. The clipped
    column ends at the quantile itself, so that pass also gives both bounds.
    """
    df = materialise(df)
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("pillar"), F.col(v).alias("value")) for v in values])
        ).alias("c")
    ).select("c.*")
    bounds = exact_quantiles(long, ["pillar"], "value", {"lo": 0.0, "hi": p})
    wide = bounds.agg(
        F.struct(
            *[
                F.max(F.when(F.col("pillar") == v, F.col(end))).alias(f"{end}_{v}")
                for v in values
                for end in ("lo", "hi")
            ]
        ).alias("b")
    )
    df = df.withColumn("_b", wide.scalar())

    def stretched(v: str) -> Column:
        low, high = F.col(f"_b.lo_{v}"), F.col(f"_b.hi_{v}")
        return F.when(
            F.col(v).isNotNull() & (high > low), 100.0 * (F.least(F.col(v), high) - low) / (high - low)
        ).when(F.col(v).isNotNull(), 0.0)

    return df.withColumns({v: stretched(v) for v in values}).drop("_b")


def pillar_index(
    df: DataFrame,
    strata: Sequence[str],
    weights: Mapping[str, float] = vocab.PILLAR_WEIGHTS,
) -> DataFrame:
    """z-score within stratum, winsorise, rebase, then the weighted sum."""
    values = list(weights)
    based = rebase(stratum_zscores(df, strata, values), values)
    total = sum((F.lit(w) * F.col(v) for v, w in weights.items()), F.lit(0.0))
    return based.withColumn("pillar_index", total)


def prospect_scores(
    df: DataFrame,
    index: str = "pillar_index",
    hot: str = "hot",
    alpha: float = vocab.PROSPECT_ALPHA,
    beta: float = vocab.PROSPECT_BETA,
    labels: Sequence[tuple[float, str]] = ((60.0, "Muy Alto"), (30.0, "Alto")),
    lowest: str = "Medio",
) -> DataFrame:
    """``alpha * index + beta * hot``, hot counts scaled by the largest to 0..100."""
    top = df.agg(F.max(hot).alias("top"))
    hot_score = F.coalesce(F.try_divide(100.0 * F.col(hot), top.scalar()), F.lit(0.0))
    out = df.withColumn("prospect_score", alpha * F.col(index) + beta * hot_score)
    label = F.lit(lowest)
    for floor, name in sorted(labels):
        label = F.when(F.col("prospect_score") >= floor, name).otherwise(label)
    return out.withColumn("prospect_label", label)


def priority_rule(hiring: Column, committed: Column, recent_press: Column) -> Column:
    """The example rule: active hiring, a commitment and recent press is "very high"."""
    return hiring & committed & recent_press


def design_weights(sample: DataFrame, frame: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Stratum size over sampled size."""
    big = frame.groupBy(*strata).agg(F.count(F.lit(1)).alias("_big"))
    small = sample.groupBy(*strata).agg(F.count(F.lit(1)).alias("_small"))
    ratio = big.join(small, list(strata)).withColumn("design_weight", F.col("_big") / F.col("_small"))
    return sample.join(ratio.drop("_big", "_small"), list(strata))


def _poisson_start(n: Column) -> tuple[Column, Column, Column]:
    """The count at which the running sum starts, its probability, and the steps to ten deviations above the mean."""
    root = F.sqrt(n)
    first = F.when(n <= 300, F.lit(0.0)).otherwise(F.floor(n - 8 * root - 20).cast("double"))
    # the logarithm of n**first * exp(-n) / first! by Stirling's series, ordered so that no large terms cancel
    series = 1 / (12 * first) - 1 / (360 * F.pow(first, F.lit(3))) + 1 / (1260 * F.pow(first, F.lit(5)))
    far = first * F.log1p((n - first) / first) - (n - first) - F.log(2 * math.pi * first) / 2 - series
    p = F.exp(F.when(n <= 300, -n).otherwise(far))
    return first, p, F.ceil(n - first + 10 * root + 60).cast("int")


def poisson(n: Column, unit: Column) -> Column:
    """The count of mean ``n`` whose place in the distribution is ``unit`` (0 to 1), by inversion.

    The running sum of the probabilities starts where less than 2**-48 lies below, and
    goes on to ten deviations above the mean, some 18 * sqrt(n) terms, so a draw costs that many steps, whatever its value.
    """
    first, p, most = _poisson_start(n)

    def step(state: Column, i: Column) -> Column:
        term = state["p"] * n / (state["k"] + 1)
        higher = F.struct(term.alias("p"), (state["sum"] + term).alias("sum"), (state["k"] + 1).alias("k"))
        return F.when(unit >= state["sum"], higher).otherwise(state)

    start = F.struct(p.alias("p"), p.alias("sum"), first.alias("k"))
    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda state: state["k"])


#: Places of a distribution that are looked through together.
CDF_STRIDE = 32


def poisson_table(counts: DataFrame, n: str) -> DataFrame:
    """``counts`` (distinct means ``n``) with the running sums of each Poisson distribution.

    ``_first`` is the count of the first sum; less than 2**-48 lies below. ``_cdf`` goes on to ten
    deviations above the mean, some 18 * sqrt(n) sums. ``_marks`` holds every ``CDF_STRIDE``-th sum.
    """
    mean = F.col(n)
    first, p, most = _poisson_start(mean)

    def step(state: Column, i: Column) -> Column:
        term = state["p"] * mean / (state["k"] + 1)
        total = state["sum"] + term
        sums = F.concat(state["sums"], F.array(total))
        return F.struct(term.alias("p"), total.alias("sum"), (state["k"] + 1).alias("k"), sums.alias("sums"))

    start = F.struct(p.alias("p"), p.alias("sum"), first.alias("k"), F.array(p).alias("sums"))
    sums = F.aggregate(F.sequence(F.lit(2), most), start, step, lambda state: state["sums"])
    cdf = counts.select(n, first.alias("_first"), sums.alias("_cdf"))
    return cdf.withColumn("_marks", F.filter("_cdf", lambda c, i: i % CDF_STRIDE == 0))


def poisson_of_table(unit: Column) -> Column:
    """The count whose place in the distribution is ``unit`` (0 to 1), in a :func:`poisson_table`.

    The marks lead to one stride of sums, so a draw costs some sqrt(n) / 2 comparisons and one stride.
    """
    below = F.size(F.filter("_marks", lambda c: c <= unit))
    within = F.size(F.filter(F.slice("_cdf", (below - 1) * CDF_STRIDE + 1, F.lit(CDF_STRIDE)), lambda c: c <= unit))
    return F.col("_first") + F.when(below == 0, 0).otherwise((below - 1) * CDF_STRIDE + within)


def bootstrap_interval(
    df: DataFrame,
    strata: Sequence[str],
    id_col: str | None,
    value: str,
    replicates: int = 200,
    seed: int = 42,
    level: float = 0.95,
) -> DataFrame:
    """Interval of the stratum mean from Poisson(1) bootstrap weights.

    The rows of one ``id_col`` are drawn together; with None every row is drawn by itself.
    n units of equal value in a stratum weigh Poisson(n) in all, which is drawn at once
    per replicate, so what is drawn grows with the distinct values (two-decimal scores:
    10,001 at most) and not with the rows. A draw inverts a hash of (stratum, value,
    replicate, seed) and so depends on neither partitions nor the order of rows.
    Null values are left out, and so is a replicate in which a whole stratum weighs nothing.
    """
    keys = [F.col(c) for c in strata]
    v = F.col(value).cast("double")
    rows = df.select(*keys, *([] if id_col is None else [F.col(id_col).alias("_id")]), v.alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull())
    if id_col is None:
        units = rows.withColumn("_size", F.lit(1))
    else:
        # decimal sums, since those of doubles would depend on the order of rows
        total = F.sum(F.col("_v").cast("decimal(28,10)")).cast("double")
        units = rows.groupBy(*strata, "_id").agg(total.alias("_v"), F.count(F.lit(1)).alias("_size"))
    equal = units.groupBy(*strata, "_v", "_size").agg(F.count(F.lit(1)).cast("double").alias("_n"))

    def draw(b: Column) -> Column:
        text = F.concat_ws("|", *[k.cast("string") for k in keys], F.col("_v").cast("string"), b.cast("string"), F.lit(str(seed)))
        unit = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)
        return F.struct(b.alias("_b"), tx.let(unit, poisson_of_table).alias("_w"))

    draws = F.transform(F.sequence(F.lit(1), F.lit(replicates)), draw)
    # few rows with many draws each: a fixed number of tasks, which are not put together by their small size
    placed = equal.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *strata, "_v", "_size")
    placed = placed.join(poisson_table(equal.select("_n").distinct(), "_n"), "_n")
    drawn = placed.select(*strata, "_v", "_size", F.inline(draws)).filter("_w > 0")
    means = drawn.groupBy(*strata, "_b").agg(
        (F.sum(F.col("_w") * F.col("_v")) / F.sum(F.col("_w") * F.col("_size"))).alias("_mean")
    )
    tail = (1.0 - level) / 2.0
    # one value per replicate: the percentile buffer holds ``replicates`` entries
    return means.groupBy(*strata).agg(
        F.percentile("_mean", tail).alias("low"),
        F.percentile("_mean", 1.0 - tail).alias("high"),
        F.count(F.lit(1)).alias("replicates"),
    )


def label_scores(
    df: DataFrame,
    text: str,
    lexicon: Sequence[tuple[str, str]],
    entity: str,
    source: str,
    arrival: str,
    source_weights: Mapping[str, float] = vocab.LABEL_SOURCE_WEIGHTS,
    damping: float = vocab.LABEL_REPEAT_DAMPING,
) -> DataFrame:
    """Best label per row by ``2 * multi-word hits + single-word hits + source weight``.

    Repeats of a text by the same entity and source weigh half as much each time
    (their source weight is damped). ``arrival`` is a unique, ordered row id. ``lexicon`` lists ``(label, term)``; a term
    counts when it stands as whole words in the folded text. Ties go to the
    label listed first. Rows without a hit, or under 2 points, get no label.
    """
    labels = list(dict.fromkeys(label for label, _ in lexicon))
    padded = F.concat(F.lit(" "), tx.fold_words(text), F.lit(" "))
    repeat = _repeat_number(df, [entity, source, text], arrival)
    staged = repeat.withColumn("_padded", padded)
    weight = F.lit(0.0)
    for name, value in source_weights.items():
        weight = F.when(F.col(source) == name, value).otherwise(weight)
    damped = weight * F.pow(F.lit(damping), F.col("_repeat") - 1)

    def hits(label: str) -> Column:
        total = F.lit(0)
        for owner, term in lexicon:
            if owner == label:
                folded = tx.fold_literal(term)
                value = 2 if " " in folded else 1
                found = F.col("_padded").contains(f" {folded} ")
                total = total + F.when(found, value).otherwise(0)
        return total

    options = F.array(
        *[
            F.struct(hits(label).alias("hits"), F.lit(-i).alias("order"), F.lit(label).alias("label"))
            for i, label in enumerate(labels)
        ]
    )
    scored = staged.withColumn("_best", F.array_max(options)).withColumn(
        "label_score", F.when(F.col("_best.hits") > 0, F.col("_best.hits") + damped).otherwise(0.0)
    )
    return scored.withColumn(
        "label", F.when(F.col("label_score") >= 2, F.col("_best.label"))
    ).drop("_padded", "_best", "_repeat")


def _repeat_number(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """1 for the first arrival of a key, 2 for the next, whatever the key's size."""
    hashed = df.withColumn("_key", F.sha2(F.to_json(F.struct(*keys)), 256))
    numbers = row_numbers(
        hashed.select("_key", arrival), [F.col(arrival).asc()], out="_repeat", within=["_key"]
    )
    return df.join(numbers.drop("_key"), arrival)


def fallback_share(
    labels: DataFrame, label: str, fallback: Sequence[str], limit: float = vocab.FALLBACK_SHARE_LIMIT
) -> DataFrame:
    """Share of rows with no label or a fallback one, against the accepted limit."""
    miss = F.col(label).isNull() | F.col(label).isin(*fallback)
    return labels.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(miss).alias("fallback_rows"),
        F.avg(miss.cast("double")).alias("share"),
    ).withColumn("accepted", F.col("share") < limit)


def inherited_industry(
    events: DataFrame, order: Sequence[str] = ("sbti", "ungc", "bcorp", "news")
) -> DataFrame:
    """Industry of a row, else the same company's from the best-ranked other source.

    The choice per company is a combined minimum, not a window over its events.
    """
    rank = F.lit(len(order))
    for i, name in reversed(list(enumerate(order))):
        rank = F.when(F.col("source") == name, i).otherwise(rank)
    known = events.filter(F.trim(tx.text_or_blank("industry")) != "")
    best = known.groupBy("company_id").agg(
        F.min(F.struct(rank.alias("r"), F.col("industry").alias("industry"))).alias("_best")
    )
    joined = events.join(best, "company_id", "left")
    own = F.nullif(F.trim(tx.text_or_blank("industry")), F.lit(""))
    return joined.withColumn("industry", F.coalesce(own, F.col("_best.industry"))).drop("_best")
