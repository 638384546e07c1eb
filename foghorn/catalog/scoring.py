"""Interest score, summaries, prospects and the event append."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W, functions as F

from foghorn.catalog.base import query, rounded
from foghorn.plans import documented as doc, events as ev, interest as it
from foghorn.operators import quantiles, rows
from foghorn.session import ensure_checkpoint_dir
from foghorn.sources import event_table, tables as tb

_SCORE_SQL = f"""
{tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}, w(grp, cap, signal_type, weight) AS (
  VALUES ('engagement', 30.0::DOUBLE, 'view', 10.0::DOUBLE), ('engagement', 30.0::DOUBLE, 'click', 12.0::DOUBLE),
         ('growth', 50.0::DOUBLE, 'signup', 15.0::DOUBLE), ('growth', 50.0::DOUBLE, 'purchase', 25.0::DOUBLE)
), s AS (
  SELECT company_id, grp, cap, ts,
         weight * signal_strength
           * exp(-(epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 86400000000.0::DOUBLE / 365.0::DOUBLE) AS event_score
  FROM e JOIN w USING (signal_type)
  WHERE signal_strength > 0 AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 366 DAY
), g AS (
  SELECT company_id, grp, least(sum(event_score), max(cap)) AS score FROM s GROUP BY ALL
), gp AS (
  SELECT company_id, coalesce(max(score) FILTER (grp = 'engagement'), 0) AS group_engagement,
         coalesce(max(score) FILTER (grp = 'growth'), 0) AS group_growth
  FROM g GROUP BY ALL
), meta AS (
  SELECT company_id, count(*) AS signals_count, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_ts
  FROM s GROUP BY ALL
), scores AS (
  SELECT u.company_id, company_name, country, industry, size_bin,
         coalesce(group_engagement, 0) AS group_engagement, coalesce(group_growth, 0) AS group_growth,
         coalesce(signals_count, 0) AS signals_count, coalesce(last_ts, '') AS last_ts,
         round(least(coalesce(group_engagement, 0) + coalesce(group_growth, 0), 100), 2) AS score_0_100
  FROM (SELECT DISTINCT company_id, company_name, country, industry, size_bin FROM u) u
  LEFT JOIN gp USING (company_id) LEFT JOIN meta USING (company_id)
)"""
_SCORE_COLS = """company_id, company_name, country, industry, size_bin, signals_count, last_ts,
  score_0_100, round(group_engagement, 4) AS group_engagement, round(group_growth, 4) AS group_growth"""


def scores(spark, sf_dir):
    return it.interest_scores(
        tb.signal_events(spark, sf_dir), tb.universe(spark, sf_dir), tb.AS_OF, tb.EVENT_WEIGHTS
    )


def _published(df):
    return rounded(df, 4, "group_engagement", "group_growth")


@query(f"WITH {_SCORE_SQL} SELECT {_SCORE_COLS} FROM scores")
def interest_score(spark, sf_dir):
    return _published(it.ranked(scores(spark, sf_dir)))


@query(f"""WITH {_SCORE_SQL}
SELECT company_id, grp AS "group", round(score, 4) AS score FROM g""")
def group_scores(spark, sf_dir):
    scored = it.scored_events(tb.signal_events(spark, sf_dir), tb.AS_OF, tb.EVENT_WEIGHTS)
    long = it.group_scores(scored, tb.EVENT_WEIGHTS)
    return rounded(long.select("company_id", "group", "score"), 4, "score")


@query(f"""WITH {tb.EVENTS_SQL}
SELECT signal_type, count(*) AS events FROM e
WHERE signal_type NOT IN ('view', 'click', 'signup', 'purchase') GROUP BY ALL""")
def dropped_signal_types(spark, sf_dir):
    return it.dropped_types(tb.signal_events(spark, sf_dir), tb.EVENT_WEIGHTS)


@query(f"""WITH {_SCORE_SQL}
SELECT country, industry, count(*) AS companies, round(avg(score_0_100), 2) AS avg_score,
  round(quantile_cont(score_0_100, 0.9), 2) AS p90_score,
  round(avg(CASE WHEN score_0_100 >= 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS high_share
FROM scores GROUP BY ALL""")
def score_summary_by_stratum(spark, sf_dir):
    return it.stratum_summary(scores(spark, sf_dir))


@query(f"""WITH {_SCORE_SQL}
SELECT {_SCORE_COLS} FROM scores
QUALIFY row_number() OVER (PARTITION BY country, industry ORDER BY score_0_100 DESC, company_id) <= 10""")
def top10_by_stratum(spark, sf_dir):
    return _published(it.top_by_stratum(scores(spark, sf_dir)))


@query(f"""WITH {_SCORE_SQL}
SELECT {_SCORE_COLS} FROM scores
WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')
  AND industry IN ('BUILDING', 'MACHINERY') AND score_0_100 >= 40
ORDER BY score_0_100 DESC, company_id LIMIT 25""")
def targeted_prospects(spark, sf_dir):
    view = it.targeted_view(
        scores(spark, sf_dir),
        [f"NATION_{i}" for i in range(1, 6)],
        ["BUILDING", "MACHINERY"],
    )
    return _published(view)


@query(f"""WITH {_SCORE_SQL}
SELECT country, industry, median(score_0_100) AS score_0_100 FROM scores GROUP BY ALL""")
def median_heat(spark, sf_dir):
    return it.median_heat(scores(spark, sf_dir))


@query(f"""WITH {_SCORE_SQL}
SELECT {_SCORE_COLS} FROM scores ORDER BY score_0_100 DESC, company_id LIMIT 200""")
def top200_companies(spark, sf_dir):
    return _published(it.top_prospects(scores(spark, sf_dir)))


# --- append and de-duplication ------------------------------------------------

def _second_batch(spark, sf_dir):
    """The whole event table again, restated: strengths doubled, click rows moved to a new url."""
    e = tb.signal_events(spark, sf_dir)
    return e.withColumn("signal_strength", F.col("signal_strength") * 2).withColumn(
        "url",
        F.when(F.col("signal_type") == "click", F.concat("url", F.lit("/v2"))).otherwise(F.col("url")),
    )


_APPEND_SQL = f"""
{tb.EVENTS_SQL}, b AS (
  SELECT *, 0 AS batch FROM e
  UNION ALL
  SELECT * REPLACE (signal_strength * 2 AS signal_strength,
                    CASE WHEN signal_type = 'click' THEN url || '/v2' ELSE url END AS url), 1 AS batch
  FROM e
), kept AS (
  SELECT * FROM b
  QUALIFY row_number() OVER (PARTITION BY company_id, signal_type, url, ts ORDER BY batch DESC, event_id DESC) = 1
)"""


@query(f"""WITH {_APPEND_SQL}
SELECT event_id, company_id, signal_type, url, round(signal_strength, 6) AS signal_strength FROM kept""")
def append_keep_last(spark, sf_dir):
    merged = ev.append_keep_last(
        tb.signal_events(spark, sf_dir), _second_batch(spark, sf_dir), order="event_id"
    )
    return merged.select(
        "event_id", "company_id", "signal_type", "url",
        F.round("signal_strength", 6).alias("signal_strength"),
    )


def _event_table(spark, sf_dir) -> str:
    """An event table in the shared folder: order events, the signals, and the signals restated."""
    folder = f"{ensure_checkpoint_dir(spark)}/events-{uuid.uuid4().hex}"
    event_table.append(spark, folder, tb.order_events(spark, sf_dir))
    event_table.append(spark, folder, tb.signal_events(spark, sf_dir))
    event_table.append(spark, folder, _second_batch(spark, sf_dir))
    return folder


_EVENT_TABLE_SQL = f"""
{tb.EVENTS_SQL}, {tb.ORDERS_SQL}, b AS (
  SELECT company_id, signal_type, coalesce(url, '') AS url, ts, source, signal_strength, climate_score,
         sentiment_score, 1 AS batch FROM e
  UNION ALL
  SELECT company_id, signal_type, CASE WHEN signal_type = 'click' THEN url || '/v2' ELSE url END, ts, source,
         signal_strength * 2, climate_score, sentiment_score, 2 FROM e
  UNION ALL
  SELECT company_id, signal_type, '', ts, source, signal_strength, NULL, 0.0, 0 FROM oe
), t AS (
  SELECT * FROM b QUALIFY row_number() OVER (
    PARTITION BY company_id, signal_type, url, ts
    ORDER BY batch DESC, source DESC, signal_strength DESC, climate_score DESC, sentiment_score DESC) = 1
)"""


@query(f"""WITH {_EVENT_TABLE_SQL}
SELECT company_id, signal_type, url, source, round(signal_strength, 6) AS signal_strength,
       epoch_us(ts) AS ts_us FROM t""")
def event_table_append(spark, sf_dir):
    return event_table.read(spark, _event_table(spark, sf_dir)).select(
        "company_id", "signal_type", "url", "source",
        F.round("signal_strength", 6).alias("signal_strength"),
        F.unix_micros("ts").alias("ts_us"),
    )


@query(f"""WITH {_EVENT_TABLE_SQL}
SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us,
       true AS in_order, true AS in_own_folder
FROM t WHERE ts >= TIMESTAMP '1997-11-15' AND ts < TIMESTAMP '2024-01-20' GROUP BY ALL""")
def event_table_months(spark, sf_dir):
    """Some months read back: their files follow each other in time and lie in the folder of the month."""
    part = event_table.read(spark, _event_table(spark, sf_dir), "1997-11-15", "2024-01-20")
    files = part.withColumns({"file": F.input_file_name(), "us": F.unix_micros("ts")})
    files = files.groupBy("file", event_table.month_of(F.col("ts")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("low"), F.max("us").alias("high")
    )
    earlier = F.max("high").over(W.partitionBy("month").orderBy("low", "high").rowsBetween(W.unboundedPreceding, -1))
    files = files.withColumn("follows", F.coalesce(earlier <= F.col("low"), F.lit(True)))
    return files.groupBy("month").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("first_us"),
        F.max("high").alias("last_us"),
        F.bool_and("follows").alias("in_order"),
        F.bool_and(F.contains("file", F.concat(F.lit("month="), "month", F.lit("/")))).alias("in_own_folder"),
    )


@query(f"""WITH {tb.EVENTS_SQL}
SELECT company_id, url, event_id, signal_type FROM e
QUALIFY row_number() OVER (PARTITION BY company_id, url ORDER BY event_id) = 1""")
def dedupe_keep_first(spark, sf_dir):
    e = tb.signal_events(spark, sf_dir).select("company_id", "url", "event_id", "signal_type")
    return rows.keep_first(e, ["company_id", "url"], "event_id")


@query(f"""WITH {tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}, {tb.ORDERS_SQL}, a AS (
  SELECT company_id, signal_type, signal_strength, source, url, climate_score FROM e
  UNION ALL SELECT company_id, signal_type, signal_strength, source, NULL, NULL FROM oe
  UNION ALL SELECT company_id, NULL, NULL, NULL, NULL, NULL FROM u
)
SELECT coalesce(signal_type, 'membership') AS signal_type, coalesce(source, 'list') AS source,
  count(*) AS n, round(sum(coalesce(signal_strength, 1.0::DOUBLE)), 4) AS strength,
  count(*) FILTER (coalesce(url, '') = '') AS blank_urls, count(climate_score) AS with_climate
FROM a GROUP BY ALL""")
def canonical_union(spark, sf_dir):
    merged = ev.union_events(
        [
            tb.signal_events(spark, sf_dir),
            tb.order_events(spark, sf_dir),
            tb.universe(spark, sf_dir).select("company_id"),
        ],
        source="list",
        signal_type="membership",
    )
    return merged.groupBy("signal_type", "source").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("signal_strength"), 4).alias("strength"),
        F.count_if(F.col("url") == "").alias("blank_urls"),
        F.count("climate_score").alias("with_climate"),
    )


# --- documented index ---------------------------------------------------------

@query("""WITH q AS (SELECT quantile_cont(c_acctbal, 0.95) AS hi FROM customer)
SELECT c_custkey, round(least(c_acctbal, hi), 4) AS c_acctbal FROM customer, q""")
def winsorised(spark, sf_dir):
    customer = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(quantiles.winsorise(customer, "c_acctbal", 0.95), 4, "c_acctbal")


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99
FROM lineitem GROUP BY ALL""")
def exact_group_quantiles(spark, sf_dir):
    line = tb.table(spark, sf_dir, "lineitem")
    out = quantiles.exact_quantiles(
        line, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    )
    return rounded(out, 4, "p50", "p90", "p99")


_PILLAR_SQL = f"""
{tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}, x AS (
  SELECT u.company_id, country, industry,
    count(*) FILTER (signal_type = 'signup')::DOUBLE AS "H",
    count(*) FILTER (signal_type = 'purchase')::DOUBLE AS "C",
    coalesce(sum(signal_strength) FILTER (signal_type = 'purchase'), 0)::DOUBLE AS "F",
    count(*) FILTER (signal_type = 'view')::DOUBLE AS "P",
    count(*) FILTER (signal_type = 'click')::DOUBLE AS "X",
    count(*) FILTER (ts >= TIMESTAMP '2024-01-24') AS hot
  FROM u LEFT JOIN e USING (company_id) GROUP BY ALL
), m AS (
  SELECT country, industry,
    {", ".join(f'avg("{p}") AS m_{p}, stddev_pop("{p}") AS s_{p}' for p in "HCFPX")}
  FROM x GROUP BY ALL
), z AS (
  SELECT company_id, country, industry, hot,
    {", ".join(f'CASE WHEN s_{p} > 0 THEN ("{p}" - m_{p}) / s_{p} ELSE 0 END AS z_{p}' for p in "HCFPX")}
  FROM x JOIN m USING (country, industry)
), q AS (
  SELECT {", ".join(f'quantile_cont(z_{p}, 0.95) AS q_{p}' for p in "HCFPX")} FROM z
), wz AS (
  SELECT company_id, country, industry, hot, {", ".join(f'least(z_{p}, q_{p}) AS w_{p}' for p in "HCFPX")} FROM z, q
), b AS (
  SELECT {", ".join(f'min(w_{p}) AS lo_{p}, max(w_{p}) AS hi_{p}' for p in "HCFPX")} FROM wz
), idx AS (
  SELECT company_id, country, industry, hot,
    {", ".join(f'CASE WHEN hi_{p} > lo_{p} THEN 100 * (w_{p} - lo_{p}) / (hi_{p} - lo_{p}) ELSE 0 END AS "{p}"' for p in "HCFPX")}
  FROM wz, b
), ix AS (
  SELECT *, 0.25::DOUBLE * "H" + 0.20::DOUBLE * "C" + 0.20::DOUBLE * "F" + 0.20::DOUBLE * "P" + 0.15::DOUBLE * "X" AS pillar_index FROM idx
)"""


def _pillars(spark, sf_dir):
    e = tb.signal_events(spark, sf_dir)
    kind = F.col("signal_type")
    counted = e.groupBy("company_id").agg(
        F.count_if(kind == "signup").cast("double").alias("H"),
        F.count_if(kind == "purchase").cast("double").alias("C"),
        F.sum(F.when(kind == "purchase", F.col("signal_strength"))).alias("F"),
        F.count_if(kind == "view").cast("double").alias("P"),
        F.count_if(kind == "click").cast("double").alias("X"),
        doc.hot_signals(F.col("ts"), tb.AS_OF, days=7).alias("hot"),
    )
    u = tb.universe(spark, sf_dir).select("company_id", "country", "industry")
    return u.join(counted, "company_id", "left").fillna(0.0, subset=list("HCFPX")).fillna(0, subset=["hot"])


@query(f"""WITH {_PILLAR_SQL}
SELECT company_id, {", ".join(f'round(z_{p}, 5) AS "{p}"' for p in "HCFPX")} FROM z""")
def stratum_zscore(spark, sf_dir):
    z = doc.stratum_zscores(_pillars(spark, sf_dir), ["country", "industry"], list("HCFPX"))
    return rounded(z.select("company_id", *"HCFPX"), 5, *"HCFPX")


@query(f"""WITH {_PILLAR_SQL}
SELECT company_id, round(pillar_index, 4) AS pillar_index FROM ix""")
def pillar_index(spark, sf_dir):
    out = doc.pillar_index(_pillars(spark, sf_dir), ["country", "industry"])
    return rounded(out.select("company_id", "pillar_index"), 4, "pillar_index")


@query(f"""WITH {_PILLAR_SQL}, h AS (
  SELECT *, CASE WHEN (SELECT max(hot) FROM ix) > 0 THEN 100.0::DOUBLE * hot / (SELECT max(hot) FROM ix) ELSE 0 END AS hot_score FROM ix
), ps AS (SELECT company_id, hot, 0.7::DOUBLE * pillar_index + 0.3::DOUBLE * hot_score AS prospect_score FROM h)
SELECT company_id, hot, round(prospect_score, 4) AS prospect_score,
  CASE WHEN prospect_score >= 60 THEN 'Muy Alto' WHEN prospect_score >= 30 THEN 'Alto' ELSE 'Medio' END AS prospect_label
FROM ps""")
def prospect_score(spark, sf_dir):
    out = doc.prospect_scores(doc.pillar_index(_pillars(spark, sf_dir), ["country", "industry"]))
    return rounded(
        out.select("company_id", "hot", "prospect_score", "prospect_label"), 4, "prospect_score"
    )


@query(f"""WITH {tb.UNIVERSE_SQL}, n AS (SELECT country, industry, count(*) AS big FROM u GROUP BY ALL),
s AS (SELECT country, industry, count(*) AS small FROM u WHERE size_bin = 'l' GROUP BY ALL)
SELECT u.company_id, round(big::DOUBLE / small, 6) AS design_weight
FROM u JOIN n USING (country, industry) JOIN s USING (country, industry) WHERE size_bin = 'l'""")
def design_weights(spark, sf_dir):
    u = tb.universe(spark, sf_dir)
    out = doc.design_weights(u.filter("size_bin = 'l'"), u, ["country", "industry"])
    return rounded(out.select("company_id", "design_weight"), 6, "design_weight")


@query(f"""WITH {_SCORE_SQL}, units AS (
  SELECT country, industry, score_0_100 AS v, count(*) AS n FROM scores WHERE score_0_100 IS NOT NULL GROUP BY ALL
), cdf AS (
  SELECT n, list(c ORDER BY k) AS cdf FROM (
    SELECT n, k, sum(exp(k * ln(n) - n - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k) AS c
    FROM (SELECT DISTINCT n, unnest(range(0, CAST(n + 10 * sqrt(n) + 60 AS BIGINT))) AS k FROM units)) GROUP BY n
), draws AS (
  SELECT country, industry, v, n, b,
    CAST('0x' || substr(md5(concat_ws('|', country, industry, v, b, 42)), 1, 12) AS BIGINT) / 281474976710656::DOUBLE AS u
  FROM (SELECT *, unnest(range(1, 101)) AS b FROM units)
), drawn AS (
  SELECT country, industry, v, b, len(list_filter(cdf, lambda c: c <= u)) AS w FROM draws JOIN cdf USING (n)
), means AS (
  SELECT country, industry, sum(w * v) / sum(w) AS mean FROM drawn GROUP BY country, industry, b HAVING sum(w) > 0
)
SELECT country, industry, round(quantile_cont(mean, 0.025), 8) AS low, round(quantile_cont(mean, 0.975), 8) AS high,
  count(*) AS replicates FROM means GROUP BY ALL""")
def bootstrap_interval(spark, sf_dir):
    out = doc.bootstrap_interval(
        scores(spark, sf_dir), ["country", "industry"], None, "score_0_100", replicates=100
    )
    return rounded(out, 8, "low", "high")
