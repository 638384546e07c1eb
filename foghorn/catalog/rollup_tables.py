"""Company rollup and the published coverage tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foghorn.catalog.base import query, rounded
from foghorn.plans import rollup as rd
from foghorn.sources import tables as tb

RECENT = "2024-01-20"


def prepared(spark, sf_dir):
    e = tb.signal_events(spark, sf_dir)
    return rd.prepare_events(tb.with_company(e, tb.universe(spark, sf_dir)))


def prepared_orders(spark, sf_dir):
    e = tb.order_events(spark, sf_dir)
    return rd.prepare_events(tb.with_company(e, tb.universe(spark, sf_dir)))


def rollup(spark, sf_dir):
    return rd.company_rollup(prepared(spark, sf_dir), tb.AS_OF, RECENT)


@query(f"""WITH {tb.ROLLUP_SQL}
SELECT company_key, company_name, country, industry, total_events, company_numeric_id, recent_activity,
  recent_events, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts,
  round(avg_strength, 6) AS avg_strength, round(avg_abs_strength, 6) AS avg_abs_strength,
  round(avg_sentiment, 6) AS avg_sentiment, round(demand_score, 6) AS demand_score,
  round(intensity_score, 6) AS intensity_score FROM c""")
def company_rollup(spark, sf_dir):
    c = rollup(spark, sf_dir)
    measures = ["avg_strength", "avg_abs_strength", "avg_sentiment", "demand_score", "intensity_score"]
    return rounded(
        c.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss")).select(
            "company_key", "company_name", "country", "industry", "total_events",
            "company_numeric_id", "recent_activity", "recent_events", "last_ts", *measures,
        ),
        6,
        *measures,
    )


_RANK_SQL = f"""
{tb.ROLLUP_SQL}, r AS (
  SELECT *, round(greatest(0.6::DOUBLE, least(0.6::DOUBLE + 0.6::DOUBLE * exp(-greatest(
    (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_ts)) / 86400000000.0::DOUBLE, 0) / 180.0::DOUBLE), 1.3::DOUBLE)), 3) AS recency_factor
  FROM c WHERE recent_activity
), rp AS (SELECT *, greatest(total_events, 1) * recency_factor AS priority_score FROM r
), k AS (
  SELECT *, sum(total_events) OVER (PARTITION BY company_key) AS key_total,
    row_number() OVER (PARTITION BY company_key ORDER BY priority_score DESC, total_events DESC, demand_score DESC) AS rn
  FROM rp
), top AS (
  SELECT * FROM k WHERE rn = 1
  ORDER BY priority_score DESC, total_events DESC, demand_score DESC, company_key LIMIT 25
)"""


@query(f"""WITH {_RANK_SQL}
SELECT company_key, company_name, country, industry, CAST(key_total AS BIGINT) AS total_events, recency_factor,
  round(priority_score, 4) AS priority_score, strftime(last_ts, '%Y-%m-%d') AS last_ts_fmt,
  CASE country WHEN 'NATION_3' THEN 0 WHEN 'NATION_7' THEN 1 ELSE 2 END AS country_rank
FROM top""")
def recency_ranking(spark, sf_dir):
    r = rd.recency_ranking(rollup(spark, sf_dir), tb.AS_OF, 25, ["NATION_3", "NATION_7"])
    return rounded(
        r.select(
            "company_key", "company_name", "country", "industry", "total_events",
            "recency_factor", "priority_score", "last_ts_fmt", "country_rank",
        ),
        4,
        "priority_score",
    )


@query(f"""WITH {_RANK_SQL}
SELECT '- ' || company_name || ' (' || country || ' · ' || industry || '): score ' || printf('%.2f', priority_score)
  || ' (base ' || printf('%.2f', demand_score) || ' · recencia ' || printf('%.2f', recency_factor)
  || '), promedio ' || printf('%.2f', avg_strength) || ', señales ' || CAST(key_total AS BIGINT)
  || ', última ' || strftime(last_ts, '%Y-%m-%d') AS value
FROM top""")
def ranking_report(spark, sf_dir):
    return rd.ranking_lines(rd.recency_ranking(rollup(spark, sf_dir), tb.AS_OF, 25))


@query(f"""WITH {tb.ROLLUP_SQL}, r AS (
  SELECT * FROM c WHERE recent_activity AND last_ts >= TIMESTAMP '2024-01-30'
)
SELECT company_key, total_events, strftime(last_ts, '%Y-%m-%d') AS last_ts_fmt FROM r
ORDER BY greatest(total_events, 1) * round(0.6::DOUBLE + 0.6::DOUBLE * exp(-(epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_ts)) / 86400000000.0::DOUBLE / 180.0::DOUBLE), 3) DESC,
  total_events DESC, demand_score DESC, company_key LIMIT 25""")
def recent_only_ranking(spark, sf_dir):
    r = rd.recency_ranking(rollup(spark, sf_dir), tb.AS_OF, 25, last_since="2024-01-30")
    return r.select("company_key", "total_events", "last_ts_fmt")


@query(f"""WITH {tb.ROLLUP_SQL}
SELECT country, industry, round(sum(demand_score), 5) AS total_score, count(company_id) AS companies,
  round(sum(sum(demand_score)) OVER (PARTITION BY country), 5) AS country_total
FROM c GROUP BY country, industry""")
def country_industry_heat(spark, sf_dir):
    return rounded(rd.country_industry_heat(rollup(spark, sf_dir)), 5, "total_score", "country_total")


@query(f"""WITH {tb.ROLLUP_SQL}
SELECT country, round(sum(demand_score), 5) AS total_score, count(company_id) AS companies,
  CASE country WHEN 'NATION_1' THEN 'N01' WHEN 'NATION_2' THEN 'N02' END AS iso3
FROM c GROUP BY country""")
def country_intensity(spark, sf_dir):
    out = rd.country_intensity(rollup(spark, sf_dir), {"NATION_1": "N01", "NATION_2": "N02"})
    return rounded(out, 5, "total_score")


@query(f"""WITH {tb.ROLLUP_SQL}
SELECT country, industry, round(sum(demand_score), 5) AS total_strength, count(company_id) AS companies_count,
  round(sum(intensity_score), 5) AS intensity
FROM c GROUP BY country, industry HAVING sum(intensity_score) > 0""")
def fact_sheet(spark, sf_dir):
    return rounded(rd.fact_sheet(rollup(spark, sf_dir)), 5, "total_strength", "intensity")


_ORDERS = f"""{tb.UNIVERSE_SQL}, {tb.ORDERS_SQL}, o AS (
  SELECT oe.*, u.company_name, u.country, u.industry, oe.company_id AS company_key,
    signal_strength AS weighted_strength FROM oe JOIN u USING (company_id)
)"""


@query(f"""WITH {_ORDERS}, m AS (
  SELECT date_trunc('month', ts) AS month, signal_type, company_id, avg(weighted_strength) AS strength
  FROM o GROUP BY ALL
)
SELECT strftime(month, '%Y-%m') AS month, signal_type, count(DISTINCT company_id) AS companies,
  round(sum(strength), 5) AS strength FROM m GROUP BY m.month, signal_type""")
def timeline_two_stage(spark, sf_dir):
    out = rd.signal_timeline(prepared_orders(spark, sf_dir))
    return rounded(out.withColumn("month", F.date_format("month", "yyyy-MM")), 5, "strength")


@query(f"""WITH {_ORDERS}, m AS (
  SELECT date_trunc('month', ts) AS month, industry, count(*) AS total_signals, sum(weighted_strength) AS total_strength
  FROM o GROUP BY ALL
), t AS (
  SELECT * FROM m WHERE month >= (SELECT max(month) FROM m) - INTERVAL 23 MONTH
), lead AS (
  SELECT industry FROM t GROUP BY industry ORDER BY sum(total_signals) DESC, industry LIMIT 3
)
SELECT strftime(month, '%Y-%m') AS month, industry, total_signals, round(total_strength, 5) AS total_strength
FROM t WHERE industry IN (SELECT industry FROM lead)""")
def monthly_top_segments(spark, sf_dir):
    out = rd.industry_timeline(prepared_orders(spark, sf_dir), months=24, top=3)
    return rounded(out.withColumn("month", F.date_format("month", "yyyy-MM")), 5, "total_strength")


@query(f"""WITH {tb.ROLLUP_SQL}
SELECT industry, CASE WHEN avg_sentiment >= 0.2 THEN 'positive' WHEN avg_sentiment <= -0.2 THEN 'negative'
  ELSE 'neutral' END AS sentiment_label, count(company_id) AS companies FROM c GROUP BY ALL""")
def sentiment_distribution(spark, sf_dir):
    e = prepared(spark, sf_dir)
    companies = rd.company_rollup(e, tb.AS_OF, RECENT)
    return rd.sentiment_distribution(rd.exact_sentiment(companies, e, ["event_id"]))


@query(f"""WITH {tb.ROLLUP_SQL}, i AS (
  SELECT industry, count(DISTINCT company_key) AS total_companies, CAST(sum(total_events) AS BIGINT) AS total_events,
    sum(demand_score) AS total_demand, median(intensity_score) AS median_intensity
  FROM c GROUP BY industry ORDER BY total_demand DESC, industry LIMIT 20
)
SELECT industry, total_companies, total_events, round(total_demand, 5) AS total_demand,
  round(median_intensity, 6) AS median_intensity, round(total_events::DOUBLE / total_companies, 2) AS avg_events_per_company,
  CAST(round(total_demand, 0) AS BIGINT) AS total_demand_text FROM i""")
def industry_indicators(spark, sf_dir):
    out = rd.industry_indicators(rollup(spark, sf_dir))
    return rounded(rounded(out, 5, "total_demand"), 6, "median_intensity")


_CELLS_SQL = f"""{tb.ROLLUP_SQL}, cell AS (
  SELECT country, industry, count(company_key) AS total_events, count(DISTINCT company_key) AS companies,
    sum(weighted_strength) AS total_demand FROM p GROUP BY ALL
)"""


@query(f"""WITH {_CELLS_SQL}
SELECT country, industry, total_events, companies, round(total_demand, 5) AS total_demand FROM cell""")
def coverage_cells(spark, sf_dir):
    return rounded(rd.coverage_cells(prepared(spark, sf_dir)), 5, "total_demand")


def _matrix_sql(measure: str, kind: str) -> str:
    cols = ", ".join(
        f"CAST(coalesce(sum({measure}) FILTER (industry = '{s}'), 0) AS {kind}) AS \"{s}\""
        for s in tb.SEGMENTS
    )
    return f"WITH {_CELLS_SQL} SELECT country, round(sum(total_demand), 5) AS country_demand, {cols} FROM cell GROUP BY country"


def _matrix(spark, sf_dir, measure):
    cells = rd.coverage_cells(prepared(spark, sf_dir))
    return rounded(rd.coverage_matrix(cells, tb.SEGMENTS, measure), 5, "country_demand")


@query(_matrix_sql("total_events", "BIGINT"))
def coverage_matrix_events(spark, sf_dir):
    return _matrix(spark, sf_dir, "total_events")


@query(_matrix_sql("companies", "BIGINT"))
def coverage_matrix_companies(spark, sf_dir):
    return _matrix(spark, sf_dir, "companies")


@query(
    f"SELECT country, country_demand, {', '.join(f'round(x.{s}, 5) AS {s}' for s in tb.SEGMENTS)} FROM ("
    + _matrix_sql("total_demand", "DOUBLE")
    + ") x"
)
def coverage_matrix_demand(spark, sf_dir):
    return rounded(_matrix(spark, sf_dir, "total_demand"), 5, *tb.SEGMENTS)


@query(f"""WITH {tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}
SELECT signal_type, count(*) AS total_signals FROM e GROUP BY ALL
UNION ALL SELECT 'Wikidata', count(DISTINCT company_numeric_id) FROM u""")
def signal_type_counts(spark, sf_dir):
    return rd.signal_type_counts(
        tb.signal_events(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )


@query(f"""WITH {tb.ROLLUP_SQL}, a AS (
  SELECT industry, count(DISTINCT company_key) AS active_companies, CAST(sum(total_events) AS BIGINT) AS total_signals,
    round(sum(demand_score), 5) AS total_demand, round(median(intensity_score), 6) AS median_intensity
  FROM c GROUP BY industry
), k AS (SELECT industry, count(DISTINCT company_numeric_id) AS universe_companies FROM u GROUP BY industry)
SELECT a.*, universe_companies, round(100.0::DOUBLE * active_companies / universe_companies, 6) AS coverage_pct,
  round(total_signals::DOUBLE / active_companies, 6) AS avg_signals_per_company FROM a JOIN k USING (industry)""")
def coverage_gaps(spark, sf_dir):
    out = rd.coverage_gaps(
        rollup(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )
    return rounded(
        rounded(out, 5, "total_demand"),
        6, "median_intensity", "coverage_pct", "avg_signals_per_company",
    )


_DIST_SQL = f"""{tb.ROLLUP_SQL}, per AS (
  SELECT company_numeric_id, sum(total_events)::BIGINT AS n FROM c GROUP BY ALL
)"""


@query(f"""WITH {_DIST_SQL}
SELECT count(*) AS companies, CAST(sum(n) AS BIGINT) AS total_signals, round(avg(n), 6) AS mean, median(n) AS median,
  round(stddev_pop(n), 6) AS sd, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3,
  min(n) AS smallest, max(n) AS largest FROM per""")
def signal_distribution(spark, sf_dir):
    return rounded(rd.signal_distribution(rollup(spark, sf_dir)), 6, "mean", "sd")


@query(f"""WITH {_DIST_SQL}, s AS (
  SELECT count(*) AS companies, CAST(sum(n) AS BIGINT) AS total, avg(n) AS mean, median(n) AS med, stddev_pop(n) AS sd,
    quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3, min(n) AS lo, max(n) AS hi FROM per
), v AS (
  SELECT count(DISTINCT u.company_numeric_id) AS total,
    count(DISTINCT u.company_numeric_id) FILTER (u.company_numeric_id IN (SELECT company_numeric_id FROM c)) AS active FROM u
)
SELECT 0 AS position, 'Empresas en el universo' AS metric, format('{{:,}}', total) AS value FROM v
UNION ALL SELECT 1, 'Empresas del universo con señales', format('{{:,}}', active) FROM v
UNION ALL SELECT 2, 'Empresas del universo sin señales', format('{{:,}}', total - active) FROM v
UNION ALL SELECT 3, '% universo cubierto', printf('%.1f', 100.0 * active / total) || '%' FROM v
UNION ALL SELECT 4, 'Empresas únicas en la muestra', format('{{:,}}', companies) FROM s
UNION ALL SELECT 5, 'Total de señales registradas', format('{{:,}}', total) FROM s
UNION ALL SELECT 6, 'Señales por empresa (media)', printf('%.2f', mean) FROM s
UNION ALL SELECT 7, 'Señales por empresa (mediana)', printf('%.2f', med) FROM s
UNION ALL SELECT 8, 'Señales por empresa (desvío estándar)', printf('%.2f', sd) FROM s
UNION ALL SELECT 9, 'Señales por empresa (Q1)', printf('%.2f', q1) FROM s
UNION ALL SELECT 10, 'Señales por empresa (Q3)', printf('%.2f', q3) FROM s
UNION ALL SELECT 11, 'Señales por empresa (mínimo)', format('{{:,}}', lo) FROM s
UNION ALL SELECT 12, 'Señales por empresa (máximo)', format('{{:,}}', hi) FROM s""")
def coverage_summary(spark, sf_dir):
    return rd.coverage_summary(
        rollup(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )


@query(f"""WITH {tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}
SELECT company_numeric_id FROM u WHERE company_numeric_id NOT IN (SELECT company_numeric_id FROM e)""")
def inactive_universe(spark, sf_dir):
    return rd.inactive_universe(
        prepared(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )


@query(f"""WITH {tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}, f AS (SELECT * FROM u WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3'))
SELECT company_id, count(*) AS n FROM e WHERE company_numeric_id IN (SELECT company_numeric_id FROM f) GROUP BY ALL""")
def events_of_focus_universe(spark, sf_dir):
    from foghorn.plans.events import in_countries

    u = in_countries(tb.universe(spark, sf_dir), ["NATION_1", "NATION_2", "NATION_3"])
    e = rd.only_universe(prepared(spark, sf_dir), rd.prepare_universe(u))
    return e.groupBy("company_id").agg(F.count(F.lit(1)).alias("n"))


_MIX_SQL = f"""{_ORDERS}, combo AS (
  SELECT company_id, string_agg(DISTINCT signal_type, ' + ' ORDER BY signal_type) AS combination FROM o GROUP BY company_id
), mix AS (SELECT combination, count(*) AS companies FROM combo GROUP BY ALL)"""


@query(f"WITH {_MIX_SQL} SELECT combination, companies FROM mix")
def signal_mix(spark, sf_dir):
    return rd.signal_mix(
        prepared_orders(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )


@query(f"""WITH {_MIX_SQL}, n AS (
  SELECT count(*) AS total, count(*) FILTER (company_id IN (SELECT company_id FROM oe)) AS active FROM u
)
SELECT 'Universo total' AS source, 'Con señales' AS target, active AS value FROM n
UNION ALL SELECT 'Universo total', 'Sin señales', total - active FROM n
UNION ALL SELECT 'Con señales', combination, companies FROM mix""")
def signal_mix_flows(spark, sf_dir):
    return rd.signal_mix_flows(
        prepared_orders(spark, sf_dir), rd.prepare_universe(tb.universe(spark, sf_dir))
    )


_QA_COLS = ", ".join(
    f"coalesce(count(DISTINCT company_id) FILTER (signal_type = '{t}'), 0) AS {t}, "
    f"coalesce(round(avg(signal_strength) FILTER (signal_type = '{t}'), 3), 0) AS avg_{t}"
    for t in tb.EVENT_TYPES
)
_QA_OUT = ", ".join(f"coalesce({t}, 0) AS {t}, coalesce(avg_{t}, 0) AS avg_{t}" for t in tb.EVENT_TYPES)


@query(f"""WITH {tb.ROLLUP_SQL}, t AS (
  SELECT country, industry, count(DISTINCT company_id) AS companies_total FROM u GROUP BY ALL
), s AS (
  SELECT country, industry, count(DISTINCT company_id) AS companies_with_signal, {_QA_COLS} FROM p GROUP BY ALL
)
SELECT coalesce(t.country, s.country) AS country, coalesce(t.industry, s.industry) AS industry,
  coalesce(companies_total, 0) AS companies_total, coalesce(companies_with_signal, 0) AS companies_with_signal,
  coalesce(round(100.0::DOUBLE * coalesce(companies_with_signal, 0) / companies_total, 1), 0) AS coverage_pct, {_QA_OUT}
FROM t FULL JOIN s ON t.country = s.country AND t.industry = s.industry""")
def qa_coverage(spark, sf_dir):
    u = tb.universe(spark, sf_dir)
    e = tb.with_company(tb.signal_events(spark, sf_dir), u)
    return rd.qa_coverage(e, u, tb.EVENT_TYPES)


@query(f"WITH {tb.UNIVERSE_SQL} SELECT country, industry, count(*) AS count FROM u GROUP BY ALL")
def strata_counts(spark, sf_dir):
    return rd.strata_counts(tb.universe(spark, sf_dir))


@query(f"""WITH {tb.UNIVERSE_SQL}, {tb.EVENTS_SQL}
SELECT industry, CASE WHEN GROUPING(source) = 1 THEN 'ALL' ELSE source END AS source, count(*) AS events
FROM e JOIN u USING (company_id) GROUP BY GROUPING SETS ((industry, source), (industry))""")
def distribution_rollup(spark, sf_dir):
    return rd.distribution_rollup(
        tb.with_company(tb.signal_events(spark, sf_dir), tb.universe(spark, sf_dir))
    )


@query(f"""WITH {tb.UNIVERSE_SQL}
SELECT coalesce(country, 'ALL') AS country, count(*) AS n FROM u GROUP BY ROLLUP (country)""")
def count_by_country(spark, sf_dir):
    return rd.count_by_country(tb.universe(spark, sf_dir))
