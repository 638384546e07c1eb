"""Sampling, entity merge, shuffles and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foghorn.catalog.base import query, rounded
from foghorn.operators import rows
from foghorn.plans import sampling as sp
from foghorn.session import ensure_checkpoint_dir
from foghorn.sources import tables as tb
from foghorn.streaming import events as st

COUNTRIES = [f"NATION_{i}" for i in range(25)]
TARGET, FLOOR = 600, 3


def candidates(spark, sf_dir):
    u = tb.universe(spark, sf_dir)
    c = tb.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"), F.col("c_acctbal").alias("employees")
    )
    return u.join(c, "company_id").select(
        F.concat(F.lit("Q"), F.lpad("company_id", 8, "0")).alias("qid"),
        "company_name", "country", "industry", "size_bin", "employees",
        F.lit("").alias("ticker"), F.lit("").alias("company_domain"),
    )


_POS = "CAST(substring(country, 8) AS INTEGER) * 5 + list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], industry)"


def _sample_sql(where: str, target: int = TARGET) -> str:
    return f"""{tb.UNIVERSE_SQL}, b AS (
  SELECT 'Q' || lpad(company_id, 8, '0') AS qid, company_name, country, industry, size_bin, c_acctbal AS employees
  FROM u JOIN customer ON c_custkey = company_numeric_id WHERE {where}
), st AS (SELECT country, industry, count(*) AS n, any_value({_POS}) AS pos FROM b GROUP BY country, industry
), q AS (SELECT *, count(*) OVER () AS n_strata, least(n, greatest({FLOOR}, floor({target} / count(*) OVER ()))) AS take FROM st
), x AS (SELECT *, n - take AS extra, greatest(0, {target} - sum(take) OVER ()) AS need FROM q
), a AS (
  SELECT *, CAST(take + greatest(0, least(extra, need - coalesce(sum(extra) OVER (ORDER BY extra DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS allotted FROM x
), r AS (SELECT b.*, row_number() OVER (PARTITION BY country, industry ORDER BY employees DESC, qid) AS rn FROM b
), s AS (
  SELECT r.*, {target}::DOUBLE / (n_strata * allotted) AS weight FROM r JOIN a USING (country, industry) WHERE rn <= allotted
)"""


@query(f"""WITH {_sample_sql('true')}
SELECT qid, country, industry, round(weight, 6) AS weight_stratum, row_number() OVER (ORDER BY qid) AS company_id FROM s""")
def stratified_sample(spark, sf_dir):
    out = sp.stratified_sample(candidates(spark, sf_dir), COUNTRIES, tb.SEGMENTS, TARGET, FLOOR)
    return rounded(out.select("qid", "country", "industry", "weight_stratum", "company_id"), 6, "weight_stratum")


@query(f"""WITH {_sample_sql('true')} SELECT country, industry, n, allotted, n_strata FROM a""")
def sample_allocation(spark, sf_dir):
    c = candidates(spark, sf_dir)
    strata = c.groupBy("country", "industry").agg(F.count(F.lit(1)).alias("n"))
    position = sp._position("country", COUNTRIES) * 5 + sp._position("industry", tb.SEGMENTS)
    plan = sp.allocate(strata.withColumn("position", position), TARGET, FLOOR)
    return plan.select("country", "industry", "n", "allotted", "n_strata")


@query(f"""WITH {_sample_sql("employees >= 9800 OR size_bin = 'l'", 1000)}
SELECT 0 AS attempt, CAST(sum(allotted) AS BIGINT) AS rows FROM a UNION ALL
SELECT 1, (WITH {_sample_sql("employees >= 9500 OR size_bin = 'l'", 1000)} SELECT CAST(sum(allotted) AS BIGINT) FROM a)""")
def sample_attempts(spark, sf_dir):
    """Rows that each of two thresholds yields, from one pass."""
    return sp.sample_attempts(candidates(spark, sf_dir), COUNTRIES, tb.SEGMENTS, [9800, 9500], 1000, FLOOR)


@query(f"""WITH {_sample_sql("employees >= 9500 OR size_bin = 'l'", 1000)}
SELECT qid, country, industry FROM s""")
def sample_with_fallback(spark, sf_dir):
    # neither threshold reaches the target: the second, listed last, is kept
    out = sp.fallback_sample(
        candidates(spark, sf_dir), COUNTRIES, tb.SEGMENTS, [9800, 9500], 1000, FLOOR
    )
    return out.select("qid", "country", "industry")


def candidate_rows(spark, sf_dir):
    """Orders of a customer as repeated scans of one candidate."""
    o = tb.table(spark, sf_dir, "orders")
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("qid"),
        F.col("o_orderkey").alias("scan"),
        F.concat("c_name", F.lit(" "), F.col("o_orderstatus")).alias("company_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.lit("").alias("description"),
        F.when(F.col("o_orderstatus") != "F", F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("employees"),
        (F.col("o_totalprice") * 1000).alias("revenue"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("https://www.w"), F.col("o_orderkey").cast("string"), F.lit(".example/x"))).otherwise("").alias("website"),
        F.col("o_orderpriority").alias("industry_label"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))).otherwise("").alias("ticker"),
    )


@query("""WITH r AS (
  SELECT CAST(o_custkey AS VARCHAR) AS qid, o_orderkey AS scan, c_name || ' ' || o_orderstatus AS name,
    CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice / 1000) END AS employees, o_totalprice * 1000 AS revenue,
    CASE WHEN o_orderstatus = 'O' THEN 'w' || o_orderkey || '.example' END AS domain, o_orderpriority AS label,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'T' || o_orderkey END AS ticker
  FROM orders JOIN customer ON o_custkey = c_custkey
), g AS (
  SELECT qid, arg_min(name, scan) AS company_name, max(employees) AS employees, round(max(revenue), 2) AS revenue,
    coalesce(arg_max(domain, scan) FILTER (domain IS NOT NULL), '') AS company_domain,
    string_agg(DISTINCT label, '; ' ORDER BY label) AS industry_raw, coalesce(min(ticker), '') AS ticker FROM r GROUP BY qid
)
SELECT *, CASE WHEN employees >= 1000 THEN 'l' WHEN employees >= 250 THEN 'm' WHEN employees >= 50 THEN 's'
  WHEN revenue >= 1e9 THEN 'l' WHEN revenue >= 1e8 THEN 'm' WHEN revenue >= 1e7 THEN 's' WHEN ticker <> '' THEN 'l' ELSE 'm' END AS size_bin FROM g""")
def entity_merge(spark, sf_dir):
    out = sp.merge_entities(candidate_rows(spark, sf_dir))
    return rounded(out.drop("country", "description"), 2, "revenue")


@query("""SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS qid, CASE WHEN contains(p_name, 'ring') THEN 'rings'
  WHEN contains(p_type, 'ECO') THEN 'eco' ELSE 'other' END AS industry FROM part
WHERE contains(p_name, 'ring') OR contains(p_type, 'ECO') OR contains(p_brand, 'Brand#1')""")
def mapped_industries(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("qid"),
        F.col("p_name").alias("company_name"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
    )
    rules = [("ring", "rings"), ("ECO", "eco"), ("brand#1", "other")]
    return sp.map_industries(part, rules).select("qid", "industry")


@query("""WITH a AS (
  SELECT c_name AS company_name, 'C' || c_custkey AS qid, 1 AS source_rank, c_nationkey AS k FROM customer
  UNION ALL SELECT s_name, 'S' || s_suppkey, 2, s_nationkey FROM supplier
  UNION ALL SELECT c_name, 'X' || c_custkey, 3, c_nationkey FROM customer
)
SELECT company_name, 'N' || k AS country, qid FROM a
QUALIFY row_number() OVER (PARTITION BY company_name, k ORDER BY source_rank, qid) = 1""")
def linked_sources(spark, sf_dir):
    def source(table: str, p: str, key: str, letter: str, rank: int):
        return tb.table(spark, sf_dir, table).select(
            F.col(f"{p}_name").alias("company_name"),
            F.concat(F.lit("N"), F.col(f"{p}_nationkey").cast("string")).alias("country"),
            F.concat(F.lit(letter), F.col(key).cast("string")).alias("qid"),
            F.lit(rank).alias("source_rank"),
        )

    merged = sp.link_sources(
        [
            source("customer", "c", "c_custkey", "C", 1),
            source("supplier", "s", "s_suppkey", "S", 2),
            source("customer", "c", "c_custkey", "X", 3),
        ]
    )
    return merged.drop("source_rank")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY md5('42:' || c_custkey), c_custkey) AS position FROM customer
ORDER BY position LIMIT 100""")
def seeded_shuffle(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer").select("c_custkey")
    head = rows.seeded_head(c, "c_custkey", 42, 100)
    key = F.md5(F.concat(F.lit("42:"), F.col("c_custkey").cast("string")))
    return rows.row_numbers(head, [key.asc(), F.col("c_custkey").asc()], out="position")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER
  (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem""")
def ranked_within_groups(spark, sf_dir):
    line = tb.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    ranked = rows.row_numbers(
        line.select(*keys, "l_returnflag", "l_shipdate"),
        [F.col("l_shipdate").asc(), *[F.col(k).asc() for k in keys]],
        out="rn",
        within=["l_returnflag"],
    )
    return ranked.select(*keys, "rn")


@query("""SELECT c_mktsegment AS segment, min(c_custkey) AS first_seen,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 2 END AS preferred_rank FROM customer GROUP BY c_mktsegment""")
def ordered_segments(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), "c_custkey")
    return rows.ordered_categories(c, "segment", "c_custkey", ["MACHINERY", "BUILDING"])


# --- streaming ----------------------------------------------------------------

def _event_stream(spark, sf_dir):
    """The event table as a stream of files; times in the session zone."""
    schema = tb.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return stream.select(
        "event_id",
        F.col("user_id").cast("string").alias("company_id"),
        F.col("event_type").alias("signal_type"),
        (F.col("value") / 500.0).alias("signal_strength"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("https://example.com/"), F.get_json_object("props", "$.k")).alias("url"),
    )


@query("""SELECT user_id::VARCHAR AS company_id, event_type AS signal_type, 'https://example.com/' || json_extract_string(props, '$.k') AS url, count(DISTINCT ts) AS n
FROM events GROUP BY ALL""")
def streaming_append(spark, sf_dir):
    kept = st.run_available(_event_stream(spark, sf_dir), _run_name("append"), st.EVENT_KEY)
    return kept.groupBy("company_id", "signal_type", "url").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (
  SELECT 0 AS batch, * FROM events UNION ALL
  SELECT 1, * REPLACE (value * 2 AS value) FROM events WHERE event_type IN ('purchase', 'signup') UNION ALL
  SELECT 2, * REPLACE (value * 3 AS value) FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'view')
SELECT CAST(user_id AS VARCHAR) AS company_id, event_type AS signal_type, epoch_us(ts) AS ts_us,
       json_extract_string(props, '$.k') AS k, round(value / 500.0::DOUBLE, 6) AS signal_strength FROM b
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts, json_extract_string(props, '$.k')
                           ORDER BY batch DESC, event_id DESC) = 1""")
def streaming_last_arrival(spark, sf_dir):
    """Three deliveries in three micro-batches, the last one late: the newest arrival of a key is kept.

    A delivery is as many files as its rows fill, so no task writes, reads or sorts a whole one.
    """
    events = tb.table(spark, sf_dir, "events")
    folder = f"{ensure_checkpoint_dir(spark)}/{_run_name('files')}"
    name = _run_name("last")
    for factor, kept in ((1, "true"), (2, "event_type IN ('purchase', 'signup')"),
                         (3, "ts < TIMESTAMP_NTZ '2024-01-10' AND event_type <> 'view'")):
        part = events.filter(kept).withColumn("value", F.col("value") * factor)
        part.hint("rebalance").write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder).select(
            F.col("user_id").cast("string").alias("company_id"),
            F.col("event_type").alias("signal_type"),
            F.get_json_object("props", "$.k").alias("k"),
            F.col("ts").cast("timestamp").alias("ts"),
            "event_id",
            "value",
        )
        # the run goes on where the last one stopped: what has landed since is its next batch
        kept = st.run_available(stream, name, ["company_id", "signal_type", "k", "ts"], every=2)
    return kept.select(
        "company_id", "signal_type", F.unix_micros("ts").alias("ts_us"), "k",
        F.round(F.col("value") / 500.0, 6).alias("signal_strength"),
    )


@query("""SELECT strftime(time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS window_start, event_type AS signal_type,
  count(*) AS total_signals, round(sum(value / 500.0::DOUBLE), 4) AS total_strength FROM events GROUP BY ALL""")
def streaming_volume(spark, sf_dir):
    volume = st.volume_stream(_event_stream(spark, sf_dir), "signal_type", "5 days", late=None)
    out = st.run_available(volume, _run_name("volume"), ["window_start", "signal_type"])
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")), 4, "total_strength")


@query("""SELECT doc_id, lang, CASE WHEN contains(lower(strip_accents(text)), 'thanedble') THEN 0.65::DOUBLE END AS climate_score FROM documents
WHERE contains(lower(strip_accents(text)), 'thanedble') AND NOT contains(lower(strip_accents(text)), 'onthanea')""")
def streaming_enrich(spark, sf_dir):
    schema = tb.table(spark, sf_dir, "documents").schema
    news = spark.readStream.schema(schema).parquet(f"{sf_dir}/document[s].parquet").select(
        "doc_id", "lang", F.lit("").alias("title"), F.col("text").alias("text_snippet"), F.lit(1.0).alias("signal_strength")
    )
    enriched = st.enrich_stream(news, ["thanedble"], ["onthanea"], {"the": 0.4})
    return st.run_available(enriched.select("doc_id", "lang", "climate_score"), _run_name("enrich"))


def _run_name(kind: str) -> str:
    """A fresh state folder per run, so that a rerun reads the table again."""
    return f"{kind}-{uuid.uuid4().hex[:8]}"
