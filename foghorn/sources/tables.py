"""Binding of the roles the plans expect to the provided Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foghorn.session import spread

AS_OF = "2024-01-31"

# (group, cap, signal_type, weight) for the event types of the provided tables
EVENT_WEIGHTS = [
    ("engagement", 30.0, "view", 10.0),
    ("engagement", 30.0, "click", 12.0),
    ("growth", 50.0, "signup", 15.0),
    ("growth", 50.0, "purchase", 25.0),
]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


# Declared schemas: no file has to be opened to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are expensive to process: small files are spread over the cores."""
    return spread(table(spark, sf_dir, name))


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies: nation is the country, market segment the industry."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    size = (
        F.when(F.col("c_acctbal") >= 5000, "l").when(F.col("c_acctbal") >= 0, "m").otherwise("s")
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("company_id"),
        F.col("c_custkey").alias("company_numeric_id"),
        F.lit("").alias("company_qid"),
        F.col("c_name").alias("company_name"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("industry"),
        size.alias("size_bin"),
    )


def signal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as company signals; errors count as bad news (negative strength)."""
    k = F.get_json_object("props", "$.k").cast("int")
    sign = F.when(F.col("event_type") == "error", -1.0).otherwise(1.0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("company_id"),
        F.lit("").alias("company_qid"),
        F.col("event_type").alias("signal_type"),
        F.concat(F.lit("feed"), (k % 4).cast("string")).alias("source"),
        (sign * F.col("value") / 500.0).alias("signal_strength"),
        "ts",
        F.concat(F.lit("https://example.com/"), k.cast("string")).alias("url"),
        (k / 100.0).alias("climate_score"),
        ((k - 50) / 50.0).alias("sentiment_score"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a multi-year event source: the priority is the signal type."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").cast("string").alias("company_id"),
        F.lit("").alias("company_qid"),
        F.col("o_orderpriority").alias("signal_type"),
        F.col("o_orderstatus").alias("source"),
        (F.col("o_totalprice") / 1000000.0).alias("signal_strength"),
        F.col("o_orderdate").alias("ts"),
        F.lit(None).cast("double").alias("climate_score"),
        F.lit(None).cast("double").alias("sentiment_score"),
    )


def with_company(events: DataFrame, companies: DataFrame) -> DataFrame:
    """Events with the company's name, country, industry and size."""
    attrs = companies.select("company_id", "company_name", "country", "industry", "size_bin")
    return events.join(attrs, "company_id", "left")


# The same bindings as DuckDB common table expressions.
UNIVERSE_SQL = """
u AS (
  SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_custkey AS company_numeric_id,
         c_name AS company_name, n_name AS country, c_mktsegment AS industry,
         CASE WHEN c_acctbal >= 5000 THEN 'l' WHEN c_acctbal >= 0 THEN 'm' ELSE 's' END AS size_bin
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
EVENTS_SQL = """
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS company_id, user_id AS company_numeric_id,
         event_type AS signal_type, ts, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), e AS (
  SELECT event_id, company_id, company_numeric_id, signal_type, ts,
         'feed' || CAST(k % 4 AS VARCHAR) AS source,
         CASE WHEN signal_type = 'error' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END * value / 500.0::DOUBLE AS signal_strength,
         'https://example.com/' || CAST(k AS VARCHAR) AS url,
         k / 100.0::DOUBLE AS climate_score, (k - 50) / 50.0::DOUBLE AS sentiment_score
  FROM raw
)"""
ORDERS_SQL = """
oe AS (
  SELECT o_orderkey AS event_id, CAST(o_custkey AS VARCHAR) AS company_id,
         o_custkey AS company_numeric_id, o_orderpriority AS signal_type, o_orderstatus AS source,
         o_totalprice / 1000000.0::DOUBLE AS signal_strength, o_orderdate AS ts
  FROM orders
)"""
ROLLUP_SQL = f"""
{UNIVERSE_SQL}, {EVENTS_SQL}, p AS (
  SELECT e.*, u.company_name, u.country, u.industry, e.company_id AS company_key,
         signal_strength * climate_score AS weighted_strength,
         abs(signal_strength * climate_score) AS abs_strength
  FROM e JOIN u USING (company_id)
), c0 AS (
  SELECT company_key, company_name, country, industry,
         avg(weighted_strength) AS avg_strength, avg(abs_strength) AS avg_abs_strength,
         count(*) AS total_events, max(ts) AS last_ts, avg(sentiment_score) AS avg_sentiment,
         min(company_id) AS company_id, min(company_numeric_id) AS company_numeric_id,
         bool_or(ts >= TIMESTAMP '2024-01-20') AS recent_activity,
         count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS recent_events
  FROM p GROUP BY ALL
), c AS (
  SELECT *, avg_strength * least(1 + 0.15::DOUBLE * ln(1 + total_events), 1.8::DOUBLE) AS demand_score,
         avg_abs_strength * least(1 + 0.15::DOUBLE * ln(1 + total_events), 1.8::DOUBLE) AS intensity_score
  FROM c0
)"""
