"""Files written, read back and compared: universe, events, members, mixed layouts, landing copies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foghorn.catalog.base import query
from foghorn.session import ensure_checkpoint_dir
from foghorn.sources import readers, sinks, tables as tb


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


@query(f"""WITH {tb.UNIVERSE_SQL}
SELECT company_id, company_name, country, industry, size_bin FROM u
WHERE country IN ('NATION_1', 'NATION_7', 'NATION_12') AND industry IN ('BUILDING', 'MACHINERY') AND size_bin IN ('m', 'l')""")
def universe_file(spark, sf_dir):
    """The universe as a CSV file with float-like ids, read with all three filters."""
    path = f"{_folder(spark)}/universe.csv"
    u = tb.universe(spark, sf_dir).drop("company_numeric_id")
    sinks.write_table(u.withColumn("company_id", F.concat("company_id", F.lit(".0"))), path, "csv")
    kept = readers.read_universe(spark, path, ["nation_1", "NATION_7", "Nation_12"], ["BUILDING", "MACHINERY"], ["M", "l"])
    return kept.select("company_id", "company_name", "country", "industry", "size_bin")


def _stamp(c: str):
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


_FILLED = ["company_id", "company_name", "source", "signal_type", "url", "title", "climate_score", "sentiment_score"]


@query(f"""WITH {tb.EVENTS_SQL}
SELECT company_id, '' AS company_name, '' AS source, signal_type, url, '' AS title, CAST(NULL AS DOUBLE) AS climate_score,
  0.0::DOUBLE AS sentiment_score, epoch_us(ts) AS ts_us, round(signal_strength, 6) AS signal_strength FROM e""")
def event_file_backfill(spark, sf_dir):
    """Events as a CSV file of five columns: the others come back with their defaults."""
    path = f"{_folder(spark)}/events.csv"
    e = tb.signal_events(spark, sf_dir).select("company_id", "signal_type", "url", "signal_strength", _stamp("ts").alias("ts"))
    sinks.write_table(e, path, "csv")
    back = readers.read_plain_events(spark, path, line_breaks=False)
    return back.select(*_FILLED, F.unix_micros("ts").alias("ts_us"), F.round("signal_strength", 6).alias("signal_strength"))


@query("""SELECT c_name AS member_name, CAST(c_custkey AS VARCHAR) AS company_id, 'sbti' AS signal_type, 'memberships' AS source,
  CASE WHEN c_nationkey < 12 THEN '2023-05-06T00:00:00Z' ELSE '2024-01-31T00:00:00Z' END AS ts,
  'https://m.example/' || c_custkey AS url, '' AS country FROM customer""")
def member_file(spark, sf_dir):
    """A member file without ``member_name``: its alias is taken; the first of two paths that exists."""
    folder = _folder(spark)
    c = tb.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("company_name"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("company_id"),
        F.concat(F.lit("https://m.example/"), F.col("c_custkey").cast("string")).alias("url"),
        F.when(F.col("c_nationkey") < 12, "2023-05-06").otherwise("").alias("ts"),
    )
    sinks.write_table(c, f"{folder}/sbti.csv", "csv")
    path = readers.first_existing(spark, [f"{folder}/sbti_latest.csv", f"{folder}/sbti.csv"])
    members = readers.read_members(spark, "sbti", path, "2024-01-31")
    return members.select("member_name", "company_id", "signal_type", "source", "ts", "url", "country")


@query("""SELECT s_name AS member_name, 'https://list.example' AS url, '2022-03-04' AS ts, 'memberships' AS source, 're100' AS signal_type,
  'N' || s_nationkey AS country, CASE WHEN s_acctbal > 0 THEN 'Energy, water' ELSE '' END AS sector FROM supplier""")
def sniffed_list(spark, sf_dir):
    """A list with headers of its own: name, date, country and sector found by priority; blank names go."""
    path = f"{_folder(spark)}/list.csv"
    s = tb.table(spark, sf_dir, "supplier").select(
        F.lit("x").alias("No"),
        F.col("s_name").alias("Organization"),
        F.lit("2022-03-04").alias("Approved"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("LOCATION"),
        F.when(F.col("s_acctbal") > 0, "Energy, water").otherwise("").alias("Categoria"),
    )
    blank = s.withColumn("Organization", F.lit("  "))
    sinks.write_table(s.unionByName(blank), path, "csv")
    return readers.member_list(readers.read_any(spark, path), "https://list.example", "re100")


@query(f"""WITH {tb.EVENTS_SQL}
SELECT company_id, CASE signal_type WHEN 'click' THEN 'a' WHEN 'error' THEN '' ELSE source END AS source,
  CASE signal_type WHEN 'click' THEN signal_type || ', "' || k || '"' || chr(10) || event_id WHEN 'error' THEN '"' || k || '"' ELSE '' END AS title,
  CASE WHEN signal_type IN ('click', 'error') THEN '' ELSE url END AS url,
  CASE WHEN signal_type <> 'error' THEN epoch_us(ts) ELSE -1 END AS ts_us,
  CASE signal_type WHEN 'click' THEN round(signal_strength, 6) ELSE 0.0::DOUBLE END AS signal_strength,
  CASE signal_type WHEN 'error' THEN climate_score ELSE 0.0::DOUBLE END AS climate_score
FROM raw JOIN e USING (event_id, company_id, company_numeric_id, signal_type, ts)""")
def recursive_scan(spark, sf_dir):
    """Three layouts in nested folders, with commas, quotes and line breaks inside cells."""
    folder = _folder(spark)
    e = tb.signal_events(spark, sf_dir).withColumn("k", F.regexp_extract("url", r"(\d+)$", 1))
    title = F.concat("signal_type", F.lit(', "'), "k", F.lit('"\n'), F.col("event_id").cast("string"))
    layouts = {
        "a/click": e.filter("signal_type = 'click'").select(
            "company_id", title.alias("title"), _stamp("ts").alias("ts"), "signal_strength", F.lit("a").alias("source")
        ),
        "b/c/error": e.filter("signal_type = 'error'").select(
            F.concat(F.lit('"'), "k", F.lit('"')).alias("title"), "climate_score", F.lit(1).alias("other"), "company_id"
        ),
        "b/rest": e.filter("signal_type NOT IN ('click', 'error')").select("url", "source", _stamp("ts").alias("ts"), "company_id"),
    }
    for name, rows in layouts.items():
        sinks.write_table(rows, f"{folder}/{name}", "csv")
    return readers.read_recursive(spark, folder).select(
        "company_id", "source", "title", "url", F.coalesce(F.unix_micros("ts"), F.lit(-1)).alias("ts_us"),
        F.round("signal_strength", 6).alias("signal_strength"), "climate_score",
    )


@query(f"""WITH {tb.UNIVERSE_SQL}
SELECT country AS country_dir, industry AS industry_dir, 2 * count(*) AS n, 2 * count(*) FILTER (size_bin = 'l') AS large
FROM u GROUP BY ALL""")
def landing_copy(spark, sf_dir):
    """Two landings of the universe, one directory per country and industry, read back by directory."""
    folder = _folder(spark)
    u = tb.universe(spark, sf_dir)
    for _ in range(2):
        sinks.land_raw(u, folder)
    back = spark.read.parquet(folder)
    return back.groupBy("country_dir", "industry_dir").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("size_bin") == "l").alias("large")
    )


@query(f"""WITH {tb.EVENTS_SQL}, b AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE signal_type = 'purchase')
SELECT company_id, signal_type, count(*) AS n FROM b GROUP BY ALL""")
def plain_append(spark, sf_dir):
    """A table appended to without de-duplication: repeated rows stay."""
    folder = _folder(spark)
    e = tb.signal_events(spark, sf_dir).select("company_id", "signal_type", "ts")
    sinks.append_plain(e, folder)
    sinks.append_plain(e.filter("signal_type = 'purchase'"), folder)
    return spark.read.parquet(folder).groupBy("company_id", "signal_type").agg(F.count(F.lit(1)).alias("n"))
