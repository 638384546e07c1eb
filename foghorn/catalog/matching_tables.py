"""Matching, mentions, registry, prospects and payload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from foghorn import vocab
from foghorn.catalog.base import query, rounded
from foghorn.functions import dates as dx, text as tx
from foghorn.operators import matching, mentions
from foghorn.plans import classify as cl, discovery as dc, events as ev, prospects as pr
from foghorn.sources import adapters, pages as pg, payloads as pl, tables as tb

_STOP = ", ".join(f"'{w}'" for w in vocab.NAME_STOPWORDS)


# --- members against a universe ----------------------------------------------
# Universe: parts, named "<p_name> <p_type> <p_brand>". Members: the same parts,
# some with an id, some with the exact name in other spelling, some abridged.

def part_universe(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("company_id"),
        F.lit("").alias("company_qid"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("company_name"),
        F.col("p_brand").alias("country"),
        F.col("p_type").alias("industry"),
        F.when(F.col("p_size") > 25, "l").otherwise("m").alias("size_bin"),
    )


def part_members(spark, sf_dir):
    part = tb.text_table(spark, sf_dir, "part")
    full = F.concat_ws("  ", F.upper("p_name"), "p_type", F.concat("p_brand", F.lit(".")))
    short = F.concat(F.lit("The "), "p_name", F.lit(" Holding "), "p_type", F.lit(" Corp"))
    size = F.col("p_size")
    return part.select(
        F.col("p_partkey").alias("row_id"),
        F.when(size <= 10, F.lit("No Name")).when(size <= 25, full).otherwise(short).alias("member_name"),
        F.lit("").alias("company_name"),
        F.when(size <= 5, F.concat(F.col("p_partkey").cast("string"), F.lit(".0")))
        .when(size <= 10, F.concat(F.lit("x"), F.col("p_partkey").cast("string")))
        .otherwise("")
        .alias("company_id"),
        F.when(size > 40, "ungc").otherwise("sbti").alias("signal_type"),
        F.lit("memberships").alias("source"),
        F.lit("2024-01-02").alias("ts"),
        F.concat(F.lit("https://members.example/"), F.col("p_partkey").cast("string")).alias("url"),
        F.lit("AR").alias("country"),
        F.lit("own").alias("industry"),
        F.lit("s").alias("size_bin"),
        F.lit("").alias("text_snippet"),
    )


_NORM = "trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'))"
_TOKENS = f"list_filter(string_split({{c}}, ' '), lambda x: length(x) > 1 AND x NOT IN ({_STOP}))"
_MEMBER_SQL = f"""
pu AS (
  SELECT CAST(p_partkey AS VARCHAR) AS match_id, p_partkey AS num, p_name || ' ' || p_type || ' ' || p_brand AS company_name,
    p_brand AS country, p_type AS industry FROM part
), un AS (SELECT *, {_NORM.format(c='company_name')} AS u_norm FROM pu
), pm AS (
  SELECT p_partkey AS row_id,
    CASE WHEN p_size <= 10 THEN 'No Name' WHEN p_size <= 25 THEN upper(p_name) || '  ' || p_type || '  ' || p_brand || '.'
      ELSE 'The ' || p_name || ' Holding ' || p_type || ' Corp' END AS member_name,
    CASE WHEN p_size <= 5 THEN CAST(p_partkey AS VARCHAR) WHEN p_size <= 10 THEN 'x' || p_partkey ELSE '' END AS cid,
    CASE WHEN p_size > 40 THEN 'ungc' ELSE 'sbti' END AS signal_type
  FROM part
), mn AS (SELECT *, {_NORM.format(c='member_name')} AS m_norm FROM pm
), qn AS (SELECT m_norm, {_TOKENS.format(c='m_norm')} AS toks FROM (SELECT DISTINCT m_norm FROM mn)
), cn AS (SELECT u_norm, min(num) AS num, {_TOKENS.format(c='u_norm')} AS ctoks FROM un GROUP BY u_norm
), qt AS (SELECT m_norm, toks, unnest(list_distinct(toks)) AS t FROM qn WHERE len(toks) >= 2
), ct AS (SELECT u_norm, num, unnest(list_distinct(ctoks)) AS t FROM cn
), shared AS (
  SELECT m_norm, any_value(toks[1]) AS first_token, u_norm, num, count(*) AS n FROM qt JOIN ct USING (t) GROUP BY m_norm, u_norm, num HAVING count(*) >= 2
)"""
_BEST = "QUALIFY row_number() OVER (PARTITION BY m_norm ORDER BY n DESC, num) = 1"
_CASCADE_SQL = f"""{_MEMBER_SQL},
s1 AS (SELECT row_id, (SELECT max(match_id) FROM pu WHERE match_id = cid) AS match_id, 'id' AS stage FROM mn WHERE cid <> ''
), s2 AS (SELECT row_id, match_id, 'name' AS stage FROM mn JOIN un ON m_norm = u_norm WHERE cid = '' AND m_norm <> ''
), bt AS (SELECT * FROM shared WHERE contains(u_norm, first_token) {_BEST}
), s3 AS (
  SELECT row_id, CAST(num AS VARCHAR) AS match_id, 'token' AS stage FROM mn JOIN bt USING (m_norm)
  WHERE cid = '' AND row_id NOT IN (SELECT row_id FROM s2)
), matched AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)"""


@query(f"WITH {_CASCADE_SQL} SELECT row_id, match_id, stage FROM matched")
def exact_then_token_match(spark, sf_dir):
    out = matching.match_members(part_members(spark, sf_dir), part_universe(spark, sf_dir))
    return out.select("row_id", "match_id", "stage")


@query(f"""WITH {_CASCADE_SQL}
SELECT coalesce(match_id, cid) AS company_id, coalesce(company_name, member_name) AS company_name,
  coalesce(pu.country, 'AR') AS country, coalesce(pu.industry, 'own') AS industry, mn.signal_type,
  'Membership: ' || mn.signal_type AS title, member_name AS text_snippet, 1.0::DOUBLE AS signal_strength, 0.6::DOUBLE AS sentiment_score
FROM matched JOIN mn USING (row_id) LEFT JOIN pu USING (match_id)""")
def member_events(spark, sf_dir):
    u = part_universe(spark, sf_dir)
    matched = ev.attach_company(matching.match_members(part_members(spark, sf_dir), u), u)
    return ev.member_events(matched).select(
        "company_id", "company_name", "country", "industry", "signal_type", "title",
        "text_snippet", "signal_strength", "sentiment_score",
    )


_INDEX_SQL = f"""{_MEMBER_SQL},
ex AS (SELECT row_id, min(num) AS num FROM mn JOIN un ON m_norm = u_norm WHERE m_norm <> '' GROUP BY row_id
), bt AS (SELECT * FROM shared {_BEST}
), im AS (
  SELECT row_id, member_name, signal_type, CAST(coalesce(ex.num, bt.num) AS VARCHAR) AS match_id,
    CASE WHEN ex.num IS NOT NULL THEN 'name' WHEN bt.num IS NOT NULL THEN 'token' ELSE 'external' END AS stage
  FROM mn LEFT JOIN ex USING (row_id) LEFT JOIN bt USING (m_norm)
)"""


@query(f"WITH {_INDEX_SQL} SELECT row_id, match_id, stage FROM im")
def index_match(spark, sf_dir):
    out = matching.index_match(part_members(spark, sf_dir), part_universe(spark, sf_dir))
    return out.select("row_id", "match_id", "stage")


@query(f"""WITH {_INDEX_SQL}
SELECT CASE WHEN match_id IS NULL THEN 'ext::' || signal_type || '::' ||
    trim(regexp_replace(lower(member_name), '[^a-z0-9]+', '-', 'g'), '-') || '-ar' ELSE match_id END AS company_id,
  coalesce(company_name, member_name) AS company_name, coalesce(pu.country, 'AR') AS country, im.signal_type,
  CASE im.signal_type WHEN 'ungc' THEN 'Participación Pacto Global' ELSE 'Compromiso SBTi' END AS title
FROM im LEFT JOIN pu USING (match_id)""")
def rebuilt_member_events(spark, sf_dir):
    u = part_universe(spark, sf_dir)
    matched = matching.index_match(part_members(spark, sf_dir), u)
    out = ev.indexed_member_events(matched.withColumn("ts", dx.parse_ts(F.col("ts"))), u)
    return out.select("company_id", "company_name", "country", "signal_type", "title")


# --- mentions -----------------------------------------------------------------

_SPACED = "lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))"


@query(f"""WITH d AS (SELECT doc_id, {_SPACED} AS t FROM documents), b AS (SELECT item_id, {_SPACED} AS t FROM benchmark)
SELECT doc_id, item_id FROM d JOIN b ON contains(d.t, b.t)""")
def mention_join(spark, sf_dir):
    return mentions.mention_join(
        tb.text_table(spark, sf_dir, "documents"), "doc_id", "text",
        tb.table(spark, sf_dir, "benchmark"), "item_id", "text",
    )


_WORD_NAMES = """n AS (
  SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN 'of the'
    WHEN 2 THEN 'in e' WHEN 3 THEN 'an' || (p_size % 7) END AS alias FROM part
)"""


def _short_names(spark, sf_dir):
    size = F.col("p_size")
    alias = (
        F.when(size % 4 == 0, F.element_at(F.split("p_name", " "), 1))
        .when(size % 4 == 1, "of the")
        .when(size % 4 == 2, "in e")
        .otherwise(F.concat(F.lit("an"), (size % 7).cast("string")))
    )
    return tb.table(spark, sf_dir, "part").select("p_partkey", alias.alias("alias")).groupBy("alias").agg(
        F.min("p_partkey").alias("alias_id")
    )


@query(f"""WITH {_WORD_NAMES}, r AS (SELECT min(p_partkey) AS alias_id, alias FROM n GROUP BY alias),
c AS (SELECT conv_id, turn, {_SPACED} AS t FROM conversations)
SELECT conv_id * 1000 + turn AS item, alias_id FROM c JOIN r ON contains(c.t, lower(alias))""")
def short_mentions(spark, sf_dir):
    c = tb.text_table(spark, sf_dir, "conversations").withColumn("item", F.col("conv_id") * 1000 + F.col("turn"))
    return mentions.mention_join(c, "item", "text", _short_names(spark, sf_dir), "alias_id", "alias")


@query(f"""WITH {_WORD_NAMES}, r AS (SELECT min(p_partkey) AS alias_id, alias FROM n GROUP BY alias),
c AS (SELECT conv_id, turn, ' ' || lower(trim(regexp_replace(strip_accents(text), '\\s+', ' ', 'g'))) || ' ' AS t FROM conversations)
SELECT conv_id * 1000 + turn AS item, alias_id FROM c JOIN r ON contains(c.t, ' ' || lower(alias) || ' ')""")
def word_mentions(spark, sf_dir):
    c = tb.text_table(spark, sf_dir, "conversations").withColumn("item", F.col("conv_id") * 1000 + F.col("turn"))
    return mentions.mention_join(
        c, "item", "text", _short_names(spark, sf_dir), "alias_id", "alias", folded=True, whole_words=True
    )


# --- registry and discovery ---------------------------------------------------

def _named_parts(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part")
    return part.select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("company_id"),
        F.lit("").alias("company_qid"),
        F.concat(F.initcap("p_name"), F.lit(" "), F.col("p_type"), F.lit(" Ltda")).alias("company_name"),
        F.when(F.col("p_size") > 45, "US").when(F.col("p_size") > 20, "ar").otherwise("").alias("country"),
        F.col("p_type").alias("industry"),
        F.lit("m").alias("size_bin"),
    )


_REG_SQL = """np AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS company_id, lower(p_name || ' ' || p_type) AS base,
    lower(p_name || ' ' || p_type || ' Ltda') AS name_key,
    CASE WHEN p_size > 45 THEN 'US' WHEN p_size > 20 THEN 'ar' ELSE '' END AS country FROM part
), known AS (
  SELECT name_key, base, min(company_id) AS company_id, arg_min(country, company_id) AS country
  FROM np WHERE country <> 'US' GROUP BY ALL
)"""


@query(f"WITH {_REG_SQL} SELECT company_id, name_key, country FROM known")
def known_companies(spark, sf_dir):
    return dc.known_companies([_named_parts(spark, sf_dir)]).select("company_id", "name_key", "country")


@query(f"""WITH {_REG_SQL}, a AS (SELECT name_key AS alias_key, company_id FROM known UNION ALL SELECT base, company_id FROM known)
SELECT alias_key, max(company_id) AS company_id FROM a GROUP BY ALL""")
def alias_registry(spark, sf_dir):
    known = dc.known_companies([_named_parts(spark, sf_dir)])
    return dc.alias_registry(known).select("alias_key", "company_id")


def _organisations(spark, sf_dir):
    """Every order mentions one organisation, in three spellings."""
    part = tb.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    line = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    name = F.concat_ws(" ", "p_name", "p_type")
    spelled = (
        F.when(F.col("l_linenumber") == 1, F.upper(name))
        .when(F.col("l_linenumber") == 2, F.concat(name, F.lit(" Inc")))
        .otherwise(F.concat(name, F.lit(" Unlisted")))
    )
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_linenumber", spelled.alias("organisation"))
        .distinct()
    )


@query(f"""WITH {_REG_SQL}, a AS (SELECT name_key AS alias_key, company_id FROM known UNION ALL SELECT base, company_id FROM known),
reg AS (SELECT alias_key, max(company_id) AS company_id FROM a GROUP BY ALL), o AS (
  SELECT DISTINCT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN upper(p_name || ' ' || p_type)
    WHEN 2 THEN p_name || ' ' || p_type || ' Inc' ELSE p_name || ' ' || p_type || ' Unlisted' END AS organisation
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT l_orderkey, l_linenumber, organisation, company_id FROM o
JOIN reg ON alias_key = regexp_replace(lower(organisation), ' inc$', '')""")
def registry_matches(spark, sf_dir):
    registry = dc.alias_registry(dc.known_companies([_named_parts(spark, sf_dir)]))
    hits = dc.match_organisations(_organisations(spark, sf_dir), "organisation", registry)
    return hits.select("l_orderkey", "l_linenumber", "organisation", "company_id")


@query("""WITH a AS (
  SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN 'SPANISH' WHEN 1 THEN 'pt' ELSE '' END AS language,
    CASE WHEN page_id % 5 = 0 THEN 'Chile' WHEN page_id % 5 = 1 THEN 'US' ELSE '' END AS declared,
    CASE page_id % 7 WHEN 0 THEN 'noticias de bogotá' WHEN 1 THEN 'lima y santiago' ELSE 'nada' END AS title
  FROM pages
), c AS (
  SELECT page_id, language, coalesce(CASE WHEN declared = 'Chile' THEN 'CL' END,
    CASE WHEN contains(title, 'bogotá') THEN 'CO' WHEN contains(title, 'santiago') THEN 'CL' END,
    CASE WHEN language = 'pt' THEN 'BR' END) AS country FROM a
)
SELECT page_id, country, round(0.5::DOUBLE + CASE WHEN language = 'SPANISH' THEN 0.2::DOUBLE ELSE 0 END + 0.2::DOUBLE + 0.02::DOUBLE * 3, 3) AS signal_strength
FROM c WHERE country IS NOT NULL""")
def discovery_events(spark, sf_dir):
    pid = F.col("page_id")
    articles = tb.text_table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.when(pid % 3 == 0, "SPANISH").when(pid % 3 == 1, "pt").otherwise("").alias("language"),
        F.when(pid % 5 == 0, "Chile").when(pid % 5 == 1, "US").otherwise("").alias("sourcecountry"),
        F.when(pid % 7 == 0, "noticias de bogotá").when(pid % 7 == 1, "lima y santiago").otherwise("nada").alias("title"),
        F.lit("").alias("text_snippet"),
        F.lit(3).alias("hits"),
        F.lit("").alias("country"),
        F.lit("").alias("industry"),
    )
    return dc.discovery_events(articles).select("page_id", "country", "signal_strength")


@query("""WITH a AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url),
n AS (SELECT *, row_number() OVER (ORDER BY page_id) AS rn, count(*) OVER () AS total FROM a)
SELECT page_id, url, rn <= floor(total * 0.25) AS full_text FROM n""")
def full_text_budget(spark, sf_dir):
    articles = dc.distinct_articles(tb.text_table(spark, sf_dir, "pages").select("page_id", "url"), "page_id")
    return dc.mark_full_text(articles, "page_id", 0.25)


@query("""SELECT doc_id, source FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 5""")
def limit_per_source(spark, sf_dir):
    d = tb.text_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return dc.limit_per_source(d, "source", [F.col("n_chars").desc(), F.col("doc_id").asc()], 5).drop("n_chars")


@query("""WITH t AS (SELECT doc_id, lower(text) AS t FROM documents),
h AS (SELECT doc_id, CAST(contains(t, 'thanedble') AS INTEGER) + CAST(contains(t, 'attion') AS INTEGER) + CAST(contains(t, 'que') AS INTEGER) AS hits FROM t)
SELECT doc_id, hits, round(hits / 3.0::DOUBLE, 3) AS climate_score FROM h WHERE hits >= 1""")
def scored_articles(spark, sf_dir):
    d = tb.text_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dc.score_articles(d, F.col("text"), ["thanedble", "attion", "que"]).drop("text")


@query("""SELECT p_type, count(*) AS n FROM part WHERE length(p_type) >= 3 AND p_type <> 'SMALL'
  AND regexp_matches(p_type, '[A-Z]') GROUP BY ALL""")
def organisation_filter(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part")
    kept = part.filter(ev.organisation_names(F.col("p_type")) & (F.col("p_type") != "SMALL"))
    return kept.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query()
def near_string_match(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part")
    names = part.select(F.concat_ws(" ", "p_name", "p_type").alias("name"))
    asked = part.select(
        F.concat(F.col("p_type"), F.lit(" "), F.regexp_replace("p_name", "e", "3")).alias("asked")
    ).distinct()
    return dc.near_string_match(asked, "asked", names, "name", 85.0)


@query("""WITH t AS (SELECT DISTINCT text FROM documents WHERE lang = 'en')
SELECT lang, count(*) FILTER (text IN (SELECT text FROM t)) AS done, count(*) FILTER (text NOT IN (SELECT text FROM t)) AS todo
FROM documents GROUP BY ALL""")
def incremental_skip(spark, sf_dir):
    d = tb.text_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    stored = (
        d.filter("lang = 'en'")
        .select(tx.payload_key(F.col("text")).alias("payload_key"))
        .distinct()
        .withColumn("stored", F.lit(True))
    )
    done, todo = cl.reuse_stored(d, ["text"], stored)
    both = done.select("lang", F.lit(1).alias("d"), F.lit(0).alias("t")).unionByName(
        todo.select("lang", F.lit(0).alias("d"), F.lit(1).alias("t"))
    )
    return both.groupBy("lang").agg(F.sum("d").alias("done"), F.sum("t").alias("todo"))


@query("""WITH a AS (
  SELECT text, lang, source, doc_id FROM documents WHERE lang IN ('en', 'de')
), s AS (
  SELECT coalesce(text, '') AS text, arg_max(source, (doc_id, source)) AS answer, max(doc_id) AS version
  FROM a GROUP BY ALL
)
SELECT doc_id, coalesce(answer, '') AS answer, coalesce(version, -1) AS version FROM documents d LEFT JOIN s ON coalesce(d.text, '') = s.text""")
def stored_answers(spark, sf_dir):
    """Every document with the newest of the answers stored for its text; some texts were answered often."""
    d = tb.text_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    stored = d.filter("lang IN ('en', 'de')").select(
        tx.payload_key(F.col("text")).alias("payload_key"), F.col("source").alias("answer"), F.col("doc_id").alias("version")
    )
    done, todo = cl.reuse_stored(d, ["text"], stored, "version")
    out = done.select("doc_id", "answer", "version").unionByName(todo.select("doc_id"), allowMissingColumns=True)
    return out.na.fill({"answer": "", "version": -1})


_FOLDED = "string_split(trim(regexp_replace(lower(strip_accents({})), '[^a-z0-9]+', ' ', 'g')), ' ')"


@query(f"""WITH RECURSIVE b AS (SELECT item_id, {_FOLDED.format('text')} AS w FROM benchmark), a AS (
  SELECT item_id, w[1:3] AS alias FROM b UNION ALL SELECT item_id, w[1:2] FROM b UNION ALL SELECT item_id, w[4:4] FROM b
), r AS (SELECT alias, len(alias) AS n, max(item_id) AS company FROM a WHERE len(alias) > 0 GROUP BY ALL),
d AS (SELECT doc_id, {_FOLDED.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(len(w))) AS pos FROM d),
h AS MATERIALIZED (
  SELECT doc_id, pos, max(n) AS n FROM (
    SELECT doc_id, pos, n FROM p JOIN r ON w[pos + 1:pos + 3] = alias AND n = 3 UNION ALL
    SELECT doc_id, pos, n FROM p JOIN r ON w[pos + 1:pos + 2] = alias AND n = 2 UNION ALL
    SELECT doc_id, pos, n FROM p JOIN r ON w[pos + 1:pos + 1] = alias AND n = 1) GROUP BY ALL
), g(doc_id, pos, n) AS (
  SELECT doc_id, min(pos), arg_min(n, pos) FROM h GROUP BY doc_id
  UNION ALL
  SELECT g.doc_id, min(h.pos), arg_min(h.n, h.pos) FROM g JOIN h ON h.doc_id = g.doc_id AND h.pos >= g.pos + g.n GROUP BY g.doc_id
)
SELECT g.doc_id, g.pos::INTEGER AS first_word, g.n::INTEGER AS n_words, r.company::VARCHAR AS company_id
FROM g JOIN d USING (doc_id) JOIN r ON d.w[g.pos + 1:g.pos + g.n] = r.alias""")
def known_company_mentions(spark, sf_dir):
    """Openings of the benchmark passages as company names, looked up in whole documents."""
    words = F.split(tx.fold_words("text"), " ")
    spelled = tb.table(spark, sf_dir, "benchmark").select(
        "item_id", F.explode(F.array(F.slice(words, 1, 3), F.slice(words, 1, 2), F.slice(words, 4, 1))).alias("w")
    )
    registry = spelled.filter(F.size("w") > 0).groupBy(F.array_join("w", " ").alias("alias_key")).agg(
        F.max("item_id").cast("string").alias("company_id")
    )
    docs = tb.text_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dc.known_company_mentions(docs, "doc_id", "text", registry)
    return found.select("doc_id", "first_word", "n_words", "company_id")


# --- prospects ----------------------------------------------------------------

def _document_events(spark, sf_dir):
    """Documents as events: the source is the company, the language the industry."""
    d = tb.text_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("event_id"),
        F.concat(F.lit("ext::"), F.col("source")).alias("company_id"),
        F.col("source").alias("company_name"),
        F.col("lang").alias("country"),
        F.concat(F.lit("ind_"), F.col("lang")).alias("industry"),
        F.when(F.col("n_chars") > 3000, "report").when(F.col("n_chars") > 800, "news").otherwise("note").alias("signal_type"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("doc_id").cast("int"))).alias("ts"),
        F.lit("").alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("<b>"), F.lit("doc"), F.lit("</b>\n"), F.col("doc_id").cast("string")).alias("text_snippet"),
    )


@query("""WITH e AS (
  SELECT doc_id, source, upper(lang) AS country, 'ind_' || lang AS industry,
    CASE WHEN n_chars > 3000 THEN 'report' WHEN n_chars > 800 THEN 'news' ELSE 'note' END AS signal_type,
    DATE '2024-01-01' + CAST(doc_id AS INTEGER) AS ts FROM documents
), cm AS (SELECT source, country, count(*) AS n FROM e GROUP BY source, country QUALIFY row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, country) = 1
), im AS (SELECT source, industry, count(*) AS n FROM e GROUP BY source, industry QUALIFY row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, industry) = 1
), g AS (
  SELECT source, string_agg(DISTINCT signal_type, '|' ORDER BY signal_type) AS kinds, string_agg(DISTINCT signal_type, ', ' ORDER BY signal_type) AS listed,
    max(ts) AS last, count(DISTINCT signal_type) AS n, max(doc_id) AS newest FROM e GROUP BY source
)
SELECT source AS company_name, cm.country, im.industry, kinds AS source,
  'signals: ' || listed || ' | last_update: ' || strftime(last, '%Y-%m-%d') || ' |  doc  ' || newest AS justification
FROM g JOIN cm USING (source) JOIN im USING (source) ORDER BY g.n DESC, last DESC, source LIMIT 25""")
def prospect_summary(spark, sf_dir):
    return pr.summarise_prospects(_document_events(spark, sf_dir))


@query("""SELECT doc_id FROM documents WHERE lang = 'fr' OR contains(lower(strip_accents(text)), 'thanedble') OR contains(lower(strip_accents(text)), 'und ')""")
def theme_candidates(spark, sf_dir):
    d = tb.text_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("industry"), F.col("text").alias("text_snippet")
    )
    return pr.theme_candidates(d, ["fr"], ["thanedble", "und "]).select("doc_id")


@query("""SELECT source AS company_name, count(*) AS n FROM documents
WHERE lang = 'en' OR contains(lower(strip_accents(text)), 'que') GROUP BY ALL""")
def external_theme_events(spark, sf_dir):
    e = _document_events(spark, sf_dir).join(
        tb.text_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text"), "event_id"
    ).withColumn("text_snippet", F.col("text"))
    kept = pr.theme_candidates(e.filter(tx.is_external("company_id")), ["ind_en"], ["que"])
    return kept.groupBy("company_name").agg(F.count(F.lit(1)).alias("n"))


# --- prices and jobs ----------------------------------------------------------

_PRICE_SQL = """px AS (
  SELECT l_suppkey, l_shipdate AS ts, l_extendedprice / l_quantity AS close, l_orderkey, l_linenumber, l_partkey FROM lineitem
), mv AS (
  SELECT l_suppkey, arg_min(close, (ts, l_orderkey, l_linenumber, l_partkey, close)) AS first_close,
    arg_max(close, (ts, l_orderkey, l_linenumber, l_partkey, close)) AS last_close, max(ts) AS last_ts FROM px GROUP BY ALL
), ch AS (
  SELECT 'S' || l_suppkey AS ticker, first_close, last_close, last_ts, (last_close - first_close) / first_close AS change FROM mv WHERE first_close <> 0
), st AS (
  SELECT *, CASE WHEN abs(change) >= 0.2 THEN 1.0::DOUBLE WHEN abs(change) >= 0.1 THEN 0.75::DOUBLE WHEN abs(change) >= 0.05 THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS signal_strength FROM ch
)"""


def _price_moves(spark, sf_dir):
    line = tb.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )
    return pr.price_moves(
        line, F.lit("1990-01-01").cast("timestamp"), "1y", ["ts", "l_orderkey", "l_linenumber", "l_partkey"]
    )


@query(f"""WITH {_PRICE_SQL} SELECT ticker, round(change, 6) AS change, signal_strength, strftime(last_ts, '%Y-%m-%d') AS last_day,
  ticker || ' activity' AS title FROM st""")
def price_move(spark, sf_dir):
    out = _price_moves(spark, sf_dir)
    return out.select(
        "ticker", F.round("change", 6).alias("change"), "signal_strength",
        F.date_format("last_ts", "yyyy-MM-dd").alias("last_day"), "title",
    )


@query(f"""WITH {_PRICE_SQL}, c AS (SELECT c_custkey, 'S' || (c_nationkey + 1) AS ticker FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS company_id, ticker, signal_strength FROM c JOIN st USING (ticker)""")
def finance_events(spark, sf_dir):
    u = tb.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"),
        F.concat(F.lit(" S"), (F.col("c_nationkey") + 1).cast("string"), F.lit(" ")).alias("ticker"),
    )
    return pr.finance_events(_price_moves(spark, sf_dir), u).select("company_id", "ticker", "signal_strength")


@query("""WITH own AS (SELECT s_nationkey, max(lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS company_id FROM supplier GROUP BY ALL)
SELECT o_orderkey, company_id, CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS signal_strength
FROM orders JOIN customer ON o_custkey = c_custkey JOIN own ON s_nationkey = c_nationkey WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def job_events(spark, sf_dir):
    nation_domain = lambda c: F.concat(F.lit("Nation"), F.col(c).cast("string"), F.lit(".Example"))
    owners = tb.table(spark, sf_dir, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("company_id"),
        nation_domain("s_nationkey").alias("company_domain"),
    )
    o = tb.table(spark, sf_dir, "orders").join(
        tb.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    postings = o.select(
        "o_orderkey",
        F.lower(nation_domain("c_nationkey")).alias("company_domain"),
        F.col("o_orderpriority").alias("title"),
        F.lit("").alias("snippet"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    out = pr.job_events(postings, owners, ["URGENT"], F.lit("1998-01-01").cast("timestamp"))
    return out.select("o_orderkey", "company_id", "signal_strength")


# --- payloads -----------------------------------------------------------------

@query("""SELECT event_id, 'https://n.example/' || event_id AS url, event_type AS title, 'k ' || json_extract_string(props, '$.k') AS text_snippet,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def json_articles(spark, sf_dir):
    e = tb.text_table(spark, sf_dir, "events")
    article = F.struct(
        F.concat(F.lit("https://n.example/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit(" "), "event_type").alias("title"),
        F.concat(F.lit("k   "), F.get_json_object("props", "$.k")).alias("snippet"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
    )
    blank = F.struct(F.lit("").alias("url"), F.lit("x").alias("title"), F.lit("").alias("snippet"), F.lit("").alias("seendate"))
    landed = e.select("event_id", F.to_json(F.struct(F.array(article, blank).alias("articles"))).alias("payload"))
    out = pl.search_articles(landed, "payload", tb.AS_OF)
    return out.select("event_id", "url", "title", "text_snippet", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("""SELECT o_orderkey, o_orderpriority AS title, 'https://j.example/' || o_orderkey AS url, o_orderstatus || ', remote' AS snippet,
  strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def json_postings(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders")
    job = F.struct(
        F.concat(F.lit("https://j.example/"), F.col("o_orderkey").cast("string")).alias("hostedUrl"),
        F.col("o_orderpriority").alias("text"),
        F.struct(F.col("o_orderstatus").alias("team"), F.lit("remote").alias("place")).alias("categories"),
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1000).cast("bigint").alias("createdAt"),
    )
    landed = o.select("o_orderkey", F.to_json(F.array(job)).alias("payload"))
    out = pl.posting_jobs(landed, "payload", tb.AS_OF)
    return out.select("o_orderkey", "title", "url", "snippet", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("""SELECT 'feed' || c_nationkey AS feed, c_custkey AS key, 'https://f.example/' || c_custkey AS url, c_name AS title, c_mktsegment AS text_snippet,
  '2024-01-05 10:00:00' AS ts FROM customer""")
def feed_entries(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    xml = F.concat(
        F.lit("<rss><channel><item><title>"), F.col("c_name"), F.lit("</title><link>https://f.example/"), key,
        F.lit("</link><description>"), F.col("c_mktsegment"),
        F.lit("</description><pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>"),
    )
    landed = c.select(F.concat(F.lit("feed"), F.col("c_nationkey").cast("string"), F.lit(":"), key).alias("feed"), xml.alias("xml"))
    out = pl.feed_entries(landed, "feed", "xml", tb.AS_OF)
    parts = F.split("feed", ":")
    return out.select(
        parts[0].alias("feed"), parts[1].cast("bigint").alias("key"), "url", "title", "text_snippet",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )


@query("""SELECT c_name AS member_name, 'https://l.example/m/' || c_custkey AS url, '2011-03-04' AS ts, 'ungc' AS signal_type, 'BR' AS country, c_mktsegment AS sector
FROM customer""")
def html_member_tables(spark, sf_dir):
    c = tb.text_table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit("<html><table><tr><th>Name</th><th>Type</th><th>Sector</th><th>Country</th><th>Joined On</th></tr>"
              "<tr><th class='name'><a href='/m/"), key, F.lit("'>"), F.col("c_name"),
        F.lit("</a></th><td class='type'>Company</td><td class='sector'>"), F.col("c_mktsegment"),
        F.lit("</td><td class='country'>Brazil</td><td class='joined-on'>4/3/2011</td></tr>"
              "<tr><th class='name'>Nowhere</th><td class='type'>SME</td><td class='sector'>x</td><td class='country'>Atlantis</td><td class='joined-on'></td></tr></table></html>"),
    )
    landed = c.select(F.concat(F.lit("https://l.example/p"), key).alias("url"), html.alias("html"))
    return pg.compact_members(pg.table_rows(landed)).select("member_name", "url", "ts", "signal_type", "country", "sector")


# --- source adapters ----------------------------------------------------------

@query("""SELECT c_name AS member_name, CASE WHEN c_acctbal < 0 THEN 's' WHEN c_acctbal < 5000 THEN 'm' ELSE 'l' END AS size_bin,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'manufacturing' WHEN 'AUTOMOBILE' THEN 'other_services' WHEN 'BUILDING' THEN 'construction_realestate' ELSE 'other_services' END AS industry,
  'CL' AS country, '2019-01-01' AS day, 'https://b.example/' || c_custkey AS url, c_mktsegment AS context_sector
FROM customer""")
def bcorp_members(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer")
    raw = c.select(
        F.col("c_name").alias("company_name"),
        F.lit("Chile ").alias("country"),
        F.lit("not a date").alias("date_certified"),
        F.lit("2019").alias("assessment_year"),
        F.lit(" ").alias("b_corp_profile"),
        F.concat(F.lit("https://b.example/"), F.col("c_custkey").cast("string")).alias("website"),
        F.col("c_mktsegment").alias("industry_category"),
        F.when(F.col("c_acctbal") < 0, "1-9").when(F.col("c_acctbal") < 5000, "50-249").otherwise("1000+").alias("size"),
        F.lit("Makes things").alias("description"),
    )
    return adapters.bcorp_members(raw, tb.AS_OF).select(
        "member_name", "size_bin", "industry", "country", F.date_format("ts", "yyyy-MM-dd").alias("day"), "url", "context_sector"
    )


_MEMBER_CONTEXT_SQL = """WITH m AS (
  SELECT c_custkey, c_mktsegment AS sector, CASE WHEN c_acctbal < 0 THEN 'Banco de prueba' ELSE '' END AS about FROM customer
)
SELECT c_custkey, CASE WHEN about <> '' THEN 'finance_insurance_capital' WHEN sector = 'AUTOMOBILE' THEN 'professional_services_consulting'
    WHEN sector = 'MACHINERY' THEN 'industrial_manufacturing' ELSE 'professional_services_consulting' END AS industry,
  CASE WHEN about <> '' THEN round(least(3.0::DOUBLE / 5 + 0.2::DOUBLE, 0.75::DOUBLE), 6) WHEN sector = 'MACHINERY' THEN 0.6::DOUBLE ELSE 0.35::DOUBLE END AS confidence,
  'Source=bcorp | sector: ' || sector || CASE WHEN about <> '' THEN ' | description: ' || about ELSE '' END AS description
FROM m"""


@query(_MEMBER_CONTEXT_SQL)
def member_classification(spark, sf_dir):
    members = tb.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lit("").alias("industry"),
        F.col("c_mktsegment").alias("context_sector"),
        F.lit(None).cast("string").alias("context_type"),
        F.when(F.col("c_acctbal") < 0, "Banco de prueba").otherwise(" ").alias("context_description"),
        F.lit("").alias("text_snippet"),
    )
    ready = cl.context_fields(members)
    pick = lambda key: F.try_element_at("context", F.lit(key))
    texts = ready.withColumns({"_s": pick("sector"), "_d": pick("description")})
    ruled = cl.rule_classify(texts, ["_s", "_d"])
    described = ruled.withColumn(
        "rule_description",
        cl.rule_description(F.lit("bcorp"), F.col("_s"), F.col("industry"), F.col("_d"), F.col("text_snippet"), F.col("rule_slug")),
    )
    out = cl.overlay_classification(described)
    return out.select(
        "c_custkey", "industry", F.round("rule_confidence", 6).alias("confidence"), "description"
    )


@query("""WITH s AS (SELECT CASE event_type WHEN 'view' THEN 'solar energy' WHEN 'click' THEN 'banco' ELSE event_type END AS industry FROM events
  UNION ALL SELECT 'hospital' FROM orders)
SELECT CASE industry WHEN 'solar energy' THEN 'energy_power_utilities' WHEN 'banco' THEN 'finance_insurance_capital'
  WHEN 'hospital' THEN 'healthcare_pharma_biotech' ELSE 'unknown' END AS industry, count(*) AS n FROM s GROUP BY ALL""")
def combined_signals(spark, sf_dir):
    kind = F.col("signal_type")
    e = tb.signal_events(spark, sf_dir).withColumn(
        "industry", F.when(kind == "view", "solar energy").when(kind == "click", "banco").otherwise(kind)
    )
    o = tb.order_events(spark, sf_dir).withColumn("industry", F.lit("hospital"))
    return cl.combine_signals([e, o]).groupBy("industry").agg(F.count(F.lit(1)).alias("n"))


# --- pages --------------------------------------------------------------------

@query()
def page_text(spark, sf_dir):
    return pg.page_contents(tb.text_table(spark, sf_dir, "pages")).select("page_id", "title", "text")


@query()
def page_links(spark, sf_dir):
    return pg.page_links(pg.page_contents(tb.text_table(spark, sf_dir, "pages")))


@query()
def page_score(spark, sf_dir):
    terms = ["thanedble", r"\bund\b", "que", "atti(on|ng)"]
    contents = pg.page_contents(tb.text_table(spark, sf_dir, "pages"))
    return rounded(pg.page_scores(contents, tb.AS_OF, terms).select("page_id", "url", "density", "score"), 4, "density")
