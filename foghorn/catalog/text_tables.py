"""Text queries over documents, parts, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foghorn import vocab
from foghorn.catalog.base import query, rounded
from foghorn.functions import dates as dx, measures as mx, text as tx
from foghorn.operators import pairs, profile
from foghorn.plans import classify as cl, documented as doc, events as ev
from foghorn.sources import tables as tb

# Words that occur in the provided texts, standing in for theme keywords.
THEMES = ["thanedble", "attion", "erin", "onthe", "que", "des", "der", "thanea"]
INCLUDE = ["thanedble", "attion", "éve", "ouen", "und"]
EXCLUDE = ["ereriner", "vérité", "onthanea"]
VALENCE = {"the": 0.4, "que": 0.4, "und": -0.7, "thanea": 1.9, "erin": -2.3, "des": -0.7, "for": 1.1}

_FOLD = "lower(trim(regexp_replace(strip_accents(text), '\\s+', ' ', 'g')))"


def _sum_contains(column: str, terms) -> str:
    return " + ".join(f"CAST(contains({column}, '{t}') AS INTEGER)" for t in terms)


def documents(spark, sf_dir):
    return tb.text_table(spark, sf_dir, "documents")


# --- keywords -----------------------------------------------------------------

@query(f"""SELECT doc_id, {_sum_contains('lower(text)', THEMES)} AS hits,
  round(({_sum_contains('lower(text)', THEMES)})::DOUBLE / {len(THEMES)}, 3) AS coverage FROM documents""")
def keyword_score(spark, sf_dir):
    text = F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        tx.term_hits(F.lower(text), THEMES).alias("hits"),
        tx.keyword_coverage(text, THEMES).alias("coverage"),
    )


_INC = tx.dedupe_terms(INCLUDE, folded=True)
_EXC = tx.dedupe_terms(EXCLUDE, folded=True)
_TIER = "CASE WHEN hits >= 3 THEN 1.0::DOUBLE WHEN hits = 2 THEN 0.85::DOUBLE WHEN hits = 1 THEN 0.65::DOUBLE ELSE 0.0::DOUBLE END"


@query(f"""WITH d AS (SELECT doc_id, {_FOLD} AS t FROM documents),
h AS (SELECT doc_id, {_sum_contains('t', _INC)} AS hits FROM d)
SELECT doc_id, hits, {_TIER} AS tier FROM h""")
def relevance_tier(spark, sf_dir):
    folded = tx.fold_match("text")
    hits = tx.term_hits(folded, _INC)
    return documents(spark, sf_dir).select(
        "doc_id", hits.alias("hits"), tx.relevance_tier(hits).alias("tier")
    )


_WORDS = "string_split(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')), ' ')"
_VALENCE_ROWS = ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in VALENCE.items())
_LEX_SQL = f"""v(w, s) AS (VALUES {_VALENCE_ROWS}),
words AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
total AS (SELECT doc_id, sum(s) AS s FROM words JOIN v USING (w) GROUP BY ALL),
lex AS (
  SELECT d.doc_id, text, n_chars, lang, source, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15.0::DOUBLE), 4) AS compound
  FROM documents d LEFT JOIN total t ON d.doc_id = t.doc_id
)"""


@query(f"""WITH {_LEX_SQL}
SELECT doc_id, round(compound, 3) AS compound,
  CASE WHEN compound >= 0.2 THEN 'positive' WHEN compound <= -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM lex""")
def lexicon_sentiment(spark, sf_dir):
    compound = ev.lexicon_compound(F.col("text"), VALENCE)
    scored = documents(spark, sf_dir).select("doc_id", compound.alias("compound"))
    return scored.select(
        "doc_id", F.round("compound", 3).alias("compound"), mx.sentiment_label(F.col("compound")).alias("label")
    )


@query(f"""WITH {_LEX_SQL}, f AS (
  SELECT doc_id, compound, n_chars / 5000.0::DOUBLE AS base, {_FOLD} AS t FROM lex
), h AS (
  SELECT *, ({_sum_contains('t', _EXC)}) > 0 AS excluded, {_sum_contains('t', _INC)} AS hits,
    CASE WHEN compound >= 0.2 THEN 'positive' WHEN compound <= -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM f
), r AS (SELECT *, {_TIER} AS tier FROM h), s AS (
  SELECT doc_id, tier, label, compound, CASE WHEN label = 'negative' THEN -abs(base * tier * (1 + abs(compound)))
    WHEN label = 'neutral' THEN base * tier * 0.5::DOUBLE ELSE base * tier * (1 + compound * 0.5::DOUBLE) END AS x
  FROM r WHERE NOT excluded AND tier > 0
)
SELECT doc_id, round(greatest(least(x, 1), -1), 3) AS signal_strength, tier AS climate_score, label AS sentiment_label,
  round(compound, 3) AS sentiment_score FROM s WHERE x <> 0""")
def enrich_strength(spark, sf_dir):
    d = documents(spark, sf_dir)
    out = ev.enrich_strength(
        d.select("doc_id", "text", "n_chars"),
        F.col("text"),
        INCLUDE,
        EXCLUDE,
        VALENCE,
        F.col("n_chars") / 5000.0,
    )
    return rounded(
        out.select("doc_id", "signal_strength", "climate_score", "sentiment_label", "sentiment_score"),
        3, "signal_strength", "sentiment_score",
    )


# --- co-occurrence ------------------------------------------------------------

_THEME_ROWS = ", ".join(f"('{t}')" for t in THEMES)
_EDGE_SQL = f"""k(t) AS (VALUES {_THEME_ROWS}),
m AS (SELECT doc_id, t FROM documents JOIN k ON contains(lower(text), t)),
edges AS (
  SELECT x.t AS a, y.t AS b, count(*) AS weight FROM m x JOIN m y ON x.doc_id = y.doc_id AND x.t < y.t GROUP BY ALL
)"""


def _edges(spark, sf_dir):
    d = documents(spark, sf_dir)
    return pairs.pair_counts(d.select(tx.matched_terms(F.lower("text"), THEMES).alias("terms")), "terms")


@query(f"WITH {_EDGE_SQL} SELECT a, b, weight FROM edges")
def theme_cooccurrence(spark, sf_dir):
    return _edges(spark, sf_dir)


@query(f"""WITH {_EDGE_SQL}
SELECT node, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS strength
FROM (SELECT a AS node, weight FROM edges UNION ALL SELECT b, weight FROM edges) GROUP BY node""")
def theme_degree(spark, sf_dir):
    return pairs.node_degrees(_edges(spark, sf_dir))


_MATRIX_COLS = ", ".join(
    f"CAST(coalesce(sum(weight) FILTER (b = '{t}'), 0) AS BIGINT) AS \"{t}\"" for t in THEMES
)


@query(f"""WITH {_EDGE_SQL}, both_ways AS (SELECT a, b, weight FROM edges UNION ALL SELECT b, a, weight FROM edges)
SELECT k.t AS a, {_MATRIX_COLS} FROM k LEFT JOIN both_ways ON k.t = a GROUP BY k.t""")
def theme_matrix(spark, sf_dir):
    return pairs.dense_matrix(_edges(spark, sf_dir), THEMES)


@query(f"SELECT doc_id, {' || '.join(f'''CASE WHEN contains(lower(text), '{t}') THEN '{t};' ELSE '' END''' for t in sorted(THEMES))} AS terms FROM documents")
def matched_keywords(spark, sf_dir):
    hits = F.transform(tx.matched_terms(F.lower("text"), THEMES), lambda t: F.concat(t, F.lit(";")))
    return documents(spark, sf_dir).select("doc_id", F.array_join(hits, "").alias("terms"))


# --- classification -----------------------------------------------------------

_RULE_ROWS = ", ".join(
    f"({i}, '(?i){p}', '{s}', {w}::DOUBLE)" for i, (p, s, w) in enumerate(vocab.INDUSTRY_PATTERNS)
)
_ALIAS_ROWS = ", ".join(
    f"({i}, '{cl._fragment_literal(a)}', '{s}')"
    for i, (s, a) in enumerate((s, a) for s, words in vocab.INDUSTRY_ALIASES for a in words)
)
_TOKEN_ROWS = ", ".join(f"({i}, '{t}', '{s}')" for i, (t, s) in enumerate(vocab.INDUSTRY_TOKENS))
_FRAG = "trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9&/\\\\]+', ' ', 'g'))"


def _class_sql(inputs: str) -> str:
    """Classification over ``inputs(row_id, industry, company_name, text_snippet)`` by joined rule tables."""
    frag = " || chr(10) || ".join(_FRAG.format(c=c) for c in ("industry", "company_name", "text_snippet"))
    return f"""{inputs},
rule(pos, pattern, slug, weight) AS (VALUES {_RULE_ROWS}),
alias(pos, term, slug) AS (VALUES {_ALIAS_ROWS}),
tok(pos, term, slug) AS (VALUES {_TOKEN_ROWS}),
x AS (
  SELECT row_id, industry, {frag} AS frags, industry || ' ' || company_name || ' ' || text_snippet AS raw FROM inp
), x2 AS (SELECT *, strip_accents(raw) AS folded, {_FRAG.format(c='raw')} AS whole FROM x
), a AS (SELECT row_id, arg_min(slug, pos) AS slug FROM x JOIN alias ON contains(frags, term) GROUP BY ALL
), s AS (
  SELECT row_id, slug, sum(weight) AS score, min(pos) AS pos
  FROM x2 JOIN rule ON regexp_matches(folded, pattern) OR regexp_matches(raw, pattern) GROUP BY ALL
), best AS (
  SELECT row_id, slug, score FROM s QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, pos) = 1
), t AS (SELECT row_id, arg_min(slug, pos) AS slug FROM x2 JOIN tok ON contains(whole, term) GROUP BY ALL
), cls AS (
  SELECT x.row_id, x.industry, coalesce(a.slug, CASE WHEN best.score >= 2.0 THEN best.slug END, t.slug, 'unknown') AS slug,
    CASE WHEN a.slug IS NOT NULL THEN 'alias' WHEN best.score >= 2.0 THEN 'weighted' WHEN t.slug IS NOT NULL THEN 'token' ELSE 'unknown' END AS reason,
    CASE WHEN a.slug IS NOT NULL THEN NULL WHEN best.score >= 2.0 THEN round(best.score, 3) WHEN t.slug IS NOT NULL THEN NULL ELSE 0.0::DOUBLE END AS score
  FROM x LEFT JOIN a USING (row_id) LEFT JOIN best USING (row_id) LEFT JOIN t USING (row_id)
)"""


_DOC_INPUT = "inp AS (SELECT doc_id AS row_id, lang AS industry, source AS company_name, text AS text_snippet FROM documents)"
_PART_INPUT = """inp AS (
  SELECT p_partkey AS row_id, 'manufacturing' AS industry, p_name AS company_name,
    CASE p_size % 5 WHEN 0 THEN 'Banco y tienda ' WHEN 1 THEN 'Solar energy ' WHEN 2 THEN 'Food truck ' WHEN 3 THEN 'Dispositivo médico ' ELSE 'Ring ' END || p_type AS text_snippet
  FROM part
)"""


def _doc_inputs(spark, sf_dir):
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("industry"),
        F.col("source").alias("company_name"),
        F.col("text").alias("text_snippet"),
    )


def _part_inputs(spark, sf_dir):
    lead = F.element_at(
        F.array(*[F.lit(v) for v in ("Banco y tienda ", "Solar energy ", "Food truck ", "Dispositivo médico ", "Ring ")]),
        F.col("p_size") % 5 + 1,
    )
    return tb.text_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.lit("manufacturing").alias("industry"),
        F.col("p_name").alias("company_name"),
        F.concat(lead, F.col("p_type")).alias("text_snippet"),
    )


@query(f"WITH {_class_sql(_DOC_INPUT)} SELECT row_id, slug AS class_slug, reason AS class_reason, score AS class_score FROM cls")
def classify_rules(spark, sf_dir):
    return cl.classify(_doc_inputs(spark, sf_dir)).select("row_id", "class_slug", "class_reason", "class_score")


_SIMPLE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in vocab.SIMPLE_INDUSTRY.items())
_RECLASS_SQL = f"""{_class_sql(_PART_INPUT)},
simple(slug, short) AS (VALUES {_SIMPLE_ROWS}),
rc AS (
  SELECT cls.*, coalesce(short, cls.slug) AS target,
    reason IN ('alias', 'weighted') AND coalesce(short, cls.slug) <> industry AS applies
  FROM cls LEFT JOIN simple USING (slug)
)"""


@query(f"""WITH {_RECLASS_SQL}
SELECT CAST(row_id AS VARCHAR) AS entity_id, industry AS old_industry, target AS new_industry, reason, score FROM rc WHERE applies""")
def reclassify_log(spark, sf_dir):
    log = cl.change_log(cl.reclassify(_part_inputs(spark, sf_dir)), ["row_id"])
    return log.drop("sector_hint")


@query(f"""WITH {_RECLASS_SQL}
SELECT count(*) AS scanned, count(*) FILTER (applies AND reason = 'alias') AS alias_changes,
  count(*) FILTER (applies AND reason = 'weighted') AS weighted_changes, count(*) FILTER (reason = 'token') AS token_hits,
  count(*) FILTER (target = 'unknown') AS unknown_hits FROM rc""")
def reclassify_counts(spark, sf_dir):
    return cl.change_counts(cl.reclassify(_part_inputs(spark, sf_dir)))


@query(f"""WITH {_RECLASS_SQL}
SELECT industry AS old_industry, target AS new_industry, count(*) AS count FROM rc WHERE applies GROUP BY ALL""")
def reclassify_confusion(spark, sf_dir):
    log = cl.change_log(cl.reclassify(_part_inputs(spark, sf_dir)), ["row_id"])
    return cl.confusion(log, "old_industry", "new_industry")


@query("""SELECT quality AS old_industry, toxic AS new_industry, count(*) AS count
FROM labels JOIN documents USING (doc_id) GROUP BY ALL""")
def label_confusion(spark, sf_dir):
    labelled = tb.table(spark, sf_dir, "labels").join(documents(spark, sf_dir).select("doc_id"), "doc_id")
    return cl.confusion(labelled, "quality", "toxic")


def _case_rules(column: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{s}'" for p, s in rules)
    return f"CASE {arms} ELSE '{default}' END"


@query(f"""SELECT doc_id, {_case_rules('lower(trim(text))', vocab.SECTOR_PATTERNS, 'other_services')} AS sector,
  {_case_rules('lower(trim(text))', vocab.SECTOR_KEYWORDS, '')} AS sector_keyword,
  {_case_rules('lower(text)', vocab.LIST_PAGE_PATTERNS, '')} AS list_page FROM documents""")
def first_match_rules(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id",
        tx.sector_industry("text").alias("sector"),
        tx.sector_exact_industry("text").alias("sector_keyword"),
        tx.first_match(F.lower("text"), vocab.LIST_PAGE_PATTERNS, "").alias("list_page"),
    )


@query(f"""WITH rule(pos, pattern, slug, weight) AS (VALUES {_RULE_ROWS}),
s AS (SELECT doc_id, slug, sum(weight) AS score FROM documents JOIN rule ON regexp_matches(text, pattern) GROUP BY ALL),
b AS (SELECT doc_id, slug, score FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, slug) = 1)
SELECT doc_id, coalesce(slug, 'professional_services_consulting') AS rule_slug, coalesce(score, 0.0::DOUBLE) AS rule_score,
  CASE WHEN score > 0 THEN round(least(score / 5.0::DOUBLE + 0.2::DOUBLE, 0.75::DOUBLE), 6) ELSE 0.35::DOUBLE END AS rule_confidence
FROM documents LEFT JOIN b USING (doc_id)""")
def rule_fallback(spark, sf_dir):
    out = cl.rule_classify(documents(spark, sf_dir).select("doc_id", "text"), ["text"])
    return rounded(out.drop("text"), 6, "rule_confidence")


# --- names, slugs, ids --------------------------------------------------------

@query(f"""SELECT doc_id, md5(strip_accents(text)) AS folded, md5({_FOLD}) AS for_match,
  md5({_FRAG.format(c='text')}) AS fragment, md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'))) AS words,
  md5(trim(regexp_replace(lower(text), '[^a-z0-9áéíóúüñ]+', ' ', 'g'))) AS accented_name,
  CAST(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+')) AS INTEGER) AS word_count FROM documents""")
def text_normal_forms(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id",
        F.md5(tx.fold("text")).alias("folded"),
        F.md5(tx.fold_match("text")).alias("for_match"),
        F.md5(tx.fragment("text")).alias("fragment"),
        F.md5(tx.fold_words("text")).alias("words"),
        F.md5(tx.normalise_name("text", fold_first=False)).alias("accented_name"),
        tx.word_count("text").alias("word_count"),
    )


_STOP = ", ".join(f"'{w}'" for w in vocab.NAME_STOPWORDS)
_COMPANY = "'Grupo ' || p_name || ' ' || p_brand || ' de ' || p_type || ' S.A.'"


def _companies(spark, sf_dir):
    name = F.concat(
        F.lit("Grupo "), "p_name", F.lit(" "), "p_brand", F.lit(" de "), "p_type", F.lit(" S.A.")
    )
    return tb.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@query(f"""WITH n AS (SELECT p_partkey, trim(regexp_replace(lower({_COMPANY}), '[^a-z0-9]+', ' ', 'g')) AS norm FROM part)
SELECT p_partkey, norm, array_to_string(list_filter(string_split(norm, ' '), lambda x: length(x) > 1 AND x NOT IN ({_STOP})), ' ') AS tokens FROM n""")
def name_tokens(spark, sf_dir):
    norm = _companies(spark, sf_dir).withColumn("norm", tx.normalise_name("name"))
    return norm.select("p_partkey", "norm", F.array_join(tx.name_tokens("norm"), " ").alias("tokens"))


@query("""WITH n AS (SELECT p_partkey, 'Compañía de ' || p_name || ' Ltda' AS a FROM part),
c AS (SELECT *, trim(regexp_replace(regexp_replace(a, '(?i)\\b(ltda|inc|corp|company|compañía)\\b', '', 'g'), '\\s+', ' ', 'g')) AS cleaned FROM n)
SELECT p_partkey, a || '|' || cleaned || '|' || regexp_replace(cleaned, '^de ', '') AS variants FROM c""")
def company_variants(spark, sf_dir):
    name = F.concat(F.lit("Compañía de "), "p_name", F.lit(" Ltda"))
    parts = tb.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return parts.select("p_partkey", F.array_join(tx.company_variants("name"), "|").alias("variants"))


@query(f"""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower({_COMPANY}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS dash,
  trim(regexp_replace({_COMPANY}, '[^a-zA-Z0-9]+', '_', 'g'), '_') AS path FROM part""")
def slugs(spark, sf_dir):
    return _companies(spark, sf_dir).select(
        "p_partkey", tx.slug_dash("name").alias("dash"), tx.slug_path("name").alias("path")
    )


@query(f"""SELECT p_partkey, CAST('0x' || substring(sha1({_COMPANY}), 1, 15) AS BIGINT) AS numeric_hash,
  'sbti-' || sha1('sbti::' || {_COMPANY} || '::AR') AS text_hash,
  regexp_replace(CAST(p_partkey AS VARCHAR) || '.0', '\\.0$', '') AS cleaned, p_partkey AS numeric_id FROM part""")
def stable_ids(spark, sf_dir):
    raw = F.concat(F.col("p_partkey").cast("string"), F.lit(".0"))
    return _companies(spark, sf_dir).select(
        "p_partkey",
        tx.hash_id(F.col("name")).alias("numeric_hash"),
        tx.prefixed_hash_id("sbti", F.col("name"), F.lit("AR")).alias("text_hash"),
        tx.clean_id(raw).alias("cleaned"),
        tx.numeric_id(raw).alias("numeric_id"),
    )


@query("""SELECT c_mktsegment AS segment, CASE c_mktsegment WHEN 'BUILDING' THEN 'Obras' WHEN 'MACHINERY' THEN 'Equipos' ELSE c_mktsegment END AS label,
  count(*) AS n FROM customer GROUP BY ALL""")
def industry_labels(spark, sf_dir):
    table = {"building": "Obras", "machinery": "Equipos"}
    c = tb.table(spark, sf_dir, "customer")
    return c.groupBy(
        F.col("c_mktsegment").alias("segment"), tx.industry_label(F.col("c_mktsegment"), table).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, 1234567.5::DOUBLE AS big, round(o_totalprice, 2) AS price FROM orders""")
def parse_numbers(spark, sf_dir):
    text = F.concat(F.lit("USD "), F.format_number("o_totalprice", 2))
    return tb.table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.parse_number(F.lit("$1,234,567.5")).alias("big"), tx.parse_number(text).alias("price")
    )


# --- URLs ---------------------------------------------------------------------

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_CANON = f"""lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || {_HOST}
  || regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]*(.*)$', 1), '/+$', '')
  || CASE WHEN kept = '' THEN '' ELSE '?' || kept END"""
_KEPT = """array_to_string(list_filter(string_split(CASE WHEN contains(regexp_replace(url, '#.*$', ''), '?')
  THEN regexp_extract(regexp_replace(url, '#.*$', ''), '[?](.*)$', 1) ELSE '' END, '&'),
  lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND NOT starts_with(lower(p), 'gclid=') AND NOT starts_with(lower(p), 'fbclid=')), '&')"""


@query(f"WITH k AS (SELECT page_id, url, {_KEPT} AS kept FROM pages) SELECT page_id, {_CANON} AS canonical FROM k")
def canonical_url(spark, sf_dir):
    return tb.table(spark, sf_dir, "pages").select("page_id", tx.canonical_url("url").alias("canonical"))


@query(f"SELECT page_id, regexp_replace({_HOST}, '^www\\.', '') AS domain FROM pages")
def url_domain(spark, sf_dir):
    return tb.table(spark, sf_dir, "pages").select("page_id", tx.url_domain("url").alias("domain"))


@query(f"""SELECT CASE WHEN ends_with({_HOST}, '.com') THEN 'US' WHEN ends_with({_HOST}, '.net') THEN 'NT'
  WHEN ends_with({_HOST}, '.org') THEN 'OR' END AS country, count(*) AS n FROM pages GROUP BY ALL""")
def country_from_domain(spark, sf_dir):
    suffixes = [(".com", "US"), (".net", "NT"), (".org", "OR")]
    p = tb.table(spark, sf_dir, "pages")
    return p.groupBy(tx.country_from_domain(tx.url_domain("url"), suffixes).alias("country")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""SELECT conv_id, turn, CASE WHEN contains(lower(text), ' und ') THEN 'DE' WHEN contains(lower(text), 'que') THEN 'FR'
  WHEN contains(lower(text), 'the') THEN 'GB' END AS country FROM conversations""")
def country_from_text(spark, sf_dir):
    markers = {"DE": [" und "], "FR": ["que"], "GB": ["the"]}
    c = tb.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", tx.country_from_text(F.col("text"), markers).alias("country"))


# --- dates --------------------------------------------------------------------

@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS day_first,
  strftime(o_orderdate, '%Y-%m-%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS millis,
  strftime(o_orderdate, '%Y') || '-01-01' AS year_only, strftime(o_orderdate, '%Y-%m') || '-01' AS month,
  strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS member_ts, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN strftime(o_orderdate, '%Y-%m-%d') END AS in_url,
  round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(o_orderdate)) / 86400000000.0::DOUBLE, 4) AS age
FROM orders""")
def lenient_dates(spark, sf_dir):
    ts = F.col("o_orderdate").cast("timestamp")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return tb.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day(dx.parse_ts(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))).alias("iso"),
        dx.day_first_date(F.date_format(ts, "d/M/yyyy")).alias("day_first"),
        day(dx.compact_ts(F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))).alias("compact"),
        day(dx.epoch_millis((F.unix_micros(ts) / 1000).cast("bigint").cast("string"))).alias("millis"),
        day(dx.first_ts(F.lit("n/a"), F.date_format(ts, "yyyy"), default=dx.as_of_lit(tb.AS_OF))).alias("year_only"),
        day(dx.month_start(ts)).alias("month"),
        dx.membership_ts(day(ts), dx.as_of_lit(tb.AS_OF)).alias("member_ts"),
        day(dx.url_date(F.concat(F.lit("https://x.example/"), F.date_format(ts, "yyyy/M/d"), F.lit("/a")))).alias("in_url"),
        F.round(dx.age_days(dx.as_of_lit(tb.AS_OF), ts), 4).alias("age"),
    )


# --- profiles -----------------------------------------------------------------

def _profile_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count({column}) AS non_null,
  round(100.0::DOUBLE * (count(*) - count({column})) / count(*), 2) AS null_pct, count(DISTINCT {column}) AS distinct_values,
  replace(replace(lower(any_value(typeof({column}))), 'varchar', 'string'), 'integer', 'int') AS data_type,
  CAST(min({column}) AS VARCHAR) AS smallest, CAST(max({column}) AS VARCHAR) AS largest,
  (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM customer
   WHERE {column} IS NOT NULL ORDER BY v LIMIT 3)) AS samples FROM customer"""


@query(" UNION ALL ".join(_profile_sql(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def column_profile(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer")
    return profile.column_profile(c, c.columns)


@query("""SELECT token, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS token FROM documents
) WHERE token <> '' GROUP BY ALL""")
def term_frequency(spark, sf_dir):
    return profile.token_frequency(documents(spark, sf_dir), "text")


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY ALL")
def value_frequency(spark, sf_dir):
    return profile.value_frequency(documents(spark, sf_dir), "lang")


# --- documented label rules ---------------------------------------------------

_LEXICON = [("alpha", "of the"), ("alpha", "thanedble"), ("beta", "que"), ("beta", "de la"), ("gamma", "und")]
_HITS = {
    label: " + ".join(
        f"CASE WHEN contains(padded, ' {t} ') THEN {2 if ' ' in t else 1} ELSE 0 END"
        for owner, t in _LEXICON
        if owner == label
    )
    for label in ("alpha", "beta", "gamma")
}


@query(f"""WITH d AS (
  SELECT doc_id, ' ' || trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) || ' ' AS padded,
    row_number() OVER (PARTITION BY source, lang, text ORDER BY doc_id) AS rep,
    CASE lang WHEN 'en' THEN 3.0::DOUBLE WHEN 'fr' THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM documents
), h AS (SELECT *, {_HITS['alpha']} AS a, {_HITS['beta']} AS b, {_HITS['gamma']} AS g FROM d
), best AS (
  SELECT doc_id, greatest(a, b, g) AS hits, weight * pow(0.5::DOUBLE, rep - 1) AS w,
    CASE WHEN a >= b AND a >= g THEN 'alpha' WHEN b >= g THEN 'beta' ELSE 'gamma' END AS label FROM h
), s AS (SELECT *, CASE WHEN hits > 0 THEN hits + w ELSE 0 END AS score FROM best)
SELECT doc_id, round(score, 6) AS label_score, CASE WHEN score >= 2 THEN label END AS label FROM s""")
def label_scores(spark, sf_dir):
    out = doc.label_scores(
        documents(spark, sf_dir), "text", _LEXICON, "source", "lang", "doc_id", {"en": 3.0, "fr": 1.5}
    )
    return rounded(out.select("doc_id", "label_score", "label"), 6, "label_score")


@query(f"""WITH {_class_sql(_DOC_INPUT)}
SELECT count(*) AS rows, count(*) FILTER (slug = 'unknown') AS fallback_rows,
  round(avg(CASE WHEN slug = 'unknown' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share,
  avg(CASE WHEN slug = 'unknown' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) < 0.08 AS accepted FROM cls""")
def fallback_share(spark, sf_dir):
    out = doc.fallback_share(cl.classify(_doc_inputs(spark, sf_dir)), "class_slug", ["unknown"])
    return rounded(out, 6, "share")


@query("""WITH d AS (
  SELECT doc_id, source AS company_id, lang AS source, CASE WHEN n_chars > 2000 THEN '' ELSE lang || '_industry' END AS industry FROM documents
), b AS (
  SELECT company_id, arg_min(industry, (CASE source WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END) || industry) AS best
  FROM d WHERE industry <> '' GROUP BY ALL
)
SELECT doc_id, coalesce(nullif(industry, ''), best) AS industry FROM d LEFT JOIN b USING (company_id)""")
def inherited_industry(spark, sf_dir):
    d = documents(spark, sf_dir).select(
        "doc_id",
        F.col("source").alias("company_id"),
        F.col("lang").alias("source"),
        F.when(F.col("n_chars") > 2000, "").otherwise(F.concat("lang", F.lit("_industry"))).alias("industry"),
    )
    return doc.inherited_industry(d, ["en", "fr"]).select("doc_id", "industry")


# --- labels, names, dates and descriptions from several fields -----------------

@query(r"""WITH m AS (
  SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'brand: ' || p_brand || '; SECTOR :  ' || p_type || ' | x' WHEN 1 THEN 'sector:' || p_type
    ELSE 'brand: ' || p_brand END AS meta FROM part)
SELECT p_partkey, CASE WHEN contains(lower(meta), 'sector') THEN trim(regexp_extract(meta, '(?i)sector\s*:\s*([^;|,]+)', 1)) ELSE '' END AS sector FROM m""")
def sector_labels(spark, sf_dir):
    meta = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("brand: "), "p_brand", F.lit("; SECTOR :  "), "p_type", F.lit(" | x")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit("sector:"), "p_type"))
        .otherwise(F.concat(F.lit("brand: "), "p_brand"))
    )
    return tb.table(spark, sf_dir, "part").select("p_partkey", cl.sector_label(meta).alias("sector"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') AND NOT contains(lower(p_name), 'eco') AND contains(lower(p_type), 'eco')
  THEN 'Eco Ring S.A.' ELSE p_name END AS name FROM part""")
def repaired_names(spark, sf_dir):
    """A name is replaced only where its context has the right form and it has not."""
    part = tb.table(spark, sf_dir, "part")
    name = tx.repair_name(F.col("p_name"), F.col("p_type"), [("ring", "eco", "Eco Ring S.A.")])
    return part.select("p_partkey", name.alias("name"))


@query("""SELECT o_orderkey, strftime(CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 1 DAY
  WHEN 2 THEN CASE WHEN o_orderdate >= DATE '1999-12-30' THEN o_orderdate + INTERVAL 2 DAY END
  WHEN 3 THEN CASE WHEN o_orderdate < DATE '2000-01-01' THEN o_orderdate + INTERVAL 100 YEAR END END, '%Y-%m-%d') AS page_date FROM orders""")
def page_dates(spark, sf_dir):
    """Date of a page: its time tag, else its meta tag, else its address (20yy only); unreadable values are passed over."""
    key = F.col("o_orderkey") % 5

    def day(plus: int, shape: str = "yyyy-MM-dd"):
        return F.date_format(F.date_add(F.col("o_orderdate").cast("date"), plus), shape)

    time_tag = F.when(key == 0, day(0)).when(key == 1, "last week")
    meta_tag = F.when(key < 2, day(1)).when(key == 3, "")
    url = F.concat(
        F.lit("https://n.example"),
        F.when(key == 4, "/news/1/")
        .when(key == 3, F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 1200), "/yyyy/M/d/"))
        .otherwise(day(2, "/yyyy/M/d/")),  # of the last century: not read as a date
    )
    found = dx.page_date(time_tag, meta_tag, url)
    return tb.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(found, "yyyy-MM-dd").alias("page_date"))


@query("""SELECT p_partkey, upper(p_brand) || ': ' || p_name || '. | ' || p_type || '.' || CASE WHEN p_size % 2 = 0 THEN ' | Sector: ' || p_brand ELSE '' END
  || CASE WHEN p_size % 3 = 0 THEN ' | Now live!' ELSE '' END AS description FROM part""")
def described_by_priority(spark, sf_dir):
    """Description, sector, status and snippet in one text, sentences that repeat dropped."""
    sentence = F.concat("p_name", F.lit(".  "), "p_type", F.lit("."))
    text = ev.priority_description(
        F.col("p_brand"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(""),
        F.concat(sentence, F.lit(" "), "p_name", F.lit(".")),
        F.when(F.col("p_size") % 3 == 0, " Now  live!").otherwise(" "),
        F.concat("p_type", F.lit(".")),
    )
    return tb.table(spark, sf_dir, "part").select("p_partkey", text.alias("description"))
