"""Text expressions: folding, name handling, slugs, URLs, ids, keyword tests."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from foghorn import vocab


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters that decompose to one base letter, then the marks to drop."""
    source, target = [], []
    for low, high in ((0x00C0, 0x0250), (0x1E00, 0x1F00)):
        for code in range(low, high):
            char = chr(code)
            base = "".join(
                c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
            )
            if len(base) == 1 and base != char:
                source.append(char)
                target.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(source + marks), "".join(target)


_FOLD_FROM, _FOLD_TO = _fold_table()
_ALNUM = "abcdefghijklmnopqrstuvwxyz0123456789"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once however often ``body`` uses it.

    Bound as a lambda variable, so the optimizer cannot copy the value's
    expression into each use, nor into filters pushed below the projection.
    """
    return F.transform(F.array(value), body).getItem(0)


def text_or_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def collapse_ws(c: Column | str) -> Column:
    """Any whitespace run becomes one space; ends trimmed; null becomes blank.

    Line ends and tabs are swapped for spaces by plain replacement; the regular
    expression then only has to join doubled spaces, or to treat rarer spaces.
    """
    text = text_or_blank(c)
    for space in "\n\r\t":
        text = F.replace(text, F.lit(space), F.lit(" "))
    rare = text.rlike(r"(?U)[\s&&[^ ]]")
    joined = F.when(rare, F.regexp_replace(text, r"(?U)\s+", " ")).otherwise(_single_spaces(text))
    return F.trim(joined)


def _single_spaces(text: Column) -> Column:
    return F.when(text.contains("  "), F.regexp_replace(text, "  +", " ")).otherwise(text)


def _keep_only(lower: Column, kept: str, pattern: str) -> Column:
    """Lower-case text in which every run of other characters is one space.

    ASCII characters outside ``kept`` become spaces by translation; only text
    with other characters left needs the regular expression.
    """
    others = "".join(
        chr(i) for i in range(128) if chr(i) not in kept and chr(i) != " " and not chr(i).isupper()
    )

    def squeeze(spaced: Column) -> Column:
        left = F.octet_length(spaced) != F.length(spaced)
        return F.trim(F.when(left, F.regexp_replace(spaced, pattern, " ")).otherwise(_single_spaces(spaced)))

    return let(F.translate(lower, others, " " * len(others)), squeeze)


def fold(c: Column | str) -> Column:
    """Drop accents from Latin letters without changing anything else.

    Text with as many bytes as characters is plain ASCII and is passed through.
    """
    text = text_or_blank(c)
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, text).otherwise(F.translate(text, _FOLD_FROM, _FOLD_TO))


def fold_match(c: Column | str) -> Column:
    """Accent-free, lower-case, single-spaced form used for containment tests."""
    return F.lower(collapse_ws(fold(c)))


def fold_literal(value: str) -> str:
    """Driver-side twin of :func:`fold_match` for keyword literals."""
    plain = "".join(
        ch for ch in unicodedata.normalize("NFKD", value) if not unicodedata.combining(ch)
    )
    return re.sub(r"\s+", " ", plain).strip().lower()


def fold_words(c: Column | str) -> Column:
    """Folded words only: every other character run is one space."""
    return _keep_only(F.lower(fold(c)), _ALNUM, r"[^a-z0-9]+")


def plain_words(folded: Column) -> Column:
    """:func:`fold_words` of text that is folded and lower case already."""
    return _keep_only(folded, _ALNUM, r"[^a-z0-9]+")


def fragment(c: Column | str) -> Column:
    """Classification fragment: folded, lower, keeping letters, digits, ``&``, ``/``, ``\\``."""
    return _keep_only(F.lower(fold(c)), _ALNUM + "&/\\", r"[^a-z0-9&/\\]+")


def normalise_name(c: Column | str, fold_first: bool = True) -> Column:
    """Company-name key. ``fold_first=False`` keeps the Spanish accented letters instead."""
    source = fold(c) if fold_first else text_or_blank(c)
    return _keep_only(F.lower(source), _ALNUM, r"[^a-z0-9áéíóúüñ]+")


def name_tokens(norm: Column | str, stopwords: Sequence[str] = vocab.NAME_STOPWORDS) -> Column:
    """Words of a normalised name longer than one character and not stopwords."""
    return F.filter(
        F.split(_col(norm), " "), lambda t: (F.length(t) > 1) & ~t.isin(*stopwords)
    )


def company_variants(c: Column | str) -> Column:
    """Name as given, without legal forms, and without connecting words."""
    base = F.trim(text_or_blank(c))
    cleaned = collapse_ws(F.regexp_replace(base, "(?iu)" + vocab.LEGAL_SUFFIX_PATTERN, ""))
    core = F.array_join(
        F.filter(
            F.split(cleaned, " "), lambda t: ~fold_match(t).isin(*vocab.VARIANT_STOPWORDS)
        ),
        " ",
    )
    return F.filter(F.array_distinct(F.array(base, cleaned, core)), lambda v: v != "")


def cut(c: Column, limit: int | None) -> Column:
    """The first ``limit`` characters; everything by default."""
    return c if limit is None else F.substring(c, 1, limit)


def slug_dash(c: Column | str, max_len: int | None = None) -> Column:
    raw = text_or_blank(c)
    slug = F.trim(F.regexp_replace(F.lower(raw), "[^a-z0-9]+", "-"), F.lit("-"))
    return cut(F.when(slug == "", F.lit("unknown")).otherwise(slug), max_len)


def slug_path(c: Column | str, fallback: str = "ALL", max_len: int | None = None) -> Column:
    slug = F.trim(F.regexp_replace(F.trim(text_or_blank(c)), "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    return cut(F.when(slug == "", F.lit(fallback)).otherwise(slug), max_len)


# --- keywords -----------------------------------------------------------------

def dedupe_terms(terms: Sequence[str], folded: bool = False) -> list[str]:
    """Order-preserving, case-insensitive distinct list of configuration terms."""
    first: dict[str, str] = {}
    for term in terms:
        term = term.strip()
        key = fold_literal(term) if folded else term.lower()
        if key:
            first.setdefault(key, key if folded else term)
    return list(first.values())


def expand_terms(
    terms: Sequence[str], synonyms: Mapping[str, Sequence[str]] = vocab.SYNONYMS
) -> list[str]:
    """Each term followed by its synonyms, first spelling of a term wins."""
    flat: list[str] = []
    for term in terms:
        flat.append(term)
        flat.extend(synonyms.get(term.strip().lower(), ()))
    return dedupe_terms(flat)


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when any literal term occurs in ``text``; folding is up to the caller."""
    result = F.lit(False)
    for term in terms:
        result = result | text.contains(term)
    return result


def matched_terms(text: Column, terms: Sequence[str]) -> Column:
    """Sorted array of the terms whose lower form occurs in lower-case ``text``."""
    hits = [F.when(text.contains(t.lower()), F.lit(t)) for t in sorted(set(terms))]
    return F.array_compact(F.array(*hits))


def term_hits(text: Column, terms: Sequence[str]) -> Column:
    """Number of listed terms that occur in ``text``."""
    total = F.lit(0)
    for term in terms:
        total = total + text.contains(term).cast("int")
    return total


def literals_found(text: Column, literals: Sequence[str]) -> Column:
    """Those of many literals that occur in ``text``, as an array in their order; null has none.

    A batch of texts is passed once by an automaton of all literals. Only texts in which it finds one
    are passed again by automata of half of them, and so on, so the usual text costs one pass however
    many literals there are.
    """
    words = list(dict.fromkeys(w for w in literals if w))
    # half after half: bounds of the words and their automaton
    plan, todo = [], [(0, len(words))] if words else []
    while todo:
        low, high = todo.pop()
        plan.append((low, high, "|".join(re.escape(w) for w in words[low:high])))
        middle = (low + high) // 2
        todo += [(middle, high), (low, middle)] if high - low > 1 else []

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        out: list[list[str]] = [[] for _ in range(len(texts))]
        left = {(0, len(words)): (texts, pa.array(range(len(texts)), pa.int32()))}
        for low, high, pattern in plan:
            part, rows = left.pop((low, high))
            if len(part):
                hit = pc.fill_null(pc.match_substring_regex(part, pattern), False)
                part, rows = part.filter(hit), rows.filter(hit)
            if high - low == 1:
                for row in rows.to_pylist():
                    out[row].append(words[low])
            else:
                middle = (low + high) // 2
                left[low, middle] = left[middle, high] = part, rows
        return pa.array(out, pa.list_(pa.string()))

    return found(text)


def keyword_coverage(text: Column, terms: Sequence[str]) -> Column:
    """Share of distinct lower-case terms present, three decimals."""
    lowered = F.lower(text)
    hits = term_hits(lowered, [t.lower() for t in terms])
    return F.round(hits / F.lit(max(1, len({t.lower() for t in terms}))), 3)


def relevance_tier(hits: Column) -> Column:
    return (
        F.when(hits >= 3, 1.0).when(hits == 2, 0.85).when(hits == 1, 0.65).otherwise(0.0)
    )


# --- URLs ---------------------------------------------------------------------

def url_domain(c: Column | str) -> Column:
    """Lower-case host without ``www.``; a bare path's first segment when there is no host."""
    url = F.trim(text_or_blank(c))
    host = F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    bare = F.regexp_extract(url, r"^([^?#]*)", 1)
    chosen = F.lower(F.when(host != "", host).otherwise(bare))
    return F.element_at(F.split(F.regexp_replace(chosen, r"^www\.", ""), "/"), 1)


def canonical_url(
    c: Column | str, tracking: Sequence[str] = vocab.TRACKING_PARAMS
) -> Column:
    """Lower host, no trailing slash, no tracking parameters, no fragment."""
    url = text_or_blank(c)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_extract(rest, r"^([^#]*)", 1)
    address = F.regexp_extract(rest, r"^([^?]*)", 1)
    host = F.lower(F.regexp_extract(address, r"^([^/]*)", 1))
    path = F.regexp_extract(address, r"^[^/]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+$", "")
    query = F.when(rest.contains("?"), F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)).otherwise("")
    kept = F.filter(
        F.split(query, "&"),
        lambda p: (p != "")
        & ~F.lower(p).startswith("utm_")
        & ~F.element_at(F.split(F.lower(p), "="), 1).isin(*tracking),
    )
    kept = F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(scheme == "", F.concat(F.regexp_replace(address, r"/+$", ""), tail)).otherwise(
        F.concat(scheme, F.lit("://"), host, path, tail)
    )


def country_from_domain(
    domain: Column, suffixes: Sequence[tuple[str, str]] = vocab.DOMAIN_SUFFIX_COUNTRY
) -> Column:
    """Country of the longest listed suffix, null when none fits."""
    chain = F.lit(None).cast("string")
    for suffix, iso in sorted(suffixes, key=lambda item: len(item[0])):
        chain = F.when(domain.endswith(suffix), iso).otherwise(chain)
    return chain


def country_from_text(
    text: Column, markers: Mapping[str, Sequence[str]] = vocab.COUNTRY_TEXT_MARKERS
) -> Column:
    """First country in listed order with a marker inside the lower-case text."""
    lowered = F.lower(text)
    return F.coalesce(
        *[F.when(contains_any(lowered, words), F.lit(iso)) for iso, words in markers.items()]
    )


def lookup(c: Column, table: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Literal-map lookup kept inside the projection, so no join is planned."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), c)
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def country_to_iso2(c: Column, table: Mapping[str, str] = vocab.COUNTRY_TO_ISO2) -> Column:
    return lookup(F.lower(F.trim(text_or_blank(c))), table, "")


def country_inside_text(
    c: Column, table: Mapping[str, str] = vocab.COUNTRY_IN_TEXT_TO_ISO2
) -> Column:
    lowered = F.lower(F.trim(text_or_blank(c)))
    return F.coalesce(*[F.when(lowered.contains(name), F.lit(iso)) for name, iso in table.items()])


# --- industry labels ----------------------------------------------------------

def simplify_industry(c: Column, table: Mapping[str, str] = vocab.SIMPLE_INDUSTRY) -> Column:
    return lookup(c, table, c)


def clean_industry(c: Column) -> Column:
    trimmed = F.trim(text_or_blank(c))
    return F.when(trimmed == "", vocab.NO_INDUSTRY).otherwise(trimmed)


def align_industry(c: Column, table: Mapping[str, str] = vocab.SIMPLE_INDUSTRY) -> Column:
    return simplify_industry(clean_industry(c), table)


def industry_key(c: Column) -> Column:
    spaced = F.regexp_replace(F.lower(fold(c)), r"[&/\-,.·:;+]", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(spaced, r"\s+", " ")), " ", "_")


def industry_label(c: Column, table: Mapping[str, str] = vocab.INDUSTRY_LABELS) -> Column:
    """Display label of a slug or of an already friendly label; otherwise the value itself."""
    trimmed = F.trim(text_or_blank(c))
    known = dict(table)
    for label in list(table.values()) + [vocab.NO_INDUSTRY]:
        known[label_key(label)] = label
    return F.when(trimmed == "", vocab.NO_INDUSTRY).otherwise(
        F.coalesce(lookup(industry_key(trimmed), known), trimmed)
    )


def label_key(value: str) -> str:
    plain = fold_literal(value)
    return "_".join(re.sub(r"[&/\-,.·:;+]", " ", plain).split())


def _found(text: Column, pattern: str) -> Column:
    """Whether a pattern is found; alternatives without special characters are tested by containment."""
    parts = [pattern] if re.search(r"[()\\]|\[[^\]]*\|", pattern) else pattern.split("|")
    literal = [p for p in parts if re.fullmatch(r"[\w -]+", p)]
    rest = [p for p in parts if p not in literal]
    tests = [text.contains(p) for p in literal] + ([text.rlike("|".join(rest))] if rest else [])
    return reduce(lambda x, y: x | y, tests)


def first_match(
    text: Column, rules: Sequence[tuple[str, str]], default: str = ""
) -> Column:
    """Slug of the first rule whose pattern is found, as one generated CASE over a text made once."""

    def choose(t: Column) -> Column:
        arms = [F.when(_found(t, pattern), F.lit(slug)) for pattern, slug in rules]
        return F.coalesce(*arms, F.lit(default))

    return let(text, choose)


def sector_industry(c: Column) -> Column:
    """First-match sector rules with the ``other_services`` default."""
    lowered = F.lower(F.trim(text_or_blank(c)))
    return F.when(lowered == "", vocab.SECTOR_DEFAULT).otherwise(
        first_match(lowered, vocab.SECTOR_PATTERNS, vocab.SECTOR_DEFAULT)
    )


def sector_exact_industry(c: Column) -> Column:
    """Exact sector name first, then the ordered keyword fallbacks, else blank."""
    key = F.lower(F.trim(text_or_blank(c)))
    return F.coalesce(
        lookup(key, vocab.SECTOR_EXACT), first_match(key, vocab.SECTOR_KEYWORDS, "")
    )


def list_page_industry(c: Column) -> Column:
    """Industry guess for rows of company-list pages."""
    text = F.lower(text_or_blank(c))
    services = (
        F.when(text.rlike(vocab.LIST_PAGE_FINANCE), "finance_insurance")
        .when(text.rlike(vocab.LIST_PAGE_ICT), "ict_telecom")
        .otherwise("retail_consumer")
    )
    return F.coalesce(
        F.nullif(first_match(text, vocab.LIST_PAGE_PATTERNS, ""), F.lit("")),
        F.when(text.rlike(vocab.LIST_PAGE_SERVICES), services),
        first_match(text, [vocab.LIST_PAGE_LAST], ""),
    )


def repair_name(
    name: Column, context: Column, repairs: Sequence[tuple[str, str, str]] = vocab.NAME_REPAIRS
) -> Column:
    """Replace a mis-transcribed name only when the context carries the right form."""
    base, around = fold_words(name), fold_words(context)
    result = text_or_blank(name)
    for wrong, right, replacement in repairs:
        hit = base.contains(wrong) & ~base.contains(right) & around.contains(right)
        result = F.when(hit, F.lit(replacement)).otherwise(result)
    return result


# --- ids and numbers ----------------------------------------------------------

def clean_id(c: Column | str) -> Column:
    """Trimmed id text without a float-style ``.0`` ending."""
    return F.regexp_replace(F.trim(text_or_blank(c)), r"\.0$", "")


def numeric_id(c: Column | str) -> Column:
    return clean_id(c).try_cast("bigint")


def is_external(c: Column | str) -> Column:
    return numeric_id(c).isNull()


def hash_id(c: Column) -> Column:
    """Integer from the first fifteen hex digits of the SHA-1, as many as a long holds.

    Sixty bits: for use as a number only. Where rows are told apart by it, use the whole digest.
    """
    return F.conv(F.substring(F.sha1(c), 1, 15), 16, 10).cast("bigint")


def prefixed_hash_id(prefix: str, *parts: Column) -> Column:
    """The prefix and the whole SHA-1 of all parts."""
    joined = F.concat_ws("::", F.lit(prefix), *parts)
    return F.concat(F.lit(prefix + "-"), F.sha1(joined))


def parse_number(c: Column | str) -> Column:
    return F.regexp_replace(
        F.regexp_replace(text_or_blank(c), r"[^0-9.,\-]", ""), ",", ""
    ).try_cast("double")


def word_count(c: Column | str) -> Column:
    return F.regexp_count(text_or_blank(c), F.lit(r"(?U)\w+"))


def payload_key(*cols: Column) -> Column:
    """Hash of a canonical JSON rendering, used to reuse stored results."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)
