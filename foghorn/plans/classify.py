"""Industry classification by aliases, weighted patterns and tokens; reclassification."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn import vocab
from foghorn.functions import measures as mx, text as tx
from foghorn.operators.rows import keep_one
from foghorn.plans.events import union_events

CONTEXT_FIELDS = (
    "industry", "company_name", "display_name", "source_meta",
    "text_snippet", "title", "description", "url",
)
UNKNOWN = "unknown"

Aliases = Sequence[tuple[str, Sequence[str]]]
Patterns = Sequence[tuple[str, str, float]]


def _fields(df: DataFrame, fields: Sequence[str]) -> list[Column]:
    return [tx.text_or_blank(c) for c in fields if c in df.columns]


def _alternatives(pattern: str) -> list[str]:
    """Top-level alternatives of a pattern."""
    parts, depth = [""], 0
    for char in pattern:
        depth += (char in "([") - (char in ")]")
        if char == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return parts


def _quoted(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any_of(found: str, words: Sequence[str]) -> str:
    """Any of the words among those found."""
    return f"arrays_overlap({found}, array({', '.join(map(_quoted, words))}))"


def _spellings(part: str) -> list[str]:
    """The literals that an alternative stands for; none if it is more than optional parts and classes of letters."""
    option = re.search(r"\(([a-z0-9 -]+)\)\?|([a-z0-9 -])\?|\[([a-záéíóúüñ0-9]+)\]", part)
    if option is None:
        return [part] if re.fullmatch(r"[a-z0-9áéíóúüñ -]+", part) else []
    choices = option.group(3) or ["", option.group(1) or option.group(2)]
    spelled = [_spellings(part[: option.start()] + c + part[option.end() :]) for c in choices]
    return sum(spelled, []) if all(spelled) else []


def _literals(pattern: str) -> list[str]:
    return [word for part in _alternatives(pattern) for word in _spellings(part)]


def _search(field: str, pattern: str, found: str | None = None) -> str:
    """Pattern found in lower-case text; literal alternatives are tested by containment.

    ``found`` names an array of the :func:`_literals` of all patterns that the text contains.
    """
    tests = []
    for part in _alternatives(pattern):
        words = _spellings(part)
        if not words:
            flags = "" if part == part.lower() else "(?iu)"
            tests.append(f"rlike({field}, {_quoted(flags + part)})")
        elif found is None:
            tests += [f"contains({field}, {_quoted(w)})" for w in words]
    if found is not None and _literals(pattern):
        tests.insert(0, _any_of(found, _literals(pattern)))
    return "(" + " OR ".join(tests) + ")"


def _searches(pattern: str) -> list[tuple[str, str]]:
    """Texts and patterns of which one has to be found for ``pattern`` to be in ``t.lower`` or ``t.folded``.

    A class that offers a letter with and without its accent is the plain letter
    in folded text. What then is plain ASCII matches the folded text whenever it
    matches the text; anything else is looked for in both.
    """
    simple = re.sub(
        r"\[([a-z])(\w)\]",
        lambda m: m.group(1) if tx.fold_literal(m.group(2)) == m.group(1) else m.group(0),
        pattern,
    )
    if simple.isascii() and not re.search(r"\[\^|\(\?|\\", simple):
        return [("folded", simple)]
    return [("folded", pattern), ("lower", pattern)]


def _pattern_hit(pattern: str) -> str:
    """Pattern found in ``t.lower`` or in its accent-free form ``t.folded``."""
    return "(" + " OR ".join(_search(f"t.{text}", p, f"_found.{text}") for text, p in _searches(pattern)) + ")"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def classify(
    df: DataFrame,
    fields: Sequence[str] = CONTEXT_FIELDS,
    aliases: Aliases = tuple(vocab.INDUSTRY_ALIASES),
    patterns: Patterns = tuple(vocab.INDUSTRY_PATTERNS),
    tokens: Sequence[tuple[str, str]] = tuple(vocab.INDUSTRY_TOKENS),
    sector_hints: Sequence[tuple[str, str]] = tuple(vocab.SECTOR_HINTS),
    accept: float = vocab.CLASSIFY_ACCEPT,
) -> DataFrame:
    """Add ``class_slug``, ``class_reason``, ``class_score`` and ``sector_hint``.

    1. the first alias (in listed order) found in any folded field decides;
    2. else pattern weights are summed per slug, a sector hint in
       ``source_meta`` adds 1.5, and the best slug wins from ``accept`` on, ties
       going to the slug that scored first in listed order;
    3. else the first listed token found; else ``unknown``.

    One projection over the row: no join and no shuffle. The literals of a text are
    looked up all at once (:func:`tx.literals_found`); what remains of the patterns
    is tested once per row, and only if no alias was found.
    """
    present = F.filter(F.array(*_fields(df, fields)), lambda f: f != "")
    fragments = F.transform(present, lambda f: tx.fragment(f))
    meta = tx.fragment("source_meta") if "source_meta" in df.columns else F.lit("")
    combined = F.lower(F.array_join(present, " "))
    texts = F.struct(
        combined.alias("lower"),
        tx.let(combined, tx.fold).alias("folded"),
        fragments.alias("frags"),
        F.coalesce(
            *[F.when(meta.contains(hint), F.lit(slug)) for hint, slug in sector_hints],
            F.lit(None).cast("string"),
        ).alias("hint"),
    )
    searched = [pair for pattern, _, _ in patterns for pair in _searches(pattern)]
    literals = {text: [w for t, p in searched if t == text for w in _literals(p)] for text in ("lower", "folded")}
    # fields are kept apart by a character that no fragment can contain; tokens may span fields
    frags = F.col("_texts.frags")
    named = [_fragment_literal(w) for _, words in aliases for w in words]
    found = {text: tx.literals_found(F.col(f"_texts.{text}"), words) for text, words in literals.items() if words}
    found["frags"] = tx.literals_found(F.array_join(frags, "\n"), named)
    found["whole"] = tx.literals_found(F.array_join(F.filter(frags, lambda f: f != ""), " "), [t for t, _ in tokens])
    return (
        df.withColumn("_texts", texts)
        .withColumn("_found", F.struct(*[words.alias(text) for text, words in found.items()]))
        .withColumn("_class", F.expr(_class_sql(aliases, patterns, tokens, sector_hints, accept)))
        .select(
            *df.columns,
            F.col("_class.slug").alias("class_slug"),
            F.col("_class.reason").alias("class_reason"),
            F.col("_class.score").alias("class_score"),
            F.col("_class.hint").alias("sector_hint"),
        )
    )


def _class_sql(
    aliases: Aliases,
    patterns: Patterns,
    tokens: Sequence[tuple[str, str]],
    sector_hints: Sequence[tuple[str, str]],
    accept: float,
) -> str:
    """The classification of the struct columns ``_texts`` and ``_found`` as one SQL expression."""

    def outcome(slug: str, reason: str, score: str, hint: str) -> str:
        return (
            f"named_struct('slug', {slug}, 'reason', '{reason}', "
            f"'score', CAST({score} AS DOUBLE), 'hint', CAST({hint} AS STRING))"
        )

    # 3. tokens, over the fragments of all fields
    first_token = " ".join(f"WHEN {_any_of('_found.whole', [t])} THEN {_quoted(s)}" for t, s in tokens)
    token = f"CASE {first_token} END" if tokens else "CAST(NULL AS STRING)"
    by_token = _let(
        "k",
        token,
        f"CASE WHEN k IS NOT NULL THEN {outcome('k', 'token', 'NULL', 't.hint')} "
        f"ELSE {outcome(_quoted(UNKNOWN), UNKNOWN, '0', 't.hint')} END",
    )

    # 2. weighted patterns: the hits are computed once and then only looked up
    owned: dict[str, list[int]] = {
        slug: [] for slug in [p[1] for p in patterns] + [s for _, s in sector_hints]
    }
    for position, (_, slug, _) in enumerate(patterns):
        owned[slug].append(position)
    options = []
    for slug, positions in owned.items():
        score = [f"IF(t.hint = {_quoted(slug)}, {float(vocab.SECTOR_HINT_BONUS)}D, 0D)"]
        score += [f"IF(h[{i}], {float(patterns[i][2])}D, 0D)" for i in positions]
        first = " ".join(f"WHEN h[{i}] THEN {-i}" for i in positions)
        order = f"CASE {first} ELSE {-len(patterns)} END" if positions else f"{-len(patterns)}"
        options.append(
            f"named_struct('score', {' + '.join(score)}, 'order', {order}, 'slug', {_quoted(slug)})"
        )
    hits = "array(" + ", ".join(_pattern_hit(pattern) for pattern, _, _ in patterns) + ")"
    best = _let("h", hits, f"array_max(array({', '.join(options)}))")
    by_weight = _let(
        "b",
        best,
        f"CASE WHEN b.score >= {float(accept)}D "
        f"THEN {outcome('b.slug', 'weighted', 'round(b.score, 3)', 't.hint')} ELSE {by_token} END",
    ) if patterns else by_token

    # 1. aliases in listed order
    arms = " ".join(
        f"WHEN {_any_of('_found.frags', tx.dedupe_terms([_fragment_literal(w) for w in words]))} THEN {_quoted(slug)}"
        for slug, words in aliases
    )
    alias = f"CASE {arms} END" if arms else "CAST(NULL AS STRING)"
    by_alias = _let(
        "a",
        alias,
        f"CASE WHEN a IS NOT NULL THEN {outcome('a', 'alias', 'NULL', 'NULL')} ELSE {by_weight} END",
    )
    return _let("t", "_texts", by_alias)


def combine_signals(frames: Sequence[DataFrame], **tables) -> DataFrame:
    """Union of signal sources as canonical events with their industry normalised.

    Each distinct industry text is classified once and joined back.
    """
    merged = union_events(frames)
    slugs = classify(merged.select("industry").distinct(), fields=("industry",), **tables)
    joined = merged.join(slugs.select("industry", "class_slug"), "industry")
    return joined.withColumn("industry", F.col("class_slug")).select(*merged.columns)


def _fragment_literal(value: str) -> str:
    return re.sub(r"[^a-z0-9&/\\]+", " ", tx.fold_literal(value)).strip()


def sector_label(source_meta: Column) -> Column:
    """The text after ``sector:`` up to the next separator, blank when absent."""
    return F.trim(F.regexp_extract(tx.text_or_blank(source_meta), r"(?i)sector\s*:\s*([^;|,]+)", 1))


def reclassify(df: DataFrame, fix_names: bool = False, **tables) -> DataFrame:
    """Apply alias and weighted classifications to ``industry``.

    Token classifications are counted but not applied. Adds ``old_industry``,
    ``new_slug``, ``change_reason`` (null when nothing changed) and the
    classification columns; with ``fix_names`` names are repaired as well.
    """
    out = classify(df, **tables)
    old = F.col("industry")
    target = tx.simplify_industry(F.col("class_slug"))
    applies = F.col("class_reason").isin("alias", "weighted") & ~target.eqNullSafe(old)
    out = out.withColumns(
        {
            "old_industry": old,
            "new_slug": target,
            "change_reason": F.when(applies, F.col("class_reason")),
        }
    ).withColumn("industry", F.when(applies, target).otherwise(old))
    if fix_names:
        context = F.concat_ws(
            " ", *[F.col(c) for c in ("text_snippet", "title", "description", "url") if c in df.columns]
        )
        out = out.withColumn("company_name", tx.repair_name(F.col("company_name"), context))
    return out


def change_log(reclassified: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """One row per applied change."""
    entity = F.coalesce(
        *[F.nullif(F.col(c).cast("string"), F.lit("")) for c in id_columns if c in reclassified.columns]
    )
    return reclassified.filter("change_reason IS NOT NULL").select(
        entity.alias("entity_id"),
        "old_industry",
        F.col("industry").alias("new_industry"),
        F.col("change_reason").alias("reason"),
        F.col("class_score").alias("score"),
        "sector_hint",
    )


def change_counts(reclassified: DataFrame) -> DataFrame:
    """Scanned rows, applied changes by reason, token hits and unknowns, in one pass."""
    return reclassified.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("change_reason") == "alias").alias("alias_changes"),
        F.count_if(F.col("change_reason") == "weighted").alias("weighted_changes"),
        F.count_if(F.col("class_reason") == "token").alias("token_hits"),
        F.count_if(F.col("new_slug") == UNKNOWN).alias("unknown_hits"),
    )


def confusion(df: DataFrame, old: str, new: str) -> DataFrame:
    return (
        df.groupBy(F.col(old).alias("old_industry"), F.col(new).alias("new_industry"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "old_industry", "new_industry")
    )


# --- rule scorer --------------------------------------------------------------

def _best_rule_sql(text: str, patterns: Patterns, found: str | None = None) -> str:
    """``(score, order, slug)`` with the largest summed weight over lower-case ``text``.

    The alphabetically first slug wins a tie. ``found`` is that of :func:`_search`.
    """
    options = []
    for i, slug in enumerate(sorted({p[1] for p in patterns})):
        score = " + ".join(
            f"IF({_search(text, pattern, found)}, {float(weight)}D, 0D)"
            for pattern, owner, weight in patterns
            if owner == slug
        )
        options.append(f"named_struct('score', {score}, 'order', {-i}, 'slug', {_quoted(slug)})")
    return f"array_max(array({', '.join(options)}))"


def rule_classify(
    df: DataFrame,
    texts: Sequence[str],
    patterns: Patterns = tuple(vocab.INDUSTRY_PATTERNS),
    unknown_label: str = "professional_services_consulting",
    alphabetical_default: bool = False,
) -> DataFrame:
    """Add ``rule_slug``, ``rule_score`` and ``rule_confidence``.

    A row without any hit gets ``unknown_label``; with ``alphabetical_default``
    a row that has text but no hit gets the alphabetically first slug instead.
    """
    corpus = F.lower(
        F.array_join(F.filter(F.array(*[tx.collapse_ws(c) for c in texts]), lambda t: t != ""), " \n ")
    )
    missing = _quoted(unknown_label)
    if alphabetical_default:
        missing = f"IF(c = '', {missing}, {_quoted(min(p[1] for p in patterns))})"
    ruled = _let(
        "c",
        "_corpus",
        _let(
            "b",
            _best_rule_sql("c", patterns, "_found"),
            f"named_struct('slug', IF(b.score > 0, b.slug, {missing}), 'score', b.score)",
        ),
    )
    found = tx.literals_found(F.col("_corpus"), [w for pattern, _, _ in patterns for w in _literals(pattern)])
    return df.withColumn("_corpus", corpus).withColumn("_found", found).withColumn("_rule", F.expr(ruled)).select(
        *df.columns,
        F.col("_rule.slug").alias("rule_slug"),
        F.col("_rule.score").alias("rule_score"),
        mx.rule_confidence(F.col("_rule.score")).alias("rule_confidence"),
    )


def rule_description(
    source: Column, sector: Column, industry: Column, description: Column, snippet: Column, slug: Column,
    limit: int | None = None,
) -> Column:
    """Joined ``key: value`` parts, cut to ``limit`` characters if given, or a fixed sentence when all are blank."""
    def part(key: str, value: Column) -> Column:
        text = F.trim(tx.text_or_blank(value))
        return F.when(text != "", F.concat(F.lit(f"{key}: "), F.regexp_replace(text, "\n", " ")))

    joined = F.concat_ws(
        " | ",
        F.when(tx.text_or_blank(source) != "", F.concat(F.lit("Source="), source)),
        part("sector", sector),
        part("industry", industry),
        part("description", description),
        part("text_snippet", snippet),
    )
    fallback = F.concat(F.lit("Classified as "), slug, F.lit(" using fallback patterns."))
    return F.when(joined == "", fallback).otherwise(tx.cut(joined, limit))


# --- stored responses ---------------------------------------------------------

RESPONSE_SCHEMA = "industry_slug string, confidence double, description string"


def parse_stored_responses(
    df: DataFrame, content: str, known: Sequence[str], patterns: Patterns = tuple(vocab.INDUSTRY_PATTERNS)
) -> DataFrame:
    """Read the outermost ``{...}`` block of a stored response and repair its label.

    A label outside ``known`` is scored with the rule patterns; unreadable
    responses give null.
    """
    block = F.regexp_extract(tx.text_or_blank(content), r"(?s)\{.*\}", 0)
    parsed = df.withColumn("_r", F.from_json(F.nullif(block, F.lit("")), RESPONSE_SCHEMA))
    slug = tx.text_or_blank("_r.industry_slug")
    parsed = parsed.withColumn("_s", F.lower(F.trim(slug)))
    best = F.expr(_let("c", "_s", _best_rule_sql("c", patterns)))
    repaired = F.when(slug.isin(*known) | (slug == ""), slug).otherwise(best["slug"])
    return parsed.select(
        *df.columns,
        F.when(F.col("_r").isNotNull(), repaired).alias("industry_slug"),
        F.coalesce(F.col("_r.confidence"), F.when(F.col("_r").isNotNull(), 0.6)).alias("confidence"),
        F.col("_r.description").alias("response_description"),
    )


def newest_answers(stored: DataFrame, version: str | None = None) -> DataFrame:
    """One stored answer per ``payload_key``: the newest by ``version``, ties by the row's content."""
    rest = [c for c in stored.columns if c not in ("payload_key", version)]
    order = [F.col(c).desc() for c in ([version] if version else []) + rest]
    return keep_one(stored, ["payload_key"], order or [F.lit(0).asc()])


def reuse_stored(
    df: DataFrame, key_columns: Sequence[str], stored: DataFrame, version: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into those with a stored result (joined) and those still to do.

    A payload that was answered more than once takes the newest answer, so no row is repeated.
    """
    keyed = df.withColumn("payload_key", tx.payload_key(*[F.col(c) for c in key_columns]))
    answers = newest_answers(stored, version)
    done = keyed.join(answers, "payload_key")
    todo = keyed.join(stored.select("payload_key"), "payload_key", "left_anti")
    return done, todo


# --- classification context ---------------------------------------------------

def context_fields(df: DataFrame) -> DataFrame:
    """Add ``context`` (map of the non-blank context columns under both names) and ``hints``."""
    names = {
        "context_sector": "sector",
        "context_type": "type",
        "context_description": "description",
        "context_extra": "text_snippet",
    }
    entries = []
    for column, alias in names.items():
        value = F.trim(tx.text_or_blank(column)) if column in df.columns else F.lit("")
        entries += [F.lit(column), value, F.lit(alias), value]
    context = F.map_filter(F.create_map(*entries), lambda _k, v: v != "")
    snippet = F.coalesce(
        F.try_element_at(context, F.lit("text_snippet")), tx.text_or_blank("text_snippet")
    )
    context = F.map_concat(
        F.map_filter(context, lambda k, _v: k != "text_snippet"),
        F.create_map(F.lit("text_snippet"), snippet),
    )
    hint_columns = [c for c in ("industry", "event_industry", "context_sector", "matched_industry") if c in df.columns]
    hints = F.filter(F.array(*[tx.text_or_blank(c) for c in hint_columns]), lambda h: h != "")
    return df.withColumn("context", context).withColumn("hints", hints)


def overlay_classification(
    df: DataFrame, slug: str = "rule_slug", described: str = "rule_description"
) -> DataFrame:
    """Classification over the event: slug replaces industry, description with fallbacks."""
    text = F.coalesce(
        F.nullif(F.trim(tx.text_or_blank(described)), F.lit("")),
        F.nullif(F.try_element_at(F.col("context"), F.lit("description")), F.lit("")),
        F.try_element_at(F.col("context"), F.lit("text_snippet")),
        F.lit(""),
    )
    return df.withColumns(
        {
            "industry": F.coalesce(F.nullif(F.col(slug), F.lit("")), F.col("industry")),
            "description": tx.collapse_ws(text),
        }
    )
