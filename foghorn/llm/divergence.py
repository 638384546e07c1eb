"""Quality rules: divergence of a document's histograms from those of its language.

Two histograms describe a text: of character classes, and of the commonest words of the languages
known here with one bin for all other words. A reference is the sum of these histograms over all
documents of a language that pass the base rules and are mostly letters. A document is kept if it passes the base rules
and its Jensen-Shannon distance to the closest reference is within the limits; below a minimum
length a histogram says too little and its limit does not apply. Words of a stated language that has no
reference are not judged by the word histogram, which would find none of the common words in an ordinary
text of it; its characters are. A text without any common word is at
distance 0.362 to 0.369 from the references of sf0.1 (24 to 25 % common words); the limit has to be below that,
or the word histogram rejects nothing.

Everything is a column expression over one row; references are sums by language, a row per language
known here at most, and enter the verdict as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.functions.text import let
from foghorn.llm.common import text_of
from foghorn.session import materialise

# Very frequent words by language, in lower case.
COMMON_WORDS = {
    "de": "der die und das in den von zu mit ist des im für auf nicht ein eine sich dem auch es an als",
    "en": "the of and to in is a that it was for with as on be at by this are from or an not which",
    "es": "de la que el en y los se del las un por con una su para es al lo como no",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas plus au avec",
}
LANGUAGES = sorted(COMMON_WORDS)
WORDS = sorted({w for text in COMMON_WORDS.values() for w in text.split()})

# Classes of characters; all others, mostly small letters, are a class of their own.
CLASSES = {
    "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0": "0123456789",
    " ": " \t\n\x0b\x0c\r",
    ".": ".,;:!?'\"()-",
    "#": "#*$%&|<>",
    "^": "@^~_=+\\/[]{}`",
}

PER_WORD = 3  # words in a window whose repetition counts


@dataclass(frozen=True)
class Rules:
    """Base rules, and for each histogram the largest distance and the length from which it counts."""

    min_words: int = 50
    repeat_percent: int = 50
    max_class_distance: float = 0.2
    min_chars: int = 200
    max_word_distance: float = 0.34
    min_common: int = 100


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text, the first included.

    Windows are compared by 64 bits of hash, within one text only.
    """

    def windows(w: Column) -> Column:
        n = F.size(w) - PER_WORD + 1
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def covered(placed: Column) -> Column:
        n = F.size(placed)
        again = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda k: ((k > 0) & (placed[F.greatest(k - 1, F.lit(0))]["w"] == placed[k]["w"]))
            | ((k < n - 1) & (placed[F.least(k + 1, n - 1)]["w"] == placed[k]["w"])),
        )
        at = F.transform(again, lambda k: placed[k]["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def count(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        distinct = F.size(F.array_distinct(found))  # most texts repeat nothing
        return F.when(distinct == F.size(found), F.lit(0)).otherwise(let(placed, covered))

    return F.when(F.size(words) < PER_WORD, F.lit(0)).otherwise(let(let(words, windows), count))


def features(text: Column) -> Column:
    """One struct with the base counts and the two histograms of a text."""
    marks = "".join(CLASSES.values())
    to = "".join(c * len(members) for c, members in CLASSES.items())
    letters = [chr(0x2460 + i) for i in range(len(WORDS))]  # one character per common word

    def of_words(words: Column, classes: Column) -> Column:
        hits = F.transform(F.filter(words, lambda w: F.lower(w).isin(WORDS)), F.lower)
        order = F.array(*[F.lit(w) for w in WORDS])
        symbols = F.array(*[F.lit(c) for c in letters])
        spelt = F.array_join(F.transform(hits, lambda w: symbols[F.array_position(order, w).cast("int") - 1]), "")
        counts = let(
            spelt,
            lambda s: F.transform(symbols, lambda c: F.length(s) - F.length(F.replace(s, c, F.lit("")))),
        )
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            let(classes, lambda c: F.length(c) - _count(c, " ")).cast("bigint").alias("word_chars"),
            let(classes, lambda c: _count(c, "#")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).cast("bigint").alias("n_repeat_words"),
            let(classes, _class_counts).alias("class_counts"),
            counts.alias("word_counts"),
        )

    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    classes = F.translate(text, marks, to)
    return let(words, lambda w: of_words(w, classes))


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _class_counts(classes: Column) -> Column:
    counts = [_count(classes, c) for c in CLASSES]
    return let(
        F.array(*counts),
        lambda found: F.concat(found, F.array(F.length(classes) - F.aggregate(found, F.lit(0), lambda a, b: a + b))),
    )


def base_failed(f: Column, rules: Rules) -> Column:
    return (f["n_words"] < rules.min_words) | (
        f["n_repeat_words"] * 100 > f["n_words"] * rules.repeat_percent
    )


def speaks_for_language(f: Column, rules: Rules) -> Column:
    """Whether a document may shape a reference: it passes the base rules and is mostly plain letters."""
    chars = F.aggregate(f["class_counts"], F.lit(0), lambda a, b: a + b)
    upper = f["class_counts"][list(CLASSES).index("A")]
    return ~base_failed(f, rules) & (f["n_symbols"] * 100 <= chars) & (upper * 5 <= chars)


def references(rows: DataFrame, rules: Rules) -> list[tuple[str, list[float], list[float]]]:
    """(language, class shares, word shares) over all rows with a known ``lang`` that speak for it.

    ``rows`` has ``lang`` and the struct ``f``. Sums are combined before the shuffle; one row per
    language of this module comes back, whatever the size of the input.
    """
    known = rows.filter(F.col("lang").isin(LANGUAGES) & speaks_for_language(F.col("f"), rules))
    sums = [F.sum(F.col("f.class_counts")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    sums += [F.sum(F.col("f.word_counts")[i]).alias(f"w{i}") for i in range(len(WORDS))]
    found = known.groupBy("lang").agg(F.sum("f.n_words").alias("n"), *sums).collect()
    out = []
    for row in sorted(found, key=lambda r: r["lang"]):
        classes = [row[f"c{i}"] for i in range(len(CLASSES) + 1)]
        words = [row[f"w{i}"] for i in range(len(WORDS))]
        words.append(row["n"] - sum(words))
        out.append((row["lang"], [c / sum(classes) for c in classes], [w / row["n"] for w in words]))
    return out


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance, base 2, of a histogram of shares from a fixed one; 0 to 1."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, F.array(*[F.lit(x) for x in q]), lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    return F.round(F.sqrt(F.greatest(total / 2, F.lit(0.0))), 6)


def verdict(
    f: Column, lang: Column, known: list[tuple[str, list[float], list[float]]], rules: Rules
) -> Column:
    """Struct of the two distances and ``kept``, from the struct of ``features`` and the language."""
    if not known:  # nothing to compare with
        nothing = F.lit(None).cast("double")
        return F.struct(nothing.alias("class_distance"), nothing.alias("word_distance"), (~base_failed(f, rules)).alias("kept"))
    chars = F.aggregate(f["class_counts"], F.lit(0), lambda a, b: a + b)
    share = lambda counts, n: F.transform(counts, lambda c: c / F.greatest(n, F.lit(1)))
    rest = f["n_words"].cast("int") - F.aggregate(f["word_counts"], F.lit(0), lambda a, b: a + b)
    classes = let(share(f["class_counts"], chars), lambda p: _least(p, [c for _, c, _ in known]))
    words = share(F.concat(f["word_counts"], F.array(rest)), f["n_words"])
    words = let(words, lambda p: _least(p, [w for _, _, w in known]))

    def judged(d: Column) -> Column:
        odd = (chars >= rules.min_chars) & (d["class_distance"] > rules.max_class_distance)
        judged_words = lang.isNull() | lang.isin([name for name, _, _ in known])
        odd |= judged_words & (f["n_words"] >= rules.min_common) & (d["word_distance"] > rules.max_word_distance)
        return F.struct(
            d["class_distance"].alias("class_distance"),
            d["word_distance"].alias("word_distance"),
            (~base_failed(f, rules) & ~odd).alias("kept"),
        )

    return let(F.struct(classes.alias("class_distance"), words.alias("word_distance")), judged)


def _least(p: Column, references: list[list[float]]) -> Column:
    distances = [js_distance(p, q) for q in references]
    return distances[0] if len(distances) == 1 else F.least(*distances)


def judge_documents(
    docs: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, both distances and kept.

    The text is read once: its counts, a few hundred bytes, are checkpointed and then judged. A null
    text has no words and fails the base rules; so do empty and very short ones. A text of any known
    language, or of none (null), is compared with the closest reference; one of a language without a
    reference by its characters only. Repeated rows are judged alike, and so are texts of any length, whole;
    of references at one distance it does not matter which is closest. An empty table gives no rows;
    other columns are dropped.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), features(text_of(text_col)).alias("f")
    )
    rows = materialise(rows)
    known = references(rows, rules)
    out = rows.select("doc_id", "f", verdict(F.col("f"), F.col("lang"), known, rules).alias("v"))
    return out.select(
        "doc_id",
        *[f"f.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(F.col("f"), rules).alias("base_failed"),
        "v.class_distance",
        "v.word_distance",
        "v.kept",
    )


def keep_regular(
    docs: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Counts are computed once and checkpointed; the verdicts on them pick rows by id and text digest,
    on which equal rows agree.
    """
    sha = F.sha2(text_of(text_col).cast("binary"), 256)
    rows = materialise(
        docs.select(
            F.col(id_col).alias("_kept_id"),
            sha.alias("_kept_sha"),
            F.col(lang_col).alias("lang"),
            features(text_of(text_col)).alias("f"),
        )
    )
    known = references(rows, rules)
    kept = rows.filter(verdict(F.col("f"), F.col("lang"), known, rules)["kept"]).select("_kept_id", "_kept_sha").distinct()
    data = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), sha.alias("_sha")
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha"))
    return data.join(kept, same, "left_semi").select("_row.*")


def judge_sql(rules: Rules = Rules()) -> str:
    """The whole judgement of ``documents`` in DuckDB."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    chars = {c: spaces if c == " " else quote(members) for c, members in CLASSES.items()}
    counts = [f"length(t) - length(translate(t, {members}, ''))" for members in chars.values()]
    names = "[" + ", ".join(quote(w) for w in WORDS) + "]"
    symbols, upper = list(CLASSES).index("#") + 1, list(CLASSES).index("A") + 1
    n_classes, n_words = len(CLASSES) + 1, len(WORDS) + 1

    def distance(p: str, q: str, n: int) -> str:
        part = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2({a} * 2 / ({a} + {b})) ELSE 0 END"
        terms = f"{part(f'{p}[i]', f'{q}[i]')} + {part(f'{q}[i]', f'{p}[i]')}"
        return f"round(sqrt(greatest(list_sum(list_transform(range(1, {n + 1}), lambda i: {terms})) / 2, 0)), 6)"

    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls,
         [{", ".join(counts)}] AS part FROM d
), low AS (
  SELECT *, list_transform(ws, lambda x: lower(x)) AS lw FROM split
), shingles AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM split WHERE len(ws) >= 3
), placed AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM shingles
), repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM placed WHERE n > 1) GROUP BY doc_id
), f AS (
  SELECT s.doc_id, lang, len(ws) AS n_words, length(t) - part[3] AS word_chars, part[{symbols}] AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         length(t) AS chars, list_append(part, length(t) - list_sum(part)::BIGINT) AS cc,
         list_transform({names}, lambda c: len(list_filter(lw, lambda y: y = c))) AS wc
  FROM low s LEFT JOIN repeats r USING (doc_id)
), g AS (
  SELECT *, n_words < {rules.min_words} OR n_repeat_words * 100 > n_words * {rules.repeat_percent} AS base_failed,
         list_append(wc, n_words - list_sum(wc)::BIGINT) AS wa FROM f
), speaking AS (
  SELECT * FROM g WHERE lang IN ({", ".join(map(quote, LANGUAGES))}) AND NOT base_failed
    AND n_symbols * 100 <= chars AND cc[{upper}] * 5 <= chars
), refs AS (
  SELECT lang,
         [{", ".join(f"sum(cc[{i}])::DOUBLE / sum(chars)::DOUBLE" for i in range(1, n_classes + 1))}] AS rc,
         [{", ".join(f"sum(wa[{i}])::DOUBLE / sum(n_words)::DOUBLE" for i in range(1, n_words + 1))}] AS rw
  FROM speaking GROUP BY lang
), shares AS (
  SELECT *, list_transform(cc, lambda x: x::DOUBLE / greatest(chars, 1)) AS pc,
         list_transform(wa, lambda x: x::DOUBLE / greatest(n_words, 1)) AS pw FROM g
), near AS (
  SELECT s.doc_id, min({distance("pc", "rc", n_classes)}) AS dc,
         CASE WHEN any_value(s.lang) IS NULL OR bool_or(s.lang = refs.lang) THEN min({distance("pw", "rw", n_words)}) END AS dw
  FROM shares s, refs GROUP BY s.doc_id
)
SELECT g.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (chars >= {rules.min_chars} AND coalesce(dc > {rules.max_class_distance}, false))
       AND NOT (n_words >= {rules.min_common} AND coalesce(dw > {rules.max_word_distance}, false)) AS kept
FROM g LEFT JOIN near USING (doc_id)"""
