"""Which registry names occur inside which texts, by equi-joins on word runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.functions import text as tx
from foghorn.session import BROADCAST_BYTE_LIMIT, BROADCAST_ROW_LIMIT

# Interior words used as the join key of long names.
ANCHOR_WORDS = 8


def word_runs(words: Column, length: Column) -> Column:
    """Runs of ``length`` consecutive words, joined by one space."""
    starts = F.when(
        F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - length + 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, length), " "))


def mention_join(
    items: DataFrame,
    item_id: str,
    text: str,
    registry: DataFrame,
    alias_id: str,
    alias: str,
    folded: bool = False,
    whole_words: bool = False,
) -> DataFrame:
    """``(item_id, alias_id)`` for every registry name found in an item's text.

    Case is ignored and whitespace runs count as one space; ``folded`` also
    drops accents. With ``whole_words`` a name must start and end at word
    boundaries (spaces); otherwise any substring counts.

    Interior words of a name stand as whole words; its first word may begin, and
    its last may end, inside a word. So a long name is joined on its interior
    words together with its first and last word: the word before the run must end
    with the first, the word after it begin with the last. A name such as
    "X de Y" is thus met by texts that hold X and Y around "de", not by every
    text with "de". One- and two-word names are resolved once per distinct word
    or word pair of the corpus and joined back. A hit of a long name is
    confirmed in the text. No item is compared with every name.
    """
    shape = tx.fold_match if folded else (lambda c: F.lower(tx.collapse_ws(c)))
    # an empty text stays: a filter on the shaped text would shape it twice
    texts = items.filter(F.col(text).isNotNull()).select(F.col(item_id), shape(F.col(text)).alias("_text"))
    texts = texts.withColumn("_words", F.split("_text", " "))
    names = registry.select(F.col(alias_id), shape(F.col(alias)).alias("_name"))
    names = names.filter("_name <> ''")
    # equal spellings are matched once and expanded back to their ids at the end
    spellings = names.select("_name").distinct().withColumn("_nw", F.split("_name", " "))
    # one look at the registry: a small one travels to the texts instead of the
    # word runs being shuffled, and name lengths that do not occur are not searched
    words = F.size("_nw")
    sizes = spellings.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(words == 1).alias("one"),
        F.count_if(words == 2).alias("two"),
        F.sort_array(F.collect_set(F.when(words >= 3, _inner_words()))).alias("inner"),
        F.sum(F.octet_length("_name")).alias("bytes"),
        F.max(F.array_max(F.transform("_nw", F.length))).alias("longest"),
    ).first()
    travels = sizes["all"] <= BROADCAST_ROW_LIMIT and (sizes["bytes"] or 0) <= BROADCAST_BYTE_LIMIT
    if travels:
        spellings = F.broadcast(spellings)
    longest = sizes["longest"] or 0

    if whole_words:
        found = _whole_word_hits(texts, item_id, spellings)
    else:
        parts = []
        if sizes["inner"]:
            if travels:
                # no run is shuffled, so a text goes along with its runs and is read once
                keyed = _long_candidates(texts, item_id, spellings, sizes["inner"], longest, ["_text"])
            else:
                keyed = _long_candidates(texts, item_id, spellings, sizes["inner"], longest).distinct()
                keyed = keyed.join(texts.select(item_id, "_text"), item_id)
            parts.append(keyed.filter(F.col("_text").contains(F.col("_name"))).select(item_id, "_name"))
        if sizes["one"]:
            parts.append(_one_word_hits(texts, item_id, spellings))
        if sizes["two"] or not parts:
            parts.append(_two_word_hits(texts, item_id, spellings, longest))
        found = reduce(DataFrame.unionByName, parts)
    return found.distinct().join(names, "_name").select(item_id, alias_id).distinct()


def _whole_word_hits(texts: DataFrame, item_id: str, spellings: DataFrame) -> DataFrame:
    lengths = spellings.select(F.size("_nw").alias("_len")).distinct()
    sizes = lengths.agg(F.sort_array(F.collect_set("_len")).alias("_lens"))
    runs = (
        texts.withColumn("_len", F.explode(sizes.scalar()))
        .select(item_id, F.explode(word_runs(F.col("_words"), F.col("_len"))).alias("_name"))
    )
    return runs.join(spellings.select("_name"), "_name").select(item_id, "_name")


def _inner_words() -> Column:
    """How many interior words of a long name are keyed."""
    return F.least(F.size("_nw") - 2, F.lit(ANCHOR_WORDS))


def _framed_runs(texts: DataFrame, kept: list[str], lengths: list[int]) -> DataFrame:
    """Runs of words of these lengths, hashed, with the word before and the word after.

    A row per place first, then expressions on it: a higher-order function would be interpreted, and the rows
    of a place would be written out before the join that drops nearly all of them.
    """
    last = F.size("_words") - min(lengths) - 2
    places = texts.select(*kept, "_words", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_at"))
    word = lambda k: F.get("_words", F.col("_at") + k)
    framed = [
        F.struct(_run_key(F.lit(n), [word(k) for k in range(1, n + 1)]).alias("_key"), word(n + 1).alias("_w2"))
        for n in lengths
    ]
    if len(framed) == 1:
        runs = places.select(*kept, word(0).alias("_w1"), framed[0].alias("_run"))
    else:
        runs = places.select(*kept, word(0).alias("_w1"), F.explode(F.array(*framed)).alias("_run"))
    return runs.select(*kept, "_w1", "_run.*").filter(F.col("_w2").isNotNull())


def _run_key(length: Column, words: list[Column]) -> Column:
    # a hash will do: containment is checked afterwards, so a collision does no harm; nulls leave it as it is
    return F.xxhash64(length, *words)


def _long_candidates(
    texts: DataFrame, item_id: str, spellings: DataFrame, lengths: list[int], longest: int, carried: Sequence[str] = ()
) -> DataFrame:
    """Names of three or more words whose interior, first and last word fit a run of the text.

    A run yields one row per suffix of the word before it that begins a name with its interior, and
    then one per prefix of the word after it: never one per name that shares the interior alone.
    ``lengths`` are the interior lengths that occur, at most ``ANCHOR_WORDS``;
    ``longest`` is the length of the longest word of a name. A name comes once per place; ``carried``
    columns of the texts come with it.
    """
    inner, kept = _inner_words(), [item_id, *carried]
    inside = F.slice("_nw", F.lit(2), inner)
    names = spellings.filter(F.size("_nw") >= 3).select(
        "_name",
        _run_key(inner, [F.get(inside, F.lit(k)) for k in range(ANCHOR_WORDS)]).alias("_key"),
        F.col("_nw")[0].alias("_a"),
        F.get("_nw", inner + 1).alias("_b"),
    )
    runs = _framed_runs(texts, kept, lengths)
    runs = runs.join(names.select("_key").distinct(), "_key", "left_semi")
    heads = _cut(runs, "_w1", "suffix", longest, "_a").select(*kept, "_key", "_w2", "_a")
    heads = heads.join(names.select("_key", "_a").distinct(), ["_key", "_a"], "left_semi")
    tails = _cut(heads, "_w2", "prefix", longest, "_b").select(*kept, "_key", "_a", "_b")
    return tails.join(names, ["_key", "_a", "_b"]).select(*kept, "_name")


def _cut(rows: DataFrame, word: str, kind: str, longest: int, out: str) -> DataFrame:
    """A row per suffix or prefix of a word, as in ``_pieces``."""
    first, size = F.lit(1), F.length(word)
    if kind == "suffix":
        at = F.sequence(F.greatest(first, size - longest + 1), size)
        return rows.withColumn("_cut", F.explode(at)).withColumn(out, F.substr(F.col(word), F.col("_cut")))
    at = F.sequence(first, F.greatest(first, F.least(size, F.lit(longest))))
    return rows.withColumn("_cut", F.explode(at)).withColumn(out, F.substr(F.col(word), first, F.col("_cut")))


def _pieces(word: str, kind: str, longest: int) -> Column:
    """All suffixes or all prefixes of a word, none longer than the longest word looked for."""
    first, size = F.lit(1), F.length(word)
    if kind == "suffix":
        starts = F.sequence(F.greatest(first, size - longest + 1), size)
        return F.transform(starts, lambda i: F.substr(F.col(word), i))
    return F.transform(
        F.sequence(first, F.greatest(first, F.least(size, F.lit(longest)))),
        lambda i: F.substr(F.col(word), F.lit(1), i),
    )


def _vocabulary(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode("_words").alias("_w")).distinct()


def _one_word_hits(texts: DataFrame, item_id: str, spellings: DataFrame) -> DataFrame:
    """One-word names, resolved on the distinct words of the corpus."""
    singles = spellings.filter(F.size("_nw") == 1).select("_name")
    # a word is cut into pieces only as long as the longest single-word name
    longest = singles.agg(F.coalesce(F.max(F.length("_name")), F.lit(0)).alias("_max"))
    cut = (
        _vocabulary(texts)
        .withColumn("_from", F.explode(F.sequence(F.lit(1), F.length("_w"))))
        .withColumn("_most", F.least(longest.scalar(), F.length("_w") - F.col("_from") + 1))
        .filter("_most > 0")
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_most"))))
        .select("_w", F.expr("substring(_w, _from, _n)").alias("_name"))
    )
    word_hits = cut.join(singles, "_name").distinct()
    in_items = texts.select(item_id, F.explode(F.array_distinct("_words")).alias("_w"))
    return in_items.join(word_hits, "_w").select(item_id, "_name")


def _two_word_hits(texts: DataFrame, item_id: str, spellings: DataFrame, longest: int) -> DataFrame:
    """Two-word names, resolved on the distinct word pairs of the corpus.

    The first word of a name ends a corpus word and the second starts the next.
    """
    pairs = spellings.filter(F.size("_nw") == 2).select(
        "_name", F.col("_nw")[0].alias("_a"), F.col("_nw")[1].alias("_b")
    )
    vocabulary = _vocabulary(texts)
    runs = texts.select(
        item_id, F.explode(F.array_distinct(word_runs(F.col("_words"), F.lit(2)))).alias("_run")
    )
    heads = (
        vocabulary.select("_w", F.explode(_pieces("_w", "suffix", longest)).alias("_a"))
        .join(pairs.select("_a").distinct(), "_a")
        .withColumnRenamed("_w", "_w1")
    )
    tails = (
        vocabulary.select("_w", F.explode(_pieces("_w", "prefix", longest)).alias("_b"))
        .join(pairs.select("_b").distinct(), "_b")
        .withColumnRenamed("_w", "_w2")
    )
    split_runs = runs.select("_run").distinct().select(
        "_run",
        F.element_at(F.split("_run", " "), 1).alias("_w1"),
        F.element_at(F.split("_run", " "), 2).alias("_w2"),
    )
    run_hits = (
        split_runs.join(heads, "_w1")
        .join(tails, "_w2")
        .join(pairs, ["_a", "_b"])
        .select("_run", "_name")
        .distinct()
    )
    return runs.join(run_hits, "_run").select(item_id, "_name")
