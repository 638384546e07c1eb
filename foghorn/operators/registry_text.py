"""Registry names inside running text: leftmost, longest, without overlaps, with their places.

A text and a name are compared as folded words. Every place of a text is looked up under its word and
under its word with the next one, which are the keys of names of one and of more words; a longer name is
confirmed on the words that follow. So a text costs two look-ups a word whatever the registry's size, and
a frequent first word ("banco") multiplies nothing by itself. The names are broadcast if their number and
bytes are within the limits; otherwise both sides are shuffled by key, where adaptive execution can split
a hot one. The choice among the hits of a text is made in one pass over their array.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foghorn.functions import text as tx
from foghorn.session import BROADCAST_BYTE_LIMIT, BROADCAST_ROW_LIMIT, materialise


def _words(c: str):
    return F.filter(F.split(tx.fold_words(c), " "), lambda w: w != "")


def _key(words, at=0):
    """The first word, with the next one if there is any."""
    return F.when(F.size(words) > at + 1, F.array_join(F.slice(words, at + 1, 2), " ")).otherwise(
        F.get(words, F.lit(at))
    )


def _free_places():
    """Which of the places of a text, from the left, begin behind the end of the one taken before."""

    @F.arrow_udf("array<int>")
    def free(starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for begin, end in zip(starts.to_pylist(), ends.to_pylist()):
            until, kept = 0, []
            for i, at in enumerate(begin):
                if at >= until:
                    until = end[i]
                    kept.append(i)
            out.append(kept)
        return pa.array(out, pa.list_(pa.int32()))

    return free


def registry_mentions(
    texts: DataFrame, text_id: str, text: str, registry: DataFrame, name: str
) -> DataFrame:
    """``text_id``, ``first_word`` (from 0), ``n_words`` and the columns of ``registry`` for each mention.

    ``registry`` has a row per spelling in ``name``; spellings without a letter or digit are left out,
    and of rows with equal folded spellings each is returned. Reading a text from the left, the longest
    name that begins at a word is taken and the search goes on behind it. Null and empty texts have no
    mentions. ``text_id`` must be unique. Texts are cut at words, never in length.
    """
    taken = {text_id, "first_word", "n_words"} & set(registry.columns)
    if taken:
        raise ValueError(f"the registry has columns that the result needs: {sorted(taken)}")
    spelled = registry.withColumn("_alias", _words(name)).filter(F.size("_alias") > 0)
    spelled = materialise(spelled.withColumn("_spelling", F.array_join("_alias", " ")))
    names = materialise(
        spelled.select("_alias", "_spelling").distinct().select("_alias", "_spelling", _key(F.col("_alias")).alias("_key"))
    )
    rows, size, longest = names.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_spelling")), F.lit(0)), F.max(F.size("_alias"))
    ).first()[:]
    if not rows:
        longest = 1
    small = rows <= BROADCAST_ROW_LIMIT and size <= BROADCAST_BYTE_LIMIT
    words = texts.select(text_id, _words(text).alias("_words"))
    places = words.select(text_id, "_words", F.posexplode("_words").alias("_at", "_w"))
    pair = F.concat("_w", F.lit(" "), F.get("_words", F.col("_at") + 1))
    keys = F.explode(F.when(pair.isNull(), F.array("_w")).otherwise(F.array(F.col("_w"), pair))).alias("_key")
    run = F.slice("_words", F.col("_at") + 1, longest)
    if small:
        # a text's words stay where they are, shared by its places: only a hit takes its own from them
        hits = places.select(text_id, "_words", "_at", keys).join(F.broadcast(names), "_key").withColumn("_run", run)
    else:
        hits = places.select(text_id, "_at", keys, run.alias("_run")).join(names, "_key")
    hits = hits.filter(F.slice("_run", 1, F.size("_alias")) == F.col("_alias"))
    found = hits.groupBy(text_id).agg(
        F.array_sort(  # from the left, longer ones first
            F.collect_list(F.struct(F.col("_at").alias("at"), (-F.size("_alias")).alias("less"), F.col("_spelling").alias("name")))
        ).alias("_hits")
    )
    free = _free_places()(F.transform("_hits", lambda h: h["at"]), F.transform("_hits", lambda h: h["at"] - h["less"]))
    chosen = found.withColumn("_free", free).select(
        text_id, F.explode(F.transform("_free", lambda i: F.get("_hits", i))).alias("_h")
    )
    chosen = chosen.select(
        text_id,
        F.col("_h.at").alias("first_word"),
        (-F.col("_h.less")).alias("n_words"),
        F.col("_h.name").alias("_spelling"),
    )
    return chosen.join(spelled.drop("_alias"), "_spelling").drop("_spelling")
