"""Entity matching by id, exact name and token overlap, without pair blow-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foghorn.functions import text as tx

#: A token of more names than this is frequent: names that share nothing else are compared by their
#: distinct sets of frequent tokens, not name by name. So a probe meets at most this many names.
FREQUENT_NAMES = 1000


def _by_rarity(names: DataFrame, tokens: str, rarity: DataFrame) -> DataFrame:
    """``names`` with ``_ranked``: its tokens that ``rarity`` knows, as (n, token), rarest first."""
    keys = names.columns
    ranked = (
        names.withColumn("_token", F.explode(tokens))
        .join(rarity, "_token")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_n", "_token"))).alias("_ranked"))
    )
    return ranked.filter(F.size("_ranked") >= 2)


def token_index(ranked: DataFrame, frequent: int = FREQUENT_NAMES) -> DataFrame:
    """A row per name and indexed token, fewer than its tokens.

    Two names that share two tokens share a token that is not the most frequent of either, so that one
    is left out; frequent tokens are left out as well.
    """
    rare = F.filter(F.slice("_ranked", 1, F.size("_ranked") - 1), lambda t: t["_n"] <= frequent)
    return ranked.withColumn("_token", F.explode(F.transform(rare, lambda t: t["_token"])))


def _found(shared: Column, rank: str) -> Column:
    """Orders hits: more shared tokens first, then the lower rank."""
    return F.struct((-shared).cast("bigint").alias("less"), F.col(rank).alias("rank"))


def _contained(q: DataFrame, c: DataFrame) -> DataFrame:
    """``c`` once for every first token of a query that its name contains.

    Found by an equi-join on the name's substrings rather than a containment join.
    """
    firsts = q.select("_first").distinct()
    words = c.select("_cnorm", F.explode(F.split("_cnorm", " ")).alias("_word")).distinct()
    pieces = (
        words.filter(F.length("_word") > 1)
        .withColumn("_from", F.explode(F.sequence(F.lit(1), F.length("_word") - 1)))
        .withColumn("_len", F.explode(F.sequence(F.lit(2), F.length("_word") - F.col("_from") + 1)))
        .select("_cnorm", F.expr("substring(_word, _from, _len)").alias("_first"))
        .distinct()
    )
    return c.join(pieces.join(firsts, "_first", "left_semi"), "_cnorm")


def _frequent_tokens(column: str, frequent: int) -> Column:
    return F.transform(F.filter(column, lambda t: t["_n"] > frequent), lambda t: t["_token"])


def _frequent_hits(open_q: DataFrame, ranked_c: DataFrame, rule: bool, frequent: int) -> DataFrame:
    """Hits of names that share only frequent tokens: each distinct set of them is compared once.

    A set keeps the lowest rank among its names, so names of one set cost one row however many they are.
    """
    on = ["_first"] if rule else []
    q = open_q.withColumn("_qfreq", _frequent_tokens("_ranked", frequent))
    c = ranked_c.withColumn("_cfreq", _frequent_tokens("_ranked", frequent)).filter(F.size("_cfreq") >= 2)
    if rule:
        c = _contained(q, c)
    c = c.groupBy(*on, "_cfreq").agg(F.min("_rank").alias("_rank"))
    rest = lambda a: F.explode(F.slice(a, 1, F.size(a) - 1)).alias("_token")
    pairs = q.select(*on, "_qfreq", rest("_qfreq")).distinct().join(
        c.select(*on, "_cfreq", "_rank", rest("_cfreq")), [*on, "_token"]
    )
    shared = F.size(F.array_intersect("_qfreq", "_cfreq"))
    best = pairs.filter(shared >= 2).groupBy(*on, "_qfreq").agg(F.min(_found(shared, "_rank")).alias("_hit"))
    return q.join(best, [*on, "_qfreq"]).drop("_qfreq")


def best_token_match(
    queries: DataFrame,
    query_tokens: str,
    candidates: DataFrame,
    candidate_tokens: str,
    candidate_rank: str,
    candidate_norm: str | None = None,
    frequent: int = FREQUENT_NAMES,
) -> DataFrame:
    """Best candidate per query by number of shared distinct tokens (two or more).

    Both inputs hold one row per distinct normalised name. Returns the query
    frame's columns plus ``_rank`` (the lowest ``candidate_rank`` among the
    candidates with most shared tokens) and ``_shared``; queries without a
    candidate are left out. With ``candidate_norm`` a candidate must also
    contain the query's first token as a substring.

    Tokens are ordered by rarity among the candidates, and the rarest token that
    two names share leads from one to the other. The query's rarest token is
    probed first. A candidate first met at the j-th of k tokens shares k - j + 1
    at most, so the other tokens are probed only as far as that bound reaches the
    best hit. Frequent tokens are never probed name by name, see
    ``_frequent_hits``. The index has fewer rows than the names have tokens.
    """
    own = queries.columns
    q = queries.withColumn("_qset", F.array_distinct(query_tokens)).filter(F.size(query_tokens) >= 2)
    if candidate_norm:
        q = q.withColumn("_first", F.element_at(F.col(query_tokens), 1))
    c = candidates.select(
        F.array_distinct(candidate_tokens).alias("_cset"),
        F.col(candidate_rank).alias("_rank"),
        *([F.col(candidate_norm).alias("_cnorm")] if candidate_norm else []),
    ).filter(F.size("_cset") >= 2)
    rarity = c.select(F.explode("_cset").alias("_token")).groupBy("_token").agg(F.count(F.lit(1)).alias("_n"))
    q = _by_rarity(q, "_qset", rarity)
    ranked_c = _by_rarity(c, "_cset", rarity)
    index = token_index(ranked_c, frequent).drop("_ranked")

    shared = F.size(F.array_intersect("_qset", "_cset"))
    good = shared >= 2
    if candidate_norm:
        good = good & F.contains("_cnorm", F.col("_first"))
    hit = F.when(good, _found(shared, "_rank"))
    columns = q.columns

    rarest = F.element_at("_ranked", 1)
    probe = F.when(rarest["_n"] <= frequent, rarest["_token"])
    first = q.withColumn("_token", probe).join(index, "_token", "left")
    first = first.groupBy(*columns).agg(F.min(hit).alias("_hit"))

    most = F.greatest(F.lit(2), F.coalesce(-F.col("_hit.less"), F.lit(0)))
    reach = F.filter(  # the j-th token, from 0, of k leads to k - j shared ones at most
        F.transform("_ranked", lambda t, j: F.struct(t["_n"].alias("n"), t["_token"].alias("token"), j.alias("j"))),
        lambda t: (t["j"] > 0) & (t["n"] <= frequent) & (F.size("_ranked") - t["j"] >= most),
    )
    later = first.withColumn("_token", F.explode(F.transform(reach, lambda t: t["token"]))).drop("_hit")
    later = later.join(index, "_token").filter(good).groupBy(*columns).agg(F.min(hit).alias("_hit"))
    open_q = first.filter(F.size(_frequent_tokens("_ranked", frequent)) >= most).drop("_hit")
    tail = _frequent_hits(open_q, ranked_c, bool(candidate_norm), frequent)
    hits = first.filter("_hit is not null").unionByName(later).unionByName(tail.select(*columns, "_hit"))
    best = hits.groupBy(*own).agg(F.min("_hit").alias("_hit"))
    return best.select(*own, F.col("_hit.rank").alias("_rank"), (-F.col("_hit.less")).alias("_shared"))


def match_members(
    members: DataFrame,
    universe: DataFrame,
    multi: str = "all",
    fold_names: bool = True,
) -> DataFrame:
    """Cascade id -> exact name -> token overlap, each stage on the rows left over.

    ``members`` needs ``row_id, member_name, company_id`` (null or blank when
    absent); ``universe`` needs ``company_id, company_name``. Adds the matched
    universe id as ``match_id`` and the ``stage`` (``id``, ``name``, ``token``).
    A member that carries an id is resolved by it even when the universe does
    not know the id; its ``match_id`` is then null. ``multi='first'`` keeps the
    lowest id where several companies share a name.
    """
    u = universe.select(
        tx.clean_id("company_id").alias("match_id"),
        tx.normalise_name("company_name", fold_names).alias("name_norm"),
    )
    m = members.withColumn("_mid", tx.clean_id("company_id")).withColumn(
        "name_norm", tx.normalise_name("member_name", fold_names)
    )
    ids = u.select("match_id").filter("match_id <> ''").distinct()
    by_id = (
        m.filter("_mid <> ''")
        .join(ids, F.col("_mid") == F.col("match_id"), "left")
        .withColumn("stage", F.lit("id"))
    )
    rest = m.filter("_mid = ''")

    names = u.filter("name_norm <> ''")
    if multi == "first":
        names = names.groupBy("name_norm").agg(F.min(_id_order("match_id")).alias("_o"))
        names = names.select("name_norm", F.col("_o.id").alias("match_id"))
    by_name = rest.join(names, "name_norm").withColumn("stage", F.lit("name"))
    rest = rest.join(names.select("name_norm").distinct(), "name_norm", "left_anti")

    by_token = token_stage(rest, u)
    out = [*members.columns, "match_id", "stage"]
    return (
        by_id.select(*out).unionByName(by_name.select(*out)).unionByName(by_token.select(*out))
    )


def _id_order(c: str) -> Column:
    """Orders ids numerically when they are numbers, by text otherwise."""
    return F.struct(
        F.coalesce(F.col(c).try_cast("bigint"), F.lit(2**62)).alias("n"), F.col(c).alias("id")
    )


def token_stage(rest: DataFrame, u: DataFrame, need_first_token: bool = True) -> DataFrame:
    """Token-overlap stage over distinct names, mapped back to the member rows."""
    u_names = (
        u.filter("name_norm <> ''")
        .groupBy("name_norm")
        .agg(F.min(_id_order("match_id")).alias("rank"))
        .withColumn("tokens", tx.name_tokens("name_norm"))
        .withColumnRenamed("name_norm", "u_norm")
    )
    q_names = rest.select("name_norm").distinct().withColumn("tokens", tx.name_tokens("name_norm"))
    best = best_token_match(
        q_names, "tokens", u_names, "tokens", "rank", "u_norm" if need_first_token else None
    )
    found = best.select("name_norm", F.col("_rank.id").alias("match_id"), F.col("_shared").alias("shared"))
    return rest.join(found, "name_norm").withColumn("stage", F.lit("token"))


def index_match(members: DataFrame, universe: DataFrame, fold_names: bool = True) -> DataFrame:
    """One company per member: exact name first, else most shared tokens; misses kept.

    Adds ``match_id`` (null for members outside the universe) and ``stage``.
    """
    u = universe.select(
        tx.clean_id("company_id").alias("match_id"),
        tx.normalise_name("company_name", fold_names).alias("name_norm"),
    )
    m = members.withColumn("name_norm", tx.normalise_name("member_name", fold_names))
    first = (
        u.filter("name_norm <> ''")
        .groupBy("name_norm")
        .agg(F.min(_id_order("match_id")).alias("_o"))
        .select("name_norm", F.col("_o.id").alias("_exact"))
    )
    exact = m.join(first, "name_norm", "left")
    fuzzy_names = exact.filter("_exact IS NULL").select("name_norm").distinct()
    fuzzy = token_stage(fuzzy_names, u, need_first_token=False).select(
        "name_norm", F.col("match_id").alias("_token")
    )
    joined = exact.join(fuzzy, "name_norm", "left")
    return (
        joined.withColumn("match_id", F.coalesce("_exact", "_token"))
        .withColumn(
            "stage",
            F.when(F.col("_exact").isNotNull(), "name")
            .when(F.col("_token").isNotNull(), "token")
            .otherwise("external"),
        )
        .select(*members.columns, "match_id", "stage")
    )
