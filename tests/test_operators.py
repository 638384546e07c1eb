"""Operators against brute force on small fixtures."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foghorn.functions import text as tx
from foghorn.operators import matching, mentions, pairs, quantiles, rows
from foghorn.plans import discovery as dc


def test_row_numbers_match_a_sort_under_skew(spark):
    random.seed(1)
    data = [("hot" if i % 3 else random.choice("abc"), random.randint(0, 50), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(7)
    got = rows.row_numbers(df, [F.col("v").asc(), F.col("id").asc()], "n", ["g"]).collect()
    want = {}
    for g, items in itertools.groupby(sorted(data), key=lambda r: r[0]):
        for n, (_, _, i) in enumerate(sorted(items, key=lambda r: (r[1], r[2])), 1):
            want[i] = n
    assert {r["id"]: r["n"] for r in got} == want
    everything = rows.row_numbers(df, [F.col("v").desc(), F.col("id").asc()], "n").collect()
    order = sorted(data, key=lambda r: (-r[1], r[2]))
    assert [r["id"] for r in sorted(everything, key=lambda r: r["n"])] == [r[2] for r in order]


def test_row_numbers_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, v int")
    got = {(r["g"], r["v"]): r["n"] for r in rows.row_numbers(df, [F.col("v").asc()], "n", ["g"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 5): 1}


@pytest.mark.parametrize("parts", [1, 8])
def test_exact_quantiles_equal_numpy(spark, parts):
    random.seed(2)
    data = [("hot" if i % 3 else random.choice("xy"), random.gauss(0, 1) if i % 5 else 0.25) for i in range(700)]
    df = spark.createDataFrame(data + [("x", None), ("one", 4.0)], "g string, v double").repartition(parts)
    probs = {"lo": 0.0, "p10": 0.1, "med": 0.5, "p95": 0.95, "hi": 1.0}
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in ("hot", "x", "y"):
        values = [v for k, v in data if k == g]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), abs=1e-12)
    assert got["one"]["p95"] == 4.0
    total = quantiles.exact_quantiles(df, [], "v", {"p": 0.9}).collect()
    assert total[0]["p"] == pytest.approx(np.quantile([v for _, v in data] + [4.0], 0.9))


def test_winsorise_by_group_and_globally(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 10.0), ("b", 7.0)], "g string, v double")
    got = {(r["g"], round(r["v"], 9)) for r in quantiles.winsorise(df, "v", 0.9, ["g"]).collect()}
    assert got == {("a", 1.0), ("a", 2.0), ("a", 8.4), ("b", 7.0)}
    high = max(r["v"] for r in quantiles.winsorise(df, "v", 0.5).collect())
    assert high == np.quantile([1, 2, 10, 7], 0.5)


def test_keep_last_is_idempotent_and_order_free(spark, rows_of):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "x")], "k string, n int, v string")
    once = rows.keep_last(df, ["k"], "n")
    assert rows_of(once) == rows_of(rows.keep_last(once, ["k"], "n"))
    assert rows_of(once) == rows_of(rows.keep_last(df.repartition(5), ["k"], "n"))
    assert {tuple(r) for r in once.collect()} == {("k", 2, "c"), (None, 1, "x")}


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    plan = rows.top_k(df, ["k"], [F.col("id").asc()], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- matching -----------------------------------------------------------------

def _norm(name):
    return " ".join("".join(c if c.isalnum() else " " for c in name.lower()).split())


def _tokens(norm):
    from foghorn.vocab import NAME_STOPWORDS

    return [t for t in norm.split() if len(t) > 1 and t not in NAME_STOPWORDS]


def _brute_token_match(members, universe, need_first):
    found = {}
    for mid, name in members:
        q = _tokens(_norm(name))
        if len(q) < 2:
            continue
        best = None
        for uid, uname in universe:
            norm = _norm(uname)
            if need_first and q[0] not in norm:
                continue
            shared = len(set(q) & set(_tokens(norm)))
            if shared >= 2 and (best is None or (-shared, uid) < best):
                best = (-shared, uid)
        if best:
            found[mid] = str(best[1])
    return found


def _names(seed, n, long_every=0):
    random.seed(seed)
    words = ["banco", "norte", "sur", "eco", "ecopetrol", "minera", "grupo", "de", "andes", "verde", "x", "agua"]
    out = []
    for i in range(n):
        size = 14 if long_every and i % long_every == 0 else random.randint(1, 5)
        extra = [f"w{j}" for j in random.sample(range(20), size)] if size > 5 else []
        out.append((i, " ".join(random.choices(words, k=min(size, 5)) + extra)))
    return out


@pytest.mark.parametrize("long_every", [0, 4])
@pytest.mark.parametrize("need_first", [True, False])
def test_token_match_equals_brute_force(spark, long_every, need_first):
    universe, members = _names(3, 60, long_every), _names(4, 50, long_every)
    u = spark.createDataFrame([(str(i), n) for i, n in universe], "match_id string, name string")
    u = u.withColumn("name_norm", tx.normalise_name("name"))
    m = spark.createDataFrame(members, "row_id int, name string").withColumn("name_norm", tx.normalise_name("name"))
    got = matching.token_stage(m, u, need_first).select("row_id", "match_id").collect()
    assert {r[0]: r[1] for r in got} == _brute_token_match(members, universe, need_first)


@pytest.mark.parametrize("frequent", [0, 3, 12])
@pytest.mark.parametrize("need_first", [True, False])
def test_token_match_of_frequent_tokens_equals_brute_force(spark, need_first, frequent):
    universe, members = _names(5, 80, 5), _names(6, 60, 7)
    least = {}
    for uid, name in universe:
        least.setdefault(_norm(name), uid)
    c = spark.createDataFrame([(n, _tokens(n), i) for n, i in least.items()], "norm string, tokens array<string>, rank int")
    asked = sorted({_norm(n) for _, n in members})
    q = spark.createDataFrame([(n, _tokens(n)) for n in asked], "name string, asked array<string>")
    found = matching.best_token_match(q, "asked", c, "tokens", "rank", "norm" if need_first else None, frequent)
    got = {r["name"]: str(r["_rank"]) for r in found.collect()}
    assert got == _brute_token_match([(n, n) for n in asked], [(i, n) for n, i in least.items()], need_first)


def test_token_index_is_linear_in_tokens(spark):
    rows = [(i, [f"r{i}", "the", "group", *[f"t{i % 7}-{j}" for j in range(18)]]) for i in range(200)]
    c = spark.createDataFrame(rows, "_rank int, _cset array<string>")
    rarity = c.select(F.explode("_cset").alias("_token")).groupBy("_token").agg(F.count(F.lit(1)).alias("_n"))
    index = matching.token_index(matching._by_rarity(c, "_cset", rarity), 100)
    assert index.count() == 200 * 19 < sum(len(t) for _, t in rows)
    assert index.filter("_token in ('the', 'group')").isEmpty()


def test_cascade_covers_each_member_once_and_prefers_id(spark):
    u = spark.createDataFrame(
        [("1", "Árbol Verde SA"), ("2", "Arbol Verde S.A."), ("3", "Banco del Norte Andino")],
        "company_id string, company_name string",
    )
    m = spark.createDataFrame(
        [(1, "whatever", "3.0"), (2, "x", "99"), (3, "arbol verde sa", ""), (4, "Banco Norte", ""), (5, "Solo", None), (6, "Norte", "")],
        "row_id int, member_name string, company_id string",
    )
    got = sorted(tuple(r) for r in matching.match_members(m, u).select("row_id", "match_id", "stage").collect())
    assert (1, "3", "id") in got and (2, None, "id") in got
    assert [g for g in got if g[0] == 3] == [(3, "1", "name")]
    assert [g for g in got if g[0] == 4] == [(4, "3", "token")]
    assert not [g for g in got if g[0] in (5, 6)]
    stages = {}
    for row_id, _, stage in got:
        stages.setdefault(row_id, set()).add(stage)
    assert all(len(s) == 1 for s in stages.values())


def test_duplicate_names_match_all_or_first(spark):
    u = spark.createDataFrame([("10", "Uno"), ("9", "uno")], "company_id string, company_name string")
    m = spark.createDataFrame([(1, "UNO", "")], "row_id int, member_name string, company_id string")
    assert {r["match_id"] for r in matching.match_members(m, u).collect()} == {"9", "10"}
    assert [r["match_id"] for r in matching.match_members(m, u, multi="first").collect()] == ["9"]


def test_empty_universe_keeps_members_outside(spark):
    u = spark.createDataFrame([], "company_id string, company_name string")
    m = spark.createDataFrame([(1, "Uno Dos", "")], "row_id int, member_name string, company_id string")
    assert matching.match_members(m, u).count() == 0
    assert [r["stage"] for r in matching.index_match(m, u).collect()] == ["external"]


# --- mentions -----------------------------------------------------------------

@pytest.mark.parametrize("whole", [False, True])
def test_mentions_equal_brute_force(spark, whole):
    random.seed(5)
    letters = ["a", "ab", "ba", "bab", "é", "Ab  ", "abba"]
    texts = [(i, " ".join(random.choices(letters, k=random.randint(1, 14)))) for i in range(60)]
    names = [(i, " ".join(random.choices(letters, k=random.randint(1, 5)))) for i in range(40)]
    names.append((40, "a b"))
    got = mentions.mention_join(
        spark.createDataFrame(texts, "t int, text string"), "t", "text",
        spark.createDataFrame(names, "n int, name string"), "n", "name", whole_words=whole,
    ).collect()
    shape = lambda s: " ".join(s.lower().split())
    pad = (lambda s: f" {shape(s)} ") if whole else shape
    want = {(t, n) for t, text in texts for n, name in names if pad(name) in (pad(text) if whole else shape(text))}
    assert {tuple(r) for r in got} == want


def test_folded_mentions(spark):
    texts = spark.createDataFrame([(1, "La compañía ÁRBOL verde")], "t int, text string")
    names = spark.createDataFrame([(7, "Arbol Verde")], "n int, name string")
    assert mentions.mention_join(texts, "t", "text", names, "n", "name", folded=True).count() == 1
    assert mentions.mention_join(texts, "t", "text", names, "n", "name").count() == 0


def test_long_names_beyond_the_anchor(spark):
    words = [f"w{i}" for i in range(20)]
    texts = spark.createDataFrame([(1, "x " + " ".join(words) + "y"), (2, " ".join(words[:19]))], "t int, text string")
    names = spark.createDataFrame([(7, " ".join(words))], "n int, name string")
    assert [tuple(r) for r in mentions.mention_join(texts, "t", "text", names, "n", "name").collect()] == [(1, 7)]


def test_common_middle_words_do_not_multiply(spark):
    n = 300
    texts = spark.createDataFrame([(i, f"grupo de xa{i} de b{i}y de c") for i in range(n)], "t int, _text string")
    names = spark.createDataFrame([(f"a{i} de b{i}",) for i in range(n)], "_name string")
    keyed = mentions._long_candidates(
        texts.withColumn("_words", F.split("_text", " ")), "t", names.withColumn("_nw", F.split("_name", " ")), [1], 4
    )
    hits = {(i, f"a{j}" + f" de b{j}") for i in range(n) for j in range(n) if f"a{j} de b{j}" in f"grupo de xa{i} de b{i}y de c"}
    assert sorted(tuple(r) for r in keyed.collect()) == sorted(hits)


def test_mentions_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(mentions, "BROADCAST_BYTE_LIMIT", 0)
    texts = spark.createDataFrame([(1, "el grupo de aceros sur"), (2, None), (3, "")], "t int, text string")
    names = spark.createDataFrame([(7, "Grupo de Aceros"), (8, "aceros"), (9, "los sur"), (10, None)], "n int, name string")
    got = mentions.mention_join(texts, "t", "text", names, "n", "name")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7), (1, 8)]


@pytest.mark.parametrize("limit", [0, mentions.BROADCAST_BYTE_LIMIT])
def test_long_mentions_of_many_lengths_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(mentions, "BROADCAST_BYTE_LIMIT", limit)
    random.seed(9)
    letters = ["a", "ab", "ba", "é", "Ab \t"]
    texts = [(i, " ".join(random.choices(letters, k=random.randint(1, 60)))) for i in range(40)]
    texts += [(90, ""), (91, " \n "), (92, None), (93, "a"), (94, "a ba ab " * 30)]
    names = [(i, " ".join(random.choices(letters, k=random.randint(3, 6)))) for i in range(40)]
    for i, (_, text) in enumerate(texts[:30]):
        words = text.split()
        names.append((100 + i, " ".join(words[1:13])[random.randint(0, 1):]))
    names += [(200, "a ba ab a"), (201, ""), (202, None), (203, "ba " * 11)]
    got = mentions.mention_join(
        spark.createDataFrame(texts, "t int, text string"), "t", "text",
        spark.createDataFrame(names, "n int, name string"), "n", "name",
    ).collect()
    shape = lambda s: " ".join((s or "").lower().split())
    want = [(t, n) for t, text in texts for n, name in names if shape(name) and shape(name) in shape(text)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            above = row[j]
            row[j] = diagonal + 1 if x == y else max(above, row[j - 1])
            diagonal = above
    return row[-1]


def _ratio(a, b):
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def test_bit_parallel_subsequences_equal_the_table():
    random.seed(8)
    word = lambda n: "".join(random.choice("ab é\u4e2d\U0001f600\x00") for _ in range(n))
    pairs = [(word(random.choice(s)), word(random.choice(s))) for s in ([0, 1, 5, 30], [63, 64, 65, 66, 130]) for _ in range(700)]
    got = dc.lcs_lengths(*zip(*pairs))
    assert got.tolist() == [_lcs(a, b) for a, b in pairs]


@pytest.mark.parametrize("floor", [70.0, 85.0, 92.0])
def test_near_strings_equal_brute_force(spark, floor):
    random.seed(6)
    base = ["banco del norte", "minera andes", "agua verde", "eco petrol sur", "a", "grupo agua"]

    def noisy(s):
        s = list(s)
        for _ in range(random.randint(0, 3)):
            at = random.randrange(len(s))
            s[at : at + 1] = random.choice([[], [random.choice("abcxyz")], [s[at], random.choice("abc")]]) or [""]
        return "".join(s)

    choices = sorted({noisy(random.choice(base)) for _ in range(40)})
    asked = sorted({noisy(random.choice(base)) for _ in range(40)})
    sort = lambda s: " ".join(sorted(s.split()))
    want = {}
    for a in asked:
        best = max(((_ratio(sort(a), sort(c)), c) for c in choices), key=lambda r: r[0])
        if best[0] >= floor and sort(a):
            want[a] = best[0]
    got = dc.near_string_match(
        spark.createDataFrame([(a,) for a in asked], "asked string"), "asked",
        spark.createDataFrame([(c,) for c in choices], "choice string"), "choice", floor,
    ).collect()
    assert {r["asked"]: pytest.approx(r["ratio"]) for r in got} == want


def test_pair_counts_ignore_repeats_and_order(spark, rows_of):
    df = spark.createDataFrame([(["b", "a", "b"],), (["a", "b"],), (["c"],), ([],), (["c", "a", "b"],)], "t array<string>")
    edges = pairs.pair_counts(df, "t")
    assert rows_of(edges) == [("a", "b", 3), ("a", "c", 1), ("b", "c", 1)]
    assert rows_of(pairs.node_degrees(edges)) == [("a", 2, 4), ("b", 2, 4), ("c", 2, 2)]
    assert rows_of(pairs.dense_matrix(edges, ["a", "z"])) == [("a", 0, 0), ("z", 0, 0)]
