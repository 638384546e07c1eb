"""Plans on hand-made rows: scoring edges, classification cases, sampling, ranking."""

import functools
import operator
import random
import re
import unicodedata
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from foghorn.operators import registry_text
from foghorn import vocab
from foghorn.functions import measures as mx, text as tx
from foghorn.plans import classify as cl, documented as doc, events as ev, interest as it
from foghorn.plans import discovery as dc, prospects as pr, rollup as rd, sampling as sp

AS_OF = "2024-01-31"
UTC = dt.timezone.utc


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "company_id string, signal_type string, signal_strength double, ts timestamp, url string"
    )


def _universe(spark):
    return spark.createDataFrame(
        [("1", "Uno", "AR", "oil_gas", "m"), ("2", "Dos", "AR", "oil_gas", "m"), ("2", "Dos", "AR", "oil_gas", "m")],
        "company_id string, company_name string, country string, industry string, size_bin string",
    )


DAY = dt.datetime(2024, 1, 30, tzinfo=UTC)


def test_interest_score_edges(spark):
    events = _events(
        spark,
        [
            ("1", " SBTI ", 1.0, DAY, "a"),
            ("1", "re100", 1.0, DAY, "b"),
            ("1", "ungc", 1.0, DAY, "c"),  # memberships reach the cap of 50
            ("1", "news", -1.0, DAY, "d"),  # bad news does not score
            ("1", "news", 0.0, DAY, "e"),
            ("1", "unheard_of", 1.0, DAY, "f"),
            ("1", "news", 1.0, dt.datetime(2022, 1, 1, tzinfo=UTC), "g"),  # before the window
            ("1", "news", 1.0, None, "h"),
            (None, "news", 1.0, DAY, "i"),
            ("9", "news", 1.0, DAY, "j"),  # not in the universe
        ],
    )
    got = {r["company_id"]: r for r in it.interest_scores(events, _universe(spark), AS_OF).collect()}
    assert len(got) == 2
    assert got["1"]["group_memberships"] == 50.0 and got["1"]["score_0_100"] == 50.0
    assert got["1"]["signals_count"] == 3 and got["1"]["last_ts"] == "2024-01-30T00:00:00Z"
    assert got["2"]["score_0_100"] == 0.0 and got["2"]["last_ts"] == "" and got["2"]["signals_count"] == 0


def test_future_events_grow_and_half_life_halves(spark):
    future = _events(spark, [("1", "news", 1.0, dt.datetime(2025, 1, 31, tzinfo=UTC), "a")])
    score = it.scored_events(future, AS_OF).first()["event_score"]
    assert score == pytest.approx(10 * math.exp(366 / 365))
    past = _events(spark, [("1", "news", 1.0, dt.datetime(2023, 2, 1, tzinfo=UTC), "a")])
    halved = it.scored_events(past, AS_OF, decay_days=364, mode="half_life").first()["event_score"]
    assert halved == pytest.approx(5.0)


def test_empty_events_give_zero_scores(spark):
    got = it.interest_scores(_events(spark, []), _universe(spark), AS_OF)
    assert {r["score_0_100"] for r in got.collect()} == {0.0}


def test_scores_do_not_depend_on_partitions(spark, rows_of):
    rows = [(str(i % 2 + 1), "news", 0.1 * i, DAY, str(i)) for i in range(50)]
    one = it.interest_scores(_events(spark, rows).coalesce(1), _universe(spark), AS_OF)
    many = it.interest_scores(_events(spark, rows).repartition(8), _universe(spark), AS_OF)
    assert rows_of(one) == rows_of(many)


def test_missing_score_columns_are_named(spark):
    with pytest.raises(ValueError, match="signals_count"):
        it.prospect_columns(spark.createDataFrame([("1",)], "company_id string"))


def test_append_is_idempotent_and_last_wins(spark, rows_of):
    a = _events(spark, [("1", "news", 0.5, DAY, "u"), ("1", "news", 0.6, DAY, "v")])
    b = _events(spark, [("1", "news", 0.9, DAY, "u"), ("2", "news", 0.1, DAY, "u")])
    merged = ev.append_keep_last(a, b)
    assert ev.added_rows(merged, a) == 1
    assert rows_of(ev.append_keep_last(merged, b).select(*a.columns)) == rows_of(merged.select(*a.columns))
    strengths = {(r["company_id"], r["url"]): r["signal_strength"] for r in merged.collect()}
    assert strengths == {("1", "u"): 0.9, ("1", "v"): 0.6, ("2", "u"): 0.1}


def test_canonical_defaults(spark):
    row = ev.canonical_events(
        spark.createDataFrame([("1", None)], "company_id string, signal_type string"), "jobs", "job_posting"
    ).first()
    assert row["signal_type"] == "job_posting" and row["signal_strength"] == 1.0
    assert row["source"] == "jobs" and row["climate_score"] is None and row["title"] == ""


# --- classification -----------------------------------------------------------

def _classify(spark, **fields):
    df = spark.createDataFrame([fields])
    return cl.classify(df).first()


def test_biotech_is_health_by_alias(spark):
    row = _classify(
        spark, industry="industrial_manufacturing", company_name="BIOTECNOLÓGICAS DEL SUR",
        source_meta="sector: Biotechnology",
    )
    assert (row["class_slug"], row["class_reason"]) == ("healthcare_pharma_biotech", "alias")


def test_supermarket_becomes_retail(spark):
    df = spark.createDataFrame(
        [("agro_food_beverage", "Jumbo Chile", "cadena de supermercado")],
        "industry string, company_name string, text_snippet string",
    )
    row = cl.reclassify(df).first()
    assert row["industry"] == "retail_consumer" and row["change_reason"] == "alias"


def test_name_repair_needs_context(spark):
    df = spark.createDataFrame(
        [("Del Pinar Sociedad Anónima", "Del Pilar anuncia planes", "x"), ("Del Pinar SA", "nada", "x")],
        "company_name string, text_snippet string, industry string",
    )
    names = [r["company_name"] for r in cl.reclassify(df, fix_names=True).collect()]
    assert names == ["Del Pilar Sociedad Anónima", "Del Pinar SA"]


def test_institute_is_public(spark):
    row = _classify(spark, industry="retail_consumer_services", company_name="Instituto Vida videira")
    assert row["class_slug"] == "public_social_education" and row["class_reason"] in ("alias", "weighted")


def test_weighted_token_unknown_and_hint(spark):
    assert _classify(spark, industry="", company_name="Solar wind park")["class_reason"] == "weighted"
    token = _classify(spark, industry="", company_name="water works xyz")
    assert (token["class_slug"], token["class_reason"]) == ("water_waste_circularity", "token")
    none = _classify(spark, industry="", company_name="qqq")
    assert (none["class_slug"], none["class_score"]) == ("unknown", 0.0)
    hint = _classify(spark, industry="", company_name="qqq", source_meta="Sector: Retailers")
    # the hint alone scores 1.5, "retail" in the text adds the weights
    assert hint["class_slug"] in ("retail_consumer_services", "retail_consumer")


def test_token_classification_is_counted_not_applied(spark):
    df = spark.createDataFrame([("old", "water works")], "industry string, company_name string")
    out = cl.reclassify(df)
    assert out.first()["industry"] == "old" and out.first()["change_reason"] is None
    assert cl.change_counts(out).first()["token_hits"] == 1


def test_rule_fallback_policies(spark):
    df = spark.createDataFrame([("zzz",), ("banco",)], "t string")
    rows = [tuple(r) for r in cl.rule_classify(df, ["t"]).collect()]
    assert rows[0] == ("zzz", "professional_services_consulting", 0.0, 0.35)
    assert rows[1][1] == "finance_insurance_capital" and rows[1][3] == pytest.approx(0.75)
    first = cl.rule_classify(df, ["t"], alphabetical_default=True).first()
    assert first["rule_slug"] == sorted({p[1] for p in vocab.INDUSTRY_PATTERNS})[0]


def test_stored_responses_are_parsed_and_repaired(spark):
    df = spark.createDataFrame(
        [('text {"industry_slug": "oil_gas", "confidence": 0.9, "description": "d"} end',),
         ('{"industry_slug": "Banking group"}',), ("no block",), ("{broken",)],
        "content string",
    )
    got = [tuple(r)[1:3] for r in cl.parse_stored_responses(df, "content", ["oil_gas"]).collect()]
    assert got == [("oil_gas", 0.9), ("finance_insurance_capital", 0.6), (None, None), (None, None)]


def test_context_and_overlay(spark):
    df = spark.createDataFrame(
        [("ind", " Banking ", "", "extra", "snippet", "", "old")],
        "industry string, context_sector string, context_type string, context_extra string, "
        "text_snippet string, rule_description string, rule_slug string",
    )
    row = cl.overlay_classification(cl.context_fields(df)).first()
    assert row["context"]["sector"] == "Banking" and row["context"]["text_snippet"] == "extra"
    assert row["hints"] == ["ind", " Banking "] and row["industry"] == "old" and row["description"] == "extra"


# --- enrichment ---------------------------------------------------------------

def test_enrichment_rules(spark):
    texts = [
        ("clima y sostenibilidad, great success", 0.5),
        ("clima: fraud and crisis", 0.5),
        ("clima", 0.5),
        ("clima y futbol", 0.5),
        ("nothing here", 0.5),
    ]
    df = spark.createDataFrame(texts, "text string, s double")
    out = ev.enrich_strength(
        df, F.col("text"), vocab.INCLUDE_KEYWORDS, vocab.EXCLUDE_KEYWORDS, vocab.VALENCE, F.col("s")
    )
    got = {r["text"]: r for r in out.collect()}
    assert set(got) == {t for t, _ in texts[:3]}
    good = got[texts[0][0]]
    compound = 5.8 / math.sqrt(5.8**2 + 15)
    assert good["climate_score"] == 0.85 and good["sentiment_label"] == "positive"
    assert good["signal_strength"] == pytest.approx(0.5 * 0.85 * (1 + round(compound, 4) / 2))
    assert got[texts[1][0]]["signal_strength"] < 0
    assert got[texts[2][0]]["signal_strength"] == pytest.approx(0.5 * 0.65 * 0.5)


# --- rollup --------------------------------------------------------------------

def _rollup_events(spark, rows):
    return rd.prepare_events(
        spark.createDataFrame(
            rows,
            "company_id string, company_qid string, company_name string, country string, industry string, "
            "signal_type string, source string, signal_strength double, climate_score double, "
            "sentiment_score double, ts timestamp",
        )
    )


def test_company_key_falls_back(spark):
    rows = [
        ("5", "Q1", "A", "ar", "x", "news", "s", 1.0, 0.5, 0.0, DAY),
        (None, "Q2", "B", "ar", "x", "news", "s", 1.0, None, 0.0, DAY),
        ("", "", "Big  Co", "ar", None, None, None, None, 1.0, 0.0, DAY),
        ("nan", None, None, "ar", "x", "news", "s", 1.0, 1.0, 0.0, DAY),
    ]
    got = [(r["company_key"], r["country"], r["weighted_strength"]) for r in _rollup_events(spark, rows).collect()]
    assert got == [("5", "AR", 0.5), ("Q2", "AR", 1.0), ("big_co", "AR", 0.0), ("unknown_company", "AR", 1.0)]


def test_ranking_keeps_the_winner_with_summed_events(spark):
    rows = [("1", "", "A", "BR", "x", "news", "s", 1.0, 1.0, 0.0, DAY)] * 3
    rows += [("1", "", "A", "AR", "x", "news", "s", 1.0, 1.0, 0.0, DAY)]
    rows += [("2", "", "B", "CL", "x", "news", "s", 1.0, 1.0, 0.0, dt.datetime(2024, 2, 20, tzinfo=UTC))]
    ranking = rd.recency_ranking(rd.company_rollup(_rollup_events(spark, rows), AS_OF), AS_OF).collect()
    assert [(r["company_key"], r["country"], r["total_events"]) for r in ranking] == [("1", "BR", 4), ("2", "CL", 1)]
    assert ranking[0]["priority_score"] == pytest.approx(3 * ranking[0]["recency_factor"])
    assert ranking[1]["recency_factor"] == 1.2  # a future event counts as today's


def test_sentiment_at_a_threshold_is_summed_in_event_order(spark):
    scores = [(k - 50) / 50.0 for k in (37, 3, 99, 12, 55, 61, 8, 70, 41, 14)]  # their mean is -0.2 but for rounding
    orders = [random.Random(i).sample(scores, 10) for i in range(8)]
    labels = ["negative" if functools.reduce(operator.add, o, 0.0) / 10 <= -0.2 else "neutral" for o in orders]
    assert set(labels) == {"negative", "neutral"}
    rows = [(str(c), "", "A", "BR", str(c), "news", "s", 1.0, 1.0, v, DAY) for c, o in enumerate(orders) for v in o]
    numbered = [(*r, i) for i, r in enumerate(rows)]
    columns = ["company_id", "company_qid", "company_name", "country", "industry", "signal_type", "source",
               "signal_strength", "climate_score", "sentiment_score", "ts", "event_id"]
    for arrived in (numbered, numbered[::-1], sorted(numbered, key=lambda r: r[9])):
        events = rd.prepare_events(spark.createDataFrame(arrived, columns))
        companies = rd.exact_sentiment(rd.company_rollup(events, AS_OF), events, ["event_id"])
        got = {r.industry: r.sentiment_label for r in rd.sentiment_distribution(companies).collect()}
        assert got == {str(c): label for c, label in enumerate(labels)}


def test_boost_is_capped(spark):
    df = spark.createDataFrame([(1,), (10**6,)], "n long")
    assert [r[0] for r in df.select(mx.volume_boost(F.col("n"))).collect()] == [pytest.approx(1 + 0.15 * math.log(2)), 1.8]


def test_empty_universe_empties_the_events(spark):
    events = _rollup_events(spark, [("1", "", "A", "BR", "x", "news", "s", 1.0, 1.0, 0.0, DAY)])
    nobody = rd.prepare_universe(spark.createDataFrame([], "company_id string, industry string, country string"))
    assert rd.only_universe(events, nobody).count() == 0


def test_all_null_country_gives_a_null_mode(spark):
    df = spark.createDataFrame(
        [(1, "A", None, "i", "news", DAY, "x", "y")],
        "event_id long, company_name string, country string, industry string, signal_type string, ts timestamp, "
        "description string, text_snippet string",
    )
    row = pr.summarise_prospects(df).first()
    assert row["country"] is None and row["justification"] == "signals: news | last_update: 2024-01-30 | x"


def test_theme_lists_take_outside_companies_only(spark):
    df = spark.createDataFrame(
        [(1, "5", "In", "CO", "energy_power_utilities", "news", DAY, "t", "d", "s"),
         (2, "ext::a", "Out", "CO", "x", "news", DAY, "Planta fotovoltáica", "d", "s"),
         (3, "102.0", "Float", "CO", "energy_power_utilities", "news", DAY, "t", "d", "s")],
        "event_id long, company_id string, company_name string, country string, industry string, signal_type string, "
        "ts timestamp, title string, description string, text_snippet string",
    )
    lists = pr.shipped_themes(df)
    assert [r["company_name"] for r in lists["renewables"].collect()] == ["Out"]
    assert lists["digital_assets"].count() == 0


def test_shipped_views_use_their_scope(spark):
    scores = spark.createDataFrame(
        [("1", "A", "CO", "energy_power", "m", 40.0, 1, ""), ("2", "B", "CO", "energy_power", "m", 39.99, 1, ""),
         ("3", "C", "AR", "ict_telecom", "m", 80.0, 1, "")],
        "company_id string, company_name string, country string, industry string, size_bin string, "
        "score_0_100 double, signals_count long, last_ts string",
    )
    views = it.shipped_views(scores)
    assert {n: [r["company_id"] for r in v.collect()] for n, v in views.items()} == {"solar": ["1"], "digital": ["3"]}


# --- sampling -----------------------------------------------------------------

def test_sample_never_passes_the_target_when_quotas_allow(spark):
    rows = [(f"Q{i:03d}", f"N{i}", "AR" if i % 3 else "BR", "oil_gas", float(i), "m", "", "") for i in range(90)]
    df = spark.createDataFrame(
        rows, "qid string, company_name string, country string, industry string, employees double, "
        "size_bin string, ticker string, company_domain string",
    )
    out = sp.stratified_sample(df, ["AR", "BR"], ["oil_gas"], total_target=70, min_per_stratum=5).collect()
    assert len(out) == 70
    counts = {c: sum(r["country"] == c for r in out) for c in ("AR", "BR")}
    assert counts == {"AR": 40, "BR": 30}  # a quota of 35, five left over from BR
    assert sorted(r["company_id"] for r in out) == list(range(1, 71))
    assert {round(r["weight_stratum"], 6) for r in out if r["country"] == "AR"} == {round(70 / (2 * 40), 6)}
    _, attempts = sp.sample_with_fallback(df, ["AR", "BR"], ["oil_gas"], [0, 300], 200, 5)
    assert [t for t, _ in attempts] == [0, 300] and attempts[0][1] == 90


def _scans(df) -> int:
    """Scans of files that the executed plan runs; a reused exchange runs none."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet", final))


def _pick_by_hand(rows, thresholds, countries, industries, target, floor):
    """The sample by plain loops: the best row of a qid, quotas, leftovers, largest employers."""
    def passes(r, t):
        e = r["employees"] or 0.0
        if t <= 0 or e >= t or (t <= 250 and r["size_bin"] in "ml") or (t > 250 and r["size_bin"] == "l"):
            return True
        return t <= 100 and bool(r["ticker"])

    out = []
    for t in thresholds:
        best = {}
        for r in sorted(rows, key=lambda r: (r["employees"] is None, -(r["employees"] or 0), r["company_name"])):
            if r["size_bin"] in "sml" and r["country"] in countries and r["industry"] in industries and passes(r, t):
                best.setdefault(r["qid"], r)
        strata = {}
        for c in countries:
            for i in industries:
                held = [r for r in best.values() if (r["country"], r["industry"]) == (c, i)]
                if held:
                    strata[c, i] = sorted(held, key=lambda r: (r["employees"] is None, -(r["employees"] or 0), r["qid"]))
        take = {k: min(len(v), max(floor, target // len(strata))) for k, v in strata.items()}
        need = max(0, target - sum(take.values()))
        for k in sorted(strata, key=lambda k: -(len(strata[k]) - take[k])):
            extra = min(need, len(strata[k]) - take[k])
            take[k] += extra
            need -= extra
        out = sorted(r["qid"] for k, v in strata.items() for r in v[: take[k]])
        if len(out) >= target:
            break
    return out


def test_sample_by_one_scan_equals_plain_loops(spark, tmp_path):
    rnd = random.Random(5)
    rows = [
        {
            "qid": f"Q{rnd.randrange(900):04d}", "company_name": f"N{i}", "country": rnd.choice(["AR", "BR", "BR", "CL", "PE"]),
            "industry": rnd.choice(["oil_gas", "mining", "other"]), "size_bin": rnd.choice(["s", "s", "m", "l", "x"]),
            # half unknown, and one frequent value, so that a cut falls among equal ones
            "employees": rnd.choice([None, None, 60.0, rnd.uniform(-2, 5000)]), "ticker": rnd.choice(["", "", "T"]),
        }
        for i in range(1500)
    ]
    path = str(tmp_path / "candidates")
    spark.createDataFrame(
        rows, "qid string, company_name string, country string, industry string, size_bin string, employees double, ticker string"
    ).write.parquet(path)
    frame = spark.read.parquet(path)
    countries, industries = ["AR", "BR", "CL"], ["oil_gas", "mining"]
    for thresholds, target, floor in (([0], 100, 5), ([4000, 300, 50], 250, 3), ([50, 5000], 10_000, 1), ([4000, 2000], 150, 40)):
        got = sp.fallback_sample(frame, countries, industries, thresholds, target, floor)
        assert _scans(got) == 1
        kept = got.orderBy("qid").collect()
        assert [r.qid for r in kept] == _pick_by_hand(rows, thresholds, countries, industries, target, floor)
        assert [r.company_id for r in kept] == list(range(1, len(kept) + 1))
    assert sp.fallback_sample(frame.limit(0), countries, industries, [300, 0], 10, 1).count() == 0


def test_prospects_by_one_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(
        [(1, "A", "co", "i", "news", DAY, "", "old"), (2, "A", "pe", "j", "jobs", DAY, " ", "<b>new</b>"),
         (3, "A", "PE", None, None, None, None, None), (4, "A", None, "j", "news", None, None, "undated"),
         (5, None, "PE", "j", "news", DAY, "x", "y"), (6, "B", "PE", "j", None, None, None, "")],
        "event_id long, company_name string, country string, industry string, signal_type string, ts timestamp, "
        "description string, text_snippet string",
    ).write.parquet(path)
    got = pr.summarise_prospects(spark.read.parquet(path))
    assert _scans(got) == 1
    first, second = got.collect()
    assert tuple(first)[:4] == ("A", "PE", "j", "jobs|news|unknown")
    # of one time the smaller id; undated ones come last
    assert first.justification == "signals: jobs, news, unknown | last_update: 2024-01-30 | old"
    assert tuple(second) == ("B", "PE", "j", "unknown", "signals: unknown")


def test_employee_mask(spark):
    df = spark.createDataFrame(
        [(120.0, "s", ""), (10.0, "m", ""), (10.0, "s", "T"), (None, "s", None), (10.0, "l", "")],
        "employees double, size_bin string, ticker string",
    )
    mask = lambda t: [r[0] for r in df.select(sp.employees_mask(t)).collect()]
    assert mask(100) == [True, True, True, False, True]
    assert mask(250) == [False, True, False, False, True]
    assert mask(500) == [False, False, False, False, True]


def test_first_match_tests_plain_alternatives_by_containment(spark):
    rules = [("a-?b|zinc ore|ü", "one"), (r"(x|y)z", "two"), ("[p|q]1|non[- ]?profit", "three"), (r"\bund\b", "four")]
    texts = ["ab", "a zinc ore", "mün", "yz", "|1", "non profit", "an und b", "grund", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(tx.first_match(F.col("t"), rules, "no").alias("r"))
    assert [r[0] for r in got.collect()] == ["one", "one", "one", "two", "three", "three", "four", "no", "no", "no"]
    plan = df.select(tx.first_match(F.col("t"), rules))._jdf.queryExecution().optimizedPlan().toString()
    assert "zinc ore)" in plan and "|zinc ore" not in plan


# --- documented methods -------------------------------------------------------

def test_bootstrap_covers_the_mean_and_repeats(spark, rows_of):
    df = spark.createDataFrame([("s", str(i), float(i % 10)) for i in range(300)], "g string, id string, v double")
    one = doc.bootstrap_interval(df, ["g"], "id", "v", 200)
    row = one.first()
    assert row["low"] < 4.5 < row["high"] and row["high"] - row["low"] < 1.5
    assert rows_of(one) == rows_of(doc.bootstrap_interval(df.repartition(7), ["g"], "id", "v", 200))


def test_poisson_counts_by_inversion(spark):
    for n in (1, 7, 300, 301, 5000, 250_000):
        places = [0.0, 1e-9, 0.025, 0.3, 0.5, 0.8, 0.975, 1 - 1e-9]
        frame = spark.createDataFrame([(float(n), u) for u in places], "n double, u double")
        got = [int(r[0]) for r in frame.select(doc.poisson(F.col("n"), F.col("u"))).collect()]
        # the distribution by ratios of its terms from twelve deviations below, made to sum to one
        low, high = max(0, int(n - 12 * math.sqrt(n))), int(n + 12 * math.sqrt(n) + 60)
        terms = [1.0]
        for k in range(low + 1, high):
            terms.append(terms[-1] * n / k)
        total, below, k, want = math.fsum(terms), 0.0, low, []
        for u in places:
            while u >= (below + terms[k - low]) / total:
                below, k = below + terms[k - low], k + 1
            want.append(k)
        # the first place is where the sum starts, which stands for all that weighs nothing
        assert got[1:] == want[1:], n


def test_poisson_table_gives_the_same_counts(spark):
    places = [0.0, 1e-9, 0.025, 0.3, 0.5, 0.8, 0.975, 1 - 1e-9, 1 - 2.0**-48]
    means = spark.createDataFrame([(float(n),) for n in (1, 7, 50, 300, 301, 5000)], "n double")
    table = doc.poisson_table(means, "n")
    frame = table.select("*", F.explode(F.array(*[F.lit(u) for u in places])).alias("u"))
    got = frame.select(doc.poisson(F.col("n"), F.col("u")).alias("a"), tx.let(F.col("u"), doc.poisson_of_table).alias("b"))
    assert got.count() == 54 and got.filter("NOT a <=> b").count() == 0


def test_bootstrap_draws_as_many_rows_as_values_and_keeps_ids_together(spark):
    rows = [("s", str(i % 5000), float(i % 4)) for i in range(20_000)]
    df = spark.createDataFrame([*rows, ("s", "x", None), ("t", "y", None)], "g string, id string, v double")
    plan = doc.bootstrap_interval(df, ["g"], None, "v", 300)
    row = plan.first()
    # the standard error of a mean of 20,000 values of deviation 1.118 is 0.0079
    assert row["low"] < 1.5 < row["high"] and 0.024 < row["high"] - row["low"] < 0.039 and plan.count() == 1
    together = doc.bootstrap_interval(df, ["g"], "id", "v", 300).first()
    # four rows of an id have one value: 5,000 units, twice the error
    assert 0.048 < together["high"] - together["low"] < 0.078


def test_description_priority(spark):
    df = spark.createDataFrame([("bcorp", "Food", "Sells bread. Sells bread.", "", "snippet")], "a string, b string, c string, d string, e string")
    got = df.select(ev.priority_description(*[F.col(c) for c in "abcde"])).first()[0]
    assert got == "BCORP: Sells bread. | Sector: Food | snippet"


# --- discovery ----------------------------------------------------------------

def test_registry_order_region_and_alias_owner(spark):
    cols = "company_id string, company_name string, country string, industry string"
    u = spark.createDataFrame([("1", "Árbol Ltda", "AR", "a"), ("2", "Fuera", "US", "a"), ("3", " ", "AR", "a")], cols)
    e = spark.createDataFrame([("ext::1", "arbol ltda", "BR", "b"), ("ext::2", "Arbol Inc", "", "b")], cols)
    known = dc.known_companies([u, e])
    assert {r["company_id"] for r in known.collect()} == {"1", "ext::2"}
    owners = {r["alias_key"]: r["company_id"] for r in dc.alias_registry(known).collect()}
    assert owners == {"arbol ltda": "1", "arbol": "ext::2", "arbol inc": "ext::2"}
    asked = spark.createDataFrame([("ARBOL LTDA",), ("Árbol Corp",), ("Otro",)], "org string")
    got = {r["org"]: r["company_id"] for r in dc.match_organisations(asked, "org", dc.alias_registry(known)).collect()}
    assert got == {"ARBOL LTDA": "1", "Árbol Corp": "ext::2"}


def test_company_industry_lookup(spark):
    table = spark.createDataFrame(
        [("Banco del Norte", "finance", ["BN"]), ("Minera Sur", "mining", [])],
        "company_name string, industry string, aliases array<string>",
    )
    names = spark.createDataFrame([("Minera Sur",), ("BN",), ("Norte del Bancoo",), ("zzz",)], "name string")
    got = {r["name"]: r["industry"] for r in dc.map_company_industry(names, "name", table).collect()}
    assert got == {"Minera Sur": "mining", "BN": "finance", "Norte del Bancoo": "finance", "zzz": "unknown"}


def test_term_lists():
    assert tx.dedupe_terms(["A", "a ", "", "b"]) == ["A", "b"]
    assert tx.expand_terms(["solar", "SOLAR", "x"])[:2] == ["solar", "fotovoltaica"]
    assert tx.expand_terms(["x"]) == ["x"]


def test_ids_tell_long_names_apart(spark):
    from foghorn.functions import text as tx
    from foghorn.plans.events import external_id
    from pyspark.sql import functions as F

    names = ["x" * 70 + " uno", "x" * 70 + " dos", "日本", "中国", "", "Unknown"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    ids = df.select(
        external_id(F.lit("ungc"), F.col("name"), F.lit("AR")), tx.prefixed_hash_id("sbti", F.col("name")),
        tx.slug_path("name"),
    ).collect()
    assert len({r[0] for r in ids}) == len({r[1] for r in ids}) == len(names)
    assert len({r[2] for r in ids[:2]}) == 2


def test_profile_extremes_keep_their_type(spark):
    from foghorn.operators.profile import column_profile

    df = spark.createDataFrame([(9, -10.5), (100, -2.0), (None, 3.25)], "a int, b double")
    got = {r["column"]: (r["smallest"], r["largest"], r["samples"], r["non_null"]) for r in column_profile(df, ["a", "b"]).collect()}
    assert got == {"a": ("9", "100", "100 | 9", 2), "b": ("-10.5", "3.25", "-10.5 | -2.0 | 3.25", 3)}


# --- registry names in text, stored answers ---------------------------------------------------------


def _brute_mentions(texts, names):
    fold = lambda t: re.findall("[a-z0-9]+", unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode().lower())
    known = {}
    for cid, name in names:
        if name is not None and fold(name):
            known.setdefault(tuple(fold(name)), []).append(cid)
    out = []
    for i, text in texts:
        words, at = fold(text), 0
        while at < len(words):
            sizes = [n for n in range(len(words) - at, 0, -1) if tuple(words[at : at + n]) in known]
            out.extend((i, at, sizes[0], c) for c in (known[tuple(words[at : at + sizes[0]])] if sizes else []))
            at += sizes[0] if sizes else 1
    return sorted(out)


@pytest.mark.parametrize("limit", [None, 0])
def test_registry_mentions_equal_brute_force(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(registry_text, "BROADCAST_ROW_LIMIT", limit)
    rnd = random.Random(2)
    words = ["banco", "del", "Norte", "andes", "Minería", "x", "sur"]
    names = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 5)))) for i in range(25)]
    names += [(90, "Banco"), (91, "BANCO"), (92, "--"), (93, None), (94, "del, norte")]
    texts = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, k=rnd.randint(0, 40)))) for i in range(40)]
    texts += [(50, None), (51, ""), (52, "banco"), (53, "El BANCO-del-norte")]
    t = spark.createDataFrame(texts, "t int, body string")
    n = spark.createDataFrame(names, "company int, spelling string")
    got = registry_text.registry_mentions(t, "t", "body", n, "spelling")
    rows = sorted((r["t"], r["first_word"], r["n_words"], r["company"]) for r in got.collect())
    assert rows == _brute_mentions(texts, names)
    assert registry_text.registry_mentions(t, "t", "body", n.limit(0), "spelling").count() == 0
    assert registry_text.registry_mentions(t.limit(0), "t", "body", n, "spelling").count() == 0


def test_repeated_stored_answers_give_one_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, text string")
    key = tx.payload_key(F.col("text"))
    stored = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("a", "new", 2)], "text string, answer string, at int")
    done, todo = cl.reuse_stored(df, ["text"], stored.select(key.alias("payload_key"), "answer", "at"), "at")
    assert sorted((r["id"], r["answer"]) for r in done.collect()) == [(1, "new"), (3, "new")]
    assert [r["id"] for r in todo.collect()] == [2]
