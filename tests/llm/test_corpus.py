"""Corpus operators against brute force, round trips and SQL, with odd rows of every kind."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foghorn.llm import (
    bpe, centroids, chat, divergence, licence_texts, licences, lines, naming, neighbours, packing, ranked, simhash,
    superminhash, toxicity,
)
from foghorn.llm.common import SPACES, documents, one_text_each, table
from foghorn.llm.components import connected_components
from foghorn.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, _row string, name int, score string"
WORDS = "the of and to in is that it was for with as on be at by this are from or an".split()


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS + ["river", "mountain", "walking", "slowly", "people"]) for _ in range(n))


ODD = [
    (1, None, "en", "x", 1, "s"),
    (2, "", None, None, None, None),
    (3, " \t\n\r\x0b\x0c ", "en", "x", 1, "s"),
    (4, prose(120, 1), "en", "x", 1, "s"),
    (5, prose(120, 1), "en", "x", 1, "s"),
    (5, prose(120, 1), "en", "x", 1, "s"),
    (6, prose(119, 1) + " ending", None, "x", 1, "s"),
    (None, "one two", "xx", None, 2, None),
    (None, None, "xx", None, 2, None),
    (9, "Ünï çødé 😀 <|endoftext|> a\x1cb c\x00", "de", "x", 1, "s"),
    (10, prose(3000, 2) + "\n" + "é" * 30000, "fr", "x", 1, "s"),
    (11, "spam spam spam " * 60, "en", "x", 1, "s"),
    (12, "", None, "x", 1, "s"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (11, 0, 1), (6, 1, 0), (None, 1, 1), (5, None, None)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF)


# --- every query -----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, SF)
    assert ok, note


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_empty_tables(empty, labels):
    assert lines.line_classes(empty).count() == 0
    assert naming.exact_duplicates(empty).count() == 0
    assert neighbours.score_documents(empty, labels).count() == 0
    assert divergence.judge_documents(empty).count() == 0
    assert licences.scan_licences(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert toxicity.score_documents(empty, labels).count() == 0
    assert bpe.round_trip_digests(empty, PATH).count() == 0
    assert packing.pack_examples(empty, PATH).count() == 0
    assert superminhash.near_duplicates(empty).count() == 0


def test_stages_keep_columns(odd, empty, labels):
    for stage in (
        lambda d: toxicity.keep_civil(d, labels),
        divergence.keep_regular,
        naming.drop_exact_duplicates,
        simhash.keep_one_per_component,
        lines.drop_fuzzy_lines,
    ):
        assert stage(odd).columns == odd.columns
        assert stage(empty).count() == 0


# --- op1 -------------------------------------------------------------------------------------------


def brute_lines(rows, s=lines.Settings()):
    first, place = {}, {}
    for i, t in sorted(rows):
        for n, line in enumerate((t or "").split("\n")):
            if line.strip(SPACES):
                place[(i, n)] = line
                first.setdefault(line, (i, n))
    names = list(first)
    sets = [lines.shingles(x, s.shingle) for x in names]
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            if lines.similarity(sets[i], sets[j]) >= s.similarity:
                root[find(i)] = find(j)
    best = {}
    for i, x in enumerate(names):
        best[find(i)] = min(best.get(find(i), first[x]), first[x])
    at = {x: i for i, x in enumerate(names)}
    return {p: best[find(at[x])] for p, x in place.items()}


def found_lines(frame):
    return {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in frame.collect()}


def test_lines_against_brute_force(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").limit(60).collect()]
    part = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string")
    assert found_lines(lines.line_classes(part)) == brute_lines(rows)


def test_sketches_never_part_similar_lines():
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdé ", k=k)) for k in (1, 5, 6, 7, 40, 300, 5000)]
    found = base + [x[:at] + "z" + x[at + 1 :] for x in base for at in (0, len(x) // 2)] + ["", "aaaaaaaaaaaaaaaa"]
    bits, sizes = lines.sketches(found, 6)
    for i, x in enumerate(found):
        for j, y in enumerate(found):
            a, b = lines.shingles(x, 6), lines.shingles(y, 6)
            assert (bits[i] ^ bits[j]).bit_count() <= len(a ^ b)
            assert len(a) <= sizes[i] and len(b) <= sizes[j]


@pytest.mark.parametrize("cell", [8, 256])
def test_lines_of_one_large_group(spark, monkeypatch, cell):
    rnd = random.Random(4)
    words = prose(30, 7).split()
    rows = []
    for i in range(120):
        own = list(words)
        own[rnd.randrange(30)] = f"w{rnd.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(lines.candidate_sets, "__defaults__", (cell,))
    found = found_lines(lines.line_classes(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert found == brute_lines(rows)


def test_lines_of_odd_rows(odd):
    got = lines.line_classes(odd).collect()
    texts = collections.Counter(line for r in ODD for line in (r[1] or "").split("\n") if line.strip(SPACES))
    assert len(got) == sum(texts.values())
    assert sum(r.kept for r in got) == len({(r.keep_doc_id, r.keep_line_no) for r in got})


# --- op2 -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [4, 64, 2048])
def test_exact_duplicates_of_odd_rows(odd, block):
    got = naming.exact_duplicates(odd, block_bytes=block).collect()
    groups = collections.defaultdict(list)
    for r in ODD:
        groups[hashlib.sha256((r[1] or "").encode()).hexdigest()].append(r[0])
    assert len(got) == len(ODD)
    kept = collections.Counter()
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_hot_blocks_take_the_broadcast_path(spark, monkeypatch):
    monkeypatch.setattr(naming, "HOT_VALUES", 4)
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(200)]
    got = naming.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), block_bytes=4)
    sizes = {r.doc_id: r.group_size for r in got.collect()}
    assert sizes == {i: (133 if i % 3 else 1) for i in range(200)} or sizes[1] == sum(1 for i in range(200) if i % 3)


def test_names_do_not_confuse_lengths(spark):
    rows = [(0, "ab"), (1, "abab"), (2, "ababab"), (3, "ab\x00"), (4, "ab"), (5, "abababab")]
    got = naming.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), block_bytes=2)
    assert {r.doc_id for r in got.collect() if r.group_size == 1} == {1, 2, 3, 5}


# --- op3, op8 --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "module, label, fold, least",
    [(neighbours, "quality", (4, 2), 0.95), (toxicity, "toxic", (5, 0), 0.93)],
)
def test_held_out_accuracy(spark, module, label, fold, least):
    sf = "/root/testdata/sf0.1"
    known = table(spark, sf, "labels")
    part = documents(spark, sf).join(known.select("doc_id"), "doc_id", "left_semi")
    got = module.score_documents(part, known).join(known, "doc_id").filter("held_out").toPandas()
    assert got.score.between(0, 1).all()
    assert (got.predicted == got[label]).mean() >= least
    clean = got[got[label] == (1 if label == "quality" else 0)]
    assert (clean.predicted == clean[label]).mean() >= 0.98
    assert fold


@pytest.mark.parametrize("module", [neighbours, toxicity])
def test_scores_of_odd_rows(odd, labels, module):
    got = module.score_documents(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    none = module.score_documents(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    again = {(r.doc_id, r.score) for r in module.score_documents(odd, labels).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_machine_learns_a_pair():
    """Neither word alone tells the label, only both together."""
    rnd = random.Random(1)
    s = toxicity.Settings(least_rows=1, epochs=60)
    texts = [rnd.choice([("alpha", 0), ("beta", 0), ("alpha beta", 1), ("gamma", 0)]) for _ in range(1200)]
    rows = [toxicity.buckets(t, s) for t, _ in texts]
    model = toxicity.Machine(s).fit(rows, np.array([y for _, y in texts], np.float32))
    scores = model.score([toxicity.buckets(t, s) for t in ("alpha", "beta", "alpha beta", "gamma")])
    assert scores[2] > 0.9 and max(scores[[0, 1, 3]]) < 0.1


# --- op4 -------------------------------------------------------------------------------------------


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    n = collections.Counter(windows)
    again = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    full = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(again)


def test_base_rules_of_odd_rows(odd):
    got = divergence.judge_documents(odd).collect()
    want = collections.Counter((r[0], *base_counts(r[1] or "")) for r in ODD)
    assert collections.Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_distance_is_a_distance(spark):
    p = [0.5, 0.25, 0.25, 0.0]
    frame = spark.createDataFrame([(p, [0.0, 0.0, 0.0, 1.0])], "a array<double>, b array<double>")
    r = frame.select(divergence.js_distance(frame["a"], p), divergence.js_distance(frame["b"], p)).first()
    assert r[0] == 0.0 and r[1] == 1.0


def test_text_without_common_words_is_rejected_by_that_alone(spark, docs):
    known = {r.doc_id for r in divergence.judge_documents(docs).filter("kept AND n_words >= 150").collect()}
    source = docs.filter(docs["lang"] == "en").filter(docs["doc_id"].isin(sorted(known))).orderBy("doc_id").first()
    shift = str.maketrans("abcdefghijklmnopqrstuvwxyz", "fghijklmnopqrstuvwxyzabcde")
    new = lambda m: m[0].lower().translate(shift) if m[0].lower() in divergence.WORDS else m[0]
    invented = re.sub(r"[^ \t-\r]+", new, source.text)
    assert not {w.lower() for w in re.split(r"[ \t-\r]+", invented)} & set(divergence.WORDS)
    other = spark.createDataFrame([(-1, invented, None)], "doc_id bigint, text string, lang string")
    rows = docs.select("doc_id", "text", "lang").unionByName(other)
    got = {r.doc_id: r for r in divergence.judge_documents(rows).filter(F.col("doc_id").isin(-1, source.doc_id)).collect()}
    assert got[source.doc_id].kept and not got[-1].kept
    assert not got[-1].base_failed and got[-1].class_distance <= divergence.Rules().max_class_distance
    assert {r.doc_id for r in divergence.keep_regular(rows).filter(F.col("doc_id") == -1).collect()} == set()


POLISH = """Rano na rynku miasteczka pojawiają się pierwsi sprzedawcy, którzy rozkładają stoiska z warzywami, serem i chlebem.
Starsza kobieta przynosi kosz jabłek z ogrodu za rzeką, jej sąsiad ustawia słoiki miodu, chłopcy pomagają nosić skrzynki.
Około dziewiątej przyjeżdża autobus z pobliskiej wsi i robi się gwarno, bo wszyscy chcą kupić świeże ryby, zanim znikną.
Po południu ruch powoli słabnie, gołębie zbierają okruchy spod stołów, muzykant przy fontannie gra dawne melodie. Wieczorem
zapalają się latarnie, kawiarnia wystawia krzesła przed drzwi, młodzi rozmawiają o meczu, starsi wspominają zimę, która
przed laty zasypała całą drogę. Kiedy zegar na wieży wybija dziesiątą, ulice pustoszeją, okna gasną jedno po drugim i słychać
tylko szum wody pod mostem oraz daleki gwizd pociągu, jadącego nocą przez lasy ku morzu."""


def test_words_of_a_language_without_reference_are_not_judged(spark, docs):
    invented = " ".join("".join(random.Random(i).choices("bcdghjkmpqvwxz", k=5)) for i in range(150))
    others = [(-1, POLISH, "pl"), (-2, POLISH, "en"), (-3, POLISH, None), (-4, invented, "en"), (-5, "# | " * 200 + invented, "pl")]
    rows = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(others, "doc_id bigint, text string, lang string")
    )
    got = divergence.judge_documents(rows)
    own = {r.doc_id: r for r in got.filter("doc_id < 0").collect()}
    assert own[-1].word_distance > divergence.Rules().max_word_distance and not own[-1].base_failed
    assert {i: r.kept for i, r in own.items()} == {-1: True, -2: False, -3: False, -4: False, -5: False}
    assert {r.doc_id for r in divergence.keep_regular(rows).filter("doc_id < 0").collect()} == {-1}
    con = duckdb.connect()
    con.register("documents", rows.toArrow())
    want = {r[0]: r[-1] for r in con.execute(divergence.judge_sql()).fetchall()}
    assert want == {r.doc_id: r.kept for r in got.collect()}


# --- op5 -------------------------------------------------------------------------------------------


def test_licence_in_other_dress(spark):
    mit = next(t for name, t in licences.KNOWN if name == "MIT" and len(t) > 100)
    dressed = "MIT Licence\n\nCopyright (c) 2019 Jane Doe\n" + mit.split("\n", 1)[1].upper().replace(".", " . ")
    rows = [(1, dressed), (2, dressed + " more"), (3, "text\nreleased under the  MIT licence!!\nmore"), (4, None)]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.license, r.line_licenses) for r in got} == {
        1: ("MIT", ""), 2: (None, ""), 3: (None, "MIT"), 4: (None, "")
    }


def test_common_licences_headers_and_tags(spark):
    full = {n: (licence_texts.FOLDER / f"{n}.txt").read_text() for n in ("Apache-2.0", "GPL-3.0-only", "BSD-3-Clause")}
    rows = [
        (1, full["Apache-2.0"], "Apache-2.0"),
        (2, full["GPL-3.0-only"].replace("\n", "\n  "), "GPL-3.0-only"),
        (3, "Copyright (c) 2020, A. Person\nAll rights reserved.\n\n" + full["BSD-3-Clause"], "BSD-3-Clause"),
        (4, "// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        (5, "a\nThis library is free software; you can redistribute it and/or modify it under the terms of the GNU "
            "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
            "License, or (at your option) any later version.\nb", "LGPL-2.1-or-later"),
        (6, "a\nThis work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.\nb", "CC-BY-SA-4.0"),
    ]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = {r.doc_id: r.license or r.line_licenses for r in licences.scan_licences(frame).collect()}
    assert got == {i: want for i, _, want in rows}


def test_no_known_form_names_two_licences(spark):
    known = spark.createDataFrame(licences.KNOWN, "license string, text string")
    forms = known.groupBy(licences.canonical(F.col("text")).alias("form")).agg(F.collect_set("license").alias("names"))
    assert [r.names for r in forms.filter(F.size("names") > 1).collect()] == []


def test_licences_of_odd_rows(odd):
    assert licences.scan_licences(odd).count() == len(ODD)


# --- op6 -------------------------------------------------------------------------------------------


def brute_marks(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(marks):
    nodes = sorted(set(marks))
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[:i]:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    return {x: find(x) for x in nodes}


def test_simhash_against_brute_force(docs, odd):
    for frame in (docs, odd):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        marks = [brute_marks(t) for _, t in rows]
        roots = brute_components(marks)
        least = {}
        for (i, _), m in zip(rows, marks, strict=True):
            if i is not None:
                least[roots[m]] = min(least.get(roots[m], i), i)
        want = collections.Counter((i, m, least.get(roots[m])) for (i, _), m in zip(rows, marks, strict=True))
        got = simhash.near_duplicates(frame).collect()
        assert collections.Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_one_row_per_component_without_or_with_repeated_ids(spark):
    far = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcde"]  # no two share a word
    for i, x in enumerate(far):
        assert all((simhash.fingerprint(x) ^ simhash.fingerprint(y)).bit_count() > 4 for y in far[:i])
    rows = [
        (None, far[0], "x"), (None, far[0], "x"), (None, far[0], "y"),  # copies without an id: one stays
        (None, far[1], "x"),
        (None, far[2], "x"), (7, far[2], "x"),  # the numbered one stays
        (5, far[3], "x"), (9, far[3], "x"),  # 5 names two groups with different texts
        (5, far[4], "x"), (5, far[4].upper(), "x"), (3, far[4], "x"), (3, far[4], "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, name string")
    got = simhash.keep_one_per_component(frame).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(None, far[0]), (None, far[1]), (7, far[2]), (5, far[3]), (3, far[4])], key=repr
    )


@pytest.mark.parametrize("cell", [32, 1024])
def test_links_of_dense_groups(spark, cell):
    rnd = random.Random(3)
    marks = set()
    for center in (rnd.getrandbits(64), rnd.getrandbits(64)):
        for _ in range(150):
            x = center
            for _ in range(rnd.randint(0, 8)):
                x ^= 1 << rnd.randrange(64)
            marks.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in marks]
    found = connected_components(simhash.links(spark.createDataFrame(signed, "fp bigint"), 4, cell)).collect()
    got = {r.node & (1 << 64) - 1: r.root for r in found}
    want = brute_components(marks)
    groups = lambda of: sorted(sorted(g) for g in _by(of, marks))
    assert groups(lambda x: got.get(x, ("alone", x))) == groups(want.get)


def _by(key, items):
    out = collections.defaultdict(list)
    for x in items:
        out[key(x)].append(x)
    return out.values()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001), (2001, 2002), (None, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 2000: 2000, 2001: 2000, 2002: 2000}


# --- op7 -------------------------------------------------------------------------------------------


def test_chat_round_trip_of_odd_turns(spark):
    rows = [
        (1, 0, "to\\ol</s>[/ROLE]\n", "\\0;\\e<s>[ROLE]x"),
        (1, 1, None, None),
        (1, 1, "user", "[INST"),
        (1, None, "assistant", "]\\</s"),
        (2, 0, "user", "hi"),
        (2, 1, "assistant", "<s></s>[/INST] yo"),
        (None, 0, "system", ""),
    ]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = made.select("conv_id", "valid", chat.read_back(made["formatted"]).alias("t"), chat.loss_text(made["segments"]).alias("x"))
    got = {r.conv_id: (r.valid, [tuple(t) for t in r.t], r.x) for r in got.collect()}
    assert got[1] == (False, [("assistant", "]\\</s"), ("to\\ol</s>[/ROLE]\n", "\\0;\\e<s>[ROLE]x"), ("", ""), ("user", "[INST")], "]\\</s")
    assert got[2] == (True, [("user", "hi"), ("assistant", "<s></s>[/INST] yo")], "<s></s>[/INST] yo")
    assert got[None] == (False, [("system", "")], "")


# --- op9 -------------------------------------------------------------------------------------------

REFERENCE = Tokenizer.from_file(PATH)
REFERENCE.no_truncation()
REFERENCE.no_padding()
VOCABULARY = bpe.Vocabulary(PATH)


def same_as_library(texts):
    for text, ids in zip(texts, bpe.Encoder(VOCABULARY).encode(texts), strict=True):
        want = REFERENCE.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert bpe.decode(VOCABULARY, ids).decode() == REFERENCE.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_encoding_of_any_text(texts):
    same_as_library(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abc ABC'stredvml<|>Σσς́é\x1c\x85 2!.\n\x00", max_size=60), max_size=6))
def test_encoding_of_odd_letters(texts):
    same_as_library([*texts, "<|endoftext|>".join(texts), "<|ENDOFTEXT|>", "a" * 500, "ab" * 300 + " " + "!" * 400])


def test_encoding_of_documents(docs, odd, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    same_as_library([r.text for r in docs.select("text").limit(80).collect()] + [r[1] or "" for r in ODD])
    got = bpe.round_trip_digests(odd, PATH).collect()
    for r, row in zip(sorted(got, key=repr), sorted(got, key=repr), strict=True):
        assert r == row
    lengths = collections.Counter((r[0], len(REFERENCE.encode(r[1] or "", add_special_tokens=False).ids)) for r in ODD)
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == lengths


def test_decoding_of_encoded_documents(odd):
    back = bpe.decode_documents(bpe.encode_documents(odd, PATH), PATH)
    want = [REFERENCE.decode(REFERENCE.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in ODD]
    assert sorted(r.text for r in back.collect()) == sorted(want)


# --- op10 ------------------------------------------------------------------------------------------


def check_places(pieces, limits):
    by = collections.defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
    padded = total = 0
    for rows in by.values():
        rows.sort(key=lambda p: p.offset)
        at = 0
        for p in rows:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits.tokens and len(rows) <= limits.segments
        assert sum(p.loss_tokens for p in rows) <= limits.loss_tokens
        total += at
        padded += at if at & (at - 1) == 0 else limits.tokens
    return 1 - total / padded


def test_packing_of_documents(docs, odd):
    import zlib

    limits = packing.Limits()
    for frame in (docs, odd):
        pieces = packing.pack_examples(frame, PATH, limits).collect()
        assert check_places(pieces, limits) < 0.02
        if frame is docs:
            ids = {r.doc_id: [*REFERENCE.encode(r.text, add_special_tokens=False).ids, 1] for r in docs.collect()}
            seen = collections.Counter()
            for p in pieces:
                own = ids[p.doc_id]
                assert p.doc_tokens == len(own)
                assert p.ids_crc32 == zlib.crc32(np.array(own[p.start : p.start + p.length], "<u4").tobytes())
                seen.update((p.doc_id, i) for i in range(p.start, p.start + p.length))
            assert set(seen.values()) == {1} and len(seen) == sum(map(len, ids.values()))
        else:
            ids = sum(len(REFERENCE.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ODD)
            assert sum(p.length for p in pieces) == ids


def test_packing_under_all_limits():
    rnd = random.Random(2)
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=40, min_piece=4, block=50)
    packer = packing.Packer(limits, 0)
    sizes = [rnd.randint(1, 200) for _ in range(300)]
    for at in range(0, 300, 50):
        packer.add(
            [(i, np.arange(sizes[i], dtype=np.uint32), np.arange(sizes[i]) >= sizes[i] // 3) for i in range(at, at + 50)]
        )
    packer.finish()
    Piece = collections.namedtuple("Piece", "key start length crc sequence_id offset loss_tokens")
    pieces = [Piece(*p) for p in packer.pieces]
    check_places(pieces, limits)
    assert collections.Counter(p.key for p in pieces).keys() == set(range(300))
    for i in range(300):
        own = sorted((p.start, p.length) for p in pieces if p.key == i)
        assert own[0][0] == 0 and sum(n for _, n in own) == sizes[i]
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    for p in pieces:
        assert p.loss_tokens == (np.arange(sizes[p.key]) >= sizes[p.key] // 3)[p.start : p.start + p.length].sum()


def test_short_examples_are_packed_without_padding():
    for length in (1, 10, 31):
        packer = packing.Packer(packing.Limits(), 0)
        for at in range(0, 6400, 800):
            packer.add([(i, np.arange(length, dtype=np.uint32), None) for i in range(at, at + 800)])
        packer.finish()
        held = collections.defaultdict(list)
        for _, _, n, _, sequence, offset, _ in packer.pieces:
            assert offset == sum(held[sequence])
            held[sequence].append(n)
        totals = [sum(pieces) for pieces in held.values()]
        assert sum(totals) == 6400 * length and max(map(len, held.values())) <= 64
        padded = sum(n if n & (n - 1) == 0 else 2048 for n in totals)
        assert padded / (6400 * length) < 1.02


def test_loss_of_a_cut_example_is_that_of_its_pieces():
    packer = packing.Packer(packing.Limits(), 0)
    packer.add([(0, np.arange(100, dtype=np.uint32), np.arange(100) >= 80)])
    packer.finish()
    assert [(p[1], p[2], p[6]) for p in packer.pieces] == [(0, 64, 0), (64, 32, 16), (96, 4, 4)]


def test_packing_of_conversations_under_token_segment_and_loss_limits(spark):
    """Instruction data: the prompt bears no loss; limits on loss and segments bind."""
    frame = spark.read.parquet(f"{SF}/conversations.parquet").groupBy("conv_id").agg(
        F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("role") != "assistant", F.col("text"))))).alias("asked"),
        F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.col("text"))))).alias("said"),
    )
    frame = frame.select(
        "conv_id", F.concat_ws(" ", "asked", "said").alias("text"), F.size(F.split("asked", " ")).alias("prompt")
    ).orderBy("conv_id").coalesce(2)
    rows = {r.conv_id: r for r in frame.collect()}
    limits = packing.Limits(tokens=512, segments=6, loss_tokens=200)
    pieces = packing.pack_examples(
        frame, PATH, limits, id_col="conv_id", prompt_tokens=F.col("prompt")
    ).collect()
    check_places(pieces, limits)
    for p in pieces:
        flags = np.arange(p.doc_tokens) >= rows[p.doc_id].prompt
        assert p.loss_tokens == flags[p.start : p.start + p.length].sum()
    assert sum(p.length for p in pieces) == sum(
        len(REFERENCE.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows.values()
    )


# --- op11 to op13, and bounds ---------------------------------------------------------------------


def test_encoder_takes_more_distinct_words_than_its_table_begins_with():
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789"
    words = ["".join(w) for w in itertools.islice(itertools.product(alphabet, repeat=4), 1_200_000)]
    random.Random(1).shuffle(words)
    text = " ".join(words)
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    got = next(iter(bpe.Encoder(bpe.Vocabulary(PATH)).encode([text])))
    assert np.array_equal(got, library.encode(text, add_special_tokens=False).ids)


def test_sample_bounds_documents_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, prose(30, i)) for i in range(200)] + [(3, prose(40, 1))], "doc_id bigint, text string")
    given = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    joined = docs.select(F.col("doc_id").alias("_id"), "text").join(given.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")), "_id")
    rows = {r["_id"]: (r["label"], r["text"]) for r in one_text_each(joined).collect()}
    first = min((prose(30, i) for i in range(200)), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert rows == {1: (0, first), 3: (0, prose(40, 1))}
    for module in (neighbours, toxicity):
        assert module.score_documents(docs, given).count() == 201


VECTORS = "vec_id bigint, embedding array<float>, cluster string, x int"


def brute_clusters(rows, s):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == s.dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(float(np.float32(x)) * s.scale) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{s.salt}:{r[0]}".encode()).hexdigest(), r[1])
    means = [v for _, v in sorted(kept, key=key)[: s.clusters]]
    gap = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m))
    near = lambda v: min((gap(v, m), k) for k, m in enumerate(means))
    for _ in range(s.rounds):
        own = [near(v)[1] for _, v in kept]
        for k in range(len(means)):
            group = [v for (_, v), c in zip(kept, own) if c == k]
            if group:
                means[k] = [sum(x) // len(group) for x in zip(*group)]
    found = [near(v) for _, v in kept]
    inertia = collections.Counter()
    for d, k in found:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    out = [(i, k, d, inertia[k], sum(inertia.values()), sha[k]) for (i, _), (d, k) in zip(kept, found)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [3, 4096])
def test_clusters_equal_brute_force(spark, block, monkeypatch):
    rnd = random.Random(4)
    s = centroids.Settings(clusters=3, dimensions=4, rounds=4)
    rows = [(i, [rnd.choice([-1.5, 0.25, rnd.uniform(-1, 1)]) for _ in range(4)]) for i in range(40)]
    rows += [(None, [0.1] * 4), (5, [0.1] * 4), (5, [0.1] * 4), (6, None), (7, []), (8, [1.0, None, 0.0, 0.0])]
    rows += [(9, [float("nan")] * 4), (10, [float("inf"), 0.0, 0.0, 0.0]), (11, [1.0] * 5)]
    monkeypatch.setattr(centroids.blocks, "__defaults__", (block,))
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], VECTORS)
    got = centroids.cluster_vectors(df, s)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_clusters(rows, s)
    few = [(1, [0.5] * 4), (1, [0.5] * 4)]
    got = centroids.cluster_vectors(spark.createDataFrame([(i, v, "c", 1) for i, v in few], VECTORS), s)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_clusters(few, s)


def test_huge_components_count_as_the_largest(spark):
    s = centroids.Settings(clusters=2, dimensions=2, rounds=1)
    df = spark.createDataFrame([(1, [3e38, -3e38]), (2, [0.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert {r["distance"] for r in centroids.cluster_vectors(df, s).collect()} == {0}
    assert centroids.cluster_vectors(df.limit(0), s).count() == 0


def super_minhash(items, length):
    """The signature of one set, an element and a step at a time."""
    word = lambda x: x & 0xFFFFFFFFFFFFFFFF

    def mixed(x):
        x = word((x ^ x >> 30) * 0xBF58476D1CE4E5B9)
        x = word((x ^ x >> 27) * 0x94D049BB133111EB)
        return x ^ x >> 31

    least = [(1 << 64) - 1] * length
    for item in items:
        order = list(range(length))
        for step in range(length):
            drawn = mixed(word(item + (step + 1) * 0x9E3779B97F4A7C15))
            other = step + (drawn & 0xFFFFFFFF) % (length - step)
            order[step], order[other] = order[other], order[step]
            least[order[step]] = min(least[order[step]], (step << 32) + (drawn >> 32))
    return least


def test_signatures_equal_the_walk_of_each_element():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 7, 60, 400)]
    got = superminhash.signatures(sets, 24)
    assert [row.tolist() for row in got] == [super_minhash(x.tolist(), 24) for x in sets]
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2000], rng.integers(0, 1 << 63, 1000, dtype=np.uint64)])
    x, y = superminhash.signatures([a, b], 2048)
    assert abs((x == y).mean() - 0.5) < 0.04


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 600), st.integers(0, 200), st.integers(0, 2**32))
def test_sketches_never_exceed_the_difference(n, apart, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    b = np.concatenate([a[apart:], rng.integers(0, 1 << 63, apart, dtype=np.uint64)]) if apart < n else a[:1]
    x, y = superminhash.parity_sketch(a), superminhash.parity_sketch(b)
    size = min(len(x), len(y))
    bits = int(np.bitwise_count(superminhash._folded(x, size) ^ superminhash._folded(y, size)).sum())
    assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def brute_near(rows, k=4):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.setdefault(find(i), doc)
        if doc is not None and (known is None or doc < known):
            least[find(i)] = doc
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("cell", [1024, 16])
def test_minhash_dedup_equals_brute_force(spark, cell):
    rnd = random.Random(11)
    rows = [(r[0], r[1]) for r in ODD] + [(20, "a b c"), (21, "A  B\nc"), (22, "a b"), (23, "b c")]
    for group, size, edits in ((0, 60, 4), (1, 40, 6), (2, 3, 1)):
        base = prose(140, 100 + group).split()
        base = [f"{w}{rnd.randrange(30)}" for w in base]
        for _ in range(size):
            text = base.copy()
            for _ in range(rnd.randrange(edits)):
                text[rnd.randrange(len(text))] = f"x{rnd.randrange(10**6)}"
            rows.append((100 + len(rows), " ".join(text)))
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, node int").repartition(3)
    got = superminhash.near_duplicates(df, cell=cell)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_near(rows)


def brute_search(docs, items, s=ranked.Settings()):
    cut = lambda t: re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())
    found = [(i, collections.Counter(w.lower() for w in cut(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = collections.Counter(w for _, c in found for w in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in found:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = 0
            for w in {w.lower() for w in cut(text)} & set(c):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                score += weight * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored)[:10], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket, bundle", [(4096, 256), (5, 2)])
def test_search_equals_brute_force(spark, bucket, bundle, monkeypatch):
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    monkeypatch.setattr(ranked, "BUNDLE", bundle)
    docs = [(r[0], r[1]) for r in ODD if r[0] != 5] + [(100 + i, prose(20 + i, i) + f" Éa {i % 3}x") for i in range(40)]
    items = [(1, "River the MOUNTAIN 1x éA"), (2, ""), (3, None), (4, "nothing-known-here"), (5, "spam ünï"), (None, "of and slowly"), (1, "people people 2x")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, bucket int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, item int")
    got = ranked.search(d, q)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items)
    assert ranked.search(d.limit(0), q).count() == ranked.search(d, q.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_characters="\n", blacklist_categories=["Cs"]), max_size=40), min_size=2, max_size=6), st.integers(0, 2))
def test_coded_shingles_have_the_similarity_of_the_shingles(given_lines, kind):
    if kind == 1:  # more different characters than fit
        given_lines = [x + "".join(chr(0x4E00 + i) for i in range(3000)) for x in given_lines]
    if kind == 2:
        given_lines = [x + "abcabc" * 5 + "中" for x in given_lines]
    coded = lines.CodedSets(given_lines, 6)
    assert (coded.codes is None) <= (kind != 2)
    for i, j in itertools.combinations(range(len(given_lines)), 2):
        want = lines.similarity(lines.shingles(given_lines[i], 6), lines.shingles(given_lines[j], 6))
        assert coded.similarity(i, j) == want


def test_fuzzy_lines_with_clashing_columns(spark):
    rows = [(1, "one line of words here\nother", 3, "x"), (2, "one line of words here", 4, "y"), (3, None, 5, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _id int, _drop string")
    got = lines.drop_fuzzy_lines(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == [rows[0], (2, "", 4, "y"), rows[2]]
