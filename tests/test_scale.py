"""Queries whose single tasks must not grow with the whole table."""

import pathlib

import pytest
from pyspark.sql import functions as F

from foghorn.catalog import QUERIES
from foghorn.functions import text as tx
from foghorn.operators.registry_text import registry_mentions
from foghorn.plans import classify as cl
from foghorn.session import ensure_checkpoint_dir
from foghorn.streaming.events import BatchFolders

SF = "/root/testdata/sf0.01"


def test_deliveries_are_cut_into_files_and_stay_three_batches(spark):
    root = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.iterdir())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    try:
        rows = QUERIES["streaming_last_arrival"](spark, SF).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    made = {p.name.split("-")[0]: p for p in set(root.iterdir()) - before}
    assert rows == 10_000
    assert len(list(made["files"].glob("*.parquet"))) > 3
    state = next(p for p in made.values() if p.name.startswith("stream-last"))
    assert BatchFolders(spark, f"{state}/out", ["k"], 2).ranges() == [(0, 1), (2, 2)]


def test_literals_of_a_text_are_found_in_one_pass(spark):
    words = ["min", "it ", "a.b", "é", "ministerio", "zz", "min"]
    texts = ["", None, "axb minist", "ministerio it é", "a.b", "x\nit y", "zzz\x00min"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.f for r in df.select("i", tx.literals_found(F.col("t"), words).alias("f")).collect()}
    distinct = list(dict.fromkeys(words))
    assert got == {i: [w for w in distinct if t is not None and w in t] for i, t in enumerate(texts)}
    assert df.select(tx.literals_found(F.col("t"), []).alias("f")).distinct().collect()[0].f == []


@pytest.mark.parametrize("name", ["classify_rules", "fallback_share", "rule_fallback"])
def test_rules_test_no_literal_by_literal(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") < 30  # some two hundred when each literal is looked for by itself


def test_patterns_that_are_no_literals_and_tokens_over_two_fields(spark):
    assert cl._spellings("min(isterio)?") == ["min", "ministerio"]
    assert cl._spellings("e-?commerce[oó]") == ["ecommerceo", "ecommerceó", "e-commerceo", "e-commerceó"]
    assert cl._spellings("a.*b") == cl._spellings("x+") == cl._spellings("(a|b)?") == []
    rows = [(1, "post it", "x"), (2, "it", ""), (3, "k12", "k"), (4, "niño", ""), (5, "foo", "bar")]
    df = spark.createDataFrame(rows, "id int, title string, url string")
    got = cl.classify(
        df, aliases=[("s", ["foo bar"])], patterns=[("k[0-9]+|zzz", "num", 3.0), ("ni(ñ)o", "kid", 2.0)],
        tokens=[("it ", "ict"), ("bar", "bar")],
    ).select("id", "class_slug", "class_reason").collect()
    assert {tuple(r) for r in got} == {
        (1, "ict", "token"), (2, "unknown", "unknown"), (3, "num", "weighted"), (4, "kid", "weighted"), (5, "bar", "token"),
    }


def test_a_text_is_cut_into_words_once_and_its_hits_are_passed_once(spark):
    texts = spark.createDataFrame([(1, "Ábc x " * 500 + "end"), (2, "x"), (3, None)], "i int, t string")
    plan = texts.select(tx.fold_words("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") <= 4
    names = spark.createDataFrame([("abc",), ("x abc",), ("x end",)], "name string")
    found = registry_mentions(texts, "i", "t", names, "name")
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.i, r.first_word, r.n_words) for r in found.collect())
    assert got == [(1, 0, 1)] + [(1, 2 * k + 1, 2) for k in range(500)]


def test_long_names_are_found_in_one_pass_over_the_texts(spark):
    plan = QUERIES["mention_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [doc_id") == 1
    assert "lambdafunction" not in plan
