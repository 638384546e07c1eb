"""The pipeline against a brute-force version of its filters, stage by stage."""

import collections

import corpus_pipeline
from foghorn.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs, kept = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert kept[name].items() <= before.items()
    last = {}
    for i, text in kept["quality_rules"].items():
        last[text] = max(i, last.get(text, i))
    assert kept["exact_dedup"] == {i: text for text, i in last.items()}

    from test_corpus import brute_components, brute_marks

    marks = {i: brute_marks(t) for i, t in kept["exact_dedup"].items()}
    roots = brute_components(list(marks.values()))
    groups = collections.defaultdict(list)
    for i, m in marks.items():
        groups[roots[m]].append(i)
    assert sorted(kept["near_dedup"]) == sorted(min(g) for g in groups.values())
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept["near_dedup"])
