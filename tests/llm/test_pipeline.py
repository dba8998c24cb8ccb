import random

import corpus_pipeline
from embedlift.llm import quality
from llm.fixtures import SCHEMA, awkward, sentence


def test_each_stage_takes_effect_and_keeps_columns(spark, scratch):
    rng = random.Random(8)
    clean = [sentence(rng, 120) for _ in range(12)]
    item = sentence(rng, 30)
    near = clean[0].split()
    near[50] = "changed"
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(20, " ".join(near), "en", "s", 1), (21, clean[1] + "\n" + sentence(rng, 80), "en", "s", 1), (22, clean[2], "en", "s", 1),
             (23, sentence(rng, 60) + " " + item + " " + sentence(rng, 30), "en", "s", 1), (24, "# $ % " * 40, "en", "s", 1), (25, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{scratch}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, scratch).write.parquet(f"{scratch}/{name}")
        out = spark.read.parquet(f"{scratch}/{name}")
        if name != "bpe_codec":
            assert out.schema == docs.schema
        docs = out
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "line_dedup":
            assert docs.where("doc_id = 21").first().text == rows[13][1].split("\n")[1]
            assert docs.where("n_chars <> length(text) and doc_id in (21)").count() == 0
    start = set(range(12))
    assert kept[0] == start | {20, 21, 22, 23}
    assert kept[1] - {20} == start | {21, 23}
    assert kept[2] == start | {21, 23}
    assert kept[3] == kept[4] == start | {21}
    final = corpus_pipeline.run(spark, scratch)
    assert {r.doc_id for r in final.collect()} == kept[4]


def test_awkward_and_empty_tables(spark, scratch):
    spark.createDataFrame([(1, "some words that never occur in it")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.createDataFrame(awkward(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), scratch).count() == 0
        assert stage(spark, docs, scratch).count() <= len(awkward())
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(quality.RULES) == 8
