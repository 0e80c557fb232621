import corpus_pipeline
from panelgrowth.llm.line_dedup import dedup_lines
from panelgrowth.llm.mix import mix_plan
from panelgrowth.llm.ngram_join import similar_components
from panelgrowth.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "ngram_join", "mix_sources", "best_fit_packing"]
    out = {}
    for name, f in stages.items():
        before, docs = docs, f(spark, docs, SF)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
        out[name] = (before, docs)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    before, after = out["quality_rules"]
    assert ids(after) == ids(quality_rules(before).where("kept"))
    before, after = out["line_dedup"]
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, dedup_lines(before).collect()))
    before, after = out["ngram_join"]
    assert ids(after) == ids(similar_components(before, 5, 80).where("doc_id = component_id"))
    before, after = out["mix_sources"]
    plan = mix_plan(before)
    assert after.count() == plan.agg({"takes": "sum"}).head()[0]
    before, after = out["best_fit_packing"]
    total = plan.agg({"taken": "sum"}).head()[0]
    assert after.agg({"n_words": "sum"}).head()[0] == total
    assert after.where("bin IS NOT NULL").groupBy("bin").sum("n_words").agg({"sum(n_words)": "max"}).head()[0] <= 2048


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
