"""The corpus pipeline on real and awkward documents."""

import corpus_pipeline
from fairlead.llm import secrets
from tests.llm import cases
from tests.llm.test_operators import SF, check_packing, plain_secrets


def test_run_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name in list(stages)[:-1]:
        before = docs
        docs = spark.createDataFrame(stages[name](spark, docs, SF).collect(), before.schema)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["secret_scan"]) == set(kept["decontamination"])
    for k, t in kept["decontamination"].items():
        assert kept["secret_scan"][k] == t or plain_secrets(t)[1]
    rows = corpus_pipeline.run(spark, SF).collect()
    check_packing(rows, kept["secret_scan"].items())
    assert secrets.scanned(docs).filter("size(base) > 0").count() == 0


def test_stages_take_awkward_and_empty_tables(spark):
    for make, least in ((cases.table, 12), (cases.empty, 0)):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            rows = out.collect()
            docs = spark.createDataFrame(rows, out.schema)
        assert len(rows) >= least
