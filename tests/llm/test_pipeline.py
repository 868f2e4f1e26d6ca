"""The pipeline's stages, each against its operator on the rows it was given."""

from __future__ import annotations

import corpus_pipeline
from forecourt.llm import decontamination, quality_rules, simhash
from forecourt.llm.common import table

SF = "/root/testdata/sf0.01"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, tmpdir_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmpdir_path}/{k}")
        out = spark.read.parquet(f"{tmpdir_path}/{k}")
        if k < 4:
            assert out.columns == columns
        if name == "quality_rules":
            assert ids(out) == ids(quality_rules.quality(docs).where("kept"))
        if name == "toxicity":
            labels = table(spark, SF, "labels")
            lost = docs.join(out, "doc_id", "left_anti").join(labels, "doc_id")
            assert lost.where("toxic = 0").count() == 0 and lost.where("toxic = 1").count() > 0
        if name == "simhash_near_dedup":
            assert ids(out) == sorted({r.component_id for r in simhash.components(docs).collect()})
        if name == "decontamination":
            found = decontamination.contamination(docs, table(spark, SF, "benchmark"))
            assert ids(out) == ids(found.where("not contaminated"))
        if name == "bpe_encode_decode":
            assert ids(out) == ids(docs) and out.where("n_tokens <> size(ids)").count() == 0
        docs = out


def test_empty(spark, tmpdir_path):
    docs = table(spark, SF, "documents").where("false")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmpdir_path}/{k}")
        docs = spark.read.parquet(f"{tmpdir_path}/{k}")
        assert docs.count() == 0
