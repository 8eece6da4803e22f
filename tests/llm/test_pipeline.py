"""The pipeline's stages, each against what its operator says of the same input."""

from __future__ import annotations

import corpus_pipeline
from seriesmill.llm import decontaminate, jaccard, pii, queries, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    _, clean, single, free, masked = kept
    assert ids(clean) == ids(toxicity.score(docs, labels).where("NOT toxic"))
    assert ids(single) == ids(jaccard.jaccard_join(clean).where("doc_id = component_id"))
    assert ids(free) == ids(decontaminate.contamination(single, benchmark).where("NOT contaminated"))
    assert {r.doc_id: r.text for r in masked.collect()} == {r.doc_id: pii.masked(r.text) for r in free.collect()}
    assert masked.where("n_chars <> char_length(text)").count() == 0
    made = corpus_pipeline.run(spark, SF)
    assert ids(made) == ids(masked) and made.where("n_tokens * 4 <> octet_length(ids)").count() == 0


def test_names():
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.ORACLES) <= set(queries.QUERIES)
