"""The stages one after the other, each against what it was given."""

from collections import Counter

import corpus_pipeline
from urbanspark.operators.tables import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF), "test-stage"))
    raw, good, distinct, apart, mixed, packed = kept
    for stage in (good, distinct, apart, mixed):
        assert stage.columns == docs.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in (raw, good, distinct, apart, mixed)]
    assert all(after <= before for before, after in zip(ids, ids[1:])) and len(ids[1]) > 0.7 * len(ids[0])
    texts = [r.text for r in distinct.collect()]
    assert len({" ".join(t.split()) for t in texts}) == len(texts)
    assert max(Counter(r.doc_id for r in mixed.select("doc_id").collect()).values()) <= 2
    assert packed.filter("piece = 0").count() == mixed.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
