from __future__ import annotations

import corpus_pipeline
from ledgersieve.llm.store import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = columns = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        left.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]
    assert left == sorted(left, reverse=True) and 0.7 * left[0] < left[-1] < left[0]
    assert docs.where("n_tokens <> size(ids)").count() == 0


def test_stages_bear_odd_and_empty_tables(spark, odd, none):
    """Nulls, empty and long texts, repeated rows and clashing columns as a stage's own input; then no row at all."""
    for name, stage in corpus_pipeline.STAGES:
        last = name == corpus_pipeline.STAGES[-1][0]
        out = written(stage(spark, odd, SF), name)
        assert last or out.columns == odd.columns, name
        assert 0 < out.count() <= odd.count(), name
        if name in ("toxicity", "personal_data", "bpe"):
            assert out.count() == odd.count(), name
        if name == "near_duplicates":
            # Texts 7 (twice), 8 and the one without an id are one class; the rest is alone.
            assert out.where("doc_id in (7, 8)").count() == 2 and out.count() == odd.count() - 2
        assert stage(spark, none, SF).count() == 0, name
