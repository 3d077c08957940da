import os

import pytest

import __spark_entry__
import corpus_pipeline
from tallyloom.llm import bloom_dedup, packing, pii, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "pii", "packing"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_stages_keep_columns_and_apply_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        before, after = ({r.doc_id for r in x.collect()} for x in (docs, out))
        assert after <= before
        if name == "exact_dedup":
            assert after == {r.doc_id for r in bloom_dedup.copies(docs).where("kept").collect()}
        if name == "simhash_near_dedup":
            assert after == {r.component_id for r in simhash.groups(docs).collect()}
        if name == "pii":
            assert after == before
            spans = {r.doc_id: r.span_text for r in pii.find(docs).collect()}
            texts = [{r.doc_id: r.text for r in x.collect()} for x in (docs, out)]
            assert all((texts[0][i] == texts[1][i]) == (not s) for i, s in spans.items())
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert after == {r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()}
        docs, ids = out, after
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in whole} == ids
    same = packing.pack(docs, queries.byte_bpe()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()
    assert sorted(tuple(r)[:5] for r in whole) == sorted(map(tuple, same))
