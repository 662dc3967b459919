"""The pipeline over a small table, stage by stage."""

from __future__ import annotations

import hashlib
import os

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).cache()
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        seen.append(out.count())
        if name != "byte-level BPE":
            assert out.columns == docs.columns
            texts = {r.doc_id: r.text for r in out.collect()}
            docs = out
    assert seen == sorted(seen, reverse=True) and 50 < seen[-1] < seen[0]
    for r in out.collect():
        assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest() and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    nothing = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert all(stage(spark, nothing, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)
