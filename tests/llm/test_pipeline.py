"""The stages one after another on a small table."""

import os

import corpus_pipeline
from gleanwork.llm.queries import ORACLES, QUERIES


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(os.path.join(tmp_path, "documents.parquet"))
    current, sizes = spark.read.parquet(os.path.join(tmp_path, "documents.parquet")), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = os.path.join(tmp_path, f"{i}.parquet")
        before = current
        stage(spark, current, str(tmp_path)).write.parquet(out)
        current = spark.read.parquet(out)
        sizes.append(current.count())
        if name != "packing":
            assert current.columns == before.columns
            assert set(current.dtypes) == set(before.dtypes)
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3] > 0
    left = spark.read.parquet(os.path.join(tmp_path, "3.parquet")).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in left if r["n_chars"] is not None)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.count() == sizes[-1]
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in left}


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
