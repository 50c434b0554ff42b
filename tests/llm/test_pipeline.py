"""The pipeline's stages against plain versions."""

from collections import Counter

import pytest

import brute
import corpus_pipeline
from quakeloom.llm import quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialise(stage(spark, docs, SF), "test")
        seen.append((name, docs, after))
        docs = after
    (_, _, good), (_, _, unique), (_, _, apart), (_, _, mixed), (_, _, encoded) = seen
    for _, _, after in seen[:-1]:
        assert after.columns == documents.columns
    ids = lambda df: [r["doc_id"] for r in df.select("doc_id").collect()]
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]
    model = quality.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(ids(good)) == sorted(r["doc_id"] for r in quality.rate(documents, model).filter("predicted = 1").collect())
    assert sorted(ids(unique)) == sorted(g[0] for g in brute.exact_groups(rows(good)) if g[3])
    assert sorted(ids(apart)) == sorted({c for _, _, c in brute.components(rows(unique), 5, 80)})
    assert set(ids(mixed)) <= set(ids(apart)) and max(Counter(ids(mixed)).values()) <= 2
    core = brute.encoding()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in encoded.collect()) == sorted((i, len(core.encode_ordinary(t))) for i, t in rows(mixed))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(tuple(r) for r in encoded.collect())


@pytest.mark.parametrize("place", range(1, 5))
def test_stages_take_odd_rows(spark, odd, empty, place):
    _, stage = corpus_pipeline.STAGES[place]
    assert stage(spark, empty, SF).count() == 0
    out = stage(spark, odd, SF)
    assert out.count() > 0 and (place == 4 or out.columns == odd.columns)
