"""Registered queries of the subpackage and the pipeline."""

import checking
import corpus_pipeline
import pytest

from tallyport.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(name, spark, sf_dir):
    assert checking.mismatch(QUERIES[name](spark, sf_dir), checking.connect(sf_dir), ORACLE[name]) is None


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 1 + len(QUERIES)))


def test_pipeline_by_stages(spark, sf_dir):
    """Every stage on its own input against what the operator says of it."""
    from tallyport.llm import line_chunks, minhash_dedup, qgram_filter

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "tokens"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        seen[name] = (docs, out)
        docs = out
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = map(ids, seen["quality"])
    assert all(labels[i] == 0 for i in before - after if i in labels)
    assert not any(labels.get(i) == 0 for i in after)
    before, after = seen["lines"]
    cut = {r.doc_id: r.text for r in line_chunks.dedup_lines(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, t in cut.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["near_duplicates"]
    groups = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(before).collect()}
    assert ids(after) == {i for i, c in groups.items() if i == c}
    before, after = seen["decontamination"]
    dirty = {r.doc_id for r in qgram_filter.matches(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert ids(after) == ids(before) - dirty
    assert ids(seen["tokens"][1]) == ids(after)


def test_pipeline_of_nothing(spark, tmp_path, sf_dir):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
