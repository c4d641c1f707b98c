"""The pipeline, stage by stage, against what each stage must do."""

import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from twinshelf.llm.common import stored  # noqa: E402


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_on_given_documents(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in docs.collect()}

    clean = stored(stages["toxicity"](spark, docs, sf_dir), "t")
    kept = {r.doc_id for r in clean.collect()}
    gone = set(rows) - kept
    assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * len(rows)

    single = stored(stages["exact_dedup"](spark, clean, sf_dir), "e")
    bodies = [body(r.text) for r in single.collect()]
    assert sorted(bodies) == sorted({body(rows[i].text) for i in kept})

    far = stored(stages["near_dedup"](spark, single, sf_dir), "n")
    sets = {r.doc_id: shingles(r.text) for r in single.collect()}
    left = {r.doc_id for r in far.collect()}

    def similar(a, b):
        return len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    assert not [(a, b) for a in left for b in left if a < b and similar(a, b)]
    assert all(any(similar(i, j) for j in sets if j != i) for i in set(sets) - left)

    pure = stored(stages["decontamination"](spark, far, sf_dir), "d")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    remaining = {r.doc_id: " ".join(r.text.split()) for r in pure.collect()}
    assert not [i for i, t in remaining.items() if any(" ".join(x.split()) in t for x in items)]
    for frame in (clean, single, far, pure):
        assert frame.columns == docs.columns

    packed = stages["packing"](spark, pure, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(remaining)
    lengths = {}
    for r in packed:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert max(lengths.values()) <= 2048
    assert sorted((r.doc_id, r.piece) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(
        (r.doc_id, r.piece) for r in packed
    )


def test_stages_on_odd_and_no_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name != "packing":
                assert out.columns == docs.columns
                docs = stored(out, name)
            else:
                assert (out.count() > 0) == (docs.count() > 0)
