"""The pipeline's stages, each against a plain version on its own input."""

import public_tokenizers
from pyspark.sql import functions as F
from test_copies import similarity
from test_pairs import plain_leaks
from test_rows import check_pieces, plain_quality, plain_spans

import corpus_pipeline
from siltworks.llm import queries, store


def test_stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    columns = docs.dtypes
    seen = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = store.cut(stage(spark, docs, sf), name)
        seen[name] = docs
        if name != "packing":
            assert docs.dtypes == columns
    text = {k: {r["doc_id"]: r["text"] for r in d.collect()} for k, d in seen.items() if k != "packing"}
    assert not [i for i in text["quality"] if plain_quality(text["start"][i])[-1]]
    ids = sorted(text["quality"])
    texts = text["quality"]
    root = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if root[i] != root[j] and similarity(texts[i], texts[j]) >= 0.8:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if r == old else r for k, r in root.items()}
    assert set(text["near_duplicates"]) == set(root.values())
    items = queries.table(spark, sf, "benchmark").select("item_id", "text").collect()
    leaks = {i for i, _ in plain_leaks(text["near_duplicates"].items(), items)}
    assert set(text["decontamination"]) == set(text["near_duplicates"]) - leaks
    assert set(text["secrets"]) == set(text["decontamination"])
    for i, t in text["secrets"].items():
        old = text["decontamination"][i]
        assert (t == old) == (plain_spans(old) == "")
    pieces = docs.withColumnRenamed("doc_id", "id").collect()
    assert check_pieces(pieces, list(text["secrets"].items())) == 0
    assert public_tokenizers


def test_pipeline_on_odd_rows(spark, odd, none, sf):
    for name, stage in corpus_pipeline.STAGES:
        assert store.cut(stage(spark, none, sf), name).count() == 0, name
    left = odd.select("*", *(F.lit(1).alias(c) for c in ("id", "key", "root", "blob", "found", "kept", "n_words", "_row", "node", "start")))
    rows = left.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:  # each stage on all odd rows
        got = store.cut(stage(spark, left, sf), name)
        assert got.columns == left.columns
        assert set(got.collect()) <= set(rows)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, left, sf).collect()}
    assert kept == {0, 3, 4, 5, 9, 11, 12, 13, None} | (kept & {7, 8, 10})
    packed = corpus_pipeline.pack(spark, left, sf).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows}
    assert all(len(r["ids"]) == r["length"] for r in packed)


def test_run_leaves_only_what_its_result_reads(spark, sf):
    store.clear(spark)
    got = corpus_pipeline.run(spark, sf)
    assert len(store._made) == 1
    assert got.count() > 0
    store.clear(spark)
    assert not store._made
