"""The pipeline's stages beside plain Python over the same rows."""

import collections

import corpus_pipeline
from tests.llm.conftest import words
from tests.llm.test_copies import brute_classes, brute_passages
from tests.llm.test_filters import brute_hits
from transferkit.llm.mixing import mixture
from transferkit.llm.quality import quality

SF_DIR = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in quality(docs).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect() if r.doc_id in good]
    rows = [(i, t) for (i, t), c in zip(rows, brute_classes(rows)) if c[1] == i]
    kept = [(i, x[5].decode("utf-8", "ignore")) for (i, _), x in zip(rows, brute_passages(rows))]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {i: t for i, t in kept if t and not brute_hits(t, items)[1]}
    left = spark.createDataFrame(list(clean.items()), "doc_id long, text string").join(docs.select("doc_id", "source"), "doc_id")
    drawn = collections.Counter({r.doc_id: len(r.shards) for r in mixture(left).collect()})
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert collections.Counter(r.doc_id for r in found) == +drawn
    assert all(r.text == clean[r.doc_id] and r.n_chars == len(r.text) and words(r.text) for r in found)


def test_stages_keep_the_columns(spark, docs, no_docs):
    for given in (docs, no_docs):
        rows = given
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF_DIR)
            assert rows.columns[: len(given.columns)] == given.columns
            rows.count()
