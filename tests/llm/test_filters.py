"""Quality rules, decontamination and mixing beside their SQL and beside plain Python."""

import collections

import duckdb
import pandas as pd
import pytest

from tests.llm.conftest import words
from tools.check import digest
from transferkit.llm import queries_filters
from transferkit.llm.decontaminate import contamination, decontaminate
from transferkit.llm.mixing import deal, mix, mixture
from transferkit.llm.quality import keep_good, quality

SF_DIR = "/root/testdata/sf0.001"
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "END"), (3, None), (None, "by"), (2, "x x x x x x x x x x x x")]


def same(df, sql, con):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(names, found.fetchall())[1]


@pytest.fixture(scope="module")
def con(awkward):
    con = duckdb.connect()
    documents = pd.DataFrame(awkward, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})
    benchmark = pd.DataFrame(ITEMS, columns=["item_id", "text"]).astype({"item_id": "Int64"})
    con.register("documents_frame", documents)
    con.register("benchmark_frame", benchmark)
    con.execute("create table documents as select * from documents_frame")
    con.execute("create table benchmark as select * from benchmark_frame")
    return con


@pytest.mark.parametrize("name", list(queries_filters.SQL))
def test_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    same(queries_filters.QUERIES[name](spark, SF_DIR), queries_filters.SQL[name], con)


def test_quality_of_awkward_rows(spark, awkward, con):
    numbered = spark.createDataFrame([(i, t) for i, (_, t, *_) in enumerate(awkward)], "doc_id long, text string")
    con.execute("create or replace temp view numbered as select row_number() over () - 1 as doc_id, text from documents")
    same(quality(numbered), queries_filters.SQL9.replace("from documents", "from numbered"), con)


def test_kept_rows_are_unchanged(docs, no_docs):
    kept = {r.doc_id for r in quality(docs).where("kept").collect()}
    rows = keep_good(docs)
    assert rows.columns == docs.columns
    assert collections.Counter(map(tuple, rows.collect())) == collections.Counter(
        tuple(r) for r in docs.collect() if r.doc_id in kept
    )
    assert quality(no_docs).count() == keep_good(no_docs).count() == 0


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        v = words(item_text)
        k = min(10, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(item)
    return len(w), len(hit), len(found - {None})


def test_contamination(spark, docs, no_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted((r.doc_id or -1, *brute_hits(r.text, ITEMS)) for r in docs.collect())
    found = contamination(docs, items).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items) for r in found) == expected
    monkeypatch.setattr("transferkit.llm.decontaminate.BROADCAST_HASHES", 4)
    again = contamination(docs, items).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert contamination(no_docs, items).count() == 0
    assert contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_decontaminate(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = [tuple(r) for r in docs.collect() if not brute_hits(r.text, ITEMS)[1]]
    rows = decontaminate(docs, items)
    assert rows.columns == docs.columns
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, clean))
    cut = decontaminate(docs, items, remove="spans").collect()
    assert len(cut) == docs.count()
    texts = {r.doc_id: r.text for r in cut}
    assert texts[6] == "the " and texts[7] == "The\x00 !" and texts[1] is None
    with pytest.raises(ValueError):
        decontaminate(docs, items, remove="all")


def test_mixture(docs, no_docs, con):
    same(mixture(docs).drop("shards"), queries_filters.SQL7, con)
    rows = mixture(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixture(docs).collect()))
    for r in rows:
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size and len(r.shards) * r.size == r.taken
    assert mixture(no_docs).count() == mix(no_docs).count() == 0


def test_mix_rows(docs):
    drawn = collections.Counter()
    for r in mixture(docs).collect():
        drawn[r.doc_id] += len(r.shards)
    rows = mix(docs)
    assert rows.columns == [*docs.columns, "mix_shard", "mix_position"]
    assert collections.Counter(r.doc_id for r in rows.collect()) == +drawn


def test_deal_is_exact(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 37), (2, 0), (3, 1)], "source_no int, draws long")
    shards = 6
    ends = {r.source_no: list(r.end) for r in deal(quotas, shards).collect()}
    assert [ends[s][-1] for s in range(4)] == [100, 37, 0, 1]
    assert all(len(e) == shards and e == sorted(e) for e in ends.values())
    sizes = [sum(ends[s][i] - (ends[s][i - 1] if i else 0) for s in ends) for i in range(shards)]
    assert sum(sizes) == 138 and max(sizes) - min(sizes) <= 1
