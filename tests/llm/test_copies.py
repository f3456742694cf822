"""Near-copies, repeated passages and archives beside brute force and round trips."""

import collections
import hashlib
import random

import duckdb
import pytest

from tests.llm.conftest import words
from tools.check import digest
from transferkit.llm import queries_copies
from transferkit.llm.graph import components
from transferkit.llm.jaccard import _split, depth_for, drop_near_copies, jaccard_classes, runs_for
from transferkit.llm.suffixes import remove_repeated, repeated_passages
from transferkit.llm.warc import archived

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    """Per row: smallest id tied to it, other sets at 0.8 or more, copies."""
    sets = collections.defaultdict(list)
    for i, text in rows:
        sets[shingles(text)].append(i)
    names = [s for s in sets if s]
    root = {s: s for s in names}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    links = collections.Counter()
    for i, s in enumerate(names):
        for t in names[i + 1 :]:
            both = len(s & t)
            if both and both >= 0.8 * (len(s) + len(t) - both):
                links[s] += 1
                links[t] += 1
                root[find(s)] = find(t)
    least = {}
    for s in names:
        ids = [i for i in sets[s] if i is not None]
        r = find(s)
        least[r] = min([*ids, *([least[r]] if least.get(r) is not None else [])], default=None)
    out = []
    for i, text in rows:
        s = shingles(text)
        out.append((i, least[find(s)], links[s], len(sets[s])) if s else (i, i, 0, 1))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_classes(docs, no_docs, monkeypatch, small):
    if small:  # every bucket is split again, and every cluster dealt in blocks
        monkeypatch.setattr("transferkit.llm.jaccard.BUCKET", 1)
        monkeypatch.setattr("transferkit.llm.jaccard.BLOCK", 2)
        monkeypatch.setattr("transferkit.llm.tables.BROADCAST_ROWS", 0)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in jaccard_classes(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute_classes(rows)))
    if not small:
        assert jaccard_classes(no_docs).count() == drop_near_copies(no_docs).count() == 0


def test_classes_of_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    found = [tuple(r) for r in queries_copies.op10_ngram_jaccard(spark, SF_DIR).collect()]
    assert sorted(found) == sorted(brute_classes(rows))


def test_one_of_each_class_stays(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    classes = brute_classes(rows)
    ids = {c for (i, t), (_, c, _, _) in zip(rows, classes) if shingles(t)}
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(map(str, [i for i, t in found if shingles(t)])) == sorted(map(str, ids))
    assert sorted(map(str, [x for x in found if not shingles(x[1])])) == sorted(str(x) for x in rows if not shingles(x[1]))


def test_classes_that_share_an_id_or_have_none_each_keep_a_row(spark):
    texts = [" ".join(f"{name}{i}" for i in range(80)) for name in "abcdef"]
    near = [t + " more" for t in texts]
    rows = [
        (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, near[1]),
        (1, texts[2]), (1, texts[3]), (1, texts[3]), (5, near[2]), (6, near[3]), (None, near[3]), (2, texts[4]), (None, texts[5]),
    ]
    found = [tuple(r) for r in drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted((t[0], str(i)) for i, t in found) == [
        ("a", "None"), ("b", "None"), ("c", "1"), ("d", "1"), ("e", "2"), ("f", "None")
    ]


def test_runs_reach_the_recall():
    assert runs_for(0.9999, 0.8, 1) == 10 and runs_for(0.9999, 0.8, 3) > runs_for(0.99, 0.8, 3)
    assert [depth_for(n) for n in (0, 1, 10**6, 10**7, 10**11, 10**13)] == [2, 2, 2, 3, 3, 4]


def test_a_split_is_made_once_and_grows_with_its_group(spark, monkeypatch):
    """A class of a group of near copies chooses its tokens once, and as many in a group twice as large."""
    base = [f"w{i}" for i in range(150)]
    rows = [(n, " ".join([*base[: n % 140], f"new{n}", *base[n % 140 + 1 :]])) for n in range(1200)]
    made, once = spark.sparkContext.accumulator(0), []

    def counting(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def split(rows, threshold):
        out = _split(rows, threshold)
        once.append(out.count())
        return out.mapInArrow(counting, "key long, node long")

    monkeypatch.setattr("transferkit.llm.jaccard._split", split)
    for n in (600, 1200):
        found = jaccard_classes(spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(3)).collect()
        assert {r.class_id for r in found} == {0}
    assert made.value == sum(once) and 0 < once[1] < 2.2 * once[0]


def test_planted_pairs_are_found(spark):
    """Pairs at 0.8 to 0.85, every other one a text inside the other: all are found, and no pair below 0.8."""
    rng = random.Random(41)
    rows, near, far = [], [], []
    for n in range(2400):
        # unrelated texts share no words; a changed word changes five shingles, a missing end as many as it has words
        size = rng.randrange(60, 400)
        text = [f"{n}w{i}x{rng.randrange(9)}" for i in range(size)]
        other = list(text)
        if n % 2:
            other = other[: size - rng.randrange(size // 7, size // 4)]
        else:
            for i in rng.sample(range(3, size - 3), max(1, size // 52 + rng.randrange(2))):
                other[i] = "changed"
        a, b = shingles(" ".join(text)), shingles(" ".join(other))
        share = len(a & b) / len(a | b)
        if share > 0.85:
            continue
        (near if share >= 0.8 else far).append(2 * n)
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(other))]
    found = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    tied = {r.doc_id for r in found if r.n_links}
    pairs = {x for i in near for x in (i, i + 1)}
    assert len(near) > 700 and len(far) > 300 and tied <= pairs
    assert len(tied) >= 0.999 * len(pairs)


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 300), (7, 7)] + [(500, 501 + i) for i in range(30)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = collections.defaultdict(set)
    for node, label in found.items():
        groups[label].add(node)
    assert sorted(map(len, groups.values())) == [3, 31, 41]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_passages(rows, window=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + window] for _, b in raw for k in range(len(b) - window + 1))
    out = []
    for i, b in raw:
        runs = []
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                if runs and k <= runs[-1][1]:
                    runs[-1][1] = k + window
                else:
                    runs.append([k, k + window])
        kept, at = b"", 0
        for a, e in runs:
            kept, at = kept + b[at:a], e
        kept += b[at:]
        out.append((i, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("ways", ["plain", "joined", "segments", "dealt"])
def test_passages(docs, no_docs, monkeypatch, ways):
    if ways == "joined":
        monkeypatch.setattr("transferkit.llm.suffixes.BROADCAST_DIGITS", -1)
        monkeypatch.setattr("transferkit.llm.tables.BROADCAST_ROWS", -1)
    if ways == "dealt":
        monkeypatch.setattr("transferkit.llm.suffixes.GROUP_ROWS", 0)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if ways == "segments":  # texts longer than two segments
        rows = [(1, "ab" * 2_200_000), (2, rows[3][1]), (3, "ab" * 120 + "c")]
        spark = docs.sparkSession
        found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {(r.doc_id, r.n_removed) for r in found if r.doc_id != 2} == {(1, 4_400_000), (3, 240)}
        return
    found = [tuple(r) for r in repeated_passages(docs).collect()]
    expected = brute_passages(rows)
    assert sorted(map(str, found)) == sorted(str(x[:5]) for x in expected)
    if ways == "plain":
        assert repeated_passages(no_docs).count() == remove_repeated(no_docs).count() == 0
        cut = remove_repeated(docs)
        assert cut.columns == docs.columns
        texts = [(i, None if t is None else x[5].decode("utf-8", "ignore")) for (i, t), x in zip(rows, expected)]
        assert sorted(map(str, ((r.doc_id, r.text) for r in cut.collect()))) == sorted(map(str, texts))


MAGIC = "WARC/1.1\r\nWARC-Type: response\r\nX-Page: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "u", "a" * 1200), (2, "u", "a" * 1200), (3, "u\r\nX: y", "x" + MAGIC + "tail"), (4, None, None), (5, "u", MAGIC),
    (6, "v", MAGIC * 30 + "WARC/1.1\r\n"), (7, "v", "WARC/1.1\r\nContent-Length: 0\r\n\r\n" * 3), (8, "z", "é" * 600),
    (9, "z", "é" * 600), (9, "z", "é" * 600), (None, "z", "é" * 600), (10, "q", "\r\n\r\nWARC/1.WARC/1.1\r\n"),
    (11, "q", ""), (12, "q", "b" * 999), (13, "q", "b" * 999), (14, "q", "long " * 100_000),
] + [(100 + i, "w", f"page {i} " * 200) for i in range(60)]


def test_archives(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # splits inside records
    try:
        df = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, type string, head string")
        found = [tuple(r) for r in archived(df.coalesce(2)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    largest = {}
    for i, _, html in PAGES:
        largest[html or ""] = max(largest.get(html or "", 0), i or 0)
    expected = []
    for i, _, html in PAGES:
        raw, first = (html or "").encode(), largest[html or ""]
        revisit = len(raw) >= 1000 and first != i
        expected.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert archived(df.limit(0)).count() == 0


def test_archive_query(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF_DIR}/pages.parquet'")
    df = queries_copies.op6_warc_archives(spark, SF_DIR)
    found = con.execute(queries_copies.SQL6)
    names = [d[0] for d in found.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(names, found.fetchall())[1]
