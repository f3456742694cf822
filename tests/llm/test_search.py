"""Mining, formatting and search beside plain Python."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tools.check import digest
from transferkit.llm import negatives, queries_search
from transferkit.llm import search as lexical
from transferkit.llm.chat import CONTROLS, escape, format_replies, format_threads, read_back, render, turns, unescape
from transferkit.llm.negatives import field_bits, mine_negatives, pack, scores
from transferkit.llm.search import search

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries_search.SQL))
def test_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    found = con.execute(queries_search.SQL[name])
    names = [d[0] for d in found.description]
    df = queries_search.QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(names, found.fetchall())[1]


@pytest.mark.parametrize("reach", [3, 300, 2**13, 2**20, 2**29])
def test_packed_products_are_exact(reach):
    rng = np.random.default_rng(reach)
    q = rng.integers(-reach, reach, (37, 5))
    low, high = int(q.min()), int(q.max())
    bits = field_bits(low, high, 5)
    found = scores(q[:11], pack(q, low, bits), len(q), q.sum(axis=1), low, bits)
    exact = q[:11].astype(object) @ q.T.astype(object)
    assert (found == exact.astype(np.int64)).all()


def mined(rows, positives=5, wanted=3):
    """(anchor, positive, rank, negative, scores) of rows (id, label, vector) by every pair."""
    rows = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a in {(i, label, tuple(v)) for i, label, v in rows if i % 50 == 0}:
        near = [
            (-sum(x * y for x, y in zip(a[2], v)), i, label)
            for i, label, v in rows
            if i != a[0] and len(v) == len(a[2])
        ]
        for p, pid, label in sorted(x for x in near if x[2] == a[1])[:positives]:
            fits = [x for x in near if x[2] != a[1] and 50 * -p <= 100 * -x[0] <= 95 * -p]
            out += [(a[0], pid, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(sorted(fits)[:wanted])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, q string, id int, `no` int, score string"


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 400 if block == 1 else block)
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [float(np.float32(rng.uniform(-0.2, 1))) for _ in range(4)]) for i in range(300)]
    rows += [(300 + i, i % 3, [0.5, 0.5, 0.25, 0.5]) for i in range(60)]  # ties
    rows += [rows[50], rows[50], rows[7], (100, 1, [1.0, 0.0, 0.0, 0.5])]  # repeated rows, one id twice
    rows += [(None, 1, [1.0] * 4), (400, None, [1.0] * 4), (401, 1, None), (402, 1, [1.0, None, 1.0, 1.0])]
    rows += [(450, 1, [float("nan"), 1.0, 1.0, 1.0]), (451, 2, [1.0, float("inf"), 1.0, 1.0])]
    rows += [(500, 1, []), (501, 1, []), (502, 2, []), (550, 0, [1.0, -1.0]), (551, 0, [2.0, 1.0]), (552, 1, [1.5, 0.7])]
    df = spark.createDataFrame([(i, v, label, "q", 1, 2, "s") for i, label, v in rows], VECTORS).repartition(4)
    found = mine_negatives(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == mined(rows)
    assert mine_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert mine_negatives(df, F.col("vec_id") < 0).count() == 0


ODD = ["", " ", "\\", "\\\\", "<", "</", "s>", "[INST", "]", "[/", "ok", "\n", "é", "</s", "<<", "SYS>>", "[ROLE] ", *CONTROLS]


def odd_text(rng):
    return "".join(rng.choice(ODD) for _ in range(rng.randrange(9)))


def test_template_is_reversible():
    rng = random.Random(8)
    for _ in range(3000):
        said = [(rng.choice(["user", "assistant", "system", "", "tool", odd_text(rng)]), odd_text(rng)) for _ in range(rng.randrange(5))]
        pieces = [render(role, text) for role, text in said]
        assert list(turns("".join(p for p, _, _ in pieces))) == said
        for (role, text), (piece, start, length) in zip(said, pieces):
            assert unescape(piece[start : start + length]) == text and unescape(escape(text)) == text


THREADS = "conv_id long, turn long, role string, text string, tree string, no int, k1 string, `path` int, part int"


def digests(said):
    learned = "".join(t for r, t in said if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in said)
    return (
        len(said), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(),
        sum(len(render(r, t)[0]) for r, t in said),
    )


@pytest.mark.parametrize("part_chars", [1, 1 << 20])
def test_threads(spark, part_chars):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), odd_text(rng)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, "user" if t % 2 else "assistant", odd_text(rng)) for t in range(700)]  # most of the rows
    rows += [(78, 0, "user", "long " * 200_000), (78, 1, "assistant", None), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    rows += [(79, 0, "user", "twice"), (79, 0, "user", "twice"), (79, None, "system", "first")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "t", 1, "k", 2, 3) for r in rows], THREADS).repartition(5)
    expected = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -1 if r[1] is None else r[1])):
        expected.setdefault(c, []).append((role or "", text or ""))
    parts = format_threads(df, part_chars=part_chars)
    for ordered in (True, False):
        back = read_back(parts, ordered).drop("path").collect()
        assert {r[0]: tuple(r)[1:] for r in back} == {c: digests(said) for c, said in expected.items()}
        assert len(back) == len(expected)
    assert read_back(format_threads(df.limit(0))).count() == 0


def branches(messages, top):
    """Root-to-leaf branches by walking up from every leaf: root id, branch, in rank order."""
    rows = sorted(set(messages), key=str)
    parent_of = {}
    holder = {}
    for r in rows:
        if r[0] is not None and r[0] not in holder:
            holder[r[0]] = r
    answered = set()
    for r in rows:
        parent_of[r] = holder.get(r[1]) if r[1] is not None else None
        if parent_of[r]:
            answered.add(parent_of[r])
    trees = {}
    for leaf in rows:
        if leaf in answered:
            continue
        path, r = [], leaf
        while r is not None and r not in path:
            path.append(r)
            r = parent_of[r]
        if r is None:
            mean = sum(x[4] or 0.0 for x in path) / len(path)
            trees.setdefault(path[-1], []).append((-mean, -len(path), [(x[2] or "", x[3] or "") for x in path[::-1]]))
    return sorted(
        (str(root[0]), n + 1, digests(said)[1]) for root, found in trees.items() for n, (_, _, said) in enumerate(sorted(found)[:top])
    )


MESSAGES = "message_id string, parent_id string, role string, text string, score double, no int, tree int, id int"


@pytest.mark.parametrize("top", [1, 2, None])
def test_reply_trees(spark, top):
    rng = random.Random(6)
    rows = [(f"m{i}", f"m{rng.randrange(max(0, i - 30), i)}" if i % 25 else None, "user", f"text {i}", i * 0.37 % 1.9) for i in range(1, 200)]
    rows += [(f"n{i}", f"n{i - 1}" if i else None, "assistant", f"deep {i}", 0.25) for i in range(70)]
    rows += [(f"w{i}", "w" if i else None, "user", f"wide {i}", i / 8) for i in range(60)] + [("w", None, "system", "root", None)]
    rows += [("c1", "c2", "user", "circle", 1.0), ("c2", "c1", "user", "circle", 1.0), ("c3", "c2", "user", "on it", 1.0)]
    rows += [("s", "s", "user", "itself", 1.0), (None, None, "user", "no id", 1.5), ("d", "gone", None, None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], MESSAGES).repartition(3)
    parts = format_replies(df, top=top)
    back = read_back(parts).join(parts.select("path", "rank").distinct(), "path")
    found = sorted((str(r.tree), r["rank"], r.turns_sha256) for r in back.collect())
    assert found == branches(rows, top)
    assert format_replies(df.limit(0)).count() == 0


def test_shared_ids(spark):
    rows = [("a", None, "user", "x", 0.0), ("a", None, "user", "x", 0.0), ("a", None, "user", "y", 0.0), ("b", "a", "assistant", "z", 1.0)]
    back = read_back(format_replies(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], MESSAGES), top=None)).collect()
    both = {(("user", "x"),) * 2 + (("assistant", "z"),), (("user", "y"),)}
    other = {(("user", "x"),) * 2, (("user", "y"), ("assistant", "z"))}
    found = {r.turns_sha256 for r in back}
    assert found in ({digests(s)[1] for s in both}, {digests(s)[1] for s in other})


def ranked(docs, items, k=20):
    """(item, rank, id, score) by scoring every document."""
    d = [(i, collections.Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total = sum(n for _, _, n in d)
    df = collections.Counter(t for _, c, _ in d for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in d:
            m = 75 + 25 * n * len(d) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(d) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in words(text)
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, docs, awkward, monkeypatch, small):
    if small:  # many blocks of queries, shards and blocks of postings
        for name, value in {"BLOCK_TERMS": 40, "SHARD_DOCS": 8, "SHARD_LEAST": 4, "BLOCK_POSTINGS": 2, "STEP_DOCS": 2}.items():
            monkeypatch.setattr(lexical, name, value)
    rng = random.Random(12)
    texts = [t for _, t, *_ in awkward if t]
    items = [(i, " ".join(rng.choice(texts).split()[:40]) + " end rights") for i in range(12)]
    items += [(20, "x"), (21, "THE end end"), (22, None), (23, ""), (24, "nowhereword"), (None, "all rights"), (21, "The end End")]
    queries = spark.createDataFrame([(i, t, "n", 1) for i, t in items], "item_id long, text string, no string, id int")
    found = sorted(map(tuple, search(docs, queries).collect()), key=str)
    assert found == ranked([(i, t) for i, t, *_ in awkward], items)
    assert search(docs.limit(0), queries).count() == search(docs, queries.limit(0)).count() == 0


def test_search_among_copies(spark):
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30)))) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(8))) for i in range(10)] + [(10, rows[3][1])]
    found = search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == ranked(rows, items)
