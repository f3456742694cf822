"""Licence scan, language, language model and toxicity beside brute force and held-out accuracy."""

import collections
import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LOW, TOKEN, words
from transferkit import session
from transferkit.llm import lm, toxicity
from transferkit.llm.batches import word_hash
from transferkit.llm.language import identify
from transferkit.llm.license import scan_licenses
from transferkit.llm.lm import CLASSES, _Part, score_documents, seat
from transferkit.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.01"
PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def part(i, n):
    return zlib.crc32(str("" if i is None else i).encode()) % n


def base_places(text):
    w = words(text)
    found = [(i, label) for label, p in PHRASES.items() for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


@pytest.mark.parametrize("data", ["awkward", "sf0.01"])
def test_licenses(spark, docs, data):
    df = docs if data == "awkward" else spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = scan_licenses(df).collect()
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]
    assert sorted(map(str, found)) == sorted(str((r.doc_id, *base_places(r.text))) for r in df.collect())
    for r in rows:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_license_labels(spark, no_docs):
    texts = {
        1: "Foo. Licensed under the Apache License, Version 2.0 (the License)", 2: "released under the MIT license",
        3: "Licensed under CC BY-NC 4.0.", 4: "the apache helicopter license", 5: "GNU General Public License, version 3",
    }
    rows = scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id int, text string")).collect()
    assert {r.doc_id: r.labels for r in rows} == {
        1: "apache-2.0", 2: "mit", 3: "cc-by,cc-by-nc", 4: "", 5: "gpl,gpl-3.0"
    }
    assert scan_licenses(no_docs).count() == 0


def test_license_labels_do_not_hang_on_rare_words(spark):
    text = "granted free of charge to any person obtaining a copy of this software"
    other = "hereby associated documentation permission is files and"
    for more in ([], [(2, "granted to this software " * 3), (3, "free of charge to any person obtaining a copy")], [(2, other)]):
        rows = scan_licenses(spark.createDataFrame([(1, text), *more], "doc_id int, text string")).collect()
        assert {r.doc_id: r.labels for r in rows} == {1: "mit"} | {i: "" for i, _ in more}
        assert max(r.score for r in rows) == 13 / 20


def test_language(spark, docs, no_docs):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(part(r.doc_id, 3) == 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows) > 0
    rows = identify(docs).collect()
    assert len(rows) == docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 8)} == {"und"}
    assert all(r.lang_pred in ("en", "de", "fr", "und") for r in rows)
    assert identify(no_docs).count() == 0
    assert {r.lang_pred for r in identify(docs.where("lang is null").limit(3)).collect()} == {"und"}


@pytest.mark.parametrize("data", ["awkward", "sf0.01"])
def test_language_model(spark, docs, data):
    df = docs if data == "awkward" else spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = df.select("doc_id", "text").collect()
    tok = [(r.doc_id, TOKEN.findall((r.text or "").translate(LOW)) + [None]) for r in given]
    c = collections.Counter(t for i, ts in tok if part(i, 7) != 2 for t in ts)
    n, v = sum(c.values()), len(c)
    expected = sorted(
        (i or -1, part(i, 7) == 2, len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 5))
        for i, ts in tok
    )
    rows = score_documents(df).collect()
    found = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4
    assert all(r.score < 0 for r in rows)
    if data == "sf0.01":
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_of_nothing(docs, no_docs):
    assert score_documents(no_docs).count() == 0
    only = [r.doc_id for r in docs.collect() if r.doc_id and part(r.doc_id, 7) == 2]
    rows = score_documents(docs.where(docs.doc_id.isin(only))).collect()
    assert rows and all(r.train_tokens == 0 and r.base_score == 0 for r in rows)


def test_probabilities_add_up():
    """In every class the words of a one-part model and the unknown word share all of the probability."""
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(1, 2**63, 50).astype(np.uint64))
    per = np.full(50, 2, np.uint8)
    ks = np.tile([3, 9], 50).astype(np.uint8)
    cs = rng.integers(1, 200, 100)
    t = np.minimum(cs, rng.integers(1, 9, 100))
    n = t.reshape(50, 2).sum(axis=1)
    m = np.minimum(n, 3)
    totals = [*np.bincount(ks, cs, CLASSES).astype(int), *np.bincount(ks, t, CLASSES).astype(int), 50, int(m.sum())]
    raw = {"words": hashes.tobytes(), "per": per.tobytes(), "ks": ks.tobytes(), "cs": cs.astype(np.int64).tobytes()}
    one = _Part(raw | {"kept": t.astype(np.int64).tobytes(), "kept_m": m.astype(np.int64).tobytes()}, [totals])
    asked = np.append(hashes, np.uint64(7))
    for k in (3, 9, 40):
        _, p = one.answer(asked, np.ones(51, np.int64), np.full(51, k, np.uint8))
        assert abs((10**p).sum() - 1) < 1e-9


def test_contexts_are_the_tokens_before(spark):
    """Restaurants by hand: as many as there are tokens before others, with all customers whatever part they lie in."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 400, 300)) for _ in range(20)] + ["w1 w1 w1", "", "w2"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("held", F.col("id") % 5 == 0)
    chunks = lm._chunks(df.repartition(3))
    counted = lm._count(lm._requests(chunks, 8, training=True), 8)
    found = collections.Counter()
    for row in (r.asDict() for r in counted.collect()):
        words, (contexts, word, ks, cs) = np.frombuffer(row["words"], np.uint64), lm._pairs_of(row)
        found.update({(int(contexts[k]), int(words[w])): int(c) for w, k, c in zip(word, ks, cs)})
    hashes = {t: word_hash(t) for text in texts for t in text.split()}
    expected = collections.Counter()
    for i, text in enumerate(texts):
        tokens = [hashes[t] for t in text.split()]
        if i % 5:
            expected.update(zip([int(lm.START), *tokens], [*tokens, int(lm.END)]))
    assert found == expected and len({k for k, _ in expected}) > 2 * CLASSES
    customers = collections.Counter()
    for (k, _), c in expected.items():
        customers[k] += c
    places = {r.part: np.frombuffer(r.contexts, np.uint64) for r in counted.collect()}
    for r in lm._context_totals(counted, 8).collect():
        totals = np.frombuffer(b"".join(bytes(x) for x in r.customers), np.int64)
        assert [customers[int(k)] for k in places[r.part]] == totals.tolist()


def test_a_token_follows_the_one_it_followed(spark):
    """Pairs seen in training beat the same words in another order; by class of the token before they hardly differ."""
    rng = np.random.default_rng(6)
    pairs = [(f"a{i}", f"b{i}") for i in range(300)]
    rows = [(i, " ".join(" ".join(pairs[j]) for j in rng.permutation(300))) for i in range(40)]
    ids = [i for i in range(40, 400) if part(i, 7) == 2][:2]
    rows += [(ids[0], " ".join(f"{a} {b}" for a, b in pairs))]
    rows += [(ids[1], " ".join(f"{a} {pairs[j][1]}" for (a, _), j in zip(pairs, rng.permutation(300))))]
    score = {r.doc_id: r.score for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert score[ids[0]] > score[ids[1]] + 200


def test_shuffles_of_the_model_are_removed(spark, monkeypatch):
    """When a table of the model is written, the shuffles that made it take no disk any more."""
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath()
    files = lambda: {f: os.path.getsize(f"{at}/{f}") for at, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}
    before, left, stored = files(), [], lm.stored

    def watched(df, *name, **options):
        out = stored(df, *name, **options)
        left.append(sum(size for f, size in files().items() if f not in before))
        return out

    monkeypatch.setattr(lm, "stored", watched)
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 300))) for i in range(200)]
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting)
    found = score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len(left) > 10 and max(left) < 50_000  # a few sums; the requests alone are ten times that
    assert spark.conf.get(setting) == kept
    assert found.count() == 200


def test_little_of_the_model_is_in_memory_at_once(spark, folder, monkeypatch):
    """Python gets few rows at a time, counts take few bytes, and of the model's tables only the scores are left."""
    batches, stored, models = lm.map_batches, lm.stored, []

    def watched(df, fn, schema):
        def sized(rows):
            for batch in rows:  # a batch ends with the row that goes beyond the limit
                with open(f"{folder}/{os.getpid()}", "a") as f:
                    f.write(f"{batch.slice(0, batch.num_rows - 1).nbytes}\n")
                yield batch

        return batches(df, lambda rows: fn(sized(rows)), schema)

    def kept(df, name):
        out = stored(df, name)
        models.extend(out.collect() if name == "lm_model" else [])
        return out

    monkeypatch.setattr(lm, "map_batches", watched)
    monkeypatch.setattr(lm, "stored", kept)
    monkeypatch.setattr(lm, "BATCH_BYTES", 1 << 16, raising=False)
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, 400))) for i in range(500)]
    before, setting = len(session._workspaces), "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(setting, None)
    found = score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(1))
    sizes = [int(x) for name in os.listdir(folder) for x in open(f"{folder}/{name}")]
    assert len(sizes) > 50 and max(sizes) < 2 << 16  # all documents are 15 times that
    assert spark.conf.get(setting, None) == was
    assert models and all(len(x) < 3 * lm._wide(r.per, len(r.words) // 8).sum() for r in models for x in r.kept)
    left = [p for p in session._workspaces[before:] if any(names for _, _, names in os.walk(p.removeprefix("file:")))]
    assert [os.path.basename(p).split("-")[0] for p in left] == ["lm_scores"]
    assert found.count() == 500


def test_parts_answer_in_any_number_of_rounds(spark, monkeypatch):
    rows = [(i, f"a{i} b{i % 7} c d{i % 3}") for i in range(100)] + [(None, None)]
    df, found = spark.createDataFrame(rows, "doc_id long, text string"), []
    for n in (1, 2, 5):
        monkeypatch.setattr(lm, "ROUNDS", n)
        found.append(sorted(map(str, score_documents(df).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 101


def test_numbers_are_sorted_with_their_places():
    """As numpy sorts them, also hashes that share their first bits and numbers that repeat."""
    rng = np.random.default_rng(11)
    close = (np.uint64(1 << 63) + rng.integers(0, 50, 3000).astype(np.uint64)).astype(np.uint64)
    large = rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64)
    for x in (close, large, np.append(large, large[:900]), rng.integers(0, 40, 900).astype(np.uint32), large[:1], large[:0]):
        found, order = lm._sorted(x)
        assert found.dtype == x.dtype and (found == x[order]).all() and (order == np.argsort(x, kind="stable")).all()
        found, of = lm._distinct(x)
        expected, places = np.unique(x, return_inverse=True)
        assert (found == expected).all() and (of == places).all()
    for x in (np.unique(close), large, np.append(large[:5], np.uint64(2**64 - 1)), large[:1], large[:0]):
        x = rng.permutation(x)
        asked = np.concatenate([x, close, large[:500] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        place = {int(h): i for i, h in enumerate(x)}
        assert lm._Places(x).find(asked).tolist() == [place.get(int(h), len(x)) for h in asked]


def test_requests_of_a_part_are_answered_together(spark, monkeypatch):
    """Small requests of many chunks cost no look-up each, and a round's chunk sorts the pairs of its parts once."""
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 50)), i % 5 == 0) for i in range(60)]
    chunks = lm._chunks(spark.createDataFrame(rows, "id long, text string, held boolean").repartition(20))
    counted = lm._count(lm._requests(chunks, 4, training=True), 4)
    totals, first = lm._sum_totals(counted), lm._context_totals(counted, 4)
    state = counted.withColumn("kept", F.array("t")).withColumn("kept_m", F.array("m"))
    model, asked = lm._model(state, first, [first]), lm._requests(chunks, 4, training=False)
    batches, tasks = lm.map_batches, []

    def kept(df, fn, schema):
        tasks.append((df, fn))
        return batches(df, fn, schema)

    monkeypatch.setattr(lm, "map_batches", kept)
    found = {(r.chunk, r.part): (r.c, r.p) for r in lm._answers(asked, model, 4, [totals]).collect()}
    assert len(found) == asked.count() > 40
    calls, answer = [], _Part.answer
    monkeypatch.setattr(_Part, "answer", lambda self, *x: calls.append(len(x[0])) or answer(self, *x))
    df, emit = tasks[-1]
    again = [r for batch in emit(iter(df.coalesce(1).toArrow().to_batches())) for r in batch.to_pylist()]
    assert {(r["chunk"], r["part"]): (r["c"], r["p"]) for r in again} == found
    assert 4 <= len(calls) < 20  # before, one for each of the requests


def test_seating():
    rng = np.random.default_rng(2)
    c = np.array([0, 1, 2, 1000, 1_000_000])
    t = seat(c, np.full(5, 50.0), np.full(5, 0.01), 0.75, 5.0, rng)
    assert t[0] == 0 and t[1] == 1 and ((t >= (c > 0)) & (t <= c)).all() and t[4] > t[3] > 1


def test_toxicity(spark, docs, no_docs):
    # enough labels to learn from: some hundred toxic ones, of which about a fifth is held out
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(df, labels).join(labels, "doc_id").where("toxic is not null").collect()
    assert all(r.held_out == (part(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    clean = [r.score for r in rows if r.held_out and not r.toxic]
    toxic = [r.score for r in rows if r.held_out and r.toxic]
    assert np.mean([a < b for a in clean for b in toxic]) > 0.85 and np.mean(np.array(clean) < 0.5) > 0.95
    assert score_toxicity(no_docs, labels).count() == 0
    few = spark.createDataFrame([(20, 1, 9), (20, 0, 9), (21, 0, 9), (None, 1, 9), (22, None, 9), (999, 1, 9)], "doc_id long, toxic int, label int")
    for given in (few, few.limit(0)):
        rows = score_toxicity(docs, given).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_no_marking_word_is_cut(spark, monkeypatch):
    """More strong words than there are features: rarer ones that stand in toxic documents only still mark."""
    rng = np.random.default_rng(4)
    fill = lambda: [f"fill{i}" for i in rng.integers(0, 300, 40)]
    strong = lambda: [f"strong{i}" for i in rng.choice(700, 60, replace=False)]
    rows = [(i, " ".join(fill() + strong()), 1) for i in range(400)]
    rows += [(1000 + i, " ".join([*fill(), f"rare{i % 25}"]), 1) for i in range(300)]
    rows += [(2000 + i, " ".join(fill()), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    marked = {r.word % (1 << 64) for r in toxicity.lexicon(df.select(df.toxic.alias("label"), "text"))[0].collect()}
    assert {word_hash(f"strong{i}") for i in range(700)} | {word_hash(f"rare{i}") for i in range(25)} <= marked
    found = {r.doc_id: r for r in score_toxicity(df.drop("toxic"), df.select("doc_id", "toxic")).collect()}
    rare = [r.score for i, r in found.items() if r.held_out and 1000 <= i < 2000]
    clean = [r.score for i, r in found.items() if r.held_out and i >= 2000]
    assert min(rare) > 0.5 and np.mean(np.array(clean) < 0.5) > 0.95
    monkeypatch.setattr("transferkit.llm.toxicity.BROADCAST_WORDS", 0)  # joined on the documents' words
    again = {r.doc_id: r for r in score_toxicity(df.drop("toxic"), df.select("doc_id", "toxic")).collect()}
    assert all(abs(again[i].score - r.score) < 1e-6 for i, r in found.items()) and len(again) == len(rows)


def test_word_hash_is_that_of_batches(spark):
    import pyarrow as pa

    from transferkit.llm.batches import pieces, words as hashed

    texts = ["a Bc, éé", "", "a", "b"]
    batch = pa.record_batch({"text": texts})
    found = [h for _, data, starts in pieces(batch, "text", 3) for h in hashed(data, starts)[0].tolist()]
    assert found == [word_hash(w) for w in ("a", "bc", "éé", "a", "b")]


def gram_buckets(text):
    """Buckets of a text's character n-grams, one number at a time."""
    small = [c.lower() if len(c.lower()) == 1 and ord(c) < 1 << 16 else c for c in text]
    shape = [0x20 if ord(c) < 128 and not "a" <= c <= "z" else ord(c) for c in small]
    for n in range(1, 5):
        for i in range(len(shape) - n + 1):
            code = 0
            for x in shape[i : i + n]:
                code = (code * 0x9E3779B97F4A7C15 + x) % 2**64
            code ^= n * 0x3C6EF372FE94F82B % 2**64
            code ^= code >> 29
            yield code * 0xBF58476D1CE4E5B9 % 2**64 >> 48


def test_language_by_hand(spark):
    words_of = {"en": "the of and to in is", "de": "der die und zu in ist ß", "zh": "的 是 不 了 在 人", "ru": "И не на Что он как"}
    rng = np.random.default_rng(9)
    rows = [
        (i, " ".join(rng.choice(words_of[lang].split(), rng.integers(1, 9))), lang if i % 11 else None)
        for i, lang in enumerate(rng.choice(list(words_of), 150).tolist())
    ] + [(900, "ЧТО", "ru"), (901, "😀ß中", "zh"), (902, None, "en"), (903, "12", "en")]
    counts, priors = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang in rows:
        if lang is not None and part(i, 3) != 1:
            priors[lang] += 1
            counts[lang].update(gram_buckets(text or ""))
    found = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, text, _ in rows:
        logs = {}
        for lang, seen in counts.items():
            whole = sum(seen.values()) + 0.1 * 65536
            logs[lang] = math.log(priors[lang] / sum(priors.values())) + sum(math.log((seen[b] + 0.1) / whole) for b in gram_buckets(text or ""))
        best = max(sorted(logs), key=logs.get)
        lettered = any(c.isalpha() for c in text or "")
        assert found[i].lang_pred == (best if lettered else "und")
        sure = 1 / sum(math.exp(x - logs[best]) for x in logs.values())
        assert abs(found[i].score - (sure if lettered else 0)) < 1e-3
