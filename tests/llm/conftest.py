import random
import re

import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, id int, size int, "
    "text_hash string, kept string, label string, `key` int, n int, `a.b` string"
)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text, lang, source) rows: nulls, empty and very long texts, copies, near-copies, repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 60_000)
    passage = prose(rng, 90)
    plain = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, long, "de", "b"),
        (5, long[:5000], "de", "b"), (6, "the end", "en", "a"), (7, "The\x00 END!", "en", None),
        (8, "!!!\n\n???", "en", "a"), (9, "x " * 300, "en", "b"), (10, "x " * 300, "en", "b"),
        (11, "All rights reserved. all RIGHTS reserved CC-BY", "en", "a"),
        (11, "All rights reserved. all RIGHTS reserved CC-BY", "en", "a"),
        (None, "General Public License by", "fr", "c"), (None, None, None, None),
        (12, "é" * 250 + passage, "fr", "c"), (13, "ß" * 230 + passage + " end", "fr", "c"),
    ]
    rows += [(20 + i, t, ("en", "de", "fr")[i % 3], "abc"[i % 3]) for i, t in enumerate(plain)]
    near = plain[0].split()
    for i in range(6):  # one word changed each
        rows.append((60 + i, " ".join(near[: 20 * i]) + f" changed{i} " + " ".join(near[20 * i + 1 :]), "en", "a"))
    rows += [(70 + i, plain[1], "de", "b") for i in range(4)]
    rows += [(80 + i, plain[2 + i] + " " + passage + "\n" + plain[3 + i], "en", "d") for i in range(5)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, awkward):
    full = [(i, t, lang, s, len(t or ""), "r", 1, 2, "h", "k", "l", 3, 4, "d") for i, t, lang, s in awkward]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
