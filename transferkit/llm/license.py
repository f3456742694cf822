"""License scans by a positional index over the rarest licence words.

Clauses of known licences are indexed by word and place.  A document's occurrences of a clause's anchor (the
word of highest IDF over the corpus in its key phrase) give places where the clause may start; the other words'
postings are intersected there by relative place, and a label stands if its key phrase is whole.  As it must be,
the anchor is at every place where the clause stands, whichever of the phrase's words it is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches, pieces, word_hash, words
from transferkit.llm.words import text_of


@dataclass(frozen=True)
class Clause:
    """Words of a licence, a phrase among them that must stand whole, and the share of words that must match."""

    label: str
    text: str
    key: str
    least: float = 0.6
    base: bool = False


BASE = (
    Clause("cc-by", "cc by", "cc by", 1.0, True),
    Clause("gpl", "general public license", "general public license", 1.0, True),
    Clause("reserved", "all rights reserved", "all rights reserved", 1.0, True),
)
# Words of public licence notices.
CLAUSES = BASE + (
    Clause("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Clause("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "in compliance with the license"),
    Clause("mit", "released under the mit license", "the mit license"),
    Clause("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge to any person obtaining a copy"),
    Clause("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Clause("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "in source and binary forms"),
    Clause("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Clause("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Clause("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Clause("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Clause("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Clause("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Clause("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Clause("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Clause("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Clause("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    Clause("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


class Index:
    """Word postings of all clauses; ``idf`` by word picks each clause's anchor."""

    def __init__(self, clauses: tuple[Clause, ...], idf: dict[str, float] | None = None):
        self.clauses = clauses
        self.texts = [c.text.split() for c in clauses]
        self.vocabulary = sorted({w for t in self.texts for w in t})
        hashes = np.array([word_hash(w) for w in self.vocabulary], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.words = [np.array([number[w] for w in t]) for t in self.texts]
        idf = idf or {}
        self.anchors, self.keys = [], []
        for c, t in zip(clauses, self.texts):
            key = c.key.split()
            k = next(i for i in range(len(t)) if t[i : i + len(key)] == key)
            self.keys.append((k, len(key)))
            # only the key's words must all match
            self.anchors.append(min(range(k, k + len(key)), key=lambda i: (-idf.get(t[i], math.inf), t[i], i)))

    def found(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def matches(self, number: np.ndarray, first: np.ndarray, end: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where clause ``c`` stands, and the share of its words found there.

        ``first`` and ``end`` bound the document of each word; a clause may begin before its document's first
        word if what is left of it suffices.
        """
        clause = self.words[c]
        of = np.flatnonzero(number == clause[self.anchors[c]])
        start = of - self.anchors[c]
        lo, hi = first[of], end[of]
        place = start[:, None] + np.arange(len(clause))
        inside = (place >= lo[:, None]) & (place < hi[:, None])
        same = inside & (number[np.clip(place, 0, max(len(number) - 1, 0))] == clause)
        share = same.mean(axis=1) if len(start) else np.zeros(0)
        k, n = self.keys[c]
        good = same[:, k : k + n].all(axis=1) & (share >= self.clauses[c].least)
        # the document is told by a word that is surely inside it: the key's first
        return start[good] + k, share[good]


def document_frequencies(docs: DataFrame, text_col: str, clauses: tuple[Clause, ...]) -> tuple[int, dict[str, int]]:
    """Documents in all, and with each licence word; what is collected has the size of the vocabulary."""
    index = Index(clauses)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocabulary) + 1, np.int64)
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                total[-1] += rows.num_rows
                hashes, _, _, per_doc = words(data, starts)
                number = index.found(hashes)
                hit = np.flatnonzero(number >= 0)
                doc = np.searchsorted(per_doc, hit, "right") - 1
                pairs = np.unique(doc * len(index.vocabulary) + number[hit])
                total[:-1] += np.bincount(pairs % len(index.vocabulary), minlength=len(index.vocabulary))
        yield pa.record_batch({"word": np.arange(len(total), dtype=np.int32), "n": total})

    rows = map_batches(docs.select(text_of(text_col).alias("text")), count, "word int, n long")
    n = {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return n.get(len(index.vocabulary), 0), {w: n.get(i, 0) for i, w in enumerate(index.vocabulary)}


FIELDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
}


def _scan(index: Index, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for rows, data, starts in pieces(batch, "text"):
        hashes, _, _, per_doc = words(data, starts)
        n = rows.num_rows
        number = index.found(hashes)
        doc = np.repeat(np.arange(n), np.diff(per_doc))
        first, end = per_doc[doc], per_doc[doc + 1]
        n_base, low, high, score = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1), np.zeros(n)
        base_labels = [set() for _ in range(n)]
        labels = [set() for _ in range(n)]
        for c, clause in enumerate(index.clauses):
            place, share = index.matches(number, first, end, c)
            d = doc[place] if len(place) else np.zeros(0, np.int64)
            np.maximum.at(score, d, share)
            for i in np.unique(d):
                labels[i].add(clause.label)
            if clause.base:
                np.add.at(n_base, d, 1)
                np.minimum.at(low, d, place - per_doc[d])
                np.maximum.at(high, d, place - per_doc[d])
                for i in np.unique(d):
                    base_labels[i].add(clause.label)
        none = n_base == 0
        columns = {
            "n_words": np.diff(per_doc),
            "n_base": n_base,
            "first_word": pa.array(low, pa.int64(), mask=none),
            "last_word": pa.array(high, pa.int64(), mask=none),
            "base_labels": [",".join(sorted(x)) for x in base_labels],
            "labels": [",".join(sorted(x)) for x in labels],
            "score": score,
        }
        yield pa.record_batch(
            [rows.column("id"), *[pa.array(v, FIELDS[k]) if not isinstance(v, pa.Array) else v for k, v in columns.items()]],
            names=["id", *columns],
        )


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", clauses: tuple[Clause, ...] = CLAUSES
) -> DataFrame:
    """Licence labels of every document, one row for each input row.

    Null and empty texts have no words and no labels, score 0.  IDF ties go by the word.  Repeated rows give
    repeated results; other columns are not read.
    """
    n, df = document_frequencies(docs, text_col, clauses)
    index = Index(clauses, {w: math.log((n + 1) / (x + 1)) for w, x in df.items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _scan(index, batch)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = map_batches(
        rows,
        scan,
        f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
    return out.withColumnRenamed("id", id_col)
