"""License scans with a positional index of rare words.

The templates are licence names, notices, identifier lines and passages of licence texts.
Document frequencies of their words are counted over all texts.  Of a file, the places of
all licence words are listed; beginning with the words of highest inverse document
frequency, the templates are opened of which that word is the rarest of the mandatory key
phrase.  The places of the key phrase's words, each moved back by its offset, are
intersected, which leaves the starts where the whole phrase stands.  Of the template's
other words those found at the same start count, and a match is kept if all words found
carry enough of the template's weight.  A base template is its own key phrase, so its
places are exactly those where its words stand one after another.

Defined cases: a null or empty text has no words, no places and no labels; repeated rows
give repeated rows; over an empty table all words are equally rare and ties go to the
word that comes first in the alphabet.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import alnum_words, per_text


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]  #: start and end of the mandatory phrase within the words
    base: bool = False


def template(label: str, phrase: str, key: str | None = None, base: bool = False) -> Template:
    words = tuple(phrase.split())
    need = tuple((key or phrase).split())
    at = next(i for i in range(len(words)) if words[i : i + len(need)] == need)
    return Template(label, words, (at, at + len(need)), base)


#: Base phrases: exact, and counted.
BASE = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
)
# Names, notices and passages of public licences, in words.  The second
# phrase must stand there word for word; words that only lead in are left out.
NOTICES = (
    template("gpl-3.0", "gnu general public license version 3"),
    template("gpl-3.0", "gnu gpl v3"),
    template("gpl-3.0", "gnu gpl version 3"),
    template("gpl-3.0", "gplv3"),
    template(
        "gpl-3.0",
        "redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 3",
    ),
    template("gpl-2.0", "gnu general public license version 2"),
    template("gpl-2.0", "gnu gpl v2"),
    template("gpl-2.0", "gnu gpl version 2"),
    template("gpl-2.0", "gplv2"),
    template(
        "gpl-2.0",
        "redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 2 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 2",
    ),
    template("lgpl", "gnu lesser general public license", "lesser general public license"),
    template("agpl", "gnu affero general public license", "affero general public license"),
    template("apache-2.0", "apache license version 2 0"),
    template("apache-2.0", "apache license 2 0"),
    template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
        "www apache org licenses license 2 0",
    ),
    template("cc-by-nc-4.0", "cc by nc 4 0"),
    template("cc-by-sa-4.0", "cc by sa 4 0"),
    template("cc-by-nd-4.0", "cc by nd 4 0"),
    template("cc-by-4.0", "cc by 4 0"),
    template("cc-by-4.0", "creative commons attribution 4 0"),
    template("cc-by-sa-4.0", "creative commons attribution sharealike 4 0"),
    template("mit-notice", "under the mit license"),
    template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
        "deal in the software without restriction",
    ),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    template("bsd-3-clause", "bsd 3 clause"),
    template(
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        "endorse or promote products derived from this software",
    ),
    template("bsd-2-clause", "bsd 2 clause"),
    template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "for any purpose with or without fee is hereby granted",
    ),
    template("mozilla", "mozilla public license version 2 0", "mozilla public license"),
    template("mozilla", "mozilla public license v 2 0", "mozilla public license"),
    template("eclipse", "eclipse public license v 2 0", "eclipse public license"),
    template("unlicense", "released into the public domain", "into the public domain"),
    template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    template("cc0", "creative commons zero v1 0 universal", "creative commons zero"),
    template("cc0", "cc0 1 0 universal"),
    template("proprietary", "all rights reserved", "all rights reserved"),
    *(
        template(label, f"spdx license identifier {name}")
        for label, name in (
            ("mit", "mit"),
            ("apache-2.0", "apache 2 0"),
            ("gpl-3.0", "gpl 3 0"),
            ("gpl-2.0", "gpl 2 0"),
            ("lgpl", "lgpl"),
            ("agpl", "agpl"),
            ("bsd-3-clause", "bsd 3 clause"),
            ("bsd-2-clause", "bsd 2 clause"),
            ("mozilla", "mpl 2 0"),
            ("eclipse", "epl 2 0"),
            ("isc", "isc"),
            ("unlicense", "unlicense"),
            ("cc0", "cc0 1 0"),
            ("cc-by-4.0", "cc by 4 0"),
            ("cc-by-sa-4.0", "cc by sa 4 0"),
            ("cc-by-nc-4.0", "cc by nc 4 0"),
            ("cc-by-nd-4.0", "cc by nd 4 0"),
        )
    ),
)
#: Share of a template's inverse document frequency that must be found.
ENOUGH = 0.8

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
    ]
)


def vocabulary(templates: tuple[Template, ...]) -> list[bytes]:
    return sorted({w.encode() for t in templates for w in t.words})


def _count_words(words: list[bytes]):
    """Per task: the number of texts that hold each licence word; ``-1`` for all texts."""

    def run(batches):
        have, n = np.zeros(len(words), np.int64), 0
        slot = {w: i for i, w in enumerate(words)}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                for w in slot.keys() & set(alnum_words(text)):
                    have[slot[w]] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(words))], pa.int32()), pa.array([n, *have], pa.int64())],
            names=["slot", "n"],
        )

    return run


def inverse_frequencies(
    docs: DataFrame, templates: tuple[Template, ...], text: str = "text"
) -> dict[bytes, float]:
    """Inverse document frequency of every template word over all texts."""
    words = vocabulary(templates)
    counted = docs.select(text).mapInArrow(_count_words(words), "slot int, n long")
    n = {r["slot"]: r["n"] for r in counted.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    total = n.get(-1, 0)
    return {w: math.log((total + 1) / (n.get(i, 0) + 1)) + 1 for i, w in enumerate(words)}


class Index:
    """Positional postings of the templates under given word weights."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates, self.idf = templates, idf
        #: rarest word of the key phrase -> templates
        self.opened: dict[bytes, list[int]] = defaultdict(list)
        #: per template: the key's words, rarest first, and the others, with offset and weight
        self.keys: list[list[tuple[int, bytes, float]]] = []
        self.others: list[list[tuple[int, bytes, float]]] = []
        for i, t in enumerate(templates):
            words = [w.encode() for w in t.words]
            total = sum(idf[w] for w in words)
            rows = [(j, w, idf[w] / total) for j, w in enumerate(words)]
            key = sorted(rows[slice(*t.key)], key=lambda r: (-idf[r[1]], r[1], r[0]))
            self.opened[key[0][1]].append(i)
            self.keys.append(key)
            self.others.append([r for r in rows if not t.key[0] <= r[0] < t.key[1]])

    def starts_of(self, i: int, places: dict[bytes, set[int]]) -> set[int]:
        """Where the template's key phrase stands: the postings of its words, each moved
        back by its offset, intersected from the rarest word on."""
        out: set[int] | None = None
        for j, w, _ in self.keys[i]:
            here = places.get(w)
            if not here:
                return set()
            out = {p - j for p in here} if out is None else {s for s in out if s + j in here}
            if not out:
                return out
        return out or set()

    def scan(self, text: str | None) -> tuple:
        words = alnum_words(text)
        places: dict[bytes, set[int]] = {}
        for at, word in enumerate(words):
            if word in self.idf:
                places.setdefault(word, set()).add(at)
        starts, labels, base, best = set(), set(), set(), 0.0
        # the file's licence words, highest inverse document frequency first
        for word in sorted(places.keys() & self.opened.keys(), key=lambda w: (-self.idf[w], w)):
            for i in self.opened[word]:
                t = self.templates[i]
                for start in self.starts_of(i, places):
                    share = sum(x for _, _, x in self.keys[i])
                    share += sum(x for j, w, x in self.others[i] if start + j in places.get(w, ()))
                    if share < (ENOUGH if not t.base else 1 - 1e-9):
                        continue
                    labels.add(t.label)
                    best = max(best, min(share, 1.0))
                    if t.base:
                        base.add(t.label)
                        starts.add(start)
        return len(words), sorted(starts), sorted(base), sorted(labels), best


def scan_licenses(
    docs: DataFrame,
    out: str,
    *,
    text: str = "text",
    templates: tuple[Template, ...] = BASE + NOTICES,
) -> DataFrame:
    """``docs`` with a struct column ``out``.

    ``n_words``, ``starts`` (of base phrases, in words), ``base_labels``, ``labels``
    (both distinct and sorted) and ``score``, the best share of a template's weight that
    was found.  Two base phrases never start at the same word.
    """
    idf = inverse_frequencies(docs, templates, text)

    def make():
        return Index(templates, idf).scan

    return docs.withColumn(out, per_text(make, FOUND)(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: license labels of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_licenses(docs, "found")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        F.size("found.starts").cast("long").alias("n_base"),
        F.array_min("found.starts").alias("first_word"),
        F.array_max("found.starts").alias("last_word"),
        F.array_join("found.base_labels", ",").alias("base_labels"),
        F.array_join("found.labels", ",").alias("labels"),
        F.round("found.score", 9).alias("score"),
    )


def _sql_templates() -> str:
    """The templates' words as SQL values ``(t, label, base, first, last, j, word)``."""
    return ", ".join(
        f"({i}, '{t.label}', {str(t.base).lower()}, {t.key[0]}, {t.key[1]}, {j}, '{w}')"
        for i, t in enumerate(BASE + NOTICES)
        for j, w in enumerate(t.words)
    )


ORACLE = (
    "WITH tw(t, label, base, first, last, j, word) AS (VALUES "
    + _sql_templates()
    + r"""),
d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
pos AS (
  SELECT r, i, word FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d)
  WHERE word IN (SELECT word FROM tw)),
idf AS (
  SELECT word, ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 1 AS x
  FROM (SELECT DISTINCT word FROM tw)
  LEFT JOIN (SELECT word, count(DISTINCT r) AS n FROM pos GROUP BY word) USING (word)),
wt AS (SELECT tw.*, x / sum(x) OVER (PARTITION BY t) AS x FROM tw JOIN idf USING (word)),
hit AS (
  SELECT r, t, label, base, last - first AS need, i - j AS s, sum(x) AS share,
         count(*) FILTER (j >= first AND j < last) AS k
  FROM pos JOIN wt USING (word) GROUP BY ALL),
ok AS (
  SELECT * FROM hit WHERE k = need AND share >= CASE WHEN base THEN 1 - 1e-9 ELSE 0.8 END),
agg AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS a, max(s) FILTER (base) AS b,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(least(share, 1)) AS score
  FROM ok GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(a AS BIGINT) AS first_word, CAST(b AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0.0), 9) AS score
FROM d LEFT JOIN agg USING (r)
"""
)
