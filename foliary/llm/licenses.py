"""Licence scan with a positional rare-token index, in DataFrame functions only.

The index maps each licence word to its postings, that is to the templates that
hold it and its offset there. Document frequencies of the licence words are
counted over all documents. In every file the places of the licence words are
listed; for each template the places of the two words of its mandatory key phrase
with the highest inverse document frequency, each less the word's offset, are
intersected, which leaves the starts where both stand at their relative position.
There the whole key phrase is compared word for word. A key phrase holds its own
rarest words, so no place is missed. The share of a template's inverse document
frequencies that agrees at their relative positions is the match's coverage.

Words are runs of ASCII letters and digits and of anything beyond ASCII, after
lower-casing A to Z. Null texts count as empty and match nothing; an empty
table gives no rows; repeated rows give repeated results. scan() replaces columns
called n_words and matches and passes all others through. Only the frequencies
of the licence words, whose number is that of the templates' words, come to the
driver.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: What separates words after lower-casing.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """label: what a match adds; words: the licence line; key: the phrase that must stand in full; base: one of the plain phrases."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words) - n + 1) if self.words[i : i + n] == self.key)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _t(label: str, text: str, key: str, base: bool = False) -> Template:
    return Template(label, tuple(WORD.findall(text.lower())), tuple(key.split()), base)


BASE = (
    _t("cc-by", "cc by", "cc by", True),
    _t("gpl", "general public license", "general public license", True),
    _t("reserved", "all rights reserved", "all rights reserved", True),
)
# The words of public licences and of the lines that name them.
TEMPLATES = (
    _t("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2"),
    _t(
        "apache-2.0",
        """you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
        "unless required by applicable law or agreed to in writing software",
    ),
    _t("mit", "released under the MIT License", "the mit license"),
    _t(
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
        "free of charge to any person obtaining a copy",
    ),
    _t("gpl-2.0", "licensed under the GNU General Public License version 2", "gnu general public license version 2"),
    _t("gpl-3.0", "this work is licensed under the GNU General Public License version 3", "gnu general public license version 3"),
    _t(
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
        "as published by the free software foundation either version",
    ),
    _t("lgpl", "licensed under the GNU Lesser General Public License", "lesser general public license"),
    _t("agpl", "licensed under the GNU Affero General Public License", "affero general public license"),
    _t("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license"),
    _t("epl", "made available under the terms of the Eclipse Public License", "eclipse public license"),
    _t(
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.""",
        "redistribution and use in source and binary forms",
    ),
    _t(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
        "copy modify and or distribute this software",
    ),
    _t("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "in no event will the authors be held liable"),
    _t("boost", "distributed under the Boost Software License, Version 1.0", "boost software license"),
    _t("unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered software released into the public domain"),
    _t("cc0-1.0", "released under CC0 1.0 Universal", "cc0 1 0"),
    _t("cc-by-4.0", "licensed under CC BY 4.0", "cc by 4 0"),
    _t("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    _t("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    _t("cc-by-nd", "licensed under CC BY-ND 4.0", "cc by nd"),
    _t("public-domain", "this work is in the public domain", "is in the public domain"),
)


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BREAKS), "")


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def frequencies(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[str, float]:
    """The inverse document frequency of each licence word over all documents, which are counted along (as an empty word)."""
    known = F.array(*map(F.lit, vocabulary(templates)))
    found = docs.select(F.explode(F.array_append(F.array_intersect(words(F.col(text)), known), "")).alias("word"))
    df = {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = df.get("", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary(templates)}


def _rarest(template: Template, idf: dict[str, float]) -> list[int]:
    """Places in the key phrase of its two words with the highest inverse document frequency; of equal words the first."""
    first = sorted({template.key.index(w) for w in template.key}, key=lambda i: (-idf[template.key[i]], i))
    return first[:2]


def _places(template: Template, idf: dict[str, float]) -> Column:
    """Starts of the template's key phrase: where its rarest words stand at their relative position, and then all of it."""

    def from_word(place: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == template.key[place]), lambda h: h["at"] - F.lit(place))

    starts = [from_word(i) for i in _rarest(template, idf)]
    both = F.array_intersect(*starts) if len(starts) == 2 else starts[0]
    stands = lambda s: (s >= 0) & (F.slice("words", F.greatest(s + 1, F.lit(1)), len(template.key)) == F.array(*map(F.lit, template.key)))
    return F.filter(both, stands)


def _coverage(template: Template, idf: dict[str, float], start: Column) -> Column:
    """Share of the template's frequencies whose words stand where they would if the key phrase began at ``start``."""
    total = sum(idf[w] for w in template.words)
    weighted = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(idf[w]).alias("idf")) for w in template.words])
    agreed = F.transform(weighted, lambda t, i: F.when(F.get(F.col("words"), start + i - F.lit(template.key_at)) == t["word"], t["idf"]).otherwise(0.0))
    return F.round(F.aggregate(agreed, F.lit(0.0), lambda a, b: a + b) / total, 6)


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``matches``: label, base, start (in words, from 0) and coverage of each match."""
    idf = frequencies(docs, templates, text)
    rarest = sorted({t.key[i] for t in templates for i in _rarest(t, idf)})
    kept = [c for c in docs.columns if c not in ("n_words", "matches")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(rarest), F.struct(i.alias("at"), w.alias("word")))), lambda h: h.isNotNull())

    def of(t: Template) -> Column:
        return F.transform(
            _places(t, idf),
            lambda s: F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.cast("long").alias("start"), (F.lit(1.0) if t.base else _coverage(t, idf, s)).alias("coverage")),
        )

    matches = F.when(F.size("hits") > 0, F.flatten(F.array(*map(of, templates))))
    kind = "array<struct<label:string,base:boolean,start:bigint,coverage:double>>"
    return (
        docs.select(row, words(F.col(text)).alias("words"))
        .select("row", "words", hits.alias("hits"))
        .select("row", F.struct(F.size("words").cast("long").alias("n_words"), F.coalesce(matches, F.array().cast(kind)).cast(kind).alias("matches")).alias("made"))
        .select("row.*", "made.*")
    )


def report(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document: the places of the base phrases, all labels, and the best coverage (a base phrase alone: 0.5)."""
    base = F.filter("matches", lambda m: m["base"])
    labels = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform(F.col("base"), lambda m: m["start"])
    own = F.array_max(F.transform(F.filter("matches", lambda m: ~m["base"]), lambda m: m["coverage"]))
    return (
        scan(docs.select("doc_id", "text"), BASE + templates)
        .select("doc_id", "n_words", "matches", base.alias("base"))
        .select(
            "doc_id",
            "n_words",
            F.size("base").cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            labels(F.col("base")).alias("base_labels"),
            labels(F.col("matches")).alias("labels"),
            F.coalesce(own, F.when(F.size("base") > 0, 0.5), F.lit(0.0)).alias("score"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def sql() -> str:
    """The same rows in DuckDB, by looking for every key phrase at every word."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    rows = ", ".join(f"({i}, '{t.label}', {str(t.base).lower()}, {quoted(t.words)}, {quoted(t.key)}, {t.key_at})" for i, t in enumerate(BASE + TEMPLATES))
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), t(id, label, base, words, key, key_at) AS (VALUES {rows}),
v AS (SELECT DISTINCT unnest(words) AS word FROM t),
u AS (SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
f AS (
  SELECT v.word, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT u.row_id) + 1)) + 1 AS idf
  FROM v LEFT JOIN u ON u.word = v.word GROUP BY v.word
), k AS (
  SELECT u.row_id, t.id, t.label, t.base, u.pos, t.words AS tw, d.words AS dw, u.pos - t.key_at AS shift
  FROM u JOIN t ON u.word = t.key[1] JOIN d ON d.row_id = u.row_id
  WHERE d.words[u.pos + 1 : u.pos + len(t.key)] = t.key
), e AS (SELECT *, unnest(tw) AS word, unnest(range(len(tw))) AS off FROM k WHERE NOT base),
c AS (
  SELECT e.row_id, e.id, e.pos, round(sum(CASE WHEN shift + off >= 0 AND dw[shift + off + 1] = e.word THEN idf ELSE 0.0 END) / sum(idf), 6) AS coverage
  FROM e JOIN f ON f.word = e.word GROUP BY ALL
), m AS (SELECT k.row_id, k.label, k.base, k.pos, c.coverage FROM k LEFT JOIN c ON c.row_id = k.row_id AND c.id = k.id AND c.pos = k.pos),
s AS (
  SELECT row_id, count(*) FILTER (WHERE base) AS n_base, min(pos) FILTER (WHERE base) AS first_word, max(pos) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS coverage
  FROM m GROUP BY row_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(coverage, CASE WHEN n_base > 0 THEN 0.5 END, 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN s ON s.row_id = d.row_id
"""
