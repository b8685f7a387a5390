"""License scans: exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, across line breaks, as long as a template and ``ADDED``
more (shorter at the end of a text). A block meets a template when it holds at least
``CONTAINMENT`` of the template's distinct words, and its distinguishing words one after the
other, which keep apart templates that share most words.

The words of all templates are ordered by how many texts hold them, rarest first. Of a
template with n words of which t must be held, any n - t + 1 include one that is held, so
only the n - t + 1 rarest (its prefix) are indexed. Every text is cut into words once; a text
without a prefix word is done. The places of prefix words meet their templates if the words
around are enough (length filter) and if the template words on both sides of the shared one, in
that order, can still add up to t (positional filter). What is left is verified by intersection
for every block that covers the place.

Beside it, fixed phrases are counted where their words stand consecutively.

Everything is DataFrame operations. Null and empty texts have no words, and so no places, null
first and last word, empty labels and score 0. A-Z alone are lower-cased. Repeated rows each get
their result: rows are numbered when they are written, and no row meets another one's notices.
Ties: a label is listed once however many notices and templates give it. Very long texts are
taken whole; a place carries the words around it only. Empty tables give no rows. Other columns
of the input are not read; template words and their counts are bounded by the templates and
are kept on the driver.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import ascii_lower, stored, table
from stratamart.llm.registry import query

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = 0.8
#: Words that may be added inside a notice.
ADDED = 2

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """``must``: runs of words that set the label apart; each stands unbroken in every notice of it."""

    label: str
    text: str
    must: tuple[str, ...] = ()

    @property
    def run(self) -> tuple[str, ...]:
        return tuple(re.findall(WORD, self.text.lower()))

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(sorted(set(self.run)))

    @property
    def needed(self) -> int:
        return math.ceil(CONTAINMENT * len(self.words) - 1e-9)

    @property
    def width(self) -> int:
        return len(self.run) + ADDED


def _gnu(kind: str, version: str) -> str:
    """The notice that the GNU licenses ask for at the start of a file."""
    return (f"you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by "
            f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


#: One-line notices, then the headers and grants of published licenses.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl-3.0", "licensed under the GNU Affero General Public License, version 3", ("gnu affero general public license", "version 3")),
    Template("mit-notice", "Released under the MIT License", ("mit license",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("by sa 4 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("by 4 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use",)),
    Template("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             ("free of charge", "any person obtaining")),
    Template("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use", "or without fee")),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license", "2 0")),
    Template("public-domain", "This is free and unencumbered software released into the public domain", ("public domain",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
             "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("apache license", "2 0")),
    Template("gpl-3.0", _gnu("", "3"), ("gnu general public license", "version 3")),
    Template("gpl-2.0", _gnu("", "2"), ("gnu general public license", "version 2")),
    Template("lgpl", _gnu("Lesser ", "3"), ("gnu lesser general public license",)),
    Template("agpl-3.0", _gnu("Affero ", "3"), ("gnu affero general public license", "version 3")),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
             ("redistributions of source code",)),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission", ("neither the name", "endorse or promote")),
    Template("mit-grant", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
             "distribute, sublicense, and/or sell copies of the Software", ("without restriction", "sublicense")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
             "with this file, You can obtain one at https://mozilla.org/MPL/2.0/", ("mozilla public license", "2 0")),
    Template("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions", ("permission is granted", "redistribute it freely")),
    Template("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
             "accompanying documentation covered by this license", ("person or organization",)),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
             ("eclipse public license", "2 0")),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def lowered(docs: DataFrame, text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def word_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How many texts hold each of the (bounded) template words."""
    held = F.array_intersect(words_of(lowered(docs, text)), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}


@dataclass(frozen=True)
class TemplateIndex:
    """Words numbered from rarest to most frequent, and each template's word numbers, ascending."""

    numbers: dict[str, int]
    rows: tuple[tuple[Template, tuple[int, ...]], ...]

    @classmethod
    def build(cls, templates: tuple[Template, ...], frequency: dict[str, int]) -> TemplateIndex:
        vocabulary = sorted({w for t in templates for w in t.words}, key=lambda w: (frequency.get(w, 0), w))
        numbers = {w: i for i, w in enumerate(vocabulary)}
        return cls(numbers, tuple((t, tuple(sorted(numbers[w] for w in t.words))) for t in templates if t.words))

    @property
    def reach(self) -> int:
        """Words that a block can have on either side of one of its words."""
        return max((t.width for t, _ in self.rows), default=1) - 1

    def prefix_words(self) -> list[str]:
        wanted = {n for t, words in self.rows for n in words[:len(words) - t.needed + 1]}
        return [w for w, n in self.numbers.items() if n in wanted]

    def entries(self, spark: SparkSession) -> DataFrame:
        """(word, template, t_words, t_at, needed, width, must): one row for each prefix word of each template."""
        names = {n: w for w, n in self.numbers.items()}
        quoted = lambda words: ", ".join(f"'{w}'" for w in words)
        rows = [
            f"('{names[words[j]]}', '{t.label}', array({', '.join(map(str, words))}), {j}, {t.needed}, {t.width}, CAST(array({quoted(t.must)}) AS array<string>))"
            for t, words in self.rows for j in range(len(words) - t.needed + 1)
        ]
        return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(word, template, t_words, t_at, needed, width, must)")


def _strings(words) -> Column:
    """An array of words (none holds a bar), as one literal."""
    words = list(words)
    return F.split(F.lit("|".join(words)), "[|]") if words else F.array().cast("array<string>")


def _numbered(words: Column, index: TemplateIndex) -> Column:
    """Each word's number, -1 for words of no template."""
    order = _strings(index.numbers)
    return F.transform(words, lambda w: F.array_position(order, w).cast("int") - 1)


def prefix_places(words: Column, index: TemplateIndex) -> Column:
    """Positions of prefix words in an array of words."""
    prefix = _strings(index.prefix_words())
    found = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(prefix, w), i)), lambda i: i.isNotNull())
    # Most texts hold none, which one hash lookup for each word tells.
    return F.when(F.arrays_overlap(words, prefix), found).otherwise(F.array().cast("array<int>"))


def met_templates(worded: DataFrame, index: TemplateIndex) -> DataFrame:
    """(row, template, containment), the largest, of every label that a block of the row meets; ``worded`` has (row, words, at)."""
    if not index.rows:
        return worded.select("row", F.lit("").alias("template"), F.lit(0.0).alias("containment")).limit(0)
    reach = index.reach
    # The words around each place are cut out as the rows multiply: a place's row is of bounded size.
    places = worded.select("row", "words", F.explode("at").alias("i")).select(
        "row", F.get("words", F.col("i")).alias("word"), F.least("i", F.lit(reach)).alias("centre"),
        F.slice("words", F.greatest(F.col("i") - reach, F.lit(0)) + 1, F.least("i", F.lit(reach)) + reach + 1).alias("near"))
    places = places.withColumn("numbers", _numbered(F.col("near"), index))
    places = places.withColumn("b_words", F.array_sort(F.array_distinct(F.filter("numbers", lambda n: n >= 0))))
    # A row for each prefix word of the given templates: a bounded broadcast.
    met = places.join(F.broadcast(index.entries(worded.sparkSession)), "word")
    b_at, t_at = F.array_position("b_words", F.get("t_words", "t_at")).cast("int") - 1, F.col("t_at")
    can_reach = F.least(b_at, t_at) + 1 + F.least(F.size("b_words") - b_at - 1, F.size("t_words") - t_at - 1) >= F.col("needed")
    met = met.where((F.size("near") >= F.col("needed")) & can_reach)

    def common(start: Column) -> Column:
        held = F.size(F.array_intersect(F.slice("numbers", start + 1, F.col("width")), F.col("t_words")))
        line = F.concat(F.lit(" "), F.array_join(F.slice("near", start + 1, F.col("width")), " "), F.lit(" "))
        whole = F.forall("must", lambda m: F.contains(line, F.concat(F.lit(" "), m, F.lit(" "))))
        return F.when(held >= F.col("needed"), F.when(whole, held).otherwise(0)).otherwise(0)

    starts = F.sequence(F.greatest(F.col("centre") - F.col("width") + 1, F.lit(0)), F.col("centre"))
    met = met.withColumn("common", F.array_max(F.transform(starts, common))).where(F.col("common") >= F.col("needed"))
    return met.groupBy("row", "template").agg(F.max(F.col("common") / F.size("t_words")).alias("containment"))


def phrase_places(words: Column, phrase: str) -> Column:
    """Positions (from 0) in an array of words where the phrase's words stand one after the other."""
    parts = phrase.split()

    def at(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.get(words, i + k) == part)
        return same

    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), at)
    all_there = F.lit(True)
    for part in dict.fromkeys(parts):
        all_there = all_there & F.array_contains(words, part)
    return F.when(all_there & (F.size(words) >= len(parts)), found).otherwise(F.array().cast("array<int>"))


def _worded(docs: DataFrame, keys: list[str], text: str, index: TemplateIndex, phrases: dict[str, str]) -> DataFrame:
    """Every row, numbered and written: keys, counts and places of phrases, and the words of rows that hold a prefix word."""
    named = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    order = [f"k{i}" for i in range(len(keys))]
    parts = docs.select(*named, words_of(lowered(docs, text)).alias("words"))
    parts = parts.select(*order, "words", F.size("words").cast("long").alias("n_words"), prefix_places(F.col("words"), index).alias("at"),
                         *[phrase_places(F.col("words"), p).alias(f"p{i}") for i, p in enumerate(phrases)])
    places = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))]) if phrases else F.array().cast("array<int>")
    base = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]).cast("array<string>"))
    parts = parts.select(
        *order, "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), F.array_distinct(base).alias("base"), "at",
        F.when(F.size("at") > 0, F.col("words")).alias("words"), F.monotonically_increasing_id().alias("row"))
    return stored(parts, "license-words", "zstd")


def _index(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> TemplateIndex:
    vocabulary = sorted({w for t in templates for w in t.words})
    return TemplateIndex.build(templates, word_frequencies(docs, vocabulary, text) if vocabulary else {})


def scan(docs: DataFrame, keys: list[str], text: str = "text", phrases: dict[str, str] = PHRASES,
         templates: tuple[Template, ...] = TEMPLATES, index: TemplateIndex | None = None) -> DataFrame:
    """keys with n_words, n_base, first_word, last_word, base_labels, labels and score for every row.

    ``score`` is the largest containment found, 1 where a phrase stands. ``index`` may give another order of
    words, which changes candidates, never results.
    """
    index = index or _index(docs, text, templates)
    parts = _worded(docs, keys, text, index, phrases)
    found = met_templates(parts.where("words is not null").select("row", "words", "at"), index)
    # A row's templates: at most one entry for each label, combined before the shuffle.
    found = found.groupBy("row").agg(F.collect_set("template").alias("own"), F.max("containment").alias("best"))
    joined = parts.drop("words", "at").join(found, "row", "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keys)], "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        score.alias("score"))


def notices(docs: DataFrame, keys: list[str], text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """keys, template (its label) and containment (the largest) of the notices in every text. Texts without a notice have no row."""
    index = _index(docs, text, templates)
    parts = _worded(docs, keys, text, index, {})
    found = met_templates(parts.where("words is not null").select("row", "words", "at"), index)
    return parts.join(found, "row").select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "template", "containment")


def _sql(phrases: dict[str, str], templates: tuple[Template, ...]) -> str:
    """The same result by comparing every block of every text with every template."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    places = []
    for phrase in phrases:
        parts = phrase.split()
        same = " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(parts))
        places.append(f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {same})")
    lists = ", ".join(f"{x} AS p{i}" for i, x in enumerate(places))
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(phrases.values()))
    known = ", ".join(f"('{t.label}', {quoted(t.words)}, {t.needed}, {t.width}, {quoted(t.must)}::VARCHAR[])" for t in templates)
    return f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents
), worded AS (
  SELECT doc_id, regexp_extract_all(t, '{WORD}') AS w FROM texts
), placed AS (
  SELECT doc_id, len(w) AS n_words, {lists} FROM worded
), summed AS (
  SELECT doc_id, n_words, list_concat({", ".join(f"p{i}" for i in range(len(phrases)))}) AS places,
         list_sort(list_distinct(list_filter([{base}], lambda x: x IS NOT NULL))) AS base FROM placed
), templates(label, words, needed, width, must) AS (VALUES {known}), near AS (
  SELECT doc_id, w, label, words, needed, width, must FROM worded JOIN templates ON len(list_intersect(w, words)) >= needed
), blocks AS (
  SELECT doc_id, label, words, needed, must, w[i + 1:i + width] AS block FROM (SELECT *, unnest(range(len(w))) AS i FROM near)
), met AS (
  SELECT doc_id, list(DISTINCT label) AS own, max(len(list_intersect(block, words)) / len(words)) AS best FROM blocks
  WHERE len(list_intersect(block, words)) >= needed
    AND len(list_filter(must, lambda m: NOT contains(' ' || array_to_string(block, ' ') || ' ', ' ' || m || ' '))) = 0 GROUP BY doc_id
)
SELECT s.doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(base, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM summed s LEFT JOIN met m ON s.doc_id = m.doc_id
"""


@query(_sql(PHRASES, TEMPLATES))
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases, license labels and score of every document."""
    return scan(table(spark, folder, "documents"), ["doc_id"])
