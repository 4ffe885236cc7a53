"""Licence texts and notices in documents, by votes of word k-grams on diagonals.

Every rolling k-gram of a document's words is joined to the places where the
templates have it. A hit votes for a diagonal: its place in the document less
its place in the template. A template that stands in the document as it is
collects all votes on one diagonal; words put in or left out move the rest to
one next to it, so neighbouring diagonals are merged before the span is
verified. All of it is DataFrame operations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a gram; a template with fewer is one gram as it stands.
GRAM_WORDS = 3
#: The part of a template's words that a span must hold to count as this template.
LEAST_COVERAGE = 0.9
#: Diagonals are neighbours up to this many words apart, and up to a fifth of the template.
MOST_SLACK = 8
#: Template grams are broadcast up to this many (about 100 bytes each); more are left to the optimizer.
BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """A text to look for. Every place of an ``exact`` one counts, word for word."""

    label: str
    text: str
    exact: bool = False


# Phrases whose every place counts.
PHRASES = (
    Template("cc-by", "cc by", exact=True),
    Template("gpl", "general public license", exact=True),
    Template("reserved", "all rights reserved", exact=True),
)

# Notices by which texts name their licence, and openings of the licences.
NOTICES = (
    Template("agpl-3.0", "GNU Affero General Public License version 3"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ),
    Template("bsd", "Released under the BSD License"),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-4.0", "Licensed under CC BY 4.0"),
    Template("cc-by-4.0", "Creative Commons Attribution 4.0 International License"),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication"),
    Template("gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl-3.0", "GNU General Public License, version 3"),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Licensed under the MIT License"),
    Template("mit", "SPDX-License-Identifier: MIT"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)
TEMPLATES = PHRASES + NOTICES

_KEY = ["doc_id", "_text", "_text2"]


def _words(text: Column) -> Column:
    """Words of a text with A-Z in lower case, all other letters as they are.

    Cut at what is between words: a match for each word would copy the text each time.
    """
    text = F.coalesce(text, F.lit(""))
    # ``lower`` is quick and means the same where there are only ASCII letters.
    is_ascii = F.octet_length(text) == F.char_length(text)
    lowered = F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _BETWEEN_WORDS), "")


def _rolled(texts: DataFrame, k: int) -> DataFrame:
    """Each word as a row: its place ``at``, and with the words after it as w0, w1, ...

    Beyond the last word these are null. A text without words is a row without a place.
    """
    counted = texts.withColumn("n_words", F.size("words"))
    shifted = counted.withColumns({f"w{i}": F.slice("words", i + 1, F.col("n_words")) for i in range(k)})
    rest = [name for name in texts.columns if name != "words"]
    zipped = F.posexplode_outer(F.arrays_zip(*[f"w{i}" for i in range(k)])).alias("at", "gram")
    rows = shifted.select(*rest, "n_words", zipped)
    return rows.select(*rest, "n_words", "at", "gram.*")


def _gram(size: int) -> Column:
    return F.concat_ws(" ", *[f"w{i}" for i in range(size)])


def _gram_hash(size: int) -> Column:
    return F.xxhash64(*[f"w{i}" for i in range(size)])


def _template_table(spark: SparkSession, templates) -> DataFrame:
    rows = [
        F.struct(
            F.lit(number).alias("number"), F.lit(wanted.label).alias("label"),
            F.lit(wanted.exact).alias("exact"), F.lit(wanted.text).alias("text"),
        )
        for number, wanted in enumerate(templates)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _template_grams(spark: SparkSession, templates, k: int) -> DataFrame:
    """(size, hash, hits): the places of each gram of the templates, all in one array."""
    texts = _template_table(spark, templates).select(
        "number", "label", "exact", _words(F.col("text")).alias("words")
    )
    size = F.least(F.lit(k), F.col("n_words"))
    slack = F.when(F.col("exact"), 0).otherwise(
        F.least(F.lit(MOST_SLACK), F.ceil(F.col("n_words") / 5).cast("int"))
    )
    rows = _rolled(texts, k).withColumns({"size": size, "slack": slack})
    whole = rows.filter(F.col("at") <= F.col("n_words") - F.col("size"))
    template = F.struct("number", "label", "exact", "n_words", "size", "slack")
    sized = [whole.filter(F.col("size") == s).select(
        "size", _gram_hash(s).alias("hash"),
        F.struct(template.alias("template"), "at", _gram(s).alias("gram")).alias("hit"),
    ) for s in range(1, k + 1)]
    every = sized[0]
    for more in sized[1:]:
        every = every.unionByName(more)
    return every.groupBy("size", "hash").agg(F.collect_list("hit").alias("hits"))


def _hits(docs: DataFrame, templates, k: int) -> DataFrame:
    """A row for every gram that is a template's, and one without a template for every document."""
    spark = docs.sparkSession
    grams = _template_grams(spark, templates, k)
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("_text"), F.xxhash64(F.lit(1), "text").alias("_text2"),
        _words(F.col("text")).alias("words"),
    )
    rows = _rolled(texts, k)
    words = [len(_split(wanted.text)) for wanted in templates]
    small = sum(words) <= BROADCAST_GRAMS
    lengths = sorted({min(k, count) for count in words} - {0})
    for size in lengths:
        known = grams.filter(F.col("size") == size).select(
            F.col("hash").alias(f"hash{size}"), F.col("hits").alias(f"hits{size}")
        )
        known = F.broadcast(known) if small else known
        rows = rows.withColumn(f"hash{size}", _gram_hash(size)).join(known, f"hash{size}", "left")
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    found = first
    for size in lengths:
        found = found | F.col(f"hits{size}").isNotNull()
    none = F.array().cast(grams.schema["hits"].dataType)
    equal = [F.filter(F.coalesce(F.col(f"hits{size}"), none), _says(size)) for size in lengths]
    marker = F.when(first, F.array(F.lit(None).cast(grams.schema["hits"].dataType.elementType))).otherwise(none)
    return rows.filter(found).select(
        *_KEY, "n_words", F.col("at").alias("place"), F.explode(F.concat(marker, *equal)).alias("hit")
    )


def _says(size: int):
    """Whether the words of a hit are those of the document, and not only their hash."""
    return lambda hit: hit["gram"] == _gram(size)


def _split(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def license_spans(
    docs: DataFrame, templates=TEMPLATES, gram_words: int = GRAM_WORDS, least_coverage: float = LEAST_COVERAGE
) -> DataFrame:
    """Spans of ``docs`` (doc_id, text) that hold a template, or a part of one.

    Returns the document's key (doc_id and two hashes of the text), ``n_words``,
    ``copies`` (rows of the table that are this document), and for each span
    ``label``, ``template`` (its number in ``templates``), ``exact``, ``first``
    and ``last`` (its words, counted from 0, the end left out), ``coverage``
    (the part of the template's words it holds) and ``verified``. Each document
    has one row more, whose label is null.

    An exact template is verified where all its words stand consecutively, so
    overlapping places count each. Another one is verified from
    ``least_coverage`` on. Null and empty texts have no words and no spans.
    Rows without an id are documents of their own unless their text is equal.
    Other columns are ignored. Templates without words find nothing.
    """
    hits = _hits(docs, tuple(templates), gram_words).select(
        *_KEY, "n_words", "hit.template", F.col("hit.at").alias("in_template"),
        (F.col("place") - F.col("hit.at")).alias("diagonal"),
    )
    # Repeats of a row are one document: their equal votes fall together here, before the shuffle.
    votes = hits.groupBy(*_KEY, "n_words", "template", "diagonal").agg(
        F.collect_set("in_template").alias("seen"), F.count("*").alias("copies")
    )
    along = Window.partitionBy(*_KEY, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(0))
    merged = votes.withColumn("_new", (apart > F.col("template.slack")).cast("int")).withColumn(
        "_run", F.coalesce(F.sum("_new").over(along), F.lit(0))
    )
    size = F.col("template.size")
    lowest, highest = F.array_min("seen"), F.array_max("seen")
    spans = merged.groupBy(*_KEY, "n_words", "template", "_run").agg(
        F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.max("copies").alias("copies"),
        F.min(F.col("diagonal") + lowest).alias("first"), F.max(F.col("diagonal") + highest + size).alias("last"),
    )
    covered = F.array_distinct(F.flatten(F.transform("seen", lambda at: F.sequence(at, at + size - 1))))
    spans = spans.withColumn("coverage", F.size(covered) / F.col("template.n_words"))
    verified = F.when(F.col("template.exact"), F.col("coverage") == 1).otherwise(
        F.col("coverage") >= least_coverage
    )
    return spans.select(
        *_KEY, "n_words", "copies", "template.label", F.col("template.number").alias("template"),
        "template.exact", "first", "last", "coverage", verified.alias("verified"),
    )


def license_digest(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per document: words, places of the exact phrases, labels, and a score.

    ``n_base`` counts all places of exact templates, ``first_word`` and
    ``last_word`` are the smallest and largest word at which one starts (null
    without any), ``base_labels`` and ``labels`` are sorted and joined by
    commas (empty without any). ``score`` is the largest part of a template
    that a span holds, 0 without any. One row for each row of ``docs``, repeats
    included; an empty table gives an empty one.
    """
    spans = license_spans(docs, templates)
    base = F.col("exact") & F.col("verified")
    found = spans.groupBy(*_KEY, "n_words").agg(
        F.max(F.when(F.col("label").isNull(), F.col("copies"))).alias("copies"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("bigint").alias("last_word"),
        _joined(F.when(base, F.col("label"))).alias("base_labels"),
        _joined(F.when(F.col("verified"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(~F.col("exact") | F.col("verified"), F.col("coverage"))), F.lit(0.0)).alias("score"),
    )
    again = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), "n_base", "first_word", "last_word",
        "base_labels", "labels", "score",
    )


def _joined(label: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(label)), ",")
