"""License scan: normalised text against licence templates by Dice coefficient.

A document is compared whole, by paragraph (runs of non-blank lines), by line
and by excerpt, a run of as many words as the template has, wherever it stands:
inside a line, or over the lines of a comment block.  Each segment and each template is reduced to its set of word bigrams;
Dice = 2|A∩B| / (|A|+|B|).  A template can only reach the threshold t for
segments whose set size lies between |B|·t/(2-t) and |B|·(2-t)/t, so templates
are keyed by every size in their range and segments meet them by an equi-join
on set size; nothing else is ever compared.  Excerpts are sought with a prefix
filter: of |B| bigrams at least |B|·t/(2-t) must be there, so one of the others'
number and one more, the longest ones, is in the text; then only runs that
begin with a bigram of the template and hold enough of them are compared.  A
document is only taken apart
when it contains an anchor word: anchors are chosen so that a segment without
any of them cannot share enough bigrams with a template.  Only DataFrame
functions run.

Defined cases: null or empty texts, segments of fewer than two words and empty
tables match nothing; a template may match several segments of a document —
each (document, licence) pair is returned once with its best coefficient, the kind of segment that
has it (ties: the later kind by name) and the number of distinct matching segments of all kinds; a
segment counts for its best template (ties: the later licence by name); an excerpt gives way to a
better one, of any template, that holds over half of its words; rows that repeat an id are one
document; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import fixed_table

from .common import saved

THRESHOLD = 0.8
MAX_TEMPLATES = 5_000     # the template tables are broadcast; larger sets are refused,
MAX_WORDS = 1_000_000     # and so are templates with more words in all

# Public licence notices and short licence texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Lower-case words: runs of a-z and 0-9, apostrophes dropped."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "['’]", ""), "[^a-z0-9]+", " ")
    return F.split(F.trim(plain), " ")


def pairs(text: Column) -> Column:
    """Adjacent word pairs of a text, in order."""
    return _let(words(text), lambda w: F.transform(
        F.slice(w, 2, F.size(w)), lambda b, i: F.concat(F.get(w, i), F.lit(" "), b)))


def bigrams(text: Column) -> Column:
    """Set of adjacent word pairs of a text."""
    return F.array_distinct(pairs(text))


def body_words(body: str) -> list[str]:
    """The words of a template, as ``words`` gives them."""
    return re.sub("[^a-z0-9]+", " ", re.sub("['’]", "", body.lower())).split()


def least_shared(size: int, threshold: float) -> int:
    """The fewest bigrams that a segment shares with a template of ``size``."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9))


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """One row per template: (template_id, license, grams)."""
    if len(templates) > MAX_TEMPLATES or sum(len(body_words(t)) for _, t in templates) > MAX_WORDS:
        raise ValueError(f"at most {MAX_TEMPLATES} templates and {MAX_WORDS} words")
    rows = [(k, lic, text) for k, (lic, text) in enumerate(templates)]
    return fixed_table(spark, rows, "template_id INT, license STRING, body STRING").select(
        "template_id", "license", bigrams(F.col("body")).alias("grams")).filter(F.size("grams") > 0)


def template_sizes(grams: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(template_id, size): the segment sizes at which a template can reach
    the threshold."""
    n, t = F.size("grams"), threshold
    low = F.greatest(F.ceil(n * F.lit(t / (2 - t)) - 1e-9), F.lit(1))
    high = F.floor(n * F.lit((2 - t) / t) + 1e-9)
    return grams.select("template_id", F.explode(F.sequence(
        low.cast("int"), high.cast("int"))).alias("size"))


def prefixes(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[int, int, int, list[str]]]:
    """(template_id, words, least shared bigrams, prefix) of each template with
    a bigram.  Fewer bigrams than must be shared lie outside the prefix; it
    holds the longest ones, which are the rarest in prose."""
    out = []
    for k, (_, body) in enumerate(templates):
        w = body_words(body)
        own = sorted({f"{x} {y}" for x, y in zip(w, w[1:])}, key=lambda g: (-len(g), g))
        if own:
            need = least_shared(len(own), threshold)
            out.append((k, len(w), need, own[:len(own) - need + 1]))
    return out


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every segment that can reach the threshold has one.

    Dice >= t needs at least |B| t/(2-t) shared bigrams.  Words are taken until
    fewer of each template's bigrams than that are without one: long words and
    those without a vowel first, as both are rare in prose, and among them the
    word that most bigrams have."""
    left, least = [], []
    for _, body in templates:
        w = body_words(body)
        left.append(set(zip(w, w[1:])))
        least.append(least_shared(len(left[-1]), threshold))
    chosen: list[str] = []
    while True:
        having = Counter(x for g, n in zip(left, least) if len(g) >= n for pair in g for x in set(pair))
        if not having:
            return sorted(chosen)
        chosen.append(max(having, key=lambda x: (
            len(x) >= 6 or not set(x) & set("aeiouy0123456789"), having[x], x)))
        left = [{pair for pair in g if chosen[-1] not in pair} for g in left]


def has_anchor(text: Column, words: list[str]) -> Column:
    """Whether a word of a text begins with one of ``words``: one pass of a
    pattern that is only tried where a word begins."""
    by_first: dict[str, list[str]] = {}
    for w in words:
        by_first.setdefault(w[0], []).append(w[1:])
    if not by_first:
        return F.lit(False)
    tails = "|".join(f"{c}(?:{'|'.join(t)})" for c, t in sorted(by_first.items()))
    plain = F.replace(F.replace(F.lower(text), F.lit("'"), F.lit("")), F.lit("’"), F.lit(""))
    return plain.rlike(f"(?<![a-z0-9])(?:{tails})")


def segments(text: Column, top: int) -> Column:
    """Array of (kind, segment, grams): the whole text, its paragraphs when
    there are several and its lines when there are several, without those
    whose set is empty or larger than ``top``."""
    def parts(kind: str, pieces: Column) -> Column:
        several = F.when(F.size(pieces) > 1, pieces).otherwise(F.array().cast("array<string>"))
        return F.transform(several, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("segment")))

    every = F.concat(
        F.array(F.struct(F.lit("document").alias("kind"), text.alias("segment"))),
        parts("paragraph", F.split(text, r"\n[\x20\x09\x0D]*\n\s*")),
        parts("line", F.split(text, r"\n")))
    grams = F.transform(every, lambda s: F.struct(
        s["kind"].alias("kind"), s["segment"].alias("segment"), bigrams(s["segment"]).alias("grams")))
    return F.filter(grams, lambda s: (F.size(s["grams"]) > 0) & (F.size(s["grams"]) <= top))


def _windows(own: Column, grams: Column, length: Column, need: Column, threshold: float) -> Column:
    """The runs of ``length`` words (fewer at the end of the text) that begin
    with a bigram of the template, reach the threshold and are no worse than
    the next such runs to either side: array of (at, dice)."""
    def coefficient(at: Column) -> Column:
        return _let(F.array_distinct(F.slice(own, at + 1, length - 1)), lambda a: 2.0 * F.size(
            F.array_intersect(a, grams)) / (F.size(a) + F.size(grams)))

    shared = F.filter(F.transform(own, lambda g, i: F.when(F.array_contains(grams, g), i)),
                      lambda i: i.isNotNull())
    likely = _let(shared, lambda p: F.filter(p, lambda x, i: F.get(p, i + need - 1) - x <= length - 2))
    scored = F.filter(F.transform(likely, lambda x: F.struct(x.alias("at"), coefficient(x).alias("dice"))),
                      lambda w: w["dice"] >= threshold - 1e-12)

    def apart(x: Column, y: Column) -> Column:
        return y.isNull() | (F.abs(x["at"] - y["at"]) >= length)

    return _let(scored, lambda d: F.filter(d, lambda x, i: (
        (apart(x, F.get(d, i - 1)) | (F.get(d, i - 1)["dice"] < x["dice"]))
        & (apart(x, F.get(d, i + 1)) | (F.get(d, i + 1)["dice"] <= x["dice"])))))


def excerpts(likely: DataFrame, grams: DataFrame, templates=TEMPLATES,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, kind, segment, dice) of the excerpts of the texts of
    ``likely``, those that give way to better ones left out."""
    spark, known = likely.sparkSession, prefixes(templates, threshold)
    schema = "doc_id " + likely.schema["doc_id"].dataType.simpleString()
    if not known:
        return spark.createDataFrame([], f"{schema}, license STRING, kind STRING, segment STRING, dice DOUBLE")
    by_gram = F.broadcast(fixed_table(spark, [(k, g) for k, _, _, prefix in known for g in prefix],
                                      "template_id INT, seen STRING"))
    about = fixed_table(spark, [(k, n, m) for k, n, m, _ in known], "template_id INT, length INT, need INT")
    first = fixed_table(spark, [(k, g, i) for k, _, _, prefix in known for i, g in enumerate(prefix)],
                        "template_id INT, g STRING, i INT").groupBy("template_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "g"))), lambda x: x["g"]).alias("prefix"))
    by_id = F.broadcast(grams.join(about, "template_id").join(first, "template_id"))
    every = sorted({g for *_, prefix in known for g in prefix})
    texts = (likely.select("doc_id", F.xxhash64("text").alias("text_key"), pairs(F.col("text")).alias("own"))
             .withColumn("all_seen", F.filter(F.array_distinct("own"), lambda g: g.isin(every)))
             .filter(F.size("all_seen") > 0))
    # A text meets a template once: at the first of its prefix that is there.
    met = (texts.withColumn("seen", F.explode("all_seen")).join(by_gram, "seen").join(by_id, "template_id")
           .filter(F.col("seen") == F.get(F.array_intersect("prefix", "all_seen"), F.lit(0))))
    found = _windows(F.col("own"), F.col("grams"), F.col("length"), F.col("need"), threshold)
    runs = (met.select("doc_id", "text_key", "license", "length", "own", F.explode(found).alias("w"))
            .select("doc_id", "text_key", "license", F.col("w.at").alias("at"), F.col("w.dice").alias("dice"),
                    F.least(F.col("w.at") + F.col("length"), F.size("own") + 1).alias("end"),
                    F.array_join(F.slice("own", F.col("w.at") + 1, F.col("length") - 1), "|").alias("segment")))
    runs = saved(runs.distinct().withColumn("run", F.monotonically_increasing_id()), "excerpts")
    # Runs that overlap share a block of the text: they meet there.
    block = max(n for _, n, _, _ in known)
    placed = runs.select("doc_id", "text_key", "run", "at", "end", F.struct(
        "dice", F.col("end") - F.col("at"), "license", -F.col("at")).alias("rank"),
        F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))).alias("block"))
    x, y = placed.alias("x"), placed.alias("y")
    inside = F.least("x.end", "y.end") - F.greatest("x.at", "y.at")
    lost = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.text_key") == F.col("y.text_key"))
                  & (F.col("x.block") == F.col("y.block")) & (F.col("x.rank") < F.col("y.rank"))
                  & (2 * inside > F.col("x.end") - F.col("x.at"))).select(F.col("x.run").alias("run"))
    return runs.join(lost, "run", "left_anti").select(
        "doc_id", "license", F.lit("excerpt").alias("kind"), "segment", "dice")


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, kind, segments): per document and licence the
    best Dice coefficient, the kind of segment that reached it and the number
    of distinct matching segments."""
    known = template_grams(docs.sparkSession, templates)
    sizes = template_sizes(known, threshold)
    top = sizes.agg(F.max("size")).first()[0] or 0
    likely = docs.filter(F.col("text").isNotNull() & has_anchor(F.col("text"), anchors(templates, threshold)))
    parts = (likely.select("doc_id", F.explode(segments(F.col("text"), top)).alias("s"))
             .select("doc_id", "s.kind", "s.segment", F.col("s.grams").alias("own"),
                     F.size("s.grams").alias("n")))
    dice = 2.0 * F.size(F.array_intersect("own", "grams")) / (F.col("n") + F.size("grams"))
    hits = (parts.join(F.broadcast(sizes), F.col("n") == F.col("size"))
            .join(F.broadcast(known), "template_id")
            .select("doc_id", "license", "kind", "segment", dice.alias("dice"))
            .filter(F.col("dice") >= threshold - 1e-12)
            .unionByName(excerpts(likely, known, templates, threshold)))
    # A segment may fit several templates: its best one counts.
    per_segment = hits.groupBy("doc_id", "kind", "segment").agg(
        F.max(F.struct("dice", "license")).alias("top")).select("doc_id", "kind", "top.*")
    return per_segment.groupBy("doc_id", "license").agg(
        F.max(F.struct("dice", "kind")).alias("best"), F.count(F.lit(1)).alias("segments")).select(
        "doc_id", "license", F.col("best.dice").alias("dice"), F.col("best.kind").alias("kind"),
        "segments")
