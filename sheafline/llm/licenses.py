"""License scan: fixed phrases, and an exact set-similarity join of text blocks with templates.

A block is a window of as many consecutive words as a template has, over line breaks
and punctuation; the template is found in it when at least ``threshold`` of the
template's different words stand in it. The template's words are ordered by how many
documents of the corpus have them, rarest first. A window that holds enough of them
holds one of the first few (prefix filter), so windows are looked for only around the
places of these; the words of the template around such a place must be enough (length
filter), and of the words a window shares with the template the place must be the
rarest, with enough words behind it in the order (positional filter). What remains is
compared word set by word set. A window can be taken to start with a word of its
template, as moving it there loses none.

Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Least share of a template's words, as a fraction of whole numbers.
THRESHOLD = (8, 10)

# Phrases with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License statements, and whole texts of short licenses, with their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.""",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("public-domain", "This work has been dedicated to the public domain."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def word_list(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def literal_rows(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A short list of structs as a table."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def _template_words(spark: SparkSession, templates: list[tuple[str, str]]) -> dict[int, list[str]]:
    """The words of each template in order; as many rows as templates."""
    rows = literal_rows(spark, [F.struct(F.lit(i).alias("number"), F.lit(text).alias("text")) for i, (_, text) in enumerate(templates)])
    return {r["number"]: list(r["words"]) for r in rows.select("number", word_list(F.col("text")).alias("words")).collect()}


def document_counts(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of a short list of words stands; at most one row per word."""
    wanted = F.array(*map(F.lit, words))
    each = docs.select(F.explode(F.array_intersect("words", wanted)).alias("word"))
    return {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _phrase_places(phrase: str) -> Column:
    """Places (from 0) where the words of a phrase stand one after the other."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - len(parts), F.lit(0)))

    def here(i: Column) -> Column:
        hit = F.get(F.col("words"), i) == parts[0]
        for k, part in enumerate(parts[1:], start=1):
            hit = hit & (F.get(F.col("words"), i + k) == part)
        return F.coalesce(hit, F.lit(False))

    # Few texts have the phrase at all; only these are searched word by word.
    maybe = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).contains(f" {phrase} ")
    return F.when(maybe, F.filter(starts, here)).otherwise(F.array().cast("array<int>"))


def template_blocks(
    words: DataFrame, spark: SparkSession, templates: list[tuple[str, str]], threshold: tuple[int, int]
) -> DataFrame:
    """(doc_id, text_key, block, label, containment) of every window that holds a template; ``block`` is its first word.

    ``words`` has doc_id, text_key and words of each document.
    """
    num, den = threshold
    in_order = _template_words(spark, templates)
    sets = {i: sorted(set(w)) for i, w in in_order.items()}
    vocabulary = sorted({w for s in sets.values() for w in s})
    counts = document_counts(words, vocabulary)
    ranked = {i: sorted(s, key=lambda w: (counts.get(w, 0), w)) for i, s in sets.items()}
    need = {i: -(-num * len(s) // den) for i, s in sets.items()}
    prefix = {i: s[: len(s) - need[i] + 1] for i, s in ranked.items()}
    longest = max(map(len, in_order.values()))

    index = literal_rows(
        spark,
        [
            F.struct(
                F.lit(w).alias("word"),
                F.lit(label).alias("label"),
                F.lit(len(in_order[i])).alias("size"),
                F.lit(need[i]).alias("need"),
                F.array(*map(F.lit, ranked[i])).alias("template"),
                # The words that come before this one in the order.
                F.array(*map(F.lit, ranked[i][:j])).cast("array<string>").alias("rarer"),
            )
            for i, (label, _) in enumerate(templates)
            for j, w in enumerate(prefix[i])
        ],
    )
    first_words = F.array(*map(F.lit, sorted({w for s in prefix.values() for w in s})))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda k: F.array_contains(first_words, F.get(F.col("words"), k)))
    # What any window over a place may hold.
    low = lambda k: F.greatest(k - (longest - 1), F.lit(0))
    around = F.transform(
        places,
        lambda k: F.struct(
            F.get(F.col("words"), k).alias("word"),
            (k - low(k)).alias("at"),
            low(k).alias("from"),
            F.slice("words", low(k) + 1, k - low(k) + longest).alias("near"),
        ),
    )
    maybe = words.filter(F.arrays_overlap("words", first_words))
    hits = maybe.select("doc_id", "text_key", F.inline(around)).join(index, "word")
    # Of the words around, only as many as this template has.
    left = F.least(F.col("at"), F.col("size") - 1)
    hits = hits.select(
        "doc_id", "text_key", "word", "label", "size", "need", "template", "rarer",
        (F.col("from") + F.col("at") - left).alias("from"), left.alias("at"),
        F.slice("near", F.col("at") - left + 1, left + F.col("size")).alias("near"),
    )
    hits = hits.filter(F.size(F.array_intersect("near", "template")) >= F.col("need"))

    def window(k: Column) -> Column:
        held = F.slice("near", k + 1, F.col("size"))
        # A window is judged at its rarest word; an earlier place of the same word would judge it as well.
        rarest = ~F.coalesce(F.arrays_overlap(held, F.col("rarer")), F.lit(False))
        both = F.when(rarest & F.array_contains("template", F.get(F.col("near"), k)), F.size(F.array_intersect(held, "template"))).otherwise(0)
        return F.struct((F.col("from") + k).alias("block"), both.alias("both"))

    good = F.filter(F.transform(F.sequence(F.lit(0), F.col("at")), window), lambda w: w["both"] >= F.col("need"))
    found = hits.select("doc_id", "text_key", "label", F.size("template").alias("all"), F.inline(good))
    return found.groupBy("doc_id", "text_key", "block", "label").agg(F.max(F.col("both") / F.col("all")).alias("containment"))


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: tuple[int, int] = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the blocks found.

    ``score`` is 1 where a phrase stands, else the greatest containment of a
    template found, else 0. ``blocks`` are the different (block, label, containment)
    found; a block is named by its first word, counted from 0. A null text is empty; a
    null id stays null; repeated rows are returned each; other columns are left behind;
    an empty table gives no rows. A text of any length is scanned whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), word_list(text).alias("words")
    )
    found = {f"_p{i}": _phrase_places(p) for i, p in enumerate(phrases)}
    base = words.select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"), *[c.alias(n) for n, c in found.items()])
    places = F.array_sort(F.concat(F.array().cast("array<int>"), *found))
    base = base.withColumn("places", places).select(
        "doc_id",
        "text_key",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"),
        F.array_max("places").cast("bigint").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(n) > 0, F.lit(label)) for n, label in zip(found, phrases.values())]).cast("array<string>")).alias("base"),
    )
    blocks = template_blocks(words, docs.sparkSession, templates, threshold)
    by_doc = blocks.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.sort_array(F.collect_set(F.struct("block", "label", "containment"))).alias("blocks"),
        F.collect_set("label").alias("found"),
        F.max("containment").alias("containment"),
    )
    joined = base.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    everything = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(everything), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        "blocks",
    )
