"""License scan by diagonal voting.

Every rolling k-gram of a text's words is hashed and joined by Spark to the places of the same k-gram in the templates;
a join also asks that the words are equal. A hit at word w of the text and place p of the template votes for the diagonal
w - p, on which the template would begin. Votes are counted by diagonal; diagonals at most ``GAP`` apart (words put in or
left out) are merged; a merged span is verified by how many of the template's words its hits cover. Short templates are
phrases: they are voted for by pairs of words, are never merged, and must be covered whole. Longer ones take four
words a gram, so that common pairs cost nothing, and must be covered to ``SHARE``.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. The templates are a parameter; they are the only
thing broadcast, and ``MAX_GRAMS`` bounds them. What is shuffled is hits and one row a document, never texts.

Cases: null text is empty and has no words; every document has a row. Rows with the same id and text are returned once,
rows with the same id and different texts each have a row; a null id is an id like others. Equal spans are listed once.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHORT_K, LONG_K = 2, 4
#: Templates with fewer words are phrases.
LONG_WORDS = 12
#: Diagonals so far apart belong to one span.
GAP = 3
#: Least share of a template's words, and of the span's, that hits must cover.
SHARE = 0.6
MAX_GRAMS = 100_000

#: All that parts words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Usual names and notices of public licenses and their labels.
OWN = (
    ("agpl", "affero general public license"),
    ("bsd", "bsd license"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("bsl", "boost software license"),
    ("cc-by", "cc by 4 0"),
    ("cc-by-nc", "cc by nc 4 0"),
    ("cc-by-nc-nd", "cc by nc nd 4 0"),
    ("cc-by-nc-sa", "cc by nc sa 4 0"),
    ("cc-by-nd", "cc by nd 4 0"),
    ("cc-by-sa", "cc by sa 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc0", "cc0 1 0"),
    ("epl", "eclipse public license"),
    ("isc", "isc license"),
    ("lgpl", "lesser general public license"),
    ("mpl", "mozilla public license"),
    ("unlicense", "released into the public domain"),
    ("zlib", "zlib license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
        "the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "bsl",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    ),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def k(self) -> int:
        return SHORT_K if len(self.words) < LONG_WORDS else LONG_K

    @property
    def gap(self) -> int:
        return 0 if len(self.words) < LONG_WORDS else GAP

    @property
    def share(self) -> float:
        return 1.0 if len(self.words) < LONG_WORDS else SHARE


def words_of(text: str) -> tuple[str, ...]:
    folded = "".join(LOWER[UPPER.index(c)] if c in UPPER else c for c in text)
    return tuple("".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in folded).split(" ")) if folded else ()


def templates(base: Sequence[tuple[str, str]] = BASE, own: Sequence[tuple[str, str]] = OWN) -> list[Template]:
    """Templates from (label, text); each needs two words at least."""
    found = []
    for is_base, listed in ((True, base), (False, own)):
        for label, text in listed:
            words = tuple(w for w in words_of(text) if w)
            if len(words) < SHORT_K:
                raise ValueError(f"a template needs {SHORT_K} words: {text!r}")
            found.append(Template(len(found), label, words, is_base))
    return found


def words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, BETWEEN), "")


#: Stands before a text's first word, so that a document without hits has a row too; no word is empty.
MARK = "cast(array(named_struct('a', '', 'b', '', 'c', '', 'd', '')) as array<struct<a:string,b:string,c:string,d:string>>)"
ZIP = """cast(arrays_zip(words, slice(words, 2, greatest(n - 1, 0)), slice(words, 3, greatest(n - 2, 0)),
    slice(words, 4, greatest(n - 3, 0))) as array<struct<a:string,b:string,c:string,d:string>>)"""


def gram_places(listed: Sequence[Template]) -> list[tuple]:
    """(k, words, template, place, size, gap, share) of every k-gram, and the mark's as template -1."""
    out: list[tuple] = [(0, "", "", "", "", -1, 0, 0, 0, 0.0)]
    for t in listed:
        for p in range(len(t.words) - t.k + 1):
            gram = t.words[p : p + t.k] + (None,) * (LONG_K - t.k)
            out.append((t.k, *gram, t.number, p, len(t.words), t.gap, t.share))
    if len(out) > MAX_GRAMS:
        raise ValueError(f"{len(out)} k-grams of templates, more than the {MAX_GRAMS} that may be broadcast")
    return out


def hits(docs: DataFrame, listed: Sequence[Template]) -> DataFrame:
    """(doc_id, digest, n_words, template, place, word, k, size, gap, share): all places where a k-gram of a text is one
    of a template, and one row with template -1 for every text."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), words(F.col("text")).alias("words"))
    sized = texts.withColumn("n", F.size("words").cast("long"))
    at = sized.select("doc_id", "digest", F.col("n").alias("n_words"), F.posexplode(F.concat(F.expr(MARK), F.expr(ZIP))).alias("place", "g"))
    w = [F.col(f"g.{c}") for c in "abcd"]
    kinds = F.explode(
        F.array(
            F.struct(F.lit(SHORT_K).alias("k"), F.when(w[1].isNotNull(), F.xxhash64(F.lit(SHORT_K), *w[:2])).alias("h")),
            F.struct(F.lit(LONG_K).alias("k"), F.when(w[3].isNotNull(), F.xxhash64(F.lit(LONG_K), *w)).alias("h")),
        )
    )
    grams = at.select("doc_id", "digest", "n_words", (F.col("place") - 1).alias("word"), "g", kinds.alias("kind")).filter("kind.h is not null")
    known = spark.createDataFrame(
        gram_places(listed), "gram_k int, a string, b string, c string, d string, template int, place int, size int, gap int, share double"
    )
    # The mark is found as a gram of four words.
    k = F.when(F.col("gram_k") == 0, F.lit(LONG_K)).otherwise(F.col("gram_k"))
    hash_of = F.when(F.col("gram_k") == SHORT_K, F.xxhash64(F.lit(SHORT_K), "a", "b")).otherwise(F.xxhash64(F.lit(LONG_K), "a", "b", "c", "d"))
    known = known.withColumn("k", k).withColumn("h", hash_of)
    same = (F.col("kind.h") == F.col("h")) & (F.col("kind.k") == F.col("k")) & (w[0] == F.col("a")) & (w[1] == F.col("b"))
    same = same & (F.col("k").eqNullSafe(F.lit(SHORT_K)) | ((w[2] == F.col("c")) & (w[3] == F.col("d"))))
    found = grams.join(F.broadcast(known), same)
    return found.select("doc_id", "digest", "n_words", "template", "place", "word", "k", "size", "gap", "share")


def scan(docs: DataFrame, listed: Sequence[Template] | None = None) -> DataFrame:
    """(doc_id, n_words, spans): the verified spans of each document, as (label, template, base, first, last, share).

    ``first`` and ``last`` are words from 0; ``share`` is the covered part of the template or the span, the longer of the two.
    """
    listed = templates() if listed is None else listed
    # One shuffle, which all that follows keeps: hits of a document meet in a task, as its text did.
    found = hits(docs, listed).repartition("doc_id", "digest")
    document = ["doc_id", "digest", "template"]
    voted = found.groupBy(*document, (F.col("word") - F.col("place")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("place").alias("places"),
        F.min("word").alias("first"),
        F.max(F.col("word") + F.col("k") - 1).alias("last"),
        F.first("k").alias("k"),
        F.first("size").alias("size"),
        F.first("gap").alias("gap"),
        F.first("share").alias("least"),
    )
    along = Window.partitionBy(*document).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("gap")
    merged = (
        voted.withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("opens").over(along))
        .groupBy(*document, "span", "k", "size", "least")
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    verified = merged.withColumn("share", covered / F.greatest("size", F.col("last") - F.col("first") + 1))
    facts = F.create_map(*[F.lit(v) for t in listed for v in (t.number, t.label)]) if listed else F.create_map(F.lit(-2), F.lit(""))
    base = F.array(*[F.lit(t.number) for t in listed if t.base]).cast("array<int>")
    span = F.struct(
        facts[F.col("template")].alias("label"),
        "template",
        F.array_contains(base, F.col("template")).alias("base"),
        F.col("first").cast("long").alias("first"),
        F.col("last").cast("long").alias("last"),
        "share",
    )
    good = (F.col("template") >= 0) & (F.col("share") >= F.col("least"))
    rows = verified.groupBy("doc_id", "digest").agg(
        F.max("n_words").alias("n_words"), F.sort_array(F.collect_list(F.when(good, span))).alias("spans")
    )
    return rows.select("doc_id", "n_words", "spans")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, places and labels of each document; texts without a span have empty labels and score 0."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(F.transform(base, lambda s: s["label"])).alias("base_labels"),
        _joined(F.transform("spans", lambda s: s["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
