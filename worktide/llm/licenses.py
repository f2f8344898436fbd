"""Licence scans: three base phrases, and licence texts found through a positional index of their rare words.

The words of each template with the highest IDF in the corpus are indexed with their positions. Each occurrence of such
a word in a document names template and relative position (place in the document less place in
the template). Where enough of a template's rare words agree on a relative position and the template's mandatory key
phrases stand there too, the template's label is given. Everything stays in expressions; only documents holding enough
licence words are exploded.

Null texts are empty, repeated rows get the same labels, an empty table gives no rows, other columns are not touched.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import ascii_lower, fence, saved, whole

# The base phrases, their labels, and the characters that stand between words.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label, mandatory key phrases, and notice of each template.
TEMPLATES = (
    ("apache-2.0", ("apache license",), "licensed under the apache license version 2.0"),
    ("apache-2.0", ("apache license", "limitations under the license"),
     "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at http www apache org licenses license 2.0 unless required by "
     "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied see the license for the specific language "
     "governing permissions and limitations under the license"),
    ("mit", ("mit license",), "released under the mit license"),
    ("mit", ("permission is hereby granted free of charge",),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("bsd", ("redistributions of source code must retain",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer"),
    ("gpl", ("gnu general public license",), "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", ("cc by nc",), "licensed under cc by nc 4.0"),
    ("mpl-2.0", ("mozilla public license",),
     "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at http mozilla org mpl 2.0"),
    ("isc", ("permission to use copy modify and or distribute this software",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", ("released into the public domain",),
     "this is free and unencumbered software released into the public domain"),
)

#: So many words of a template, those of the highest IDF in the corpus, are indexed.
INDEXED = 12
#: Share of a template's indexed IDF that must agree on a relative position.
AGREE = 0.6
#: Relative positions within so many words count as the same.
SLACK = 8


def split_terms(text: str) -> list[str]:
    return [w for w in re.split(_BETWEEN, text) if w]


def template_words() -> list[str]:
    return sorted({w for _, _, notice in TEMPLATES for w in split_terms(notice)})


def template_index(idf: dict[str, float]) -> list[tuple]:
    """Postings (term, template, position, weight). A key phrase is a term too, with weight 0."""
    postings = []
    for k, (_, phrases, notice) in enumerate(TEMPLATES):
        words = split_terms(notice)
        first = {w: at for at, w in reversed(list(enumerate(words)))}
        for word in sorted(first, key=lambda w: (-idf[w], w))[:INDEXED]:
            postings.append((word, k, first[word], idf[word]))
        for phrase in phrases:
            parts = split_terms(phrase)
            at = next(i for i in range(len(words)) if words[i:i + len(parts)] == parts)
            postings.append((phrase, k, at, 0.0))
    return postings


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively, counted from 0."""
    parts = split_terms(phrase)
    rare = max(parts, key=len)

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return found

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(F.array_contains(words, rare), places).otherwise(F.array().cast("array<int>"))


def _terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    lower = ascii_lower(whole(docs[text]))
    rows = docs.select(docs[key].alias("doc_id"), F.xxhash64(whole(docs[text])).alias("digest"), F.split(lower, _BETWEEN, -1).alias("words"))
    return rows.select("doc_id", "digest", F.filter("words", lambda w: w != "").alias("words"))


def survey(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document, checkpointed: its word count, the places of the base phrases, its template words."""
    rows = _terms(docs, key, text)
    none = F.array().cast("array<int>")
    marks = [F.when(F.size("words") > 0, phrase_places(F.col("words"), p)).otherwise(none).alias(f"p{k}") for k, (p, _) in enumerate(BASE)]
    vocabulary = F.array(*[F.lit(w) for w in template_words()])
    return saved(rows.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), *marks,
                             F.array_intersect(vocabulary, F.col("words")).alias("terms")))


def corpus_idf(surveyed: DataFrame) -> dict[str, float]:
    """The IDF of the template words over the corpus; one count per template word comes to the driver."""
    total = surveyed.count()
    seen = {r["term"]: r["count"] for r in surveyed.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in template_words()}


def matched_templates(docs: DataFrame, idf: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, labels, score, spans) of the documents in which a template stands; spans: start word by label."""
    spark = docs.sparkSession
    postings = template_index(idf)
    weights = {k: {w: weight for w, t, _, weight in postings if t == k and " " not in w} for k in range(len(TEMPLATES))}
    total = {k: max(sum(own.values()), 1e-9) for k, own in weights.items()}
    rows = _terms(docs, key, text)
    indexed = F.array(*[F.lit(w) for w in sorted({w for own in weights.values() for w in own})])
    rows = rows.select("*", F.array_intersect(indexed, F.col("words")).alias("rare"), fence().alias("fence"))
    # Only a document with enough of a template's words can have them agree.
    possible = F.lit(False)
    for k, own in weights.items():
        possible = possible | (sum((F.when(F.array_contains("rare", w), x).otherwise(0.0) for w, x in own.items()), F.lit(0.0)) >= AGREE * total[k] - 1e-9)
    rows = rows.filter(possible & (F.col("fence") >= 0))
    found = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("term"))),
                     lambda x: F.array_contains("rare", x["term"]))
    parts = [found]
    for phrase in sorted({p for _, keys, _ in TEMPLATES for p in keys}):
        parts.append(F.transform(phrase_places(F.col("words"), phrase), _place(phrase)))
    hits = rows.select("doc_id", "digest", F.explode(F.concat(*parts)).alias("x")).select("doc_id", "digest", "x.*")
    # Fixed size: the templates above.
    index = spark.createDataFrame(postings, "term string, template int, place int, weight double")
    near = hits.join(F.broadcast(index), "term").withColumn("shift", F.col("at") - F.col("place"))
    # Two overlapping grids: shifts within SLACK words share a cell of one of them.
    cells = F.array(F.struct(F.lit(0).alias("g"), F.floor(F.col("shift") / (2 * SLACK)).alias("c")),
                    F.struct(F.lit(1).alias("g"), F.floor((F.col("shift") + SLACK) / (2 * SLACK)).alias("c")))
    near = near.withColumn("cell", F.explode(cells))
    once = near.groupBy("doc_id", "digest", "template", "cell", "place", "term").agg(F.max("weight").alias("weight"), F.min("shift").alias("shift"))
    scored = once.groupBy("doc_id", "digest", "template", "cell").agg(
        F.sum("weight").alias("weight"), F.sum(F.contains(F.col("term"), F.lit(" ")).cast("int")).alias("keys"), F.min("shift").alias("start"))
    facts = spark.createDataFrame([(k, TEMPLATES[k][0], float(total[k]), len(TEMPLATES[k][1])) for k in total],
                                  "template int, label string, total double, needed int")
    scored = (scored.join(F.broadcast(facts), "template").withColumn("share", F.least(F.col("weight") / F.col("total"), F.lit(1.0)))
              .filter((F.col("keys") >= F.col("needed")) & (F.col("share") >= AGREE)))
    return scored.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("share").alias("score"),
        F.array_sort(F.collect_set(F.struct("start", "label"))).alias("spans"))


def _place(phrase: str):
    return lambda i: F.struct(i.alias("at"), F.lit(phrase).alias("term"))


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base places, their labels, all labels, and the score: 1 with a base phrase, else the
    largest agreeing share of a verified template, else 0."""
    rows = surveyed = survey(docs, key, text)
    places = F.concat(*[F.col(f"p{k}") for k in range(len(BASE))])
    labels = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, label) for k, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "digest", "n_words", F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
                       F.array_sort(labels).alias("base"))
    more = matched_templates(docs, corpus_idf(surveyed), key, text).select(F.struct("doc_id", "digest").alias("at"), F.col("labels").alias("more"),
                                                     F.col("score").alias("share"))
    rows = rows.join(more, F.col("at").eqNullSafe(F.struct("doc_id", "digest")), "left")
    both = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                       F.array_join(both, ",").alias("labels"),
                       F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
