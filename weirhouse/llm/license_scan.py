"""License scans by a positional index of rare words, in DataFrame functions only.

Each template is a licence line with a mandatory phrase.  Of the phrase's words, the one with the
highest inverse document frequency in the scanned corpus is its anchor.  A file's words that are
anchors are looked up in the postings (anchor -> template, position); each posting fixes where
the template would start, and the template's other words are intersected at their relative
positions.  A place counts if all words of the mandatory phrase stand there, one after the other; the
share of the template's weight found around it is its score.  Every whole phrase holds its anchor,
so no place is missed.

Only the document frequencies of the template words (a fixed list) leave the executors.  Each
row is looked at by itself: no shuffle, no skew.

Null, empty and word-less texts have no words, no places, null first and last word, empty labels
and score 0.  Repeated rows and ids are scanned one by one.  An empty table gives no rows.  Columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import ascii_lower, whole

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrase_words(self) -> list[str]:
        return self.phrase.split()

    @property
    def phrase_at(self) -> int:
        n = len(self.phrase_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.phrase_words)


# Labels, licence lines and mandatory phrases.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("mit", "released under the mit license", "mit license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl-gnu", "this program is distributed under the gnu general public license", "gnu general public license"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("permission", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def idf_of(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Of each word of the templates, over all of ``docs``."""
    vocabulary = sorted({w for t in templates for w in t.words})
    marked = F.array_distinct(F.filter(words_of(whole()), lambda w: w.isin(vocabulary)))
    # Empty arrays keep a null row, so the documents are counted on the way.
    counts = docs.select(F.explode_outer(F.concat(F.array(F.lit("")), marked)).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    total = found.get("", 0)
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places): places is an array of (template, label, base, first, last, score),
    word positions of the phrase counted from 0."""
    idf = idf_of(docs, templates)
    anchors = []
    for t in templates:
        best = max(t.phrase_words, key=lambda w: idf[w])
        anchors.append((best, t.phrase_words.index(best)))
    names = sorted({a for a, _ in anchors})
    postings = F.create_map(
        *[x for n in names for x in (F.lit(n), F.array(*[F.struct(F.lit(i).alias("template"), F.lit(at).alias("at")) for i, (a, at) in enumerate(anchors) if a == n]))]
    )
    phrases = F.array(*[_strings(t.phrase_words) for t in templates])
    lines = F.array(*[_strings(t.words) for t in templates])
    weights = F.array(*[F.array(*[F.lit(idf[w]) for w in t.words]) for t in templates])
    totals = F.array(*[F.lit(sum(idf[w] for w in t.words)) for t in templates])
    offsets = F.array(*[F.lit(t.phrase_at) for t in templates])
    labels, base = _strings([t.label for t in templates]), F.array(*[F.lit(t.base) for t in templates])

    words = F.col("words")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(whole()).alias("words"))
    seen = F.filter(F.transform(words, lambda w, i: F.when(w.isin(names), i)), lambda i: i.isNotNull())
    located = rows.select("doc_id", "words", seen.alias("seen"))
    candidates = F.flatten(
        F.transform("seen", lambda i: F.transform(F.element_at(postings, F.get(words, i)), lambda p: F.struct(p["template"].alias("template"), (i - p["at"]).alias("first"))))
    )
    stands = lambda c: (c["first"] >= 0) & (F.slice(words, F.greatest(c["first"], F.lit(0)) + 1, F.size(F.get(phrases, c["template"]))) == F.get(phrases, c["template"]))

    def weighed(c: Column) -> Column:
        start = c["first"] - F.get(offsets, c["template"])
        found = F.aggregate(
            F.transform(F.get(lines, c["template"]), lambda w, j: F.when(F.get(words, F.when(start + j >= 0, start + j)) == w, F.get(F.get(weights, c["template"]), j)).otherwise(F.lit(0.0))),
            F.lit(0.0),
            lambda a, x: a + x,
        )
        return F.struct(
            F.get(labels, c["template"]).alias("label"),
            F.get(base, c["template"]).alias("base"),
            c["first"].cast("long").alias("first"),
            (c["first"] + F.size(F.get(phrases, c["template"])) - 1).cast("long").alias("last"),
            F.least(F.lit(1.0), found / F.get(totals, c["template"])).alias("score"),
        )

    places = F.when(F.size("seen") > 0, F.transform(F.filter(candidates, stands), weighed))
    empty = F.expr("CAST(array() AS array<struct<label:string,base:boolean,first:bigint,last:bigint,score:double>>)")
    return located.select("doc_id", F.size(words).cast("long").alias("n_words"), F.coalesce(places, empty).alias("places"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, bounds, labels and the best score of each file's places."""
    based = F.filter("places", lambda p: p["base"])
    starts = F.transform(based, lambda p: p["first"])
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(based).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(based).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )
