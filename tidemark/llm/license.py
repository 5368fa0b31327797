"""License scans with a positional rare-token index, in DataFrame functions only.

A template is the word sequence of a licence name or notice. Its postings say at which
positions a word stands in it. A place of a template counts if all of its key phrases stand
there: a name needs all its words, a notice its mandatory phrases, whatever became of the
words between. So places are looked up by words of the key phrases alone. Those of them
that are rarest (highest inverse document frequency over all documents) are looked up in a
file; the file positions found, less the template positions, are the places where the
template may start, and the places of two rare words are intersected. A file that holds a
template has all of these words, so its rarest are the same in each such file, and a file
without one of them cannot hold the template. The key phrases are verified at every place.

The word statistics are the one pass that shuffles, and they shuffle a row per template
word and task. The scan itself works on each row's word array, so no document is moved and
a document may hold any number of places.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lower_ascii, text_or_empty

# What separates words, and the names that every scan counts.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licences, and the phrases that must stand in them.
NOTICES = {
    "mit-notice": (
        "permission is hereby granted free of charge to any person obtaining a copy",
        ("permission is hereby granted", "free of charge"),
    ),
    "bsd-notice": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use", "binary forms"),
    ),
    "apache-2.0": ("licensed under the apache license version 2", ("apache license version 2",)),
    "gpl-3.0": ("general public license version 3", ("general public license version 3",)),
    "gpl-notice": (
        "free software you can redistribute it and or modify it under the terms of the gnu",
        ("you can redistribute it", "modify it under the terms"),
    ),
    "mpl-2.0": ("mozilla public license version 2", ("mozilla public license version 2",)),
    "cc-by-nc": ("licensed under cc by nc", ("cc by nc",)),
    "cc-by-sa": ("licensed under cc by sa", ("cc by sa",)),
}

#: Rare words of a template's key phrases that are looked up; their places are intersected.
RARE = 2


@dataclass(frozen=True)
class Template:
    """A word sequence; the places of its key phrases are (position, words)."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]
    base: bool


def _find(words: tuple[str, ...], phrase: tuple[str, ...]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def templates() -> list[Template]:
    found = [
        Template(label, tuple(p.split()), ((0, tuple(p.split())),), True) for p, label in BASE.items()
    ]
    for label, (notice, phrases) in NOTICES.items():
        words = tuple(notice.split())
        keys = tuple((_find(words, tuple(p.split())), tuple(p.split())) for p in phrases)
        found.append(Template(label, words, keys, False))
    return found


def words_of(text_col: str) -> Column:
    return F.array_remove(F.split(lower_ascii(text_or_empty(text_col)), SEPARATORS), "")


def rarity(docs: DataFrame, text_col: str, lexicon: list[str]) -> dict[str, float]:
    """Inverse document frequency of each lexicon word over all documents."""
    found = docs.select(words_of(text_col).alias("words")).select(
        F.explode(F.array_append(
            F.array_distinct(F.filter("words", lambda w: w.isin(lexicon))), F.lit("")
        )).alias("word")
    )
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in lexicon}


def _rare(template: Template, idf: dict[str, float]) -> list[int]:
    """Positions of the rarest words that must stand: those of the key phrases."""
    must = [at + k for at, phrase in template.keys for k in range(len(phrase))]
    return sorted(must, key=lambda i: (-idf[template.words[i]], i))[:RARE]


def _places(template: Template, idf: dict[str, float]) -> Column:
    """Where the template may start: places that its rarest key words agree on.

    Words before the first key phrase may be missing at the start of a file, so a place
    may be negative as long as that phrase is inside.
    """
    at = _rare(template, idf)
    least = -min(k for k, _ in template.keys)

    def starts(i: int) -> Column:
        own = F.filter("marks", lambda m: m["word"] == F.lit(template.words[i]))
        return F.transform(own, lambda m: m["at"] - F.lit(i))

    places = starts(at[0])
    for i in at[1:]:
        places = F.array_intersect(places, starts(i))
    return F.filter(places, lambda p: p >= F.lit(least))


def _holds(place: Column, at: int, phrase: tuple[str, ...]) -> Column:
    """The phrase stands ``at`` words behind ``place``."""
    return F.slice(F.col("words"), place + F.lit(at + 1), F.lit(len(phrase))) == F.array(*map(F.lit, phrase))


def _verified(template: Template, idf: dict[str, float]) -> Column:
    def whole(place: Column) -> Column:
        test = _holds(place, *template.keys[0])
        for at, phrase in template.keys[1:]:
            test = test & _holds(place, at, phrase)
        return test

    return F.filter(_places(template, idf), whole)


def _likeness(template: Template, places: Column) -> Column:
    """Largest share of the template's words that stand at one verified place, 0 without any."""
    def share(place: Column) -> Column:
        equal = [
            F.coalesce((F.get("words", place + F.lit(i)) == F.lit(w)).cast("int"), F.lit(0))
            for i, w in enumerate(template.words)
        ]
        return sum(equal[1:], equal[0]) / F.lit(float(len(template.words)))

    if template.base:
        return (F.size(places) > 0).cast("double")
    return F.coalesce(F.array_max(F.transform(places, share)), F.lit(0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts every place of a name; ``first_word`` and ``last_word`` are the first
    and last of them. ``labels`` adds the notices whose key phrases were verified. ``score``
    is the largest share of a template's words found at one place.

    Null texts count as empty: no words, no labels, null places, score 0. Null ids and
    repeated rows give a row each; overlapping places all count. An empty table gives no
    rows. Other columns are not read.
    """
    every = templates()
    lexicon = sorted({w for t in every for w in t.words})
    idf = rarity(docs, text_col, lexicon)
    rare = sorted({t.words[i] for t in every for i in _rare(t, idf)})
    rows = docs.select(F.col(id_col).alias("id"), words_of(text_col).alias("words")).withColumn(
        "marks",
        F.array_compact(F.transform(
            "words", lambda w, i: F.when(w.isin(rare), F.struct(w.alias("word"), i.alias("at")))
        )),
    )
    rows = rows.select("id", "words", F.when(F.size("marks") > 0, F.col("marks")).alias("marks"))
    spots = F.struct(*[_verified(t, idf).alias(t.label) for t in every])
    rows = rows.withColumn("spots", F.when(F.col("marks").isNotNull(), spots))
    names = [t for t in every if t.base]
    base = F.concat(*[F.col("spots")[t.label] for t in names])

    def listed(chosen: list[Template]) -> Column:
        hit = [F.when(F.size(F.col("spots")[t.label]) > 0, F.lit(t.label)) for t in sorted(chosen, key=lambda t: t.label)]
        return F.concat_ws(",", *hit)

    rows = rows.withColumn("base", base)
    none = F.col("spots").isNull()
    score = F.greatest(*[_likeness(t, F.col("spots")[t.label]) for t in every])
    return rows.select(
        F.col("id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        F.when(none, F.lit(0)).otherwise(F.size("base")).cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        F.when(none, F.lit("")).otherwise(listed(names)).alias("base_labels"),
        F.when(none, F.lit("")).otherwise(listed(every)).alias("labels"),
        F.when(none, F.lit(0.0)).otherwise(score).alias("score"),
    )
