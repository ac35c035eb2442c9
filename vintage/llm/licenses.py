"""Licence scans with a positional index of rare words.

Every licence template is a sequence of words with mandatory key phrases. The words of all templates
are looked for in the whole corpus, and how many files hold each gives its inverse document frequency.
The index holds, per template, the positions of its ``RARE`` words of highest such frequency. A file's
words that are in the index are looked up; those that agree on the difference between their place in the
file and in the template stand for one copy of it. A copy counts if all key phrases stand at their
places there and the agreeing words carry enough of the template's weight.

Base phrases are reported at all their places, whatever the templates say.

Defined results: a null text is the empty text, which has no words; labels are distinct, sorted and
comma-joined, "" if there are none; the score is the best coverage among the found templates, 0 if none;
repeated rows are scanned each on its own; an empty table gives an empty result. Texts are scanned whole, also
very long ones; the words of a text must fit in a task. Columns outside ``carry`` are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.staging import inline, packed, stage
from vintage.llm.text import whole

#: Characters between words: ASCII other than digits and letters.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wording of public licence notices, label -> (words, key phrases, all of which must stand in their places).
TEMPLATES = {
    "gpl": ("this work is licensed under the gnu general public license", ("gnu general public license",)),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", ("general public license version 2",)),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("general public license version 3",)),
    "lgpl": ("licensed under the gnu lesser general public license", ("lesser general public license",)),
    "agpl": ("licensed under the gnu affero general public license", ("affero general public license",)),
    "apache": ("licensed under the apache license", ("apache license",)),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "mit": ("released under the mit license", ("mit license",)),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify",),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    "cc-by": ("licensed under cc by", ("cc by",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa": ("licensed under cc by sa", ("cc by sa",)),
    "cc-by-nc": ("licensed under cc by nc", ("cc by nc",)),
    "cc-by-nd": ("licensed under cc by nd", ("cc by nd",)),
    "cc0": ("to the extent possible under law the author has waived all copyright cc0 1 0 universal", ("cc0 1 0",)),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    "all-rights-reserved": ("copyright all rights reserved", ("all rights reserved",)),
}
RARE = 6
MIN_COVERAGE = 0.6
#: Words of templates too common in any text to be looked up; phrases may hold them all the same.
COMMON = frozenset(
    "a and any are by for free in into is it met of or that the this to use with without has all 0 1 2 3 4 v".split()
)


def _phrases() -> list[str]:
    return sorted({*BASE, *(p for _, keys in TEMPLATES.values() for p in keys)})


def _lookups() -> list[str]:
    every = {w for text, _ in TEMPLATES.values() for w in text.split()} | {w for p in BASE for w in p.split()}
    return sorted(every - COMMON)


def _anchor(phrase: str) -> int:
    """The place in a phrase of a word that is looked up."""
    return next(i for i, w in enumerate(phrase.split()) if w not in COMMON)


def scanned(df: DataFrame, carry: list[str]) -> DataFrame:
    """Per row of ``df``: ``row``, ``rid``, ``n_words``, ``hits`` (looked-up words and their places) and ``places`` by phrase.

    Lower-casing reaches further than ASCII, so the one letter that it would turn into an ASCII one is
    put out of its way; words of other letters equal no word looked for either way.
    """
    text = F.lower(F.replace(whole(F.col("text")), F.lit("K"), F.lit("ĸ")))
    words = df.select(packed(df, carry).alias("row"), F.array_remove(F.split(text, _GAPS), "").alias("words"))
    wanted = _lookups()
    hits = words.withColumn(
        "hits",
        F.when(
            F.size("words") > 0,
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(*wanted)),
                lambda i: F.struct(F.get("words", i).alias("w"), i.alias("at")),
            ),
        ),
    )

    def starts(phrase: str) -> Column:
        parts, anchor = phrase.split(), _anchor(phrase)

        def stands(hit: Column) -> Column:
            found = hit["w"] == parts[anchor]
            for k, word in enumerate(parts):
                if k != anchor:
                    found = found & (F.coalesce(F.get("words", hit["at"] + (k - anchor)), F.lit("")) == word)
            return found

        return F.transform(F.filter("hits", stands), lambda h: h["at"] - anchor)

    found = F.when(F.size("hits") > 0, F.struct(*(starts(p).alias(f"p{k}") for k, p in enumerate(_phrases()))))
    return hits.select(
        "row", F.monotonically_increasing_id().alias("rid"), F.size("words").cast("long").alias("n_words"),
        "hits", found.alias("places"),
    )


def index(n_files: int, holding: dict[str, int]) -> list[tuple[str, str, int, float]]:
    """Postings (template, word, position, share of the template's weight) of each template's rarest words."""
    postings = []
    for label, (text, _) in TEMPLATES.items():
        words = text.split()
        idf = {w: math.log(1 + n_files / (1 + holding.get(w, 0))) for w in words if w not in COMMON}
        rare = sorted(idf, key=lambda w: (-idf[w], w))[:RARE]
        total = sum(idf[w] for w in words if w in rare) or 1.0
        postings += [(label, w, i, idf[w] / total) for i, w in enumerate(words) if w in rare]
    return postings


def scan(df: DataFrame, carry: list[str]) -> DataFrame:
    """``row``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` per row of ``df``."""
    files = stage(scanned(df, carry))
    holding = files.select(F.explode(F.array_distinct("hits.w")).alias("w")).groupBy("w").count()
    postings = index(files.count(), {r["w"]: r["count"] for r in holding.collect()})
    lookup = inline(df.sparkSession, "label, w, position, weight", postings)
    offsets = lambda text, phrase: [
        i for i in range(len(text.split())) if text.split()[i : i + len(phrase.split())] == phrase.split()
    ]
    names = _phrases()
    keys = inline(
        df.sparkSession, "label, phrase, position, n_keys",
        [(label, names.index(p), i, len(set(phrases))) for label, (text, phrases) in TEMPLATES.items() for p in phrases for i in offsets(text, p)],
    )
    some = files.filter(F.size("hits") > 0)
    no_key = [F.lit(None).cast("int").alias(c) for c in ("phrase", "n_keys")]
    aligned = (
        some.select("rid", F.explode("hits").alias("hit"))
        .select("rid", "hit.w", "hit.at")
        .join(F.broadcast(lookup), "w")
        .select("rid", "label", (F.col("at") - F.col("position")).alias("start"), "weight", *no_key)
    )
    every_place = F.array(*(F.struct(F.lit(k).alias("phrase"), F.col(f"places.p{k}").alias("at")) for k in range(len(names))))
    verified = (
        some.select("rid", F.explode(F.filter(every_place, lambda p: F.size(p["at"]) > 0)).alias("p"))
        .select("rid", "p.phrase", F.explode("p.at").alias("at"))
        .join(F.broadcast(keys), "phrase")
        .select("rid", "label", (F.col("at") - F.col("position")).alias("start"), F.lit(0.0).alias("weight"), "phrase", "n_keys")
    )
    copies = (
        aligned.union(verified)
        .groupBy("rid", "label", "start")
        .agg(
            F.sum(F.round("weight", 12).cast("decimal(20,12)")).cast("double").alias("coverage"),
            F.size(F.collect_set("phrase")).alias("n_found"),
            F.max("n_keys").alias("n_keys"),
        )
        .filter((F.col("n_found") == F.col("n_keys")) & (F.col("coverage") >= MIN_COVERAGE))
    )
    found = copies.groupBy("rid").agg(
        F.collect_set("label").alias("found"), F.least(F.max("coverage"), F.lit(1.0)).alias("best")
    ).withColumnRenamed("rid", "of")
    base = {label: F.col(f"places.p{names.index(phrase)}") for phrase, label in BASE.items()}
    empty = F.array().cast("array<int>")
    starts = F.concat(*(F.coalesce(at, empty) for at in base.values()))
    labels = F.array_sort(F.filter(F.array(*(F.when(F.size(at) > 0, F.lit(name)) for name, at in base.items())), lambda x: x.isNotNull()))
    return files.join(found, F.col("rid") == F.col("of"), "left").select(
        "row",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
