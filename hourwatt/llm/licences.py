"""Licence scans by a positional index of rare words, with DataFrame functions only.

Templates are sentences of well-known licences. A text's licence words are the words of the
templates, weighed by inverse document frequency over the corpus. Each template is posted under its
highest-weighted words (word, template, position), as many as leave no place with enough of its words
without a posting; a posting proposes the place where the template would begin. There all of its words are
counted, and places with enough of them are checked for the template's mandatory phrase.
Base phrases are postings like any other: each place of a phrase is found from its rarest word
and verified word by word.

Null and empty texts have no words and no labels. Texts with several licences get all labels. Rows
are scanned one by one: repeated rows get equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.common import handed_over

# A word, the base phrases with their labels, and opening or defining sentences of licences.
LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE: dict[str, str] = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: label: (sentence, phrase that must stand in it)
TEMPLATES: dict[str, tuple[str, str]] = {
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files", "permission is hereby granted free of charge",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met", "redistribution and use in source and binary forms",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted", "permission to use copy modify",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license",
    ),
    "lgpl": ("gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    "agpl": ("gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license", "this program is free software",
    ),
    "gpl-work": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license"),
    "apache-notice": ("licensed under the apache license version 2 0", "licensed under the apache license"),
    "mit-notice": ("released under the mit license", "released under the mit license"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "cc by sa"),
    "creative-commons": ("licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "unencumbered software"),
    "epl": ("this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
}
#: Words of the phrases that ordinary texts use too; every phrase has others besides.
COMMON = frozenset(
    "a an and any are as binary by copy following for forms free general in is it modify of on or public source that the this to"
    " under use version with work you".split()
)
LEAST_SHARE = 0.6  # of a template's words that must stand in place


def words_of(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(LICENCE_WORD), F.lit(0))


def _phrase_at(words: Column, start: Column, phrase: Column) -> Column:
    """Whether the words of ``phrase`` stand in ``words`` from ``start`` (from 0) on."""
    return (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(phrase)) == phrase)


def scan(
    docs: DataFrame, text: str = "text", base: Mapping[str, str] = BASE,
    templates: Mapping[str, tuple[str, str]] = TEMPLATES, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``score`` is the largest share of a found template's words that stand in place, 1 for a base phrase.
    """
    spark = docs.sparkSession
    index = [(label, "base", phrase.split(), phrase.split()) for phrase, label in base.items()]
    index += [(label, "template", s.split(), must.split()) for label, (s, must) in templates.items()]
    licence_words = sorted({w for _, _, words, _ in index for w in words})
    # A phrase of common words alone is looked for by all of them.
    signal = sorted({w for _, _, _, must in index for w in (set(must) - COMMON or must)})
    words, spots = F.col("words"), F.col("spots")
    # A text keeps its words only if it holds a word that some phrase cannot do without.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col(text)).alias("words"))
    rows = rows.select("doc_id", words, F.array_intersect(words, F.lit(licence_words)).alias("kinds"))
    held = F.arrays_overlap("kinds", F.lit(signal))
    rows = handed_over(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), "kinds",
            F.when(held, words).alias("words"),
        ),
        "licence-words",
    )
    # Inverse document frequency of the licence words over all texts: one row per word.
    counts = rows.select(F.explode("kinds").alias("w")).groupBy("w").count().collect()
    n_docs = rows.count()
    weights = {w: math.log((n_docs + 1) / n) for w, n in counts}
    rank = {w: k for k, w in enumerate(sorted(licence_words, key=lambda w: (-weights.get(w, 99.0), w)))}
    # A base phrase is posted under its rarest word alone. With the least number of words in place, a template
    # lacks size - least of them, so one of any size - least + 1 is in place.
    postings = []
    for label, kind, ws, must in index:
        least = max(1, math.ceil(least_share * len(ws) - 1e-9)) if kind == "template" else len(ws)
        for i in sorted(range(len(ws)), key=lambda k: rank[ws[k]])[: len(ws) - least + 1]:
            postings.append((ws[i], label, i, len(ws), ws, must, kind == "base"))
    posted = spark.createDataFrame(
        postings, "w string, label string, at int, size int, phrase array<string>, must array<string>, base boolean"
    )  # as many rows as the templates have words
    posted_words = sorted({p[0] for p in postings})
    spots = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(posted_words))
    texts = rows.where(words.isNotNull())
    place = (F.col("spot.i") - F.col("at")).alias("place")
    looked_up = texts.select("row", "words", F.explode(spots).alias("spot")).join(
        F.broadcast(posted), F.col("spot.w") == F.col("w")
    )
    # Base phrases: every place, whatever else the text holds.
    hits = (
        looked_up.where(F.col("base") & _phrase_at(words, F.col("spot.i") - F.col("at"), F.col("phrase")))
        .select("row", "label", place)
        .groupBy("row")
        .agg(
            F.count("*").alias("n_base"), F.min("place").cast("long").alias("first_word"),
            F.max("place").cast("long").alias("last_word"), F.collect_set("label").alias("base_set"),
        )
    )
    # Templates: each proposed place is counted word by word.
    in_place = F.filter(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.get(words, F.col("place") + i) == F.get(F.col("phrase"), i)
    )
    inside = F.sequence(F.greatest(F.col("place"), F.lit(0)), F.greatest(F.col("place") + F.col("size") - F.size("must"), F.lit(0)))
    near = F.exists(inside, lambda k: F.slice(words, k + 1, F.size("must")) == F.col("must"))
    found = (
        looked_up.where(~F.col("base"))
        .select("row", "words", "label", "size", "phrase", "must", place)
        .withColumn("n", F.size(in_place))
        .where((F.col("n") >= least_share * F.col("size")) & near)
        .groupBy("row")
        .agg(F.collect_set("label").alias("label_set"), F.max(F.col("n") / F.col("size")).alias("share"))
    )
    empty = F.array().cast("array<string>")
    base_set, label_set = F.coalesce("base_set", empty), F.coalesce("label_set", empty)
    return (
        rows.select("row", "doc_id", "n_words")
        .join(hits, "row", "left")
        .join(found, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
            F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base_set, label_set)), ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        )
    )
